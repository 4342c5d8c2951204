"""Orders and running totals that no single task must hold: a hot key's rows are dealt by range and cut in runs of 4,096."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castellan.workspace import keep

#: Rows in a run, as a power of two.
RUN = 12


def in_order(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """df dealt by ranges of keys (null first), sorted, written and reread, with pos: a long that ascends with keys. Equal rows are told apart by arrival, so
    that even a third of all rows being equal splits; as they are equal, it does not matter which comes first."""
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    return keep(tied.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie").withColumn("pos", F.monotonically_increasing_id()), name)


def running(df: DataFrame, key: str, at: str, values: dict[str, Column], total, join) -> DataFrame:
    """df with a running total up to and with each row of its key by `at`: total (an aggregate such as F.bit_xor) within a run of rows, and
    join(total of the runs before, total in the run). A key's runs are one row each where they are added up."""
    run = df.withColumns({"_run": F.shiftright(F.col(at), RUN), **{f"_v{i}": v for i, v in enumerate(values.values())}})
    sums = run.groupBy(key, "_run").agg(*[total(F.col(f"_v{i}")).alias(f"_s{i}") for i in range(len(values))])
    before = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(key).alias("_key"), F.col("_run").alias("_r"), *[F.coalesce(total(F.col(f"_s{i}")).over(before), F.lit(0)).alias(f"_b{i}") for i in range(len(values))])
    within = Window.partitionBy(key, "_run").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    both = run.join(sums, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_run") == F.col("_r")))
    return both.select(*df.columns, *[join(F.col(f"_b{i}"), total(F.col(f"_v{i}")).over(within)).alias(n) for i, n in enumerate(values)])
