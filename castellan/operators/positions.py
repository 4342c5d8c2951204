"""Row numbers over a whole table without bringing it to one task: rows are dealt by range, and counts by partition are added up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from castellan.workspace import keep


def positioned(df: DataFrame, keys: list[str], position: str = "position") -> DataFrame:
    """df with its rows' places (from 1) in the order of keys, null first. Equal rows get places of their own, in no set order."""
    rows = keep(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "in-order")
    part = F.shiftright("_at", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_part", (before - F.col("_first") + 1).alias("_shift"))
    return rows.join(counts, part == F.col("_part")).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(position))


def offset_limit(df: DataFrame, keys: list[str], skip: int, limit: int | None = None) -> DataFrame:
    """The rows behind the first `skip` by keys, `limit` of them if given."""
    p = positioned(df, keys, "_position").filter(F.col("_position") > skip)
    return (p if limit is None else p.filter(F.col("_position") <= skip + limit)).drop("_position")
