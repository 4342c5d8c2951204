"""Dedup, ordered merges and comparisons. Whatever comes first or last is so by an explicit order column, never by arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row for each key, the first by order. A grouped minimum: nothing is sorted and a hot key is pre-aggregated."""
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), by).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def last_wins(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row for each key, the last by order."""
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def insert_only(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """existing and those rows of new whose key it lacks."""
    return existing.unionByName(new.join(existing.select(*keys), keys, "left_anti"))


def first_non_null(df: DataFrame, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """For each key and field the first value by order that is neither null nor, in a string, empty. Rows that order leaves level give either's value: it should tell all rows of a key apart."""
    by = F.struct(*order)
    present = {f: F.when(F.col(f) != "", F.col(f)) if df.schema[f].dataType.simpleString() == "string" else F.col(f) for f in fields}
    return df.groupBy(*keys).agg(*[F.min_by(v, F.when(v.isNotNull(), by)).alias(f) for f, v in present.items()])


def full_outer_diff(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, side (both, left or right) and for each field whether the sides agree, null agreeing with null."""
    a = left.select(F.col(key).alias("k"), F.struct(*fields).alias("l"))
    b = right.select(F.col(key).alias("k"), F.struct(*fields).alias("r"))
    j = a.join(b, "k", "full_outer")
    side = F.when(F.isnull("r"), "left").when(F.isnull("l"), "right").otherwise("both")
    both = side == "both"
    return j.select(F.col("k").alias(key), side.alias("side"), *[F.when(both, F.col(f"l.{f}").eqNullSafe(F.col(f"r.{f}"))).alias(f"same_{f}") for f in fields])


def mismatch_report(diff: DataFrame, key: str, fields: list[str], samples: int = 8) -> DataFrame:
    """field, mismatches, and the least keys among them, comma-joined, samples at most."""
    tall = diff.filter("side = 'both'").select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"same_{f}").alias("same")) for f in fields])).alias("x")).select(key, "x.*").filter("not same")
    ranked = tall.withColumn("n", F.row_number().over(Window.partitionBy("field").orderBy(key)))
    counts = tall.groupBy("field").agg(F.count("*").alias("mismatches"))
    some = ranked.filter(F.col("n") <= samples).groupBy("field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda k: k.cast("string")), ",").alias("samples"))
    return counts.join(some, "field")


def unique_claims(aliases: DataFrame, alias: str, target: str, canonical: DataFrame, canonical_key: str) -> DataFrame:
    """alias, target for aliases that one target alone claims and that are no canonical name themselves."""
    one = aliases.groupBy(alias).agg(F.count_distinct(target).alias("n"), F.min(target).alias(target)).filter("n = 1").drop("n")
    return one.join(canonical.select(F.col(canonical_key).alias(alias)).distinct(), alias, "left_anti")


def unique_or_unresolved(rows: DataFrame, key: str, candidates: DataFrame, candidate_key: str, ref: str) -> DataFrame:
    """rows with ref where exactly one candidate has the key, else null: never a guess."""
    one = candidates.groupBy(F.col(candidate_key).alias("_k")).agg(F.count_distinct(ref).alias("_n"), F.min(ref).alias(ref)).filter("_n = 1").drop("_n")
    return rows.join(one, rows[key] == one["_k"], "left").drop("_k")


def overlapping(rows: DataFrame, key: str, start: str, end: str, occurrences: DataFrame, o_key: str, o_start: str, o_end: str) -> DataFrame:
    """Rows joined to the occurrences of their key whose interval meets theirs."""
    return rows.join(occurrences, (rows[key] == occurrences[o_key]) & (rows[start] <= occurrences[o_end]) & (rows[end] >= occurrences[o_start]))
