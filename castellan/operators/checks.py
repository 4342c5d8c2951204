"""Data-quality rules over tournament documents: each gives the rows or groups that break it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castellan.functions import dates


def out_of_order(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows whose start is after their end, where both are known."""
    return df.filter(start > end)


def dates_out_of_order(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows whose partial dates are both days of the calendar and the start is after the end; a date of a year or month alone says nothing about order."""
    return df.filter(dates.iso(start) > dates.iso(end))


def same_both_sides(df: DataFrame, one: str, other: str) -> DataFrame:
    return df.filter(F.col(one) == F.col(other))


def broken_sequences(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Groups whose numbers are not 1 to n, each once: problem is duplicate, gap or both."""
    g = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(number).alias("distinct"), F.min(number).alias("first"), F.max(number).alias("last"))
    dup = F.col("n") != F.col("distinct")
    gap = (F.col("first") != 1) | (F.col("last") - F.col("first") + 1 != F.col("distinct"))
    return g.withColumn("problem", F.when(dup & gap, "both").when(dup, "duplicate").when(gap, "gap")).filter("problem is not null")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference resolves to nothing."""
    return df.join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def count_mismatch(heads: DataFrame, key: str, stated: str, parts: DataFrame, part_key: str) -> DataFrame:
    """Heads whose stated count is not the number of their parts."""
    n = parts.groupBy(F.col(part_key).alias(key)).agg(F.count("*").alias("found"))
    return heads.join(n, key, "left").withColumn("found", F.coalesce("found", F.lit(0))).filter(F.col(stated) != F.col("found"))


def value_problems(rows: DataFrame, rating: str, day: str, month: str, year: str) -> DataFrame:
    """rows with a problem, a row for each: a rating outside 0 to 4000, a day outside 1 to 31, a month outside 1 to 12, a day without a month, a
    month without a year. Null values have none."""
    outside = lambda c, low, high: ~F.col(c).between(low, high)
    found = F.array_compact(F.array(
        F.when(outside(rating, 0, 4000), "rating out of range"), F.when(outside(day, 1, 31), "day out of range"), F.when(outside(month, 1, 12), "month out of range"),
        F.when(F.col(day).isNotNull() & F.col(month).isNull(), "day without a month"), F.when(F.col(month).isNotNull() & F.col(year).isNull(), "month without a year")))
    return rows.withColumn("problem", F.explode(found))


def base_problems(lines: DataFrame, generated: tuple[str, ...] = ("@SITE", "@EVENT", "@ROUND")) -> DataFrame:
    """One row about the lines (column value) of a base file: markers (how many), has_players, generated (sections that must not be there,
    sorted), replacement_characters and usable."""
    marker = F.upper(F.regexp_extract("value", r"^\s*(@\S*)", 1))
    n = F.length("value") - F.length(F.replace("value", F.lit("�"), F.lit("")))
    r = lines.select(marker.alias("m"), n.alias("n")).agg(
        F.count_if(F.col("m") != "").alias("markers"), F.coalesce(F.bool_or(F.col("m") == "@PLAYER"), F.lit(False)).alias("has_players"),
        F.array_sort(F.collect_set(F.when(F.col("m").isin(*generated), F.col("m")))).alias("generated"), F.coalesce(F.sum("n"), F.lit(0)).alias("replacement_characters"))
    return r.withColumn("usable", F.col("has_players") & (F.size("generated") == 0))
