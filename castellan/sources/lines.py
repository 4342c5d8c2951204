"""The line format of player blocks and normalisation tables, read by Spark's text source: no file passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SECTIONS = ("PLAYER", "EVENT", "SITE", "ROUND")


def section_of_header(line: Column) -> Column:
    """The section a header opens, OTHER for an unknown one; null for any other line."""
    name = F.lit("OTHER")
    for s in SECTIONS:
        name = F.when(line.startswith(f"@{s}"), s).otherwise(name)
    return F.when(line.startswith("@"), name)


def sectioned_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, line_no (from 1, in the file), value, line (trimmed), indented, header and section (null before the first header).

    Files are split in blocks as Spark splits them: a block's lines before its first header belong to the last header of the blocks before, of
    which each leaves one row."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    line = F.trim(F.regexp_replace("value", r"^[\t ]+|[\t\r ]+$", ""))
    raw = raw.select("file", "block", "at", "value", line.alias("line"), F.col("value").rlike("^[ \t]").alias("indented")).withColumn("header", section_of_header(F.col("line")))
    own = F.last("header", ignorenulls=True).over(Window.partitionBy("file", "block").orderBy("at"))
    last = raw.groupBy("file", "block").agg(F.max_by("header", F.when(F.col("header").isNotNull(), F.col("at"))).alias("last"), F.min("at").alias("first_at"), F.count("*").alias("lines"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select(F.col("file").alias("f"), F.col("block").alias("b"), F.last("last", ignorenulls=True).over(earlier).alias("before"), (F.coalesce(F.sum("lines").over(earlier), F.lit(0)) - F.col("first_at") + 1).alias("shift"))
    j = raw.withColumn("own", own).join(last, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    return j.select("file", "block", (F.col("at") + F.col("shift")).alias("line_no"), "value", "line", "indented", "header", F.coalesce("own", "before").alias("section"))


def line_kind(line: Column, indented: Column, section: Column, header: Column) -> Column:
    """What a line counts as: comment, record, alias, elo, fide_id or rule; null for headers, blank lines and what counts as nothing."""
    detail = F.when(line.startswith("= "), "alias").when(line.startswith("%Elo"), "elo").when(line.startswith("%Bio") & line.contains("FIDE"), "fide_id")
    own = F.when(section == "PLAYER", F.when(indented, detail).otherwise("record")).when(section.isin(*SECTIONS[1:]), F.concat(F.lower(section), F.lit("_rule")))
    return F.when((line == "") | header.isNotNull(), None).when(~indented & line.startswith("#"), "comment").otherwise(own)


def section_counts(spark: SparkSession, path: str) -> DataFrame:
    """kind and n: lines, comments, player records, their aliases, rating lines and FIDE ids, and the rules of each other section."""
    s = sectioned_lines(spark, path).select(line_kind(F.col("line"), F.col("indented"), F.col("section"), F.col("header")).alias("kind"))
    counted = F.explode(F.array(F.lit("line"), "kind"))
    return s.select(counted.alias("kind")).filter("kind is not null").groupBy("kind").agg(F.count("*").alias("n"))
