"""The event registry: series, and occurrences that may take their series' name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castellan.functions.text import normalize_space

SERIES = "`_ref` string, `ctml:name` string"
_PLACE = "struct<`_ref`:string,`ctml:name`:string>"
OCCURRENCE = f"`_ref` string, `ctml:seriesRef` string, `ctml:name` string, `ctml:aliases` struct<`ctml:alias`:array<struct<`_VALUE`:string,`_source`:string,`_site`:string>>>, `ctml:placeRef` array<{_PLACE}>, `ctml:notes` string"


def read_event_records(spark: SparkSession, path: str, priority: int = 0) -> DataFrame:
    """ref, name, aliases, sites, place_refs, place_names, notes and priority of every named series and occurrence of event registries.

    An occurrence without a name takes that of its series; one without either is left out, as are blank aliases, sites and places."""

    def read(tag: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).option("rowTag", f"ctml:{tag}").format("xml").load(path)

    def filled(c):
        return F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), normalize_space), lambda x: x.isNotNull() & (x != ""))))

    named = read("eventSeries", SERIES).select(F.trim("`_ref`").alias("ref"), normalize_space(F.col("`ctml:name`")).alias("name")).filter("ref <> '' and name <> ''")
    alias, place = F.col("`ctml:aliases`")["ctml:alias"], F.col("`ctml:placeRef`")
    o = read("eventOccurrence", OCCURRENCE).select(
        F.trim("`_ref`").alias("ref"), F.nullif(normalize_space(F.col("`ctml:name`")), F.lit("")).alias("own"), normalize_space(F.col("`ctml:seriesRef`")).alias("series"),
        filled(F.transform(alias, lambda a: a["_VALUE"])).alias("aliases"), filled(F.transform(alias, lambda a: a["_site"])).alias("sites"),
        filled(F.transform(place, lambda p: p["_ref"])).alias("place_refs"), filled(F.transform(place, lambda p: p["ctml:name"])).alias("place_names"), F.col("`ctml:notes`").alias("notes"))
    by_ref = named.groupBy(F.col("ref").alias("series")).agg(F.max("name").alias("series_name"))
    o = o.join(by_ref, "series", "left").withColumn("name", F.coalesce("own", "series_name")).filter("name is not null")
    none = F.array().cast("array<string>")
    columns = ["ref", "name", "aliases", "sites", "place_refs", "place_names", "notes"]
    series = named.select("ref", "name", *[none.alias(c) for c in columns[2:6]], F.lit(None).cast("string").alias("notes"))
    return series.unionByName(o.select(*columns)).withColumn("priority", F.lit(priority))


def referenced(events: DataFrame, pattern: str = r"^Edo tournament (t\d+)$") -> DataFrame:
    """key and ref: the occurrence that names a record of another collection in its notes; the last ref of a key by name."""
    key = F.regexp_extract(F.trim("notes"), pattern, 1)
    return events.filter("ref is not null and notes is not null").select(key.alias("key"), "ref").filter("key <> ''").groupBy("key").agg(F.max("ref").alias("ref"))
