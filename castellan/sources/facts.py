"""Tournament facts of several sources as one table: crosstables and tournament documents brought to the same columns."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castellan.functions import dates, names
from castellan.functions.text import int_like, normalize_space
from castellan.sources.registry import CROSSTABLE
from castellan.workspace import hadoop, keep

_DAY = "`_y`:int,`_m`:int,`_d`:int"
_DATE = f"struct<{_DAY},`ctml:day`:struct<{_DAY}>,`ctml:month`:struct<{_DAY}>,`ctml:year`:struct<{_DAY}>>"
_PARTICIPANT = (
    "struct<`ctml:playerRef`:struct<`_ref`:string,`ctml:name`:struct<`_display`:string,`_VALUE`:string,`ctml:family`:string,`ctml:given`:array<string>,`ctml:unstructured`:string>,`ctml:federation`:string,`ctml:title`:string,"
    "`ctml:ids`:struct<`ctml:fideId`:string>>,`ctml:ratingSnapshot`:array<struct<`ctml:value`:string>>,`ctml:score`:string,`ctml:notes`:string>"
)
DOCUMENT = (
    f"`_id` string, `ctml:header` struct<`ctml:name`:string,`ctml:eventRef`:struct<`_ref`:string>,`ctml:dates`:struct<`ctml:start`:{_DATE},`ctml:end`:{_DATE}>,`ctml:placeRef`:struct<`ctml:name`:string>>, "
    f"`ctml:participants` struct<`ctml:participant`:array<{_PARTICIPANT}>>, `ctml:source` struct<`_kind`:string,`ctml:uri`:string>"
)


def squeezed(x: Column) -> Column:
    """Single blanks, none at the ends; empty for null."""
    return F.coalesce(normalize_space(x.cast("string")), F.lit(""))


def points(x: Column) -> Column:
    """A score as a number: a comma is a point, and a half sign a half."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(x.cast("string")), ",", "."), "^½$", "0.5"), "½$", ".5").try_cast("double")


def rank_of_notes(notes: Column) -> Column:
    return F.nullif(F.regexp_extract(notes, r"rank=(\d+)", 1), F.lit("")).try_cast("bigint")


def _participant(ref: Column, name: Column, fed: Column, title: Column, fide_id: Column, rating: Column, score: Column, rank: Column) -> Column:
    parts = {"ref": ref, "name": name, "fed": F.coalesce(names.normalize_federation(fed), F.lit("")), "title": squeezed(title), "fide_id": fide_id, "rating": rating, "score": score, "rank": rank}
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def _stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)


def crosstable_facts(spark: SparkSession, path: str) -> DataFrame:
    """Facts of a crosstable file: file, row_index (from 1, left-out tables counted), tid, source (the folder's name where none is given),
    source_uri, name, event_ref, start, end (the start where none is given), place, participants. Tables without a start date or a named player
    are left out; a federation's id gives a player without a reference one."""
    raw = spark.read.schema(CROSSTABLE).option("multiLine", True).json(path).select("*", F.col("_metadata.file_path").alias("file"))
    # an array is read by one task, in order, so its rows' ids ascend within the file
    raw = raw.withColumn("_at", F.monotonically_increasing_id()).withColumn("row_index", F.row_number().over(Window.partitionBy("file").orderBy("_at")))
    start = dates.parse_iso(F.col("start"))

    def one(p: Column) -> Column:
        fide, ref = squeezed(p["fide_id"]), squeezed(p["ref"])
        known = F.when((ref == "") & fide.rlike(r"^\d{4,12}$"), F.concat(F.lit("player:fide:"), fide)).otherwise(ref)
        return _participant(known, squeezed(p["name"]), p["fed"], p["title"], fide, p["rating"], points(p["score"]), p["rank"])

    people = F.transform(F.filter("players", lambda p: squeezed(p["name"]) != ""), one)
    or_else = lambda c, other: F.coalesce(F.nullif(squeezed(F.col(c)), F.lit("")), other)
    folder = F.regexp_extract("file", r"([^/]*)/[^/]*$", 1)
    return raw.select(
        "file", "row_index", or_else("ref", F.concat(_stem(F.col("file")), F.lit("-"), F.col("row_index"))).alias("tid"), or_else("source", folder).alias("source"), squeezed(F.col("url")).alias("source_uri"),
        squeezed(F.col("event")).alias("name"), squeezed(F.col("event_ref")).alias("event_ref"), start.alias("start"), F.coalesce(dates.parse_iso(F.col("end")), start).alias("end"), squeezed(F.col("place")).alias("place"), people.alias("participants"),
    ).filter(F.col("start").isNotNull() & (F.size("participants") > 0))


def document_facts(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    """Facts of tournament documents, one a file, in the columns of crosstable_facts (row_index is 1). Documents without a start year, and files that
    hold no tournament, are left out; without a source's kind, it is the first folder below root."""
    raw = spark.read.schema(DOCUMENT).option("rowTag", "ctml:tournament").format("xml").load(path).select("*", F.col("_metadata.file_path").alias("file"))

    def at(*path: str) -> Column:
        out = F.col(f"`ctml:{path[0]}`")
        for step in path[1:]:
            out = out[step if step.startswith("_") else f"ctml:{step}"]
        return out

    def date(name: str) -> Column:
        d = at("header", "dates", name)
        part = lambda k: F.nullif(F.coalesce(d[k], d["ctml:day"][k], d["ctml:month"][k], d["ctml:year"][k]), F.lit(0))
        return F.when(part("_y").isNotNull(), dates.partial(part("_y"), part("_m"), part("_d")))

    def one(p: Column) -> Column:
        r = p["ctml:playerRef"]
        n = r["ctml:name"]
        spelled = F.concat_ws(" ", n["ctml:family"], F.array_join(n["ctml:given"], " "), n["ctml:unstructured"], n["_VALUE"])
        shown = F.coalesce(F.nullif(squeezed(n["_display"]), F.lit("")), squeezed(spelled))
        rating = F.try_element_at(p["ctml:ratingSnapshot"], F.lit(1))["ctml:value"]
        return _participant(F.coalesce(r["_ref"], F.lit("")), shown, r["ctml:federation"], r["ctml:title"], squeezed(r["ctml:ids"]["ctml:fideId"]), int_like(rating), points(p["ctml:score"]), rank_of_notes(p["ctml:notes"]))

    people = F.transform(F.filter(at("participants", "participant"), lambda p: p["ctml:playerRef"].isNotNull()), one)
    below = F.regexp_extract(F.substring_index("file", root.rstrip("/") + "/", -1) if root else F.col("file"), r"^/*([^/]+)/", 1)
    source = F.coalesce(F.nullif(F.trim(at("source", "_kind")), F.lit("")), below)
    none = F.array().cast("array<struct<ref:string,name:string,fed:string,title:string,fide_id:string,rating:bigint,score:double,rank:bigint>>")
    return raw.select(
        "file", F.lit(1).alias("row_index"), F.coalesce("`_id`", _stem(F.col("file"))).alias("tid"), source.alias("source"), squeezed(at("source", "uri")).alias("source_uri"), squeezed(at("header", "name")).alias("name"),
        F.coalesce(at("header", "eventRef", "_ref"), F.lit("")).alias("event_ref"), date("start").alias("start"), date("end").alias("end"), squeezed(at("header", "placeRef", "name")).alias("place"), F.coalesce(people, none).alias("participants"),
    ).filter(F.col("start").isNotNull())


def collected_facts(spark: SparkSession, crosstables: list[str], documents: list[str] = (), root: str = "") -> DataFrame:
    """All facts of the sources in their order, those that do not exist left out, with idx, which ascends by source, file and row.

    The ids come from one sort over all tasks, written once, so that they never change on a second reading."""

    def there(path: str) -> bool:
        store, p = hadoop(spark, path)
        return bool(store.globStatus(p))

    parts = [crosstable_facts(spark, p) for p in crosstables if there(p)] + [document_facts(spark, p, root) for p in documents if there(p)]
    if not parts:
        raise FileNotFoundError("none of the sources exists")
    ordered = [p.withColumn("source_order", F.lit(i)) for i, p in enumerate(parts)]
    return keep(functools.reduce(DataFrame.unionByName, ordered).orderBy("source_order", "file", "row_index").withColumn("idx", F.monotonically_increasing_id()), "facts")
