"""Registries and tables: XML shards, crosstable JSON, opening tables and spreadsheets."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OPENINGS = "eco string, name string, pgn string, uci string, epd string"
PLACE = "`_ref` string, `_kind` string, `ctml:name` string, `ctml:country` string, `ctml:admin1` string, `ctml:parentRef` string, `ctml:wikiDataId` string, `ctml:latitude` decimal(11,8), `ctml:longitude` decimal(11,8)"
PLAYER_ROW = "rank:bigint,name:string,title:string,fed:string,rating:bigint,score:double,fide_id:string,seed:string,source_id:string,sex:string,club:string,ref:string"
CROSSTABLE = f"event string, header string, format string, source string, ref string, event_ref string, start string, end string, place string, country string, cadence string, classification string, notes string, rating_system string, reader string, url string, source_path string, players array<struct<{PLAYER_ROW}>>"


def read_openings(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated opening lines under a header; a row of too few fields fails."""
    return spark.read.schema(OPENINGS).option("sep", "\t").option("header", True).option("quote", "").option("mode", "FAILFAST").csv(path)


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """Place registry shards; path may hold wildcards."""
    raw = spark.read.schema(PLACE).option("rowTag", "ctml:place").format("xml").load(path)
    return raw.select(*[F.col(f"`{c}`").alias(re.sub(r"^_|^ctml:", "", c)) for c in raw.columns])


def count_records(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """records and shards of a registry."""
    raw = spark.read.option("rowTag", row_tag).schema("`_ref` string").format("xml").load(path)
    return raw.select(F.input_file_name().alias("file")).agg(F.count("*").alias("records"), F.count_distinct("file").alias("shards"))


def element_counts(spark: SparkSession, path: str, record: str, sub: str | None = None) -> DataFrame:
    """file, records and sub_records of registry shards: start tags by local name, whatever their prefix, counted in byte ranges of lines; nothing is parsed as a document. Comments of one line do not count."""
    plain = F.regexp_replace("value", "<!--.*?-->", "")
    found = lambda name: F.sum(F.regexp_count(plain, F.lit(rf"<(?:[\w.-]+:)?{name}(?=[\s/>]|$)"))).cast("bigint")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.groupBy("file").agg(found(record).alias("records"), (found(sub) if sub else F.lit(0).cast("bigint")).alias("sub_records"))


NAME = "struct<_display:string,family:string,given:array<string>,suffix:string>"
MONTH = "struct<_num:int,_VALUE:string>"
PLAYER = (
    "`_ref` string, `ctml:name` struct<`_display`:string,`ctml:family`:string,`ctml:given`:array<string>,`ctml:suffix`:string>, `ctml:federation` string, `ctml:title` array<string>, `ctml:sex` string, "
    "`ctml:ids` struct<`ctml:fideId`:string,`ctml:internalId`:array<string>>, `ctml:birthDate` struct<`ctml:year`:struct<`_y`:int,`_VALUE`:string>>, "
    "`ctml:aliases` struct<`ctml:alias`:array<struct<`_display`:string,`ctml:family`:string,`ctml:given`:array<string>,`ctml:suffix`:string>>>, "
    "`ctml:ratingHistory` struct<`ctml:ratingTrack`:struct<`_system`:string,`ctml:current`:int,"
    "`ctml:peak`:struct<`ctml:value`:int,`ctml:achieved`:struct<`ctml:month`:struct<`_y`:int,`_m`:int,`_VALUE`:string>>>,"
    "`ctml:history`:struct<`ctml:year`:array<struct<`_value`:int,`ctml:month`:array<struct<`_num`:int,`_VALUE`:string>>>>>>>"
)


def read_player_registry(spark: SparkSession, path: str) -> DataFrame:
    """Player registry shards: ref, fide_id, display, family, given, suffix, federation, titles, female, birth_year, ids, aliases (family, given,
    suffix), rating_system, current_rating, peak, peak_year, peak_month and history (year and its months with ratings, null for unrated ones). Players are read a
    shard at a time by the row tag; path may hold wildcards."""
    raw = spark.read.schema(PLAYER).option("rowTag", "ctml:player").format("xml").load(path)
    at = lambda p: F.col(".".join(f"`{x if x.startswith('_') else 'ctml:' + x}`" for x in p.split(".")))
    name = lambda n: F.struct(F.coalesce(n["ctml:family"], F.lit("")).alias("family"), F.coalesce(n["ctml:given"], F.array().cast("array<string>")).alias("given"), n["ctml:suffix"].alias("suffix"))
    own, none = name(F.col("`ctml:name`")), F.array().cast("array<string>")
    track = "ratingHistory.ratingTrack"
    aliases = F.coalesce(F.transform(at("aliases.alias"), name), F.array().cast("array<struct<family:string,given:array<string>,suffix:string>>"))
    years = F.transform(at(f"{track}.history.year"), lambda y: F.struct(y["_value"].alias("year"), F.transform(y["ctml:month"], lambda m: F.struct(m["_num"].alias("month"), m["_VALUE"].try_cast("int").alias("rating"))).alias("months")))
    return raw.select(
        F.col("`_ref`").alias("ref"), at("ids.fideId").alias("fide_id"), at("name._display").alias("display"), own["family"].alias("family"), own["given"].alias("given"), own["suffix"].alias("suffix"),
        at("federation").alias("federation"), F.coalesce(at("title"), none).alias("titles"), F.coalesce(F.lower(at("sex")).isin("f", "female"), F.lit(False)).alias("female"), at("birthDate.year._y").alias("birth_year"),
        F.coalesce(at("ids.internalId"), none).alias("ids"), aliases.alias("aliases"), at(f"{track}._system").alias("rating_system"), at(f"{track}.current").alias("current_rating"), at(f"{track}.peak.value").alias("peak"),
        at(f"{track}.peak.achieved.month._y").alias("peak_year"), at(f"{track}.peak.achieved.month._m").alias("peak_month"), F.coalesce(years, F.array().cast("array<struct<year:int,months:array<struct<month:int,rating:int>>>>")).alias("history"))


def read_crosstables(spark: SparkSession, path: str) -> DataFrame:
    """Crosstables, an array or lines of JSON; numbers in text fields come as text. A record without an event, a format or players fails the read."""
    raw = spark.read.schema(CROSSTABLE).option("multiLine", True).option("mode", "FAILFAST").json(path)
    needed = [F.when(F.col(c).isNull(), F.raise_error(F.lit(f"a crosstable without {c}"))).otherwise(F.col(c)).alias(c) for c in ("event", "format", "players")]
    return raw.select(*[next((n for c, n in zip(("event", "format", "players"), needed) if c == f), F.col(f)) for f in raw.columns])


def sheet_rows(data: bytes) -> Iterator[list[str]]:
    """The cells of a workbook's first sheet, by row."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        text = lambda e: "".join(t.text or "" for t in e.iter() if t.tag.endswith("}t"))
        shared = [text(e) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        sheet = ElementTree.fromstring(z.read(min(n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))))
    for row in (e for e in sheet.iter() if e.tag.endswith("}row")):
        cells: dict[int, str] = {}
        for c in row:
            letters = re.match(r"[A-Z]+", c.get("r", ""))
            at = sum((ord(x) - 64) * 26**i for i, x in enumerate(reversed(letters[0]))) - 1 if letters else len(cells)
            value = next((v.text or "" for v in c if v.tag.endswith("}v")), "")
            cells[at] = shared[int(value)] if c.get("t") == "s" and value else text(c) if c.get("t") == "inlineStr" else value
        yield [cells.get(i, "") for i in range(max(cells, default=-1) + 1)]


def read_sheets(spark: SparkSession, path: str) -> DataFrame:
    """file, row (from 0) and cells of the first sheet of each workbook."""


    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, data in zip(b.column(0).to_pylist(), b.column(1)):
                cells = list(sheet_rows(data.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(cells), pa.string()), pa.array(range(len(cells)), pa.int32()), pa.array(cells, pa.list_(pa.string()))], ["file", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, row int, cells array<string>")
