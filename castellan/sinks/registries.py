"""Whole registries as files: player records in shards by first letter, and generated sections behind a copy of their base."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castellan.functions import text
from castellan.operators.documents import NAMESPACE, lines, person_element
from castellan.operators.positions import positioned
from castellan.workspace import hadoop, new_path

BANNER = ("# BEGIN GENERATED NON-PLAYER SECTIONS", "# Generated; do not edit by hand.", "")
CLOSING = ("", "# END GENERATED NON-PLAYER SECTIONS")


def wrapped(indent: int, name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{' ' * indent}<ctml:{name}>"), value, F.lit(f"</ctml:{name}>"))


def player_element() -> Column:
    """A record of registries.player_records as XML: names in parts, federation, titles, ids, birth, sex, aliases and the ratings by month (? where there is none)."""
    many = lambda items, one: F.nullif(F.array_join(F.transform(items, one), "\n"), F.lit(""))
    group = lambda indent, name, inner: F.when(inner != "", lines(f"{' ' * indent}<ctml:{name}>", inner, f"{' ' * indent}</ctml:{name}>"))
    ids = F.concat_ws("\n", wrapped(6, "fideId", F.col("fide_id")), many(F.col("ids"), lambda i: wrapped(6, "internalId", text.esc(F.concat_ws(":", i["source"], i["id"])))))
    as_alias = lambda x: F.regexp_replace(F.regexp_replace(x, "^      <ctml:name ", "      <ctml:alias "), "      </ctml:name>$", "      </ctml:alias>")
    month = lambda v, i: F.concat(F.lit('            <ctml:month num="'), (i + 1).cast("string"), F.lit('">'), F.coalesce(v.cast("string"), F.lit("?")), F.lit("</ctml:month>"))
    year = lambda y: lines(F.concat(F.lit('          <ctml:year value="'), y["year"].cast("string"), F.lit('">')), F.array_join(F.transform(y["months"], month), "\n"), "          </ctml:year>")
    when = F.concat(F.lit('          <ctml:achieved><ctml:month y="'), F.col("peak_year").cast("string"), F.lit('" m="'), F.col("peak_month").cast("string"), F.lit('"/></ctml:achieved>'))
    best = group(8, "peak", F.concat_ws("\n", wrapped(10, "value", F.col("peak").cast("string")), when))
    track = lines('      <ctml:ratingTrack system="combined">', wrapped(8, "current", F.col("current_rating").cast("string")), best, group(8, "history", many(F.col("history"), year)), "      </ctml:ratingTrack>")
    return lines(
        F.concat(F.lit('  <ctml:player ref="'), text.esc(F.col("ref")), F.lit('">')), person_element(F.col("name"), 4), wrapped(4, "federation", F.nullif("federation", F.lit(""))), many(F.col("titles"), lambda t: wrapped(4, "title", t)),
        group(4, "ids", ids), F.concat(F.lit('    <ctml:birthDate><ctml:year y="'), F.col("birth_year").cast("string"), F.lit('"/></ctml:birthDate>')), F.when(F.col("female"), "    <ctml:sex>F</ctml:sex>"),
        group(4, "aliases", many(F.col("aliases"), lambda a: as_alias(person_element(a, 6)))), F.when(F.size("history") > 0, lines("    <ctml:ratingHistory>", track, "    </ctml:ratingHistory>")), "  </ctml:player>")


def player_shards(records: DataFrame, shard_records: int = 25_000) -> DataFrame:
    """file_name, xml and records of registry shards (to be written by files.write_each): players by first letter, name and reference, numbered shards where a letter has many.

    The places of players are found by ranges, so a letter that most names begin with is no single task; a shard is one row of at most so many records."""
    r = records.select(text.shard_key(F.col("name")).alias("letter"), F.lower("name").alias("folded"), "ref", player_element().alias("x"))
    r = positioned(r, ["letter", "folded", "ref"])
    first = r.groupBy(F.col("letter").alias("l")).agg(F.min("position").alias("first"))
    r = r.join(first, F.col("letter") == F.col("l")).withColumn("shard", F.floor((F.col("position") - F.col("first")) / shard_records))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "x"))), lambda s: s["x"]), "\n")
    shards = r.groupBy("letter", "shard").agg(body.alias("body"), F.count("*").alias("records"))
    xml = F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?>\n<ctml:playerRegistry xmlns:ctml="{NAMESPACE}" ctmlVersion="2.0">\n'), "body", F.lit("\n</ctml:playerRegistry>\n"))
    return shards.select(F.concat(F.lit("players-"), "letter", F.when(F.col("shard") > 0, F.concat(F.lit("-"), F.col("shard") + 1)).otherwise("")).alias("file_name"), xml.alias("xml"), "records")


def place_shards(places: DataFrame, xml: str = "xml", order: str = "ref", shard_records: int = 100_000) -> DataFrame:
    """file_name, xml and records of place registries: countries, states (first-level divisions), and of everything else a file for each country's code, numbered where it has many records.

    places: kind, country (its code) and each place's element (see places.place_element); a place without a country goes to a file of those."""
    name = F.when(F.col("kind") == "country", "places-countries").when(F.col("kind") == "admin1", "places-states").otherwise(F.concat(F.lit("places-cities-"), F.coalesce(F.nullif("country", F.lit("")), F.lit("NONE"))))
    r = positioned(places.select(name.alias("name"), F.col(order).alias("nth"), F.col(xml).alias("x")), ["name", "nth"])
    first = r.groupBy(F.col("name").alias("n")).agg(F.min("position").alias("first"))
    r = r.join(first, F.col("name") == F.col("n")).withColumn("shard", F.floor((F.col("position") - F.col("first")) / shard_records))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "x"))), lambda s: s["x"]), "\n")
    shards = r.groupBy("name", "shard").agg(body.alias("body"), F.count("*").alias("records"))
    whole = F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?>\n<ctml:placeRegistry xmlns:ctml="{NAMESPACE}" ctmlVersion="2.0">\n'), "body", F.lit("\n</ctml:placeRegistry>\n"))
    return shards.select(F.concat("name", F.when(F.col("shard") > 0, F.concat(F.lit("-"), F.col("shard") + 1)).otherwise("")).alias("file_name"), whole.alias("xml"), "records")


def section_rows(entries: DataFrame) -> DataFrame:
    """Entries (canonical, aliases) in order of folded name, one text a row: the name, and its aliases indented below."""
    below = F.transform("aliases", lambda a: F.concat(F.lit("  = "), a))
    return entries.repartitionByRange(F.lower("canonical"), "canonical").sortWithinPartitions(F.lower("canonical"), "canonical").select(F.array_join(F.concat(F.array("canonical"), below), "\r\n").alias("value"))


def write_enriched(spark: SparkSession, base: str, output: str, sections: dict[str, tuple[str, list[tuple[str, str, str]], DataFrame]]) -> int:
    """Write base, byte for byte, and behind it the generated sections as one file with CRLF line ends; returns its size.

    sections: name to (ignored characters, rules of type, source and replacement, entries). Tasks write each section's entries in parallel, in order; the parts are then streamed
    behind each other into a file aside, which one rename puts in place, so a reader sees the old file or the new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    aside = f"{output.rpartition('/')[0]}/.{uuid.uuid4().hex}.tmp"
    fs, target = hadoop(spark, aside)
    folders = {}
    for name, (_, _, entries) in sections.items():
        folders[name] = new_path(spark, f"section-{name}")
        section_rows(entries).write.option("lineSep", "\r\n").text(folders[name])
    quoted = lambda v: '"' + v.replace("\\", "\\\\").replace('"', '\\"') + '"'
    out = fs.create(target, True)

    def copy(path: str) -> None:
        store, p = hadoop(spark, path)
        source = store.open(p)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
        source.close()

    def say(*told: str) -> None:
        out.write(bytearray("".join(f"{x}\r\n" for x in told).encode()))

    try:
        copy(base)
        store, p = hadoop(spark, base)
        size = store.getFileStatus(p).getLen()
        if size:
            end = store.open(p)
            end.seek(size - 1)
            if end.read() != 10:
                say("")
            end.close()
        say("", *BANNER)
        for i, (name, (ignored, rules, _)) in enumerate(sections.items()):
            say(*([""] if i else []), f'@{name} "{ignored}"', *(f"%{kind} {quoted(a)} {quoted(b)}" for kind, a, b in rules))
            store, folder = hadoop(spark, folders[name])
            for f in sorted(str(s.getPath().toString()) for s in store.listStatus(folder) if s.getPath().getName().startswith("part-")):
                copy(f)
        say(*CLOSING)
        out.close()
    except Exception:
        out.close()
        fs.delete(target, False)
        raise
    written = fs.getFileStatus(target).getLen()
    replace = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    replace[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(target, hadoop(spark, output)[1], replace)
    return written
