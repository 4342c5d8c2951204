"""Files for readers that know no Spark: one file a row, reports, manifests, indexes and line-format sections.

Rows are written by the tasks that hold them, through the file system of the target (local, HDFS or an object store): aside first, then moved to
their names, so a task that runs twice leaves one file and none is ever half written."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castellan.functions import text
from castellan.workspace import hadoop, keep


def write_each(docs: DataFrame, folder: str, name: str = "file_name", body: str = "xml", suffix: str = ".xml") -> DataFrame:
    """Write each row's body to folder under its name, which must be unique (see registries.unique_names). Returns name and bytes, a row a file: the files are there when it
    does, and reading what it returned writes nothing again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for b in batches:
            sizes = []
            for n, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = (t or "").encode()
                aside = f"{root}/.{uuid.uuid4().hex}"
                with store.open_output_stream(aside) as out:
                    out.write(data)
                store.move(aside, f"{root}/{n}{suffix}")
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], ["name", "bytes"])

    return keep(docs.select(F.col(name).cast("string"), F.col(body).cast("string")).mapInArrow(run, "name string, bytes bigint"), "written-files")


def wipe(spark, folder: str) -> None:
    """Delete a folder of an earlier run."""
    store, p = hadoop(spark, folder)
    store.delete(p, True)


def write_lines(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """One JSON object a line, as many files as df has partitions."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_table(df: DataFrame, path: str, *, sep: str = "\t", mode: str = "overwrite") -> None:
    """Delimited text with a header in every file; arrays are joined by commas."""
    flat = [F.array_join(F.col(f.name).cast("array<string>"), ",").alias(f.name) if f.dataType.simpleString().startswith("array") else F.col(f.name) for f in df.schema]
    df.select(*flat).write.mode(mode).option("sep", sep).option("header", True).option("emptyValue", "").option("quoteAll", False).csv(path)


def write_report(report: dict, spark, path: str) -> None:
    """A small report as one JSON file."""
    store, p = hadoop(spark, path)
    out = store.create(p, True)
    out.write((json.dumps(report, indent=2, ensure_ascii=False) + "\n").encode())
    out.close()


def metrics(**tables: DataFrame) -> DataFrame:
    """measure and n: the number of rows of each table, in one result."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("measure"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def section_text(entries: DataFrame, section: str, ignored: str, prefixes: tuple[str, ...] = ()) -> DataFrame:
    """place and line of a line-format section: its header, the prefixes, then each canonical name with its aliases indented below, by folded name.

    entries: canonical, aliases (array)."""
    head = [f'@{section} "{ignored}"', *([f"%Prefix {' '.join(json.dumps(p) for p in prefixes)}"] if prefixes else [])]
    spark = entries.sparkSession
    top = spark.createDataFrame([("", "", i, h) for i, h in enumerate(head)], "folded string, canonical string, at int, line string")
    body = entries.select(F.concat(F.lit("1"), F.lower("canonical")).alias("folded"), "canonical", F.posexplode(F.concat(F.array("canonical"), F.transform("aliases", lambda a: F.concat(F.lit("  = "), a)))).alias("at", "line"))
    return top.unionByName(body).orderBy("folded", "canonical", "at").select("line")


def registry_element(ref: Column, name: Column, **parts: Column) -> Column:
    """A registry record as XML: its parts in order, blank ones left out."""
    inner = [F.when(F.trim(v) != "", F.concat(F.lit(f"    <ctml:{k}>"), text.esc(v), F.lit(f"</ctml:{k}>"))) for k, v in {"name": name, **parts}.items()]
    return F.concat_ws("\n", *inner)


def registry_shards(records: DataFrame, kind: str, ref: str = "ref", name: str = "name", parts: tuple[str, ...] = (), shard_records: int = 25_000) -> DataFrame:
    """file_name and xml of registry shards: records by first letter of their name, cut at shard_records each, sorted by name and ref.

    A shard is one row, so its size is bounded: a letter of many records makes numbered shards."""
    r = records.withColumn("_letter", text.shard_key(F.col(name)))
    nth = F.row_number().over(Window.partitionBy("_letter").orderBy(F.lower(name), ref))
    r = r.withColumn("_shard", F.floor((nth - 1) / shard_records) + 1)
    one = F.concat(F.lit(f'  <ctml:{kind} ref="'), text.esc(F.col(ref)), F.lit('">\n'), registry_element(F.col(ref), F.col(name), **{p: F.col(p).cast("string") for p in parts}), F.lit(f"\n  </ctml:{kind}>"))
    listed = F.array_sort(F.collect_list(F.struct(F.lower(name).alias("f"), F.col(ref).alias("r"), one.alias("x"))))
    shards = r.groupBy("_letter", "_shard").agg(F.transform(listed, lambda s: s["x"]).alias("x"), F.count("*").alias("records"))
    xml = F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?>\n<ctml:{kind}s xmlns:ctml="urn:ctml:2.0" ctmlVersion="2.0">\n'), F.array_join("x", "\n"), F.lit(f"\n</ctml:{kind}s>\n"))
    return shards.select(F.concat(F.lit(f"{kind}s-"), "_letter", F.when(F.col("_shard") > 1, F.concat(F.lit("-"), "_shard")).otherwise("")).alias("file_name"), xml.alias("xml"), "records")
