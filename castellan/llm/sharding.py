"""Sharding: a table of immutable files under versioned manifests, compacted by size tiers.

An append writes small shards that no reader sees until a manifest naming them is committed. Compaction puts shards in tiers by size, each
tier ``fan_in`` times the one below, and merges shards of one tier, up to the target size, into one file; a run of fewer than ``fan_in`` shards
waits for more, and a file of half the target or more is done. Every merge is one task that reads its run and writes one file: no shuffle.
A manifest lists every live file; it is written aside and renamed to its version's name, which fails if another writer took that version, who
then is read again and the commit tried anew. So readers see one whole version, and lost executors or a lost driver leave nothing
but files that no manifest names, which vacuum deletes.

Cases: rows are kept as they are, nulls, repeated rows and very long texts included; an empty append adds no file and commits nothing; an empty table has
version 0 and no rows; column names are the table's own. Files are listed on the driver, one small entry for a file of target size.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace
from functools import reduce
from math import floor, log

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from castellan.workspace import hadoop


@contextmanager
def partitions_apart(spark: SparkSession) -> Iterator[None]:
    """A union whose inputs are single partitions keeps a partition for each, rather than make one of them."""
    key = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class CommitConflict(Exception):
    """Another writer committed this version."""


@dataclass(frozen=True)
class Shard:
    name: str  # level, and place within its commit
    path: str
    rows: int
    bytes: int
    level: int


class ShardedTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    # manifests

    def versions(self) -> list[int]:
        fs, p = hadoop(self.spark, f"{self.root}/manifests")
        return sorted(int(s.getPath().getName()[1:-5]) for s in fs.listStatus(p) if re.fullmatch(r"v\d+\.json", s.getPath().getName())) if fs.exists(p) else []

    def shards(self, version: int | None = None) -> tuple[int, list[Shard]]:
        """A version, by default the last one, and its live files."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return 0, []
        fs, p = hadoop(self.spark, f"{self.root}/manifests/v{version:012d}.json")
        size = fs.getFileStatus(p).getLen()
        stream = fs.open(p)
        try:
            data = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)
        finally:
            stream.close()
        return version, [Shard(**json.loads(line)) for line in bytes(data).decode().splitlines()]

    def commit(self, version: int, shards: list[Shard]) -> int:
        fs, aside = hadoop(self.spark, f"{self.root}/aside/{uuid.uuid4().hex}.json")
        out = fs.create(aside, True)
        out.write("".join(json.dumps(asdict(s)) + "\n" for s in shards).encode())
        out.close()
        _, to = hadoop(self.spark, f"{self.root}/manifests/v{version:012d}.json")
        fs.mkdirs(to.getParent())
        sc = self.spark.sparkContext
        context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), sc._jsc.hadoopConfiguration())
        kind = getattr(sc._jvm, "org.apache.hadoop.fs.Options$Rename")
        never_over = sc._gateway.new_array(kind, 1)
        never_over[0] = kind.NONE
        try:
            context.rename(aside, to, never_over)
        except Exception as e:
            if fs.exists(to):
                raise CommitConflict(version) from e
            raise
        return version

    # data

    def _write(self, df: DataFrame, level: int, shard_rows: int = 0) -> list[Shard]:
        """Write df as it is partitioned; one entry for each file, in the order of partitions."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").option("maxRecordsPerFile", shard_rows).parquet(path)
        files = self.spark.read.schema(self.schema).parquet(path).groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count("*").alias("n")).collect()
        found = []
        for f, size, n in sorted(files, key=lambda x: self._place(x[0])):
            part, chunk = self._place(f)
            found.append(Shard(f"L{level}-{part:05d}-{chunk:03d}", f, n, size, level))
        return found

    @staticmethod
    def _place(path: str) -> tuple[int, int]:
        m = re.search(r"part-(\d+)-[^/]*?(?:\.|-)c(\d+)[^/]*$", path)
        return int(m[1]), int(m[2])

    def append(self, df: DataFrame, *, shard_rows: int = 0) -> int:
        """Add the rows of df in one shard for each task, cut at shard_rows rows if given; the version that has them."""
        new = self._write(df, 0, shard_rows)
        while True:
            version, live = self.shards()
            if not new:
                return version
            taken = sum(s.level == 0 for s in live)
            try:
                return self.commit(version + 1, live + [replace(s, name=f"{s.name}-a{version}") if taken else s for s in new])
            except CommitConflict:
                continue

    @staticmethod
    def plan(live: list[Shard], target_bytes: int, fan_in: int, least_bytes: int = 1 << 16) -> list[list[Shard]]:
        """Runs to merge: shards of one tier whose sizes add up to the target at most."""
        tiers: dict[int, list[Shard]] = {}
        for s in live:
            if s.bytes * 2 < target_bytes:
                tiers.setdefault(max(0, floor(log(max(s.bytes, 1) / least_bytes, fan_in))), []).append(s)
        runs = []
        for _, shards in sorted(tiers.items()):
            run: list[Shard] = []
            for s in sorted(shards, key=lambda s: (s.level, s.name, s.path)):
                if run and sum(r.bytes for r in run) + s.bytes > target_bytes:
                    runs.append(run)
                    run = []
                run.append(s)
            if len(run) >= fan_in:
                runs.append(run)
        return [r for r in runs if len(r) > 1]

    def compact(self, *, target_bytes: int = 256 << 20, fan_in: int = 4, at_once: int = 64) -> int:
        """Merge until no tier has a run; the last version. Each round's merges are committed together."""
        while True:
            version, live = self.shards()
            runs = self.plan(live, target_bytes, fan_in)
            if not runs:
                return version
            merged: dict[str, Shard] = {}
            made: list[Shard] = []
            for at in range(0, len(runs), at_once):
                some = runs[at : at + at_once]
                level = 1 + max(s.level for r in some for s in r)
                parts = [self.spark.read.schema(self.schema).parquet(*[s.path for s in r]).coalesce(1) for r in some]
                with partitions_apart(self.spark):
                    new = self._write(reduce(DataFrame.unionAll, parts), level)
                if [s.rows for s in new] != [n for n in (sum(s.rows for s in r) for r in some) if n]:
                    raise RuntimeError("a merge lost or gained rows; nothing was committed")
                made += [replace(s, name=f"{s.name}-v{version}-{at:06d}") for s in new]
                merged |= {s.path: s for r in some for s in r}
            while True:
                version, live = self.shards()
                if not merged.keys() <= {s.path for s in live}:
                    break  # another writer merged some of these: its version stands, plan anew
                try:
                    self.commit(version + 1, [s for s in live if s.path not in merged] + made)
                    break
                except CommitConflict:
                    continue

    def vacuum(self, retain: int = 1) -> int:
        """Delete files that none of the last versions names, and older manifests. Not while an append or a merge runs elsewhere."""
        versions = self.versions()
        live = {s.path for v in versions[-retain:] for s in self.shards(v)[1]}
        names = {"/".join(p.split("/")[-2:]) for p in live}
        fs, data = hadoop(self.spark, f"{self.root}/data")
        gone = 0
        for folder in fs.listStatus(data) if fs.exists(data) else []:
            files = [f.getPath() for f in fs.listStatus(folder.getPath())]
            dead = [p for p in files if f"{p.getParent().getName()}/{p.getName()}" not in names]
            if len([p for p in dead if p.getName().startswith("part-")]) == len([p for p in files if p.getName().startswith("part-")]):
                fs.delete(folder.getPath(), True)
            else:
                for p in dead:
                    fs.delete(p, False)
            gone += len([p for p in dead if p.getName().startswith("part-")])
        for v in versions[:-retain]:
            fs.delete(hadoop(self.spark, f"{self.root}/manifests/v{v:012d}.json")[1], False)
        return gone

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, with shard (name), shard_rows, shard_bytes, level and version of their file in a struct _shard."""
        version, live = self.shards(version)
        if not live:
            empty = self.spark.createDataFrame([], self.schema)
            return empty.withColumn("_shard", F.lit(None).cast("struct<name:string,rows:bigint,bytes:bigint,level:bigint,version:bigint>"))
        rows = self.spark.read.schema(self.schema).parquet(*[s.path for s in live]).withColumn("_file", F.element_at(F.split("_metadata.file_path", "/data/"), -1))
        manifest = self.spark.read.schema("name string, path string, rows bigint, bytes bigint, level bigint").json(f"{self.root}/manifests/v{version:012d}.json")
        entry = manifest.select(F.element_at(F.split("path", "/data/"), -1).alias("_file"), F.struct("name", "rows", "bytes", "level", F.lit(version).cast("bigint").alias("version")).alias("_shard"))
        return rows.join(entry, "_file").drop("_file")
