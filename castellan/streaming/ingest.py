"""Incremental ingest: each micro-batch of game files adds the games that the corpus lacks and never changes those it has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from castellan.sources.games import headers, merge_games, playable, replayed

#: Files of a stream come whole in one batch, cut before each blank line and event tag.
BREAK = "\n\n[Event "
SLOT = ["event", "round", "white", "black"]
COLUMNS = [*SLOT, "result", "ply_count", "trajectory_fp", "final_position_fp"]


def ingest(spark: SparkSession, folder: str, corpus: str, checkpoint: str, keys: Sequence[int], *, once: bool = True) -> StreamingQuery:
    """Start reading folder for game files. Games go to corpus/games, divergent ones to corpus/divergences, a folder for each batch: a batch
    that is run again after a failure overwrites its own folder and so adds nothing twice."""
    raw = spark.readStream.schema("value string").option("lineSep", BREAK).text(folder)
    text = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("[Event "), F.col("value")))
    games = raw.filter(F.trim("value") != "").select(text.alias("game"))

    def merge(batch: DataFrame, number: int) -> None:
        new = playable(headers(replayed(batch, keys))).filter(F.isnull("error")).select(*[F.coalesce(c, F.lit("")).alias(c) if c in SLOT else F.col(c) for c in COLUMNS])
        kept = existing(batch.sparkSession, corpus, number)
        added, diverging = merge_games(kept, new, SLOT)
        added.write.mode("overwrite").parquet(f"{corpus}/games/batch={number}")
        diverging.write.mode("overwrite").parquet(f"{corpus}/divergences/batch={number}")

    q = games.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (q.trigger(availableNow=True) if once else q).start()


def existing(spark: SparkSession, corpus: str, before: int | None = None) -> DataFrame:
    """The games of a corpus, or of its batches before one."""
    schema = ", ".join(f"{c} {'int' if c == 'ply_count' else 'string'}" for c in COLUMNS)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{corpus}/games")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return spark.createDataFrame([], schema)
    games = spark.read.schema(f"{schema}, batch int").parquet(f"{corpus}/games")
    return (games if before is None else games.filter(F.col("batch") < before)).drop("batch")
