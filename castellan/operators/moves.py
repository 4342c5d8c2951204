"""Positions and game text as tables: one row a move, a token or a resolved text; counts of move sequences spread over tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castellan.chess import notation
from castellan.chess.position import Position, perft, uci

MOVE = pa.struct([pa.field("uci", pa.string()), pa.field("fen_after", pa.string())])
RESOLVED = pa.struct([pa.field("uci", pa.string()), pa.field("fen_after", pa.string()), pa.field("error", pa.string())])


def _listed(fen: Column, moves_of: Callable[[Position], list]) -> Column:
    def one(text: str | None) -> list[dict] | None:
        if text is None:
            return None
        try:
            p = Position.from_fen(text)
        except (ValueError, IndexError):
            return None
        return [{"uci": uci(m), "fen_after": p.after(m).fen()} for m in moves_of(p)]

    @F.arrow_udf("array<struct<uci:string,fen_after:string>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array([one(x) for x in b.to_pylist()], pa.list_(MOVE))

    return run(fen)


def legal_moves(df: DataFrame, fen: str) -> DataFrame:
    """df with a row for each legal move of its position: uci and fen_after. No rows for a null or malformed position, or one without moves."""
    return df.withColumn("_m", F.explode(_listed(F.col(fen), Position.legal))).select(*df.columns, "_m.*")


def pseudo_legal_moves(df: DataFrame, fen: str) -> DataFrame:
    """As legal_moves, with moves that leave the king in check."""
    return df.withColumn("_m", F.explode(_listed(F.col(fen), lambda p: list(p.candidates())))).select(*df.columns, "_m.*")


def resolved(df: DataFrame, fen: str, san: str) -> DataFrame:
    """df with the move that a text names in its position: uci and fen_after, or the reason in error."""

    def one(text: str | None, move: str | None) -> dict:
        try:
            to, p = notation.step(Position.from_fen(text or ""), move or "")
        except (ValueError, IndexError) as e:
            return {"uci": None, "fen_after": None, "error": str(e)}
        return {"uci": to, "fen_after": p.fen(), "error": None}

    @F.arrow_udf("struct<uci:string,fen_after:string,error:string>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for fens, sans in batches:
            yield pa.array([one(*x) for x in zip(fens.to_pylist(), sans.to_pylist())], RESOLVED)

    return df.withColumn("_m", run(F.col(fen), F.col(san))).select(*df.columns, "_m.*")


def mainline(df: DataFrame, text: str) -> DataFrame:
    """A row for each main-line move of a game text: ply from 1, and san."""

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array([notation.parse_game(x or "")[1] for x in b.to_pylist()], pa.list_(pa.string()))

    return df.select(*df.columns, F.posexplode(run(F.col(text))).alias("_p", "san")).withColumn("ply", F.col("_p") + 1).drop("_p")


def move_counts(df: DataFrame, fen: str, depth: str, tasks: int | None = None) -> DataFrame:
    """df's positions and depths, distinct, with nodes, the number of move sequences of that length.

    The first two moves become rows dealt to all tasks, so that one deep position occupies no single task; what follows is counted there."""

    @F.arrow_udf("bigint")
    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for fens, depths in batches:
            yield pa.array([perft(Position.from_fen(f), d) for f, d in zip(fens.to_pylist(), depths.to_pylist())], pa.int64())

    asked = df.select(F.col(fen).alias("fen"), F.col(depth).cast("int").alias("depth")).distinct()
    rows = asked.select("*", F.col("fen").alias("_at"), F.col("depth").alias("_left"))
    done = []
    for _ in range(2):
        done.append(rows.filter("_left <= 1"))
        rows = legal_moves(rows.filter("_left > 1"), "_at").select("fen", "depth", F.col("fen_after").alias("_at"), (F.col("_left") - 1).alias("_left"))
    width = tasks or df.sparkSession.sparkContext.defaultParallelism * 4
    rest = rows.repartition(width).withColumn("n", count("_at", "_left"))
    few = done[0].unionByName(done[1]).withColumn("n", count("_at", "_left"))
    counted = rest.unionByName(few).groupBy("fen", "depth").agg(F.sum("n").alias("n"))
    return asked.join(counted, ["fen", "depth"], "left").select(F.col("fen").alias(fen), F.col("depth").alias(depth), F.coalesce("n", F.lit(0)).alias("nodes"))
