"""Game files by record: each game with its number in the file, whichever way the file is split.

Spark's text source deals byte ranges of lines. A game begins at a line that looks like a tag pair (``[Name "``) behind a line that does not, blank lines aside, so blank lines between games,
line ends and the order of tags do not matter. A range knows the games that begin and end in it; what stands before its first beginning and after its last belongs to games
that cross its ends, and these fragments, two a range, are put together by themselves. Counts by range give every game its number, so skip, limit and joins by position sort nothing and
no game's text is shuffled, but for those few.

The files are read once: what a range knows is written to the shared folder and numbered from there, as two reads need not split the files alike.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castellan.chess.notation import RESULTS, TOKEN
from castellan.workspace import keep

TAG_LINE = re.compile(r'\s*\[\s*\w+\s+"')
RESULT = re.compile(r"(?<![^\s{}();$\[\]])(?:1-0|0-1|1/2-1/2|\*)(?![^\s{}();$\[\]])")
TAGS = re.compile(r'(?:\s*\[(?:[^"\]\\]|"(?:[^"\\]|\\.)*+"|\\.)*+\])*+', re.S)


def by_result(text: str) -> list[str]:
    """The games of a text with one group of tags: moves that go on after a result are another game, without tags."""
    out = []
    while text.strip():
        body = TAGS.match(text).end()
        found = list(itertools.islice(RESULT.finditer(text, body), 2))
        end = found[0].end() if found else len(text)
        if len(found) > 1 or text[end:].strip():  # results may stand in comments and variations: go by tokens
            depth, end = 0, len(text)
            for m in TOKEN.finditer(text, body):
                depth = max(0, depth + (m[0] == "(") - (m[0] == ")"))
                if not depth and m[0] in RESULTS:
                    end = m.end()
                    break
        out.append(text[:end].strip())
        text = text[end:]
    return out


def begins(lines: list[str], known: bool) -> list[int]:
    """Where games begin among lines. What stands before the first line is a beginning if known, else it is not told."""
    out, tagged = [0] if known and lines else [], None
    for i, line in enumerate(lines):
        if line.strip():
            is_tag = bool(TAG_LINE.match(line))
            if is_tag and tagged is False and i not in out[-1:]:
                out.append(i)
            tagged = is_tag
    return out


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    rows = ((f, b, v) for batch in batches for f, b, v in zip(*(c.to_pylist() for c in batch.columns)))
    for (file, block), lines in itertools.groupby(rows, key=lambda r: r[:2]):
        yield file, block, [v.rstrip("\r") for _, _, v in lines]


def _pieces(lines: list[str]) -> tuple[str, list[str], str | None]:
    """What stands before the first sure beginning, the games that are whole, and what the last beginning has of its game."""
    at = begins(lines, known=False)
    if not at:
        return "\n".join(lines), [], None
    whole = [g for a, b in itertools.pairwise(at) for g in by_result("\n".join(lines[a:b]))]
    return "\n".join(lines[: at[0]]), whole, "\n".join(lines[at[-1] :])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def game_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Of each byte range (file, block) a row for each game that is whole in it (nth, game), and one with head, games (how many are whole) and tail (null if no game begins there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, lines in _ranges(batches):
            head, whole, tail = _pieces(lines)
            n = len(whole) + 1
            columns = {"file": [file] * n, "block": [block] * n, "nth": [*range(n - 1), None], "game": [*whole, None], "head": [None] * (n - 1) + [head], "games": [None] * (n - 1) + [n - 1], "tail": [None] * (n - 1) + [tail]}
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if c in ("block", "nth", "games") else pa.string()) for c, v in columns.items()], list(columns))

    return keep(_lines(spark, path).mapInArrow(run, "file string, block bigint, nth bigint, game string, head string, games bigint, tail string"), "game-pieces")


def _crossing(index: DataFrame) -> DataFrame:
    """file, block (of the range that a crossing game is followed by, null after the last), first (games of the file before), games: the games put together from fragments.

    Tails and heads alternate: the head of a range belongs to the last tail before it."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    index = index.withColumn("nth", F.coalesce(F.count("tail").over(earlier), F.lit(0)))
    part = F.explode(F.filter(F.array(F.struct("nth", F.lit(0).alias("side"), F.col("head").alias("text")), F.struct((F.col("nth") + 1).alias("nth"), F.lit(1).alias("side"), F.col("tail").alias("text"))), lambda p: p["text"].isNotNull()))
    parts = index.select("file", "block", part.alias("p")).groupBy("file", F.col("p.nth").alias("nth"))
    joined = parts.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "p.side", "p.text"))), lambda x: x["text"]), "\n").alias("text"))

    @F.arrow_udf("array<string>")
    def cut(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            out = []
            for text in t.to_pylist():
                lines = text.split("\n")
                at = [*begins(lines, known=True), len(lines)]
                out.append([g for a, b in itertools.pairwise(at) for g in by_result("\n".join(lines[a:b]))])
            yield pa.array(out, pa.list_(pa.string()))

    joined = joined.select("file", "nth", cut("text").alias("games"))
    after = index.filter("tail is not null").select("file", "nth", "block", F.col("games").alias("whole"))
    both = joined.join(after, ["file", "nth"], "left")
    before = Window.partitionBy("file").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    return both.select("file", "block", F.coalesce(F.sum(F.size("games") + F.coalesce("whole", F.lit(0))).over(before), F.lit(0)).alias("first"), "games")


def numbered_games(pieces: DataFrame) -> DataFrame:
    """file, game_no and game of what game_pieces gave."""
    crossing = keep(_crossing(pieces.filter("nth is null").select("file", "block", "head", "games", "tail")), "crossing-games")
    ends = crossing.filter("block is not null").select(F.col("file").alias("f"), F.col("block").alias("b"), (F.col("first") + F.size("games")).alias("first"))
    inside = pieces.filter("nth is not null").join(ends, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).select("file", (F.col("first") + F.col("nth") + 1).alias("game_no"), "game")
    across = crossing.select("file", "first", F.posexplode("games").alias("n", "game")).select("file", (F.col("first") + F.col("n") + 1).alias("game_no"), "game")
    return inside.unionByName(across)


def read_games(spark: SparkSession, path: str, skip: int = 0, limit: int | None = None) -> DataFrame:
    """file, game_no (from 1, in the file) and game (its text). skip and limit count games of each file."""
    games = numbered_games(game_pieces(spark, path))
    games = games.filter(F.col("game_no") > skip) if skip else games
    return games if limit is None else games.filter(F.col("game_no") <= skip + limit)


def zipped(left: DataFrame, right: DataFrame, at: str = "game_no") -> DataFrame:
    """Rows side by side by position (both have `at`), those without a counterpart included: right's columns as r_<name>."""
    other = right.toDF(*[f"r_{c}" for c in right.columns])
    return left.join(other, F.col(at) == F.col(f"r_{at}"), "full").select(F.coalesce(at, f"r_{at}").alias(at), *[c for c in left.columns if c != at], *[c for c in other.columns if c != f"r_{at}"])
