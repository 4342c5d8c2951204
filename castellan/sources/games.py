"""Games (see gamefiles.read_games) parsed and replayed in Arrow batches, in parallel across games."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castellan.chess import hashing, notation
from castellan.functions import dates, vocabulary

GAME = "tags map<string,string>, sans array<string>, terminator string, ucis array<string>, trajectory_fp string, final_position_fp string, error string"
ARROW_GAME = [pa.field("tags", pa.map_(pa.string(), pa.string()))] + [pa.field(n, pa.list_(pa.string()) if n in ("sans", "ucis") else pa.string()) for n in ("sans", "terminator", "ucis", "trajectory_fp", "final_position_fp", "error")]


def replayed(games: DataFrame, keys: Sequence[int], text: str = "game", tasks: int | None = None) -> DataFrame:
    """games with tags, moves and fingerprints added. A game that cannot be played has its reason in error and null fingerprints; it is never fatal.

    A start position counts only where the SetUp tag is 1. Replaying costs a thousand times what reading does: tasks deals games that lie in a few
    splits to that many tasks; many large files need none."""
    games = games.repartition(tasks) if tasks else games

    def one(game: str | None) -> tuple:
        tags, sans, result = notation.parse_game(game or "")
        try:
            steps = list(notation.play(sans, tags.get("FEN") if tags.get("SetUp") == "1" else None))
        except (ValueError, IndexError) as e:
            return tags, sans, result, None, None, None, str(e)
        return tags, sans, result, [u for u, _ in steps[1:]], *hashing.fingerprints([p for _, p in steps], keys), None

    @F.arrow_udf(f"struct<{GAME.replace(' ', ':').replace(',:', ',')}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            rows = [one(g) for g in b.to_pylist()]
            columns = [pa.array([tuple(r[i].items()) if i == 0 else r[i] for r in rows], f.type) for i, f in enumerate(ARROW_GAME)]
            yield pa.StructArray.from_arrays(columns, fields=ARROW_GAME)

    return games.withColumn("_g", run(F.col(text))).select(*games.columns, "_g.*")


def headers(games: DataFrame) -> DataFrame:
    """The usual columns of replayed games: blank tags are null, the result is the tag's or else the terminator's."""

    def tag(name: str) -> Column:
        return F.nullif(F.trim(F.try_element_at("tags", F.lit(name))), F.lit(""))

    plain = {"event": "Event", "site": "Site", "round": "Round", "white": "White", "black": "Black"}
    coded = {"start_fen": F.when(tag("SetUp") == "1", tag("FEN")), "white_elo": vocabulary.elo(tag("WhiteElo")), "black_elo": vocabulary.elo(tag("BlackElo")), "eco": vocabulary.eco_code(tag("ECO")), "termination": vocabulary.termination(tag("Termination"))}
    g = games.withColumns({c: tag(t) for c, t in plain.items()} | coded | {"date": dates.parse_pgn(tag("Date")), "result": vocabulary.game_result(F.coalesce(tag("Result"), F.col("terminator")))})
    return g.withColumn("ply_count", F.size("ucis"))


def playable(games: DataFrame) -> DataFrame:
    """Games between two different named players."""
    return games.filter(F.col("white").isNotNull() & F.col("black").isNotNull() & (F.col("white") != F.col("black")))


def merge_games(existing: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """What to add to existing games and what diverges from them. keys name a slot (event, players, round); an equal trajectory is the same
    game, another one in a taken slot is a divergence and the existing game stands."""
    taken = existing.select(*keys, "trajectory_fp").distinct()
    added = new.dropDuplicates([*keys, "trajectory_fp"]).join(taken.select(*keys).distinct(), keys, "left_anti")
    played = taken.filter("trajectory_fp is not null")
    others = new.select(*keys, "trajectory_fp").filter("trajectory_fp is not null").distinct()
    diverging = others.join(played.select(*keys).distinct(), keys, "left_semi").join(played, [*keys, "trajectory_fp"], "left_anti")
    return added, diverging
