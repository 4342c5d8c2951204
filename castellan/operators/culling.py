"""Culling a rating database to the tournaments and matches whose every player has a rating at or above a floor: nothing is deleted, the kept rows are tables of their own."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castellan.workspace import hadoop

#: The tables of a rating database and the columns that culling reads; others are carried along.
TABLES = {
    "tournaments": ("tournament_id", "page_title", "place_id"), "tournament_result_rows": ("tournament_id", "row_kind", "player_id", "edo"), "year_events": ("year", "event_id", "event_kind", "event_text"),
    "year_ratings": ("year", "player_id", "edo"), "location_events": ("location_id", "event_kind", "event_id"), "player_ratings": ("player_id",), "players": ("player_id",), "locations": ("location_id",), "registry_entries": ("kind", "native_id"),
}


@dataclass(frozen=True)
class Culled:
    """tables: what is kept of each. tournaments and matches: every one with its figures, reason and status. summary: one row of totals."""

    tables: dict[str, DataFrame]
    tournaments: DataFrame
    matches: DataFrame
    summary: DataFrame


def profile(rows: DataFrame, keys: list[str], present: Column, edo: Column, floor: int) -> DataFrame:
    """Of joined rows by keys: rows, missing, below, min_rating, max_rating."""
    return rows.groupBy(*keys).agg(
        F.count(present).alias("rows"), F.count_if(present.isNotNull() & edo.isNull()).alias("missing"), F.count_if(present.isNotNull() & (edo < floor)).alias("below"),
        F.min(F.when(present.isNotNull(), edo)).alias("min_rating"), F.max(F.when(present.isNotNull(), edo)).alias("max_rating"))


def _kept(df: DataFrame, rules: list[tuple[Column | None, str, DataFrame]]) -> DataFrame:
    """Rows that no rule drops. A rule (when, column, ids) drops rows that it is for (all, if None) and whose column is not null and not among ids."""
    out = df
    for i, (when, column, ids) in enumerate(rules):
        flagged = ids.select(F.col(ids.columns[0]).alias(f"_id{i}")).distinct()
        out = out.join(flagged, F.col(column) == F.col(f"_id{i}"), "left")
        dropped = F.col(column).isNotNull() & F.col(f"_id{i}").isNull()
        out = out.filter(~F.coalesce(dropped if when is None else when & dropped, F.lit(False))).drop(f"_id{i}")
    return out


def cull(tables: dict[str, DataFrame], match_players: DataFrame, floor: int) -> Culled:
    """tables: by the names of TABLES. match_players: event_id, player_id (whose page links the match).

    A tournament stays if it has score rows and each has a rating at or above floor; a match if exactly two players are linked to it and both are rated so in its year. Players stay who scored in a
    kept tournament or played a kept match, places that held one, and of every other table the rows about what stays. A row whose id is null is about nothing and stays."""
    t = tables
    scores = t["tournament_result_rows"].filter("row_kind = 'score'")
    s = scores.select(F.col("tournament_id").alias("_t"), F.lit(1).alias("_p"), "edo")
    tournaments = profile(t["tournaments"].select("tournament_id", "page_title").join(s, F.col("tournament_id") == F.col("_t"), "left"), ["tournament_id", "page_title"], F.col("_p"), F.col("edo"), floor)
    stays = (F.col("rows") > 0) & (F.col("missing") == 0) & (F.col("below") == 0)
    count = lambda c: F.col(c).cast("string")
    why = F.when(F.col("rows") == 0, "no score rows").when(F.col("missing") > 0, F.concat(count("missing"), F.lit(" missing/unrated player ratings"))).when(F.col("below") > 0, F.concat(count("below"), F.lit(" player ratings below threshold"))).otherwise("all player ratings >= threshold")
    status = F.when(stays, "keep").otherwise("reject").alias("status")
    tournaments = tournaments.select(*tournaments.columns, status, why.alias("reason"))

    linked = match_players.select(F.col("event_id").alias("_e"), F.col("player_id").alias("_p"))
    rated = t["year_ratings"].select(F.col("year").alias("_y"), F.col("player_id").alias("_r"), "edo")
    games = t["year_events"].filter("event_kind = 'match'").select("year", "event_id", "event_text")
    games = games.join(linked, F.col("event_id") == F.col("_e"), "left").join(rated, (F.col("year") == F.col("_y")) & (F.col("_p") == F.col("_r")), "left")
    matches = profile(games, ["year", "event_id", "event_text"], F.col("_p"), F.col("edo"), floor).withColumnRenamed("rows", "linked_players")
    n = F.col("linked_players")
    both = (n == 2) & (F.col("missing") == 0) & (F.col("below") == 0)
    why = (
        F.when(n == 0, "no linked player pages").when(n < 2, "fewer than two linked player pages").when(n > 2, "more than two linked player pages").when(F.col("missing") > 0, F.concat(count("missing"), F.lit(" missing/unrated annual Edo ratings")))
        .when(F.col("below") > 0, F.concat(count("below"), F.lit(" annual Edo ratings below threshold"))).otherwise("both annual Edo ratings >= threshold"))
    kept_match_ids = matches.filter(both).select("event_id").distinct()
    kept_ids = tournaments.filter("status = 'keep'").select("tournament_id").distinct()
    among = matches.join(kept_match_ids.select(F.col("event_id").alias("_k")), F.col("event_id") == F.col("_k"), "left")
    matches = among.select(*matches.columns, F.when(F.col("_k").isNotNull(), "keep").otherwise("reject").alias("status"), why.alias("reason")).withColumn("missing", F.col("missing") + F.greatest(F.lit(0), 2 - n))

    in_kept = scores.join(kept_ids, "tournament_id", "left_semi").select("player_id").filter("player_id is not null")
    players = in_kept.union(match_players.join(kept_match_ids, "event_id", "left_semi").select("player_id")).distinct()
    places = t["tournaments"].join(kept_ids, "tournament_id", "left_semi").select(F.col("place_id").alias("location_id")).filter("location_id <> ''")
    held = t["location_events"].filter("event_kind = 'match'").join(kept_match_ids, "event_id", "left_semi").select("location_id").filter("location_id is not null")
    places = places.union(held).distinct()
    kind = lambda c, v: F.col(c) == v
    events = [(kind("event_kind", "tournament"), "event_id", kept_ids), (kind("event_kind", "match"), "event_id", kept_match_ids)]
    kept = {
        "tournaments": _kept(t["tournaments"], [(None, "tournament_id", kept_ids)]), "tournament_result_rows": _kept(t["tournament_result_rows"], [(None, "tournament_id", kept_ids)]), "year_events": _kept(t["year_events"], events),
        "location_events": _kept(t["location_events"], [(None, "location_id", places), *events]), "player_ratings": _kept(t["player_ratings"], [(None, "player_id", players)]), "year_ratings": _kept(t["year_ratings"], [(None, "player_id", players)]),
        "players": _kept(t["players"], [(None, "player_id", players)]), "locations": _kept(t["locations"], [(None, "location_id", places)]),
        "registry_entries": _kept(t["registry_entries"], [(kind("kind", "tournament"), "native_id", kept_ids), (kind("kind", "player"), "native_id", players), (kind("kind", "location"), "native_id", places)]),
    }
    total = lambda c, when=None: F.coalesce(F.sum(c if when is None else F.when(when, c)), F.lit(0)).cast("bigint")
    is_kept = F.col("status") == "keep"
    figures = lambda rows: [F.count("*").alias("events"), F.count_if(is_kept).alias("kept_events"), total(rows).alias("rows"), total(rows, is_kept).alias("kept_rows"), total(F.col("missing")).alias("missing"), total(F.col("below")).alias("below")]
    parts = tournaments.agg(*figures(F.col("rows"))).unionByName(matches.agg(*figures(n)))
    summary = parts.agg(*[F.sum(c).alias(c) for c in parts.columns])
    return Culled(kept, tournaments, matches, summary.select("*", (F.col("events") - F.col("kept_events")).alias("rejected_events"), (F.col("rows") - F.col("kept_rows")).alias("rejected_rows")))


def write_version(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> int:
    """Write all tables as the next version under root: each to a folder of its own, then one small file that names them, put in place by a rename. A reader sees all tables of a version or none."""
    fs, base = hadoop(spark, root)
    path = lambda *p: hadoop(spark, "/".join((root, *p)))[1]
    done = [int(s.getPath().getName().removeprefix("v").removesuffix(".json")) for s in fs.listStatus(base) if s.getPath().getName().endswith(".json")] if fs.exists(base) else []
    version = 1 + max(done, default=0)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/v{version}/{name}")
    out = fs.create(path(f"_v{version}.tmp"), True)
    out.write(bytearray(json.dumps({"version": version, "tables": sorted(tables)}).encode()))
    out.close()
    if not fs.rename(path(f"_v{version}.tmp"), path(f"v{version}.json")):
        raise FileExistsError(f"version {version} of {root} was written by another")
    return version


def read_version(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version, the last if none is named."""
    listed = spark.read.json(f"{root}/v*.json")
    row = listed.filter(F.col("version") == version).first() if version else listed.orderBy(F.desc("version")).first()
    return {name: spark.read.parquet(f"{root}/v{row.version}/{name}") for name in row.tables}
