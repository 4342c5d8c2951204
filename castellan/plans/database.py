"""Culling a whole database: orders stand for tournaments, order lines for result rows, suppliers for players and for their matches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from castellan.operators.culling import cull

FLOOR = 4

#: The same definitions for both engines: name, rows, and where they come from.
TABLES = {
    "tournaments": "SELECT 't' || o_orderkey AS tournament_id, o_orderpriority AS page_title, CASE WHEN o_custkey % 50 > 0 THEN 'l' || (o_custkey % 50) ELSE '' END AS place_id FROM orders",
    "tournament_result_rows": "SELECT 't' || l_orderkey AS tournament_id, CASE WHEN l_returnflag = 'R' THEN 'note' ELSE 'score' END AS row_kind, 'p' || l_suppkey AS player_id, CASE WHEN l_discount > 0 THEN CAST(l_quantity AS INT) END AS edo FROM lineitem",
    "year_events": "SELECT 1900 + s_nationkey AS year, 'm' || s_suppkey AS event_id, 'match' AS event_kind, s_name AS event_text FROM supplier UNION ALL SELECT 1900 + CAST(o_orderkey % 100 AS INT), 't' || o_orderkey, 'tournament', o_orderpriority FROM orders",
    "year_ratings": "SELECT 1900 + n_nationkey AS year, 'p' || s_suppkey AS player_id, CAST((s_suppkey * 7 + n_nationkey * 3) % 40 AS INT) AS edo FROM supplier, nation WHERE (s_suppkey + n_nationkey) % 13 > 0",
    "location_events": "SELECT 'l' || (o_custkey % 50) AS location_id, 'tournament' AS event_kind, 't' || o_orderkey AS event_id FROM orders UNION ALL SELECT 'l' || (60 + s_suppkey % 30), 'match', 'm' || s_suppkey FROM supplier",
    "player_ratings": "SELECT 'p' || l_suppkey AS player_id, l_linenumber AS n FROM lineitem",
    "players": "SELECT 'p' || s_suppkey AS player_id, s_name AS name FROM supplier",
    "locations": "SELECT 'l' || (c_custkey % 100) AS location_id, c_custkey AS n FROM customer",
    "registry_entries": "SELECT 'tournament' AS kind, 't' || o_orderkey AS native_id FROM orders UNION ALL SELECT 'player', 'p' || s_suppkey FROM supplier UNION ALL SELECT 'location', 'l' || (c_custkey % 100) FROM customer UNION ALL SELECT 'other', c_name FROM customer",
    "match_players": "SELECT 'm' || s_suppkey AS event_id, 'p' || s_suppkey AS player_id FROM supplier WHERE s_suppkey % 7 > 0 UNION ALL SELECT 'm' || s_suppkey, 'p' || (s_suppkey - 1) FROM supplier UNION ALL SELECT 'm' || s_suppkey, 'p0' FROM supplier WHERE s_suppkey % 11 = 0",
}
FOUND = {
    "tp": f"SELECT tournament_id, count(r) AS n, count(*) FILTER (r = 1 AND edo IS NULL) AS missing, count(*) FILTER (edo < {FLOOR}) AS below FROM tournaments LEFT JOIN (SELECT tournament_id AS t, 1 AS r, edo FROM tournament_result_rows WHERE row_kind = 'score') ON t = tournament_id GROUP BY 1",
    "kt": "SELECT tournament_id AS id FROM tp WHERE n > 0 AND missing = 0 AND below = 0",
    "mp": f"SELECT e.year, e.event_id, count(m.player_id) AS n, count(*) FILTER (m.player_id IS NOT NULL AND y.edo IS NULL) AS missing, count(*) FILTER (y.edo < {FLOOR}) AS below FROM year_events e LEFT JOIN match_players m ON m.event_id = e.event_id LEFT JOIN year_ratings y ON y.year = e.year AND y.player_id = m.player_id WHERE event_kind = 'match' GROUP BY 1, 2",
    "km": "SELECT event_id AS id FROM mp WHERE n = 2 AND missing = 0 AND below = 0",
    "kp": "SELECT player_id AS id FROM tournament_result_rows SEMI JOIN kt ON tournament_id = id WHERE row_kind = 'score' UNION SELECT player_id FROM match_players SEMI JOIN km ON event_id = id",
    "kl": "SELECT place_id AS id FROM tournaments SEMI JOIN kt ON tournament_id = id WHERE place_id <> '' UNION SELECT location_id FROM location_events SEMI JOIN km ON event_id = id",
}
KEPT = {
    "tournaments": "tournament_id IN (FROM kt)", "tournament_result_rows": "tournament_id IN (FROM kt)", "year_events": "event_id IN (FROM kt UNION FROM km)", "location_events": "location_id IN (FROM kl) AND event_id IN (FROM kt UNION FROM km)",
    "player_ratings": "player_id IN (FROM kp)", "year_ratings": "player_id IN (FROM kp)", "players": "player_id IN (FROM kp)", "locations": "location_id IN (FROM kl)", "registry_entries": "native_id IN (FROM kt UNION FROM kp UNION FROM kl) OR kind = 'other'",
}
SQL = "WITH " + ", ".join(f"{n} AS ({q})" for n, q in (TABLES | FOUND).items()) + " " + " UNION ALL ".join(
    [f"SELECT '{n}' AS name, count(*) AS n FROM {n} WHERE {w}" for n, w in KEPT.items()]
    + ["SELECT status, n FROM (SELECT 'tournaments ' || CASE WHEN tournament_id IN (FROM kt) THEN 'keep' ELSE 'reject' END AS status, count(*) AS n FROM tp GROUP BY 1)", "SELECT 'matches ' || CASE WHEN event_id IN (FROM km) THEN 'keep' ELSE 'reject' END, count(*) FROM mp GROUP BY 1"]
    + ["SELECT 'missing', (SELECT sum(missing) FROM tp) + (SELECT sum(missing + greatest(0, 2 - n)) FROM mp)", "SELECT 'below', (SELECT sum(below) FROM tp) + (SELECT sum(below) FROM mp)"])


def cull_database(spark, sf_dir):
    """How many rows each table keeps, and of tournaments and matches how many have each status, with missing and too low ratings."""
    named = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "lineitem", "supplier", "customer", "nation")}

    def table(sql: str):
        used = [t for t in named if f" {t}" in sql]
        for t in used:
            sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f", {t} WHERE", f", {{{t}}} WHERE")
        return spark.sql(sql, **{t: named[t] for t in used})

    tables = {n: table(q) for n, q in TABLES.items()}
    c = cull(tables, tables.pop("match_players"), FLOOR)
    parts = [df.agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n, df in c.tables.items()]
    for name, df in (("tournaments ", c.tournaments), ("matches ", c.matches)):
        parts.append(df.groupBy(F.concat(F.lit(name), "status").alias("name")).agg(F.count("*").alias("n")))
    parts.append(c.summary.select(F.explode(F.array(F.struct(F.lit("missing").alias("name"), F.col("missing").alias("n")), F.struct(F.lit("below").alias("name"), F.col("below").alias("n")))).alias("x")).select("x.*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


SUITE = {"cull_database": (cull_database, SQL)}
