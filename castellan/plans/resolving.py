"""Queries of player and event resolution: orders stand for games, customers for registered players, and orders' dates for occurrences."""

from __future__ import annotations

from pyspark.sql import functions as F

from castellan.operators import resolution

SEGMENT = "element_at(array('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'), cast(1 + o_orderkey div 4 % 5 as int))"

PLAYERS_SQL = """
    WITH c AS (SELECT 'player:' || c_custkey AS ref, 'f' || (c_custkey % 700) AS family, lower(c_mktsegment) AS given, 'the nick ' || (c_custkey % 900) AS nick, c_custkey FROM customer),
    k AS (SELECT family || ' ' || given AS key, 1 AS tier, ref FROM c UNION ALL SELECT given || ' ' || family, 1, ref FROM c UNION ALL SELECT nick, 2, ref FROM c UNION ALL SELECT family, 3, ref FROM c
        UNION ALL SELECT '#' || (c_custkey + 1000), 0, ref FROM c WHERE c_custkey % 3 = 0),
    d AS (SELECT key, arg_min(low, tier) AS low, arg_min(high, tier) AS high, min(tier) AS tier FROM (SELECT key, tier, min(ref) AS low, max(ref) AS high FROM k GROUP BY 1, 2) GROUP BY 1),
    q AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_custkey + 1000 AS VARCHAR) END AS id, CASE o_orderkey % 4
        WHEN 0 THEN 'F' || (o_custkey % 700) || ', ' || g WHEN 1 THEN g || '  F' || (o_custkey % 700) WHEN 2 THEN 'The Nick-' || (o_custkey % 900) ELSE 'F' || (o_custkey % 700) END AS name,
        CASE o_orderkey % 4 WHEN 0 THEN 'f' || (o_custkey % 700) || ' ' || lower(g) WHEN 1 THEN lower(g) || ' f' || (o_custkey % 700) WHEN 2 THEN 'the nick ' || (o_custkey % 900) ELSE 'f' || (o_custkey % 700) END AS key
        FROM (SELECT *, ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][1 + o_orderkey // 4 % 5] AS g FROM orders)),
    f AS (SELECT q.*, CASE WHEN i.key IS NOT NULL THEN i.low ELSE n.low END AS low, CASE WHEN i.key IS NOT NULL THEN i.high ELSE n.high END AS high, CASE WHEN i.key IS NOT NULL THEN i.tier ELSE n.tier END AS tier
        FROM q LEFT JOIN d i ON i.key = '#' || q.id LEFT JOIN d n ON n.key = q.key)
    SELECT o_orderkey, CASE WHEN low = high THEN low ELSE 'player:syn:' || substr(sha1(lower(name)), 1, 16) END AS player_ref,
        CASE WHEN low = high THEN ['fide-id', 'name-exact', 'name-alias', 'surname-unique'][tier + 1] ELSE 'unresolved' END AS method, CASE WHEN low = high THEN 1 WHEN low IS NULL THEN 0 ELSE 2 END AS candidates FROM f
"""


def player_resolution(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    family = F.concat(F.lit("F"), (F.col("c_custkey") % 700).cast("string"))
    players = c.select(
        F.concat(F.lit("player:"), F.col("c_custkey").cast("string")).alias("ref"), F.concat(family, F.lit(", "), F.initcap("c_mktsegment")).alias("name"),
        F.when(F.col("c_custkey") % 3 == 0, (F.col("c_custkey") + 1000).cast("string")).alias("fide_id"), F.array(F.concat(F.lit("The Nick "), (F.col("c_custkey") % 900).cast("string"))).alias("aliases"))
    family, given = "'F' || (o_custkey % 700)", SEGMENT
    name = F.expr(f"CASE o_orderkey % 4 WHEN 0 THEN {family} || ', ' || {given} WHEN 1 THEN {given} || '  ' || {family} WHEN 2 THEN 'The Nick-' || (o_custkey % 900) ELSE {family} END")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", name.alias("name"), F.expr("CASE WHEN o_orderkey % 11 = 0 THEN cast(o_custkey + 1000 as string) END").alias("fide"))
    return resolution.resolve_players(rows, players, fide_id="fide").select("o_orderkey", "player_ref", "method", "candidates")


EVENTS_SQL = """
    WITH o AS (SELECT o_orderkey, 'open ' || (o_custkey % 100) AS n, 'gp ' || (o_custkey % 70) AS alias, CAST(o_orderdate AS DATE) AS s, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INT) ELSE CAST(o_orderdate AS DATE) END AS e
        FROM orders WHERE o_orderstatus = 'F'),
    k AS (SELECT n AS key, o_orderkey, s, e FROM o UNION SELECT alias, o_orderkey, s, e FROM o),
    q AS (SELECT DISTINCT CASE WHEN l_linenumber % 2 = 0 THEN 'open ' || (l_suppkey % 100) ELSE 'gp ' || (l_suppkey % 70) END AS key, CAST(l_shipdate AS DATE) AS s, CASE WHEN l_linenumber > 5 THEN CAST(l_shipdate AS DATE) ELSE CAST(l_shipdate AS DATE) + l_linenumber END AS e FROM lineitem),
    f AS (SELECT q.key, q.s, q.e, min(o_orderkey) AS low, max(o_orderkey) AS high FROM q LEFT JOIN k ON k.key = q.key AND q.s <= k.e AND q.e >= k.s GROUP BY 1, 2, 3)
    SELECT key, s AS start, e AS "end", CASE WHEN low = high THEN low END AS occurrence, CASE WHEN low = high THEN 1 WHEN low IS NULL THEN 0 ELSE 2 END AS candidates,
        CASE WHEN low = high THEN 'event:' || low ELSE 'event:' || strftime(s, '%Y%m%d') || '-' || strftime(e, '%Y%m%d') || '-' || replace(key, ' ', '-') END AS event_ref FROM f
"""


def event_resolution(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderstatus = 'F'")
    occurrences = o.select(
        F.col("o_orderkey").alias("ref"), F.expr("array('Open ' || (o_custkey % 100), 'GP ' || (o_custkey % 70), 'open_' || (o_custkey % 100))").alias("names"), F.col("o_orderdate").alias("start"),
        F.expr("CASE WHEN o_orderkey % 4 > 0 THEN date_add(o_orderdate, cast(o_orderkey % 15 as int)) END").alias("end"))
    event, end = "CASE WHEN l_linenumber % 2 = 0 THEN 'OPEN  ' || (l_suppkey % 100) ELSE 'GP-' || (l_suppkey % 70) END", "CASE WHEN l_linenumber <= 5 THEN date_add(l_shipdate, l_linenumber) END"
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.expr(event).alias("event"), F.to_date("l_shipdate").alias("start"), F.expr(end).alias("end")).distinct()
    found = resolution.resolve_events(rows, occurrences)
    made = resolution.event_ref_or_made(F.concat(F.lit("event:"), F.col("event_ref").cast("string")), F.col("event"), F.col("start"), F.col("end"))
    key = F.replace(resolution.event_key(F.col("event")), F.lit("-"), F.lit(" "))
    return found.select(key.alias("key"), "start", F.coalesce("end", "start").alias("end"), F.col("event_ref").alias("occurrence"), F.col("candidates").cast("int").alias("candidates"), made.alias("event_ref")).distinct()


SUITE = {"player_resolution": (player_resolution, PLAYERS_SQL), "event_resolution": (event_resolution, EVENTS_SQL)}
