"""Queries that write the tables as files of the formats that the library reads, and read them back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from castellan.operators.positions import positioned
from castellan.sources.gamefiles import read_games, zipped
from castellan.sources.players import read_players
from castellan.workspace import new_path

BLOCKS_SQL = """
    SELECT c_custkey % 1000 + 1000 AS fide_id, count(*) AS blocks, count(*) FILTER (c_custkey % 10 = 0) AS malformed, max(CASE WHEN c_custkey % 10 > 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'USA' END END) AS federation,
        sum(CASE WHEN c_custkey % 10 > 0 THEN CAST(floor(abs(c_acctbal)) AS BIGINT) END) AS ratings, min(CASE WHEN c_custkey % 10 > 0 THEN 1900 + c_nationkey END) AS birth_year, min(CASE WHEN c_custkey % 10 > 0 THEN c_mktsegment || ' Alias' || c_custkey END) AS alias,
        sum(CASE WHEN c_custkey % 10 > 0 THEN 2 * c_nationkey + 3 ELSE 0 END) AS points FROM customer GROUP BY 1
"""


def player_blocks(spark, sf_dir):
    """Customers written in the line format and read back from the files: what a block says, added up by the number in its id."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    line = """concat('@PLAYER\n# ', c_custkey, '\n', replace(c_name, '#', ' '), ', ', c_mktsegment, ' ', '#GM+IM', if(c_custkey % 2 = 0, ' USA', ''), if(c_custkey % 10 = 0, '', concat(' [', cast(floor(abs(c_acctbal)) as bigint), ']')), ' ', 1900 + c_nationkey, '.??.??\n',
        '  %Bio FIDE ', c_custkey % 1000 + 1000, '\n\n  %Bio Key ', c_custkey, '\n  %Elo 2001:', c_nationkey, ',?,', c_nationkey + 3, ',x\n  = ', c_mktsegment, ' Alias', c_custkey)"""
    path = new_path(spark, "player-lines")
    c.select(F.expr(line)).write.text(path)
    b = read_players(spark, path).withColumn("key", F.coalesce(F.col("fide_id").cast("bigint"), F.regexp_extract("line", r"(\d{9}),", 1).cast("bigint") % 1000 + 1000))
    points = F.aggregate(F.filter(F.flatten(F.map_values("elo")), lambda v: v.isNotNull()), F.lit(0), lambda a, v: a + v)
    return b.groupBy(F.col("key").alias("fide_id")).agg(
        F.count("*").alias("blocks"), F.count_if("malformed").alias("malformed"), F.max("federation").alias("federation"), F.sum("bracket_rating").alias("ratings"), F.min("birth_year").alias("birth_year"),
        F.min(F.get("aliases", F.lit(0))).alias("alias"), F.sum(points).alias("points"))


GAMES_SQL = """
    WITH n AS (SELECT o_orderkey, o_custkey, o_orderpriority, row_number() OVER (ORDER BY o_orderkey) AS game_no FROM orders), w AS (SELECT row_number() OVER (ORDER BY c_custkey) AS game_no, c_name FROM customer)
    SELECT coalesce(n.game_no, w.game_no) AS game_no, o_orderkey, o_custkey, o_orderpriority AS event, CASE o_orderkey % 3 WHEN 0 THEN '1-0' WHEN 1 THEN '*' WHEN 2 THEN '0-1' END AS result, c_name FROM n FULL JOIN w ON n.game_no = w.game_no
"""


def game_files(spark, sf_dir):
    """Orders written as games, with and without blank lines, in files that go on from each other; each game's number over all files, beside the customer of that position."""
    game = """concat('[Event "', o_orderpriority, '"]\n[Round "', o_orderkey, '"]\n', if(o_orderkey % 2 = 0, '\n', ''), '1. e4 {[c "', o_custkey, '"] 1-0}\n', if(o_orderkey % 5 = 0, '\n', ''), 'e5 (1... c5 *) ',
        element_at(array('1-0', '*', '0-1'), cast(o_orderkey % 3 + 1 as int)), if(o_orderkey % 7 = 0, '\n', ''))"""
    path = new_path(spark, "game-files")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
    o.select(F.expr(game)).write.text(path)
    g = read_games(spark, path)
    files = g.groupBy("file").agg(F.max("game_no").alias("games"))
    before = F.coalesce(F.sum("games").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select(F.col("file").alias("f"), before.alias("before"))
    part = lambda p: F.regexp_extract("game", p, 1)
    g = g.join(files, F.col("file") == F.col("f")).select(
        (F.col("before") + F.col("game_no")).alias("game_no"), part(r'Round "(\d+)"').cast("bigint").alias("o_orderkey"), part(r'\[c "(\d+)"').cast("bigint").alias("o_custkey"), part(r'Event "([^"]*)"').alias("event"), F.substring_index("game", " ", -1).alias("result"))
    c = positioned(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name"), ["c_custkey"], "game_no").drop("c_custkey")
    return zipped(g, c).withColumnRenamed("r_c_name", "c_name")


SUITE = {"player_blocks": (player_blocks, BLOCKS_SQL), "game_files": (game_files, GAMES_SQL)}
