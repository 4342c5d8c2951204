"""The embedded SQL of the culling step, as Spark SQL over temporary views: profiles, keep sets and pruning, without deleting anything."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PROFILE = """SELECT o.o_orderkey, COUNT(l.l_orderkey) AS n_rows, COALESCE(SUM(CASE WHEN l.l_discount = 0 THEN 1 ELSE 0 END), 0) AS missing, COALESCE(SUM(CASE WHEN l.l_quantity < {floor} THEN 1 ELSE 0 END), 0) AS below,
    MIN(CAST(l.l_quantity AS INT)) AS least, MAX(CAST(l.l_quantity AS INT)) AS most
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'A' GROUP BY o.o_orderkey"""
MATCH_PROFILE = """SELECT c.c_custkey, COUNT(o.o_orderkey) AS orders, COUNT(l.l_orderkey) AS matched, MIN(l.l_linenumber) AS least
  FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_suppkey = c.c_custkey GROUP BY c.c_custkey"""
KEEP_SETS = """SELECT o_custkey AS player FROM orders WHERE o_totalprice >= 400000 UNION SELECT l_suppkey AS player FROM lineitem WHERE l_quantity >= 49"""
PRUNE = """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') ORDER BY c_custkey"""
TOTALS = """SELECT o_orderstatus, COUNT(*) AS total, SUM(CASE WHEN o_totalprice >= 250000 THEN 1 ELSE 0 END) AS kept, COALESCE(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END), 0) AS urgent FROM orders GROUP BY o_orderstatus"""
DISTINCT = "SELECT DISTINCT o_custkey, o_orderstatus FROM orders"


TABLES = ("orders", "lineitem", "customer")


def _run(sql: str) -> Callable[[SparkSession, str], DataFrame]:
    """The statement with its tables passed in, so that no view of the caller's session is touched."""
    used = [t for t in TABLES if f" {t} " in f"{sql} "]
    filled = f"{sql} "
    for t in used:
        filled = filled.replace(f" {t} ", f" {{{t}}} ")
    return lambda spark, sf_dir: spark.sql(filled, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


SUITE = {
    "edo_profile_sql": (_run(PROFILE.format(floor=10)), PROFILE.format(floor=10)), "match_profile_sql": (_run(MATCH_PROFILE), MATCH_PROFILE), "keep_sets_union": (_run(KEEP_SETS), KEEP_SETS),
    "prune_anti": (_run(PRUNE), PRUNE), "cull_totals": (_run(TOTALS), TOTALS), "select_distinct": (_run(DISTINCT), DISTINCT),
}
