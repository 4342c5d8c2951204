"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castellan.workspace import drop_kept, keep


def _star(pairs: DataFrame, smaller_only: bool) -> DataFrame:
    """Tie each node's neighbours to the least of them and itself: in a large star the greater neighbours, in a small star the smaller ones.

    The least is a pre-aggregated minimum joined back, so that a node of very many neighbours is no single task."""
    if smaller_only:
        near = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        tied = near.join(least, "u")
        out = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        near = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = near.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """node, root for every node of links (columns a, b of long): root is the least node reachable. Both directions count; loops and
    repeated links do no harm; no links give no rows. Takes a number of rounds that grows with the logarithm of the longest path."""
    pairs = keep(links.filter("a <> b").distinct(), "pairs")
    seen = None
    while True:
        after = keep(_star(_star(pairs, False), True), "pairs")
        drop_kept(pairs)
        pairs = after
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
