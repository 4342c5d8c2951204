"""Rating floors and rating profiles: what may enter the corpus, and why not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def floor_profile(rows: DataFrame, keys: list[str], rating: Column, floor: int) -> DataFrame:
    """For each group the number of rows, of missing ratings and of those below the floor, the extremes, and the verdict: a missing rating
    rejects before a low one does, and a floor of 0 or less admits all."""
    n, missing, below = F.count("*"), F.count_if(rating.isNull()), F.count_if(rating < floor)
    p = rows.groupBy(*keys).agg(n.alias("n_rows"), missing.alias("missing"), below.alias("below"), F.min(rating).alias("least"), F.max(rating).alias("most"))
    reason = F.when(F.lit(floor) <= 0, "kept").when(F.col("n_rows") == 0, "no player rows").when(F.col("missing") > 0, "missing ratings").when(F.col("below") > 0, "below floor").otherwise("kept")
    return p.withColumn("reason", reason).withColumn("keep", F.col("reason") == "kept")


def admitted_by_lowest(rows: DataFrame, group: list[str], member: list[str], rating: str, floor: int) -> DataFrame:
    """Groups whose every member's lowest known rating reaches the floor; a member without any rejects its group."""
    lowest = rows.groupBy(*group, *member).agg(F.min(rating).alias("lowest"))
    g = lowest.groupBy(*group).agg(F.count("*").alias("members"), F.count_if(F.isnull("lowest")).alias("unrated"), F.min("lowest").alias("lowest"))
    return g.filter((F.col("unrated") == 0) & (F.col("lowest") >= floor))


def rating_profile(rows: DataFrame, keys: list[str], rating: str, threshold: int, strong: int, top: int = 10) -> DataFrame:
    """Counts, extremes, averages, median and the mean of the best, one group-by; a rating of 0 or null is unrated.

    The best are kept by a bounded aggregate: what a group carries does not grow with it."""
    r = F.coalesce(F.col(rating), F.lit(0))
    rated = F.when(r > 0, r)
    per = rows.groupBy(*keys).agg(
        F.count("*").alias("total"), F.count(rated).alias("rated"), F.count_if(r <= 0).alias("unrated"), F.min(r).alias("min_all"), F.min(rated).alias("min_rated"), F.max(r).alias("max_rating"),
        F.round(F.avg(r), 6).alias("avg_all"), F.round(F.avg(rated), 6).alias("avg_rated"), F.coalesce(F.median(rated), F.lit(0.0)).alias("median_rated"), F.count_if(r >= strong).alias("strong"), F.count_if(r < threshold).alias("below"))
    by_value = rows.filter(F.col(rating) > 0).groupBy(*keys, F.col(rating).alias("v")).agg(F.count("*").alias("n"))
    best = by_value.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list(F.struct("v", "n")), False), 1, top).alias("b"))
    taken = F.aggregate("b", F.struct(F.lit(0).cast("double").alias("s"), F.lit(0).cast("bigint").alias("k")), lambda a, x: F.struct(
        (a["s"] + x["v"] * F.least(x["n"], top - a["k"])).alias("s"), F.least(F.lit(top).cast("bigint"), a["k"] + x["n"]).alias("k")))
    best = best.select(*keys, F.round(taken["s"] / taken["k"], 6).alias("top_avg"))
    return per.join(best, keys, "left").withColumn("top_avg", F.coalesce("top_avg", F.lit(0.0)))


GATES = {
    "strict_all_players": lambda t: F.col("below") == 0, "avg_all": lambda t: F.col("avg_all") >= t, "avg_rated": lambda t: (F.col("rated") > 0) & (F.col("avg_rated") >= t), "top_avg": lambda t: (F.col("rated") > 0) & (F.col("top_avg") >= t),
    "max_rating": lambda t: F.col("max_rating") >= t, "strong_count": lambda t: F.col("strong") >= t, "html_tour_avg": lambda t: F.col("html_avg") >= t,
}


def gate(profile: DataFrame, name: str, threshold: float) -> DataFrame:
    """A rating profile with the verdict of one of GATES in column passes; strong_count takes a number of players. A group without players, or without
    what the gate asks for, does not pass. html_tour_avg reads html_avg, the mean of the tournament's page (pages.rating_mean)."""
    usable = F.lit(True) if name == "html_tour_avg" else F.col("total") > 0
    return profile.withColumn("passes", F.coalesce(usable & GATES[name](threshold), F.lit(False)))
