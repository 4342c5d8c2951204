"""Runs of games that make up a tournament."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gap_sessions(games: DataFrame, keys: list[str], date: str, order: str, max_gap: int = 21) -> DataFrame:
    """games with session (from 1): a run goes on while a game is at most max_gap days after the one before it. An undated game belongs to the
    run if its key has just one, else to a run of its own, 0."""
    w = Window.partitionBy(*keys).orderBy(F.col(date).asc_nulls_last(), order)
    before = F.lag(date).over(w)
    starts = F.col(date).isNotNull() & (before.isNull() | (F.datediff(date, before) > max_gap))
    g = games.withColumn("_new", starts.cast("int")).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = F.sum("_new").over(Window.partitionBy(*keys))
    return g.withColumn("session", F.when(F.col(date).isNotNull(), F.col("_run")).when(runs == 1, F.lit(1)).otherwise(F.lit(0)).cast("bigint")).drop("_new", "_run")


def session_bounds(sessions: DataFrame, keys: list[str], date: str) -> DataFrame:
    """For each session its games and first and last date; with no date at all 1970-01-01 and undated set."""
    s = sessions.groupBy(*keys, "session").agg(F.count("*").alias("games"), F.min(date).alias("start"), F.max(date).alias("end"))
    epoch = F.lit("1970-01-01").cast("date")
    return s.withColumn("undated", F.isnull("start")).withColumn("start", F.coalesce("start", epoch)).withColumn("end", F.coalesce("end", epoch))


def first_seen_numbers(rows: DataFrame, keys: list[str], member: str, order: list[str], prefix: str = "p") -> DataFrame:
    """keys, member and number (p0001 for the member seen first)."""
    first = rows.groupBy(*keys, member).agg(F.min(F.struct(*order)).alias("_o"))
    n = F.row_number().over(Window.partitionBy(*keys).orderBy("_o"))
    return first.withColumn("number", F.format_string(f"{prefix}%04d", n)).drop("_o")


def latest_and_peak(history: DataFrame, keys: list[str], year: str, month: str, rating: str) -> DataFrame:
    """For each key the rating of the last month that has one, and the greatest rating with the first month that reached it."""
    known = history.filter(F.col(rating).isNotNull())
    peak = F.max(F.struct(F.col(rating).alias("v"), (-F.col(year)).alias("y"), (-F.col(month)).alias("m")))
    g = known.groupBy(*keys).agg(F.max_by(rating, F.struct(year, month)).alias("latest"), peak.alias("_p"), F.count("*").alias("points"))
    return g.select(*keys, "latest", F.col("_p.v").alias("peak"), (-F.col("_p.y")).alias("peak_year"), (-F.col("_p.m")).alias("peak_month"), "points")
