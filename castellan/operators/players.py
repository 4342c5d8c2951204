"""Two player registries side by side: the same player by FIDE id, eleven fields compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What is compared, in the order of the report.
FIELDS = ("family", "given", "federation", "title", "female", "suffix", "birth_year", "current_rating", "aliases", "peak", "history")


def history_grid(elo: Column) -> Column:
    """A map of year to ratings by month as years with twelve months, unrated ones null, in order of years."""
    months = lambda v: F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.get(v, i))
    return F.transform(F.array_sort(F.map_entries(elo)), lambda e: F.struct(e["key"].alias("year"), months(e["value"]).alias("months")))


def grid_of_points(history: Column) -> Column:
    """Years with the months that are rated as years with twelve months; of a repeated year or month the last counts."""
    at = lambda y, i: F.element_at(F.filter(y["months"], lambda m: m["month"] == i), -1)["rating"]
    full = F.transform(history, lambda y: F.struct(y["year"].alias("year"), F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: F.when(F.exists(y["months"], lambda m: m["month"] == i), at(y, i))).alias("months")))
    last = F.filter(full, lambda y, i: ~F.exists(F.slice(full, i + 2, F.size(full)), lambda z: z["year"] == y["year"]))
    return F.array_sort(last)


def points(grid: Column) -> Column:
    """The rated months of a grid as (rating, year, month), in order."""
    flat = F.flatten(F.transform(grid, lambda y: F.transform(y["months"], lambda r, i: F.struct(r.alias("rating"), y["year"].alias("year"), (i + 1).alias("month")))))
    return F.filter(flat, lambda p: p["rating"].isNotNull())


def total_points(grid: Column) -> Column:
    """How many months are rated."""
    return F.size(points(grid))


def latest(grid: Column) -> Column:
    return F.try_element_at(points(grid), F.lit(-1))["rating"]


def peak(grid: Column) -> Column:
    """The greatest rating with the first month that reached it; all null without any."""
    best = F.array_max(F.transform(points(grid), lambda p: F.struct(p["rating"].alias("v"), (-p["year"]).alias("y"), (-p["month"]).alias("m"))))
    return F.struct(best["v"].alias("value"), (-best["y"]).alias("year"), (-best["m"]).alias("month"))


def compare_players(lines: DataFrame, registry: DataFrame) -> DataFrame:
    """fide_id, side (both, lines, registry) and for players on both whether each of FIELDS differs (differs_family, ...).

    lines: fide_id, family, given, suffix, federation, titles, female, birth_year, aliases, grid (of ratings); its latest rating and peak are worked
    out from the grid. registry: the same, with current_rating and peak as it states them. Aliases are compared as multisets, histories
    as grids. One shuffle on the id; players without one are on neither side."""
    a, b = (d.filter(F.col("fide_id").isNotNull()).alias(n) for d, n in ((lines, "a"), (registry, "b")))
    j = a.join(b, F.col("a.fide_id") == F.col("b.fide_id"), "full_outer")
    same = {f: F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")) for f in ("family", "given", "federation", "female", "suffix", "birth_year")}
    same["title"] = F.col("a.titles").eqNullSafe(F.col("b.titles"))
    same["current_rating"] = latest(F.col("a.grid")).eqNullSafe(F.col("b.current_rating"))
    same["aliases"] = F.array_sort("a.aliases").eqNullSafe(F.array_sort("b.aliases"))
    worked = peak(F.col("a.grid"))
    same["peak"] = worked["value"].eqNullSafe(F.col("b.peak")) & worked["year"].eqNullSafe(F.col("b.peak_year")) & worked["month"].eqNullSafe(F.col("b.peak_month"))
    same["history"] = F.col("a.grid").eqNullSafe(F.col("b.grid"))
    side = F.when(F.col("b.fide_id").isNull(), "lines").when(F.col("a.fide_id").isNull(), "registry").otherwise("both")
    return j.select(F.coalesce("a.fide_id", "b.fide_id").alias("fide_id"), side.alias("side"), *(F.when(side == "both", ~same[f]).alias(f"differs_{f}") for f in FIELDS))


def comparison_report(compared: DataFrame) -> DataFrame:
    """measure, n and the least id: how many players each side has, and on how many each field differs."""
    counted = F.explode(F.array(F.concat(F.lit("side "), "side"), *(F.when(F.col(f"differs_{f}"), f) for f in FIELDS)))
    return compared.select("fide_id", counted.alias("measure")).filter("measure is not null").groupBy("measure").agg(F.count("*").alias("n"), F.min("fide_id").alias("least"))
