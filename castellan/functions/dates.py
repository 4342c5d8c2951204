"""Partial dates: struct of year, month and day, the later parts null where they are unknown. Never a DATE, which would invent them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def partial(y: Column, m: Column, d: Column) -> Column:
    return F.struct(y.try_cast("int").alias("y"), m.try_cast("int").alias("m"), d.try_cast("int").alias("d"))


def is_calendar_day(date: Column) -> Column:
    """Whether all three parts are there and name a day that exists."""
    text = F.format_string("%04d-%02d-%02d", date["y"], date["m"], date["d"])
    return date["d"].isNotNull() & date["m"].isNotNull() & date["y"].isNotNull() & F.try_to_date(text, "yyyy-MM-dd").isNotNull()


def parse_iso(x: Column) -> Column:
    """YYYY, YYYY-MM, YYYY-MM-DD or YYYYMMDD; zero months and days of the compact form are unknown. Null for anything else."""
    g = lambda p, i: F.regexp_extract(F.trim(x), p, i)
    dashed = r"^(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?$"
    compact = r"^(\d{4})(\d{2})(\d{2})$"
    known = lambda c: F.nullif(c, F.lit("00"))
    return F.when(F.trim(x).rlike(dashed), partial(g(dashed, 1), F.nullif(g(dashed, 2), F.lit("")), F.nullif(g(dashed, 3), F.lit("")))).when(
        F.trim(x).rlike(compact), partial(g(compact, 1), known(g(compact, 2)), F.when(known(g(compact, 2)).isNotNull(), known(g(compact, 3)))))


def parse_pgn(x: Column) -> Column:
    """YYYY.MM.DD with ?? for unknown parts. Null without a year; a month or day that cannot be is unknown, and so is what follows."""
    p = r"^(\d{4})\.(\d{2}|\?\?)\.(\d{2}|\?\?)$"
    y, m, d = (F.regexp_extract(F.trim(x), p, i).try_cast("int") for i in (1, 2, 3))
    m = F.when(m.between(1, 12), m)
    exists = is_calendar_day(F.struct(y.alias("y"), m.alias("m"), d.alias("d")))
    return F.when(F.trim(x).rlike(p), F.struct(y.alias("y"), m.alias("m"), F.when(exists, d).alias("d")))


def parse_day_month_year(x: Column) -> Column:
    """12 Mar 1901, Mar 1901, or 1901 for years 1000 to 2100; null where the day is not 1 to 31 or the month has no known name."""
    parts = F.split(F.trim(x), r"\s+")
    n, number = F.size(parts), lambda i: F.get(parts, F.lit(i)).try_cast("int")
    named = lambda i: F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(F.lower(F.rtrim(F.get(parts, F.lit(i)), F.lit("."))), 1, 3)), F.lit(0)).cast("int")
    made = lambda y, m, d: F.struct(y.alias("y"), m.cast("int").alias("m"), d.cast("int").alias("d"))
    none = F.lit(None)
    return (
        F.when((n == 3) & number(0).between(1, 31) & named(1).isNotNull() & number(2).isNotNull(), made(number(2), named(1), number(0)))
        .when((n == 2) & named(0).isNotNull() & number(1).isNotNull(), made(number(1), named(0), none)).when((n == 1) & number(0).between(1000, 2100), made(number(0), none, none))
    )


def sanitize(date: Column) -> Column:
    """A month out of range leaves the year; a day that does not exist leaves the month."""
    m = F.when(date["m"].between(1, 12), date["m"])
    clean = F.struct(date["y"].alias("y"), m.alias("m"), F.when(m.isNotNull(), date["d"]).alias("d"))
    return F.struct(date["y"].alias("y"), m.alias("m"), F.when(is_calendar_day(clean), date["d"]).alias("d"))


def precision(date: Column) -> Column:
    return F.when(date["d"].isNotNull(), "day").when(date["m"].isNotNull(), "month").when(date["y"].isNotNull(), "year")


def compact(date: Column) -> Column:
    """YYYYMMDD, zeros for unknown parts."""
    return F.format_string("%04d%02d%02d", date["y"], F.coalesce(date["m"], F.lit(0)), F.coalesce(date["d"], F.lit(0)))


def text(date: Column) -> Column:
    return F.concat_ws("-", F.lpad(date["y"].cast("string"), 4, "0"), F.lpad(date["m"].cast("string"), 2, "0"), F.lpad(date["d"].cast("string"), 2, "0"))


def iso(date: Column) -> Column:
    """The text of a date that is a day of the calendar, else null."""
    return F.when(is_calendar_day(date), text(date))


def approximate(date: Column) -> Column:
    """A DATE for grouping only: unknown parts are the first."""
    return F.make_date(F.greatest(date["y"], F.lit(1)), F.coalesce(date["m"], F.lit(1)), F.coalesce(date["d"], F.lit(1)))
