"""Screening of spreadsheet exports: where their table begins, which rows are players, what ratings these have, and the manifest's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castellan.functions import text

# Column headings of starting-rank lists.
RATING_HEADERS = ("rtg", "rating", "elo", "fide rtg", "int. rating", "nat. rating", "rtgi", "rtgn", "rat", "elo fide")
NAME_HEADERS = ("name", "player", "spieler", "nombre", "nome", "nom", "naam", "фамилия", "имя")
NUMBER_HEADERS = ("no.", "no", "sno", "rank", "rk.", "start no", "startno")
EXPORT = {"list": "", "starting rank": "art=0", "crosstable": "art=4"}


def normalize_header(x: Column) -> Column:
    return F.regexp_replace(F.replace(F.lower(text.normalize_space(x)), F.lit(" "), F.lit(" ")), r"\s+", " ")


def clean_value(x: Column) -> Column:
    """A cell as text: nothing for null, no decimals for a whole number."""
    return F.coalesce(F.trim(F.regexp_replace(x.cast("string"), r"^(-?\d+)\.0+$", "$1")), F.lit(""))


def has(cells: Column, known: tuple[str, ...]) -> Column:
    return F.arrays_overlap(cells, F.array(*map(F.lit, known)))


def is_header(cells: Column) -> Column:
    """Whether a row heads a table: it has a rating column, or a name column with a number or federation column."""
    h = F.transform(cells, normalize_header)
    return has(h, RATING_HEADERS) | (has(h, NAME_HEADERS) & (has(h, NUMBER_HEADERS) | F.array_contains(h, "fed")))


def first_of(headers: Column, known: tuple[str, ...]) -> Column:
    """The place (from 0) of the first column with a known heading, or null."""
    at = F.array_position(F.transform(headers, lambda h: h.isin(*known)), F.lit(True))
    return F.nullif(at, F.lit(0)).cast("int") - 1


def is_player_row(cells: Column, number_at: Column, name_at: Column) -> Column:
    """A row with a whole number in the number column, or a name of two letters or more that is no line of the site's own."""
    number, name = F.trim(F.get(cells, number_at)), F.trim(F.get(cells, name_at))
    low = F.lower(name)
    foreign = low.contains("chess-results") | (low.contains("tournament") & low.contains("manager")) | low.contains("last update")
    return F.coalesce(number.rlike(r"^\d+\.?$"), F.lit(False)) | F.coalesce((F.length(name) >= 2) & ~foreign, F.lit(False))


def starting_ranks(rows: DataFrame) -> DataFrame:
    """file, row, rating of the players of sheets (file, row, cells: see registry.read_sheets): 0 without a rating; sheets without a rating column
    give none. The column headed rtg counts alone if there is one, else the greatest of all rating columns."""
    heads = rows.filter(is_header(F.col("cells"))).groupBy("file").agg(F.min_by("cells", "row").alias("head"), F.min("row").alias("head_row"))
    h = F.transform("head", normalize_header)
    every = F.filter(F.transform(h, lambda c, i: F.when(c.isin(*RATING_HEADERS), i)), lambda i: i.isNotNull())
    rtg = F.array_position(h, "rtg").cast("int")
    heads = heads.select("file", "head_row", F.when(rtg > 0, F.array(rtg - 1)).otherwise(every).alias("at"), first_of(h, NAME_HEADERS).alias("name_at"), first_of(h, NUMBER_HEADERS).alias("number_at")).filter(F.size("at") > 0)
    j = rows.join(heads, "file").filter(F.col("row") > F.col("head_row")).filter(is_player_row(F.col("cells"), F.col("number_at"), F.col("name_at")))
    best = F.array_max(F.transform("at", lambda i: F.coalesce(text.rating_value(F.get("cells", i)), F.lit(0))))
    return j.select("file", "row", best.alias("rating"))


def export_url(key: Column, query: str = "") -> Column:
    return F.concat(F.lit("https://chess-results.com/tnr"), key, F.lit(".aspx?lan=1" + (f"&{query}" if query else "")))


def manifest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The rows of a manifest whose key is a number, the first of each key, with a url for each kind of page."""
    k = F.trim(key)
    first = rows.filter(k.rlike("^[0-9]+$")).withColumn("_k", k).groupBy("_k").agg(F.min_by(F.struct(*rows.columns), order).alias("r"))
    return first.select("r.*", *(export_url(F.col("_k"), q).alias(f"{n.replace(' ', '_')}_url") for n, q in EXPORT.items()))


def seed_urls(rows: DataFrame, key: str, order: str) -> DataFrame:
    """url of every page to fetch for a manifest's keys, each once: kinds of page in the order of EXPORT, keys by the order of their first row."""
    m = manifest(rows, F.col(key), order)
    kinds = [F.struct(F.lit(i).alias("kind"), F.col(f"{n.replace(' ', '_')}_url").alias("url")) for i, n in enumerate(EXPORT)]
    return m.select(F.col(order).alias("_first"), F.explode(F.array(*kinds)).alias("u")).groupBy("u.url").agg(F.min("u.kind").alias("kind"), F.min("_first").alias("first"))
