"""File names and paths that are safe everywhere, made from URLs and titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters and names that some file systems refuse.
REFUSED = r'<>:"/\|?*'
DEVICES = ("con", "prn", "aux", "nul", *(f"com{i}" for i in range(1, 10)), *(f"lpt{i}" for i in range(1, 10)))


def _decoded(x: Column) -> Column:
    """Percent signs resolved, a plus left alone; as it is where the percent signs stand for nothing."""
    return F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)


def safe_segment(x: Column) -> Column:
    """A part of a path: decoded, with an underscore for each refused character and before a device's name; an empty one is an underscore."""
    s = F.translate(F.trim(_decoded(x)), REFUSED, "_" * len(REFUSED))
    return F.when(s == "", "_").when(F.lower(s).isin(*DEVICES), F.concat(F.lit("_"), s)).otherwise(s)


def local_path(url: Column) -> Column:
    """html/host/path of a URL. A last part without a dot gets .html, a query is told apart by ten digits of its hash; no path is index.html."""
    host = safe_segment(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    path, asked = F.regexp_replace(F.regexp_extract(rest, r"^[^?#]*", 0), ";[^/]*$", ""), F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    parts = F.transform(F.filter(F.split(path, "/"), lambda p: p != ""), safe_segment)
    parts = F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("index.html")))
    last = F.element_at(parts, -1)
    last = F.when(last.contains("."), last).otherwise(F.concat(last, F.lit(".html")))
    stem, suffix = F.regexp_extract(last, r"^(.+?)(\.[^.]+)?$", 1), F.regexp_extract(last, r"^.+?(\.[^.]+)$", 1)
    hashed = F.concat(stem, F.lit("-"), F.substring(F.sha1(asked), 1, 10), F.coalesce(F.nullif(suffix, F.lit("")), F.lit(".html")))
    file = F.when(asked != "", hashed).otherwise(last)
    return F.array_join(F.concat(F.array(F.lit("html"), host), F.slice(parts, 1, F.size(parts) - 1), F.array(file)), "/")


def safe_file_part(x: Column, longest: int = 80) -> Column:
    """A title as part of a file name: refused and control characters are underscores, blanks single, none of them or dots at the ends."""
    s = F.regexp_replace(F.regexp_replace(F.trim(x), r'[<>:"/\\|?*\x00-\x1f]', "_"), r"(?U)\s+", " ")
    s = F.btrim(s, F.lit(" ._"))
    return F.substring(F.when(s == "", "untitled").otherwise(s), 1, longest)


def file_name_of_url(url: Column) -> Column:
    """The decoded last part of a URL's path with refused characters as underscores; one made from a hash where the path has none."""
    path = F.regexp_replace(F.regexp_extract(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"^[^?#]*", 0), ";[^/]*$", "")
    name = F.trim(F.translate(_decoded(F.regexp_extract(path, r"([^/]*)/*$", 1)), REFUSED, "_" * len(REFUSED)))
    return F.when(name == "", F.concat(F.lit("crosstable-"), F.substring(F.sha1(url), 1, 12), F.lit(".html"))).otherwise(name)
