"""What crawled pages and exports say: link kinds, crosstable pages, rating tables, content types."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ENCODINGS = ("utf-8-sig", "utf-8", "cp1250", "iso-8859-2", "cp1252", "latin-1")
ASSETS = "css|js|png|jpe?g|gif|svg|ico|pdf|zip|mp3"
MARKERS = ("final standings", "## final standings", "## standings", "crosstable", "## the final group", "stage:", "round:")
TABLE_WORDS = (("pos.",), ("pts",), ("games", "gms"))
RESULTS = (" 1 ", " 0 ", " ½ ", "1/2")


def link_kind(url: Column) -> Column:
    """asset, export, crosstable, event (a year in its path), section (a folder) or page."""
    path = F.lower(F.regexp_extract(url, r"^[^?#]*", 0))
    return (
        F.when(path.rlike(rf"\.({ASSETS})$"), "asset").when(F.lower(url).rlike(r"[?&](zeilen|prt|excel)="), "export").when(path.rlike("cross|tabel"), "crosstable")
        .when(path.rlike(r"(^|[^0-9])(18|19|20)\d\d([^0-9]|$)"), "event").when(path.endswith("/"), "section").otherwise("page")
    )


def looks_like_crosstable(page_text: Column) -> Column:
    """Whether a page's text has one of the markers, or the words of a table together with results."""
    t = F.lower(page_text)
    any_of = lambda words: reduce(or_, (t.contains(w) for w in words))
    return any_of(MARKERS) | reduce(and_, (any_of(w) for w in (*TABLE_WORDS, RESULTS)))


def rating_mean(html: Column) -> Column:
    """The whole mean of the positive numbers in the first column headed by something with Rtg of the page's first table.CRs1, or null."""
    body = F.regexp_extract(html, r'(?is)<table class="CRs1"(.*?)</table>', 1)
    rows = F.transform(F.regexp_extract_all(body, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1), lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1), lambda c: F.trim(F.regexp_replace(c, r"(?s)<[^>]*>", ""))))
    at = F.array_position(F.transform(F.get(rows, F.lit(0)), lambda c: c.contains("Rtg")), F.lit(True)).cast("int")
    cell = lambda r: F.when(at > 0, F.get(r, at - 1))
    found = F.filter(F.transform(F.slice(rows, 2, F.greatest(F.size(rows), F.lit(1))), lambda r: F.when(cell(r).rlike("^[0-9]+$"), cell(r)).try_cast("int")), lambda v: v > 0)
    return F.when(F.size(found) > 0, F.floor(F.aggregate(found, F.lit(0).cast("bigint"), lambda a, v: a + v) / F.size(found)))


def content_kind(content: Column, header: Column) -> Column:
    """File extension by the first bytes of a workbook, else by the stated type of one, else by the first characters; .bin for anything else."""
    kind = F.lower(F.coalesce(header, F.lit("")))
    start = F.lower(F.substring(F.ltrim(F.decode(F.substr(content, F.lit(1), F.lit(4096)), "ISO-8859-1"), F.lit(" \t\n\x0b\f\r")), 1, 300))
    return (
        F.when(F.hex(F.substr(content, F.lit(1), F.lit(4))) == "504B0304", ".xlsx").when(kind.contains("spreadsheetml"), ".xlsx").when(kind.contains("ms-excel"), ".xls")
        .when(start.startswith("<!doctype") | start.contains("<html"), ".html").when(start.startswith("%pdf"), ".pdf").otherwise(".bin")
    )


def decoded(content: Column) -> Column:
    """Bytes as text: the first of ENCODINGS in which they are valid, a byte order mark taken off UTF-8."""

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda b: None if b is None else first_decoding(bytes(b)))

    return F.pandas_udf(run, "string")(content)


def first_decoding(raw: bytes) -> str:
    for e in ENCODINGS:
        try:
            return raw.decode(e)
        except UnicodeDecodeError:
            continue
    return raw.decode("utf-8", "replace")
