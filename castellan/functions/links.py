"""Which links of a tournament site lead where: rules on a link's address and text, as Column predicates. A null address is no link; a null text is empty."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from castellan.functions.text import normalize_space

# Fixed values.
BAD_EXTENSIONS = ("gif", "jpg", "jpeg", "png", "svg", "webp", "ico", "css", "js", "zip", "pgn", "cbv", "pdf", "doc", "docx", "xls", "xlsx", "txt")
BAD_LINK_WORDS = (
    "", "<<", ">>", "back", "home", "overview", "summary", "competition summary", "statistics", "missing data", "information", "books", "trivia", "search", "search for a player", "search for a team/club",
    "take a quiz", "vote in a poll!", "sign guestbook", "join newsletter", "contact us", "copyright policy", "credits", "author's foreword", "what's new", "literature", "writings' corner", "history", "today", "travel", "business",
)
BAD_PATH_BITS = ("/img/", "/images/", "/help", "/search", "/guest", "/poll", "/quiz", "/contact", "/credits", "/copyright", "/newsletter")
DETAIL_LINK_WORDS = (
    "standings", "final standings", "crosstable", "the final group", "final group", "final", "preliminary", "preliminaries", "qualification", "qualifying", "group a", "group b", "group c", "group d", "group e", "group f", "stage",
)
SUMMARY_WORDS = ("summary", "competition summary", "statistics", "information", "books", "missing data")
CROSSTABLE_FOLDER = "/minev/files/"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1), r";[^/]*$", ""))


def file_name(url: Column) -> Column:
    return F.substring_index(F.regexp_replace(path(url), "/+$", ""), "/", -1)


def folder(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path(url), "/+$", ""), "/[^/]*$", "")


def suffix(url: Column) -> Column:
    """The extension of the file's name without its dot; a dot that begins or ends the name makes none."""
    return F.regexp_extract(file_name(url), r"^.+\.([^.]+)$", 1)


def is_http(url: Column) -> Column:
    return scheme(url).isin("http", "https")


def same_site(url: Column, start: Column) -> Column:
    """Whether the hosts are one, a leading www. aside."""
    bare = lambda u: F.regexp_replace(host(u), r"^www\.", "")
    return bare(url) == bare(start)


def is_page(url: Column) -> Column:
    return suffix(url).isin("", "html", "htm", "php")


def is_download(url: Column) -> Column:
    return suffix(url).isin(*BAD_EXTENSIONS)


def text_key(text: Column) -> Column:
    return F.lower(normalize_space(F.coalesce(text, F.lit(""))))


def is_code_or_score(text: Column) -> Column:
    """Nothing, a team's abbreviation, a score or a mark."""
    t = normalize_space(F.coalesce(text, F.lit("")))
    return (t == "") | t.rlike(r"^([A-Z]{2,5}\d?|\d+([½./:-]\d+)?|[WDL]|[+=-]+)$")


def is_round_text(text: Column) -> Column:
    return text_key(text).rlike(r"^\d{1,2}(st|nd|rd|th)$")


def has_bad_path(url: Column) -> Column:
    return reduce(or_, (path(url).contains(b) for b in BAD_PATH_BITS))


def in_section(url: Column, section: str) -> Column:
    """section: individual, team or all."""
    individual = path(url).contains("/ind-")
    return {"all": F.lit(True), "individual": individual, "team": ~individual}[section]


def has_year(url: Column) -> Column:
    """A year in the file's name or a folder that is one."""
    return file_name(url).rlike(r"(18|19|20)\d{2}") | path(url).rlike(r"/(18|19|20)\d{2}/")


def _on_site(url: Column, start: Column) -> Column:
    return same_site(url, start) & ~is_download(url) & is_page(url) & ~has_bad_path(url)


def _worded(text: Column) -> Column:
    return ~text_key(text).isin(*BAD_LINK_WORDS) & ~is_code_or_score(text)


def is_summary_seed(url: Column, text: Column, start: Column, section: str = "all") -> Column:
    return F.coalesce(is_http(url) & _on_site(url, start) & _worded(text) & ~path(url).isin("/", "/index.php") & in_section(url, section), F.lit(False))


def is_event_candidate(url: Column, text: Column, parent: Column, start: Column, section: str = "all") -> Column:
    return F.coalesce((url != parent) & is_http(url) & _on_site(url, start) & _worded(text) & in_section(url, section) & has_year(url), F.lit(False))


def is_detail(url: Column, text: Column, parent: Column, start: Column, round_pages: bool = False) -> Column:
    """A page beside its parent that is named as standings, a group or, if wanted, a round."""
    t = text_key(text)
    named = t.isin(*DETAIL_LINK_WORDS) | (is_round_text(text) & F.lit(round_pages))
    return F.coalesce((url != parent) & _on_site(url, start) & (folder(url) == folder(parent)) & ~t.isin(*SUMMARY_WORDS) & named, F.lit(False))


def is_era_page(url: Column, text: Column, site: Column) -> Column:
    """An HTML page of the site (a host) that lists the events of some years."""
    ours = is_http(url) & (host(url) == site) & path(url).rlike(r"\.html?$")
    return F.coalesce(ours & (file_name(url).startswith("events") | F.lower(F.coalesce(text, F.lit(""))).startswith("events ")), F.lit(False))


def is_crosstable_file(url: Column, site: Column) -> Column:
    return F.coalesce(is_http(url) & (host(url) == site) & path(url).rlike(r"\.html?$") & path(url).contains(CROSSTABLE_FOLDER), F.lit(False))
