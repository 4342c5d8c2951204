"""Text, identifiers and URLs as Catalyst expressions: each takes and returns a Column and is null where its input is."""

from __future__ import annotations

from collections.abc import Callable
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_space(x: Column) -> Column:
    """Runs of Unicode white space, no-break space included, become one blank; none at the ends."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def bound(values: dict[str, Column], use: Callable[[Column], Column]) -> Column:
    """use of a struct of values, each of them computed once however often it is used, in lambdas too. No Python functions in either."""
    return F.transform(F.array(F.struct(*[v.alias(n) for n, v in values.items()])), use)[0]


def slug(x: Column, fallback: str = "unknown") -> Column:
    """Lower-case letters and digits; white space, underscores and hyphens become single hyphens, anything else goes."""
    kept = F.regexp_replace(F.lower(normalize_space(x)), r"[^\p{IsAlphabetic}\p{N}\s_-]", "")
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(kept, r"[\s_-]+", "-"), F.lit("-")), F.lit("")), F.lit(fallback))


def sha1_hex16(x: Column) -> Column:
    return F.substring(F.sha1(x), 1, 16)


def xml_id(*parts: Column) -> Column:
    """Non-empty parts joined by an underscore, made a legal XML id of at most 180 characters."""
    raw = F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), "_")
    safe = F.btrim(F.regexp_replace(raw, "[^A-Za-z0-9_.-]", "_"), F.lit("_.-"))
    named = F.when(safe == "", F.concat(F.lit("t_"), sha1_hex16(raw))).when(safe.rlike("^[A-Za-z_]"), safe).otherwise(F.concat(F.lit("t_"), safe))
    return F.substring(named, 1, 180)


def esc(x: Column) -> Column:
    """XML entities for the four characters that need them."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(char), F.lit(entity))
    return x


def format_g(x: Column) -> Column:
    """A number without decimals if it has none, and never with an exponent."""
    plain = x.cast("string")
    spelled = F.regexp_replace(plain.try_cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    return F.when((F.abs(x) < 1e18) & (x == F.floor(x)), F.floor(x).cast("string")).when(plain.contains("E"), F.coalesce(spelled, plain)).otherwise(plain)


#: Words that say nothing about which tournament it is.
GENERIC_WORDS = ("open", "tournament", "championship", "final", "group", "section")


def name_key(x: Column) -> Column:
    """A tournament name without ordinal, year and generic words, for comparison."""
    k = F.replace(F.lower(normalize_space(x)), F.lit("&"), F.lit(" and "))
    k = F.regexp_replace(k, r"^\d{1,3}(st|nd|rd|th)\s+", "")
    k = F.regexp_replace(k, r"\b(1[5-9]|20)\d\d\b", "")
    k = F.regexp_replace(k, rf"\b({'|'.join(GENERIC_WORDS)})\b", " ")
    return F.trim(F.regexp_replace(k, "[^a-z0-9]+", " "))


def token_jaccard(a: Column, b: Column) -> Column:
    """The share of words that two keys have in common; 0 if either is empty."""
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    return F.when((a == "") | (b == ""), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def key_words(k: Column) -> Column:
    """The distinct words of a key in order, none for an empty one."""
    return F.array_sort(F.array_distinct(F.array_remove(F.split(k, " "), "")))


def words_jaccard(x: Column, y: Column) -> Column:
    """token_jaccard of two keys whose distinct words are known."""
    common = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(common / (F.size(x) + F.size(y) - common))


def escape_rule(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def shard_key(x: Column) -> Column:
    """The upper-case first letter from A to Z, else OTHER."""
    first = F.upper(F.substring(x, 1, 1))
    return F.when(first.rlike("^[A-Z]$"), first).otherwise("OTHER")


def name_problem(x: Column) -> Column:
    """Why a line-format name is unusable, or null."""
    return (
        F.when(x.isNull() | (F.trim(x) == ""), "empty").when(x.contains("�"), "replacement character").when(x.contains("#"), "contains #").when(x.rlike("^[@%=>]"), "reserved first character")
    )


def notes(**parts: Column) -> Column:
    """name=value pairs joined by a semicolon; blank ones are left out."""
    return F.concat_ws("; ", *(F.when(F.trim(v) != "", F.concat(F.lit(f"{k}="), v)) for k, v in parts.items()))


def int_like(x: Column) -> Column:
    """The whole number that a string of digits spells, else null."""
    return F.when(F.trim(x).rlike("^[0-9]+$"), F.trim(x).try_cast("bigint"))


def rating_value(x: Column) -> Column:
    """Of a text: its first run of three or four digits if that is 100 or more, else 0."""
    run = F.regexp_extract(x, r"(\d{3,4})", 1).try_cast("int")
    return F.when(run >= 100, run).otherwise(0)


def rating_number(x: Column) -> Column:
    """Of a number: its whole part if positive, else 0."""
    return F.greatest(F.coalesce(x.try_cast("int"), F.lit(0)), F.lit(0))


def canonical_url(url: Column, aliases: dict[str, str] | None = None) -> Column:
    """Lower-case scheme (https if none) and host, no parameters and no fragment; path and query stay. An aliased host becomes its own, over https."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    scheme = F.coalesce(F.nullif(F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), F.lit("")), F.lit("https"))
    aliased = host.isin(*(aliases or {"": ""}))
    own = host
    for old, new in (aliases or {}).items():
        own = F.when(host == old, new).otherwise(own)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    path = F.regexp_replace(path, r";[^/]*$", "")
    query = F.regexp_replace(F.regexp_extract(url, r"^[^#?]*(\?[^#]*)", 1), r"^\?$", "")
    return F.concat(F.when(aliased, "https").otherwise(scheme), F.lit("://"), own, F.when(path == "", "/").otherwise(path), query)


def html_text(html: Column) -> Column:
    """What is left without scripts, styles and tags, all entities resolved (in Arrow batches: there are thousands of them)."""
    t = F.regexp_replace(F.regexp_replace(html, r"(?is)<script.*?</script>", " "), r"(?is)<style.*?</style>", " ")
    return normalize_space(unescaped(F.regexp_replace(t, r"(?s)<[^>]+>", " ")))


def unescaped(x: Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unescape(t) if t and "&" in t else t)

    return F.pandas_udf(run, "string")(x)


def links(html: Column) -> Column:
    """The targets of the anchors, in order."""
    return F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*?href=\"([^\"]*)\""), 1)


class Anchors(HTMLParser):
    """Anchors of a page: target joined to the page's address, and text, a picture's alternative text or title counting as text."""

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.found, self.open = base, [], None

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        if tag == "a" and own.get("href"):
            self.handle_endtag("a")
            self.open = (urljoin(self.base, own["href"].strip()), [own.get("title") or ""])
        elif tag == "img" and self.open:
            self.open[1].append(own.get("alt") or own.get("title") or "")

    handle_startendtag = handle_starttag

    def handle_data(self, data):
        if self.open:
            self.open[1].append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.open:
            url, (title, *parts) = self.open
            self.found.append({"url": url, "text": " ".join(" ".join(parts).split()) or title})
            self.open = None


def anchors(html: Column, base: Column) -> Column:
    """Array of url and text of all anchors with a target, in order; an anchor without text goes by its title."""

    def run(pages: pd.Series, bases: pd.Series) -> pd.Series:
        out = []
        for page, own in zip(pages, bases):
            a = Anchors(own or "")
            a.feed(page or "")
            a.handle_endtag("a")
            out.append(a.found)
        return pd.Series(out)

    return F.pandas_udf(run, "array<struct<url:string,text:string>>")(html, base)
