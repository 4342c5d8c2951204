"""Person names, titles, federations and player identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from castellan.functions.text import normalize_space, sha1_hex16

# Fixed values.
SUFFIXES = ("jr", "jr.", "sr", "sr.", "i", "ii", "iii", "iv", "v", "vi", "2nd", "3rd")
TITLES = ("GM", "IM", "FM", "CM", "WGM", "WIM", "WFM", "WCM", "NM")
SHORT_TITLES = {"G": "GM", "M": "IM", "F": "FM", "C": "CM", "N": "NM"}


def split_name(display: Column, extract_suffix: bool = True) -> Column:
    """Struct of family, given and suffix. With a comma the family stands before it and a last word that is a suffix is taken off; without
    one the last word is the family."""
    return split_normal(normalize_space(display), extract_suffix)


def split_normal(d: Column, extract_suffix: bool = True) -> Column:
    """split_name of a name without superfluous blanks."""
    at = F.locate(",", d)
    words = lambda x: F.filter(F.split(F.trim(x), " "), lambda w: w != "")
    rest = words(F.substr(d, at + 1))
    is_suffix = F.coalesce(F.lower(F.try_element_at(rest, F.lit(-1))).isin(*SUFFIXES), F.lit(False)) & F.lit(extract_suffix) & (F.size(rest) > 0)
    all_words = words(d)
    none = F.array().cast("array<string>")
    comma = F.struct(F.trim(F.substr(d, F.lit(1), at - 1)).alias("family"), F.when(is_suffix, F.slice(rest, 1, F.size(rest) - 1)).otherwise(rest).alias("given"), F.when(is_suffix, F.try_element_at(rest, F.lit(-1))).alias("suffix"))
    plain = F.struct(F.coalesce(F.try_element_at(all_words, F.lit(-1)), F.lit("")).alias("family"), F.when(F.size(all_words) > 1, F.slice(all_words, 1, F.size(all_words) - 1)).otherwise(none).alias("given"), F.lit(None).cast("string").alias("suffix"))
    return F.when(at > 0, comma).otherwise(plain)


def person_key(display: Column) -> Column:
    """family|given given|suffix in lower case: equal for spellings of one name."""
    n = split_name(display)
    return F.lower(F.concat_ws("|", n["family"], F.array_join(n["given"], " "), F.coalesce(n["suffix"], F.lit(""))))


def title_tokens(token: Column) -> Column:
    """Struct of titles (known ones, in order, once) and female (whether any part begins with W). Titles are in capitals, or none."""
    parts = F.filter(F.split(token, r"\+"), lambda p: (p != "") & (p != "-"))
    return F.struct(F.array_distinct(F.filter(parts, lambda p: p.isin(*TITLES))).alias("titles"), F.exists(parts, lambda p: p.startswith("W")).alias("female"))


def normalize_title(raw: Column) -> Column:
    """Struct of title and other, in capitals: a known title, its one-letter form written out, or else the text as other."""
    return title_of(F.upper(normalize_space(raw)))


def title_of(upper: Column) -> Column:
    """normalize_title of a text in capitals without superfluous blanks."""
    t = upper
    for short, title in SHORT_TITLES.items():
        t = F.when(upper == short, title).otherwise(t)
    known = t.isin(*TITLES)
    return F.struct(F.when(known, t).otherwise("").alias("title"), F.when(known, "").otherwise(t).alias("other"))


def normalize_federation(raw: Column) -> Column:
    return federation_of(F.upper(normalize_space(raw)))


def federation_of(f: Column) -> Column:
    """normalize_federation of a text in capitals without superfluous blanks."""
    return F.when(f.rlike("^[A-Z]{3}$"), f).otherwise("")


def is_valid_fide_id(x: Column) -> Column:
    return x.rlike("^[0-9]{4,12}$")


def player_ref(explicit: Column, fide_id: Column, name: Column, federation: Column) -> Column:
    """Struct of ref and method: a given reference, else the FIDE id, else a hash of name and federation."""
    given = F.trim(F.coalesce(explicit, F.lit("")))
    synthetic = F.concat(F.lit("player:syn:"), sha1_hex16(F.concat(F.lower(F.trim(name)), F.lit("|"), F.upper(F.trim(F.coalesce(federation, F.lit("")))))))
    fide = F.trim(fide_id)
    valid = F.coalesce(is_valid_fide_id(fide), F.lit(False))
    ref = F.when(given != "", given).when(valid, F.concat(F.lit("player:fide:"), fide)).otherwise(synthetic)
    method = F.when(given != "", F.when(given.startswith("player:syn:"), "unresolved").otherwise("")).when(valid, "fide-id").otherwise("unresolved")
    return F.struct(ref.alias("ref"), method.alias("method"))
