"""Closed vocabularies of the tournament document and the mappings onto them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from castellan.functions.text import normalize_space

# Fixed values.
RESULTS = ("1-0", "0-1", "1/2-1/2", "0-0", "*")
TERMINATIONS = {"normal": "normal", "time forfeit": "timeout", "abandoned": "abandoned", "adjudication": "adjudication", "rules infraction": "forfeit", "unterminated": "unknown"}
FORMATS = ("round-robin", "swiss", "match", "team", "knockout", "scheveningen", "other", "unknown")
FORMAT_HINTS = (("schweizer", "swiss"), ("swiss", "swiss"), ("rundenturnier", "round-robin"), ("round robin", "round-robin"), ("round-robin", "round-robin"), ("match", "match"), ("team", "team"))
CADENCE_VALUES = ("classical", "rapid", "blitz", "bullet", "correspondence", "mixed", "unknown")
RATING_SYSTEMS = ("fide", "uscf", "ecf", "national", "online", "edo", "chessmetrics", "combined", "none", "unknown")
CADENCES = (("blitz", ("blitz", "блиц")), ("rapid", ("rapid", "рапид", "rapide")), ("bullet", ("bullet",)), ("classical", ("classical", "классика", "standard")))


def event_format(raw: Column) -> Column:
    """The enumerated format, else the first hint that the text contains, else unknown."""
    f = F.lower(normalize_space(raw))
    out = F.when(f.isin(*FORMATS), f)
    for hint, name in FORMAT_HINTS:
        out = out.when(f.contains(hint), name)
    return out.otherwise("unknown")


def cadence(text: Column) -> Column:
    """The first cadence one of whose words occurs, else null."""
    tokens = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    out = None
    for name, words in CADENCES:
        hit = F.arrays_overlap(tokens, F.array(*map(F.lit, words)))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def event_cadence(stated: Column, text: Column) -> Column:
    """The stated cadence if it is one, else what the text says, else nothing."""
    value = normalize_space(F.coalesce(stated, F.lit("")))
    return F.when(value.isin(*CADENCE_VALUES), value).otherwise(F.coalesce(cadence(text), F.lit("")))


def rating_system(raw: Column) -> Column:
    value = normalize_space(F.coalesce(raw, F.lit("")))
    return F.when(value.isin(*RATING_SYSTEMS), value).otherwise("unknown")


def game_result(raw: Column) -> Column:
    return F.when(raw.isin(*RESULTS), raw).otherwise("*")


def termination(raw: Column) -> Column:
    out = None
    for text, name in TERMINATIONS.items():
        hit = F.lower(F.trim(raw)) == text
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def eco_code(raw: Column) -> Column:
    return F.when(raw.rlike("^[A-E][0-9]{2}$"), raw)


def elo(raw: Column) -> Column:
    return F.when(F.trim(raw).rlike("^[0-9]+$"), F.trim(raw).try_cast("int"))
