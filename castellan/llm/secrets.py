"""Secret scans: an Aho-Corasick automaton finds keywords in one pass, anchored expressions run only at its hits, and the kinds that embed a
checksum are kept only if it holds.

Texts are scanned as UTF-8 bytes, lower-cased for the automaton in A-Z only; spans are given in code points. The base kinds need no
checksum; plain hexadecimal runs have no keyword and are found by one scan of their own.

A card number or IBAN may be followed by digits or capitals (an expiry, a BIC): each admissible length that ends with a group is tried, the
longest first, and the first that passes its checksum counts. A match that fails its checksum hides no keyword within it.

Kinds added by checksum: ``github`` and ``npm`` tokens (six base-62 digits of the CRC-32 of what stands before), ``card`` numbers after a
card keyword (Luhn), ``iban`` after its keyword (ISO 7064 mod 97, at its country's length where LENGTHS has it), ``jwt`` (its header decodes to a JSON object naming an algorithm).

Cases: a null text is empty and has no spans; whole texts are scanned whatever their length; repeated rows give repeated rows; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "github", "npm", "card", "iban", "jwt")
BASE = KINDS[:3]


@dataclass(frozen=True)
class Rule:
    """keywords: lower case, where the pattern may match; a match is tried at the hit. holds: whether a match counts. others: patterns to try, in order, where none before holds."""

    kind: str
    keywords: tuple[str, ...]
    pattern: re.Pattern[bytes]
    holds: Callable[[re.Match[bytes]], bool]
    others: tuple[re.Pattern[bytes], ...] = ()


def any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def crc_62(m: re.Match[bytes]) -> bool:
    """The last six characters are the CRC-32 of the random part, in base 62."""
    digits = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    value = 0
    for c in m[2]:
        value = value * 62 + digits.index(c)
    return value == zlib.crc32(m[1])


def luhn(m: re.Match[bytes]) -> bool:
    digits = [c - 48 for c in m[1] if 48 <= c <= 57]
    doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return 13 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


# Lengths of IBANs by country, by the public registry.
LENGTHS = {
    c[:2]: int(c[2:])
    for c in """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27
    GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 PK24 PL28 PS29
    PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20""".split()
}


def mod_97(m: re.Match[bytes]) -> bool:
    code = m[1].replace(b" ", b"").decode()
    return len(code) == LENGTHS.get(code[:2], len(code)) and 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def names_algorithm(m: re.Match[bytes]) -> bool:
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(m[1] + b"=" * (-len(m[1]) % 4)))
    except (ValueError, TypeError):
        return False


def card_of(digits: int) -> re.Pattern[bytes]:
    return re.compile(rb"[A-Za-z]+[^0-9\n]{0,24}((?:[0-9][ -]?){%d}[0-9])(?![0-9])" % (digits - 1))


def iban_of(length: int) -> re.Pattern[bytes]:
    return re.compile(rb"[A-Za-z]{4}[: ]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){%d})(?![A-Za-z0-9])" % (length - 4))


NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
RULES = (
    Rule("assign", NAMES, re.compile(("(" + "|".join(map(any_case, ("password", "passwd", "secret", "token"))) + "|" + any_case("api") + "_?" + any_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""").encode()), lambda m: len(m[2]) >= 6),
    Rule("access", ("akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    Rule("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"), crc_62),
    Rule("npm", ("npm_",), re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"), crc_62),
    Rule("card", ("card", "visa", "mastercard", "amex"), card_of(19), luhn, tuple(map(card_of, range(18, 12, -1)))),
    Rule("iban", ("iban",), iban_of(34), mod_97, tuple(map(iban_of, range(33, 14, -1)))),
    Rule("jwt", ("eyj",), re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), names_algorithm),
)
HEX = re.compile(rb"[0-9a-f]{24,}")
TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    by_word: dict[str, list[int]] = {}
    for i, r in enumerate(RULES):
        for w in r.keywords:
            by_word.setdefault(w, []).append(i)
    for w, rules in by_word.items():
        a.add_word(w, (len(w), rules))
    a.make_automaton()
    return a


def spans_of(text: str | None, a: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then by the order of KINDS."""
    data = (text or "").encode("utf-8", "surrogatepass")
    hits = sorted((end + 1 - n, i) for end, (n, rules) in a.iter(data.translate(TO_LOWER).decode("latin-1")) for i in rules)
    found = [(*m.span(), "hex") for m in HEX.finditer(data)]
    done = [0] * len(RULES)
    for start, i in hits:
        if start < done[i]:
            continue  # within the last match of the kind
        for p in (RULES[i].pattern, *RULES[i].others):
            m = p.match(data, start)
            if m and RULES[i].kind in BASE:
                done[i] = m.end()
            if m and RULES[i].holds(m):
                done[i] = m.end()
                # a checked code is the span itself, without the keyword before it
                found.append((*(m.span(1) if RULES[i].kind in ("card", "iban") else m.span()), RULES[i].kind))
                break
    if found and not data.isascii():
        at, done_to, chars = {}, 0, 0
        for b in sorted({b for s in found for b in s[:2]}):  # each piece is decoded once
            chars += len(data[done_to:b].decode("utf-8", "surrogatepass"))
            at[b] = chars
            done_to = b
        found = [(at[s], at[e], k) for s, e, k in found]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def scan_secrets(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and spans (array of kind, start, end), one row for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e} for s, e, k in spans_of(t.as_py(), a)] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], ["id", "spans"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
