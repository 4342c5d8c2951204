"""Personal data: base kinds by their patterns, further kinds by candidates, boosted trees and calibrated thresholds.

Generators propose every span that could be of a further kind, overlapping ones too: ``email_spelled`` (``jane [at] mail [dot] org``), ``phone_local`` (without +), ``card_part`` (13 to
19 digits between group ends of a longer chain), ``national_id``, ``iban``, ``ipv6``, ``mac``, ``birth_date``, ``document_id``. Features are a candidate's format (counts, groups,
checksums) and its context (what stands beside it, how near cue words of each class are). Trees boosted on labelled candidates score them, a threshold for each kind, calibrated on
labelled candidates that the trees did not see, selects, and of overlapping selected spans the best stays. Base spans always stay and nothing overlaps them.

Labels: the tables have none, so the trees learn from planted data. ``sample`` documents (the least by a hash of id, excerpts of ``excerpt`` code points: the
bound of what is fitted on) get made-up personal data and look-alikes (order numbers, versions, dates of events) with and without cue words; a candidate is right if it is
exactly a planted span. A third of these documents is held out for the thresholds. Every document is scored whole.

Spans are in code points, end exclusive. Cases: a null text is empty and has no spans; a text of any length is scanned in time linear in it; repeated rows give repeated rows; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import bisect
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castellan.llm.boosting import Boosted, fit, threshold_for

BASE = ("email", "ip", "card", "phone")
ADDED = ("email_spelled", "phone_local", "card_part", "national_id", "iban", "ipv6", "mac", "birth_date", "document_id")
KINDS = BASE + ADDED

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


# ---- base kinds: leftmost, non-overlapping, each in one pass

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """From each @: its name reaches back over name characters to the last match, so a long run is read once for each @ beside it and not from each of its characters."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not NOT_LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", at + 1)


def addresses(text: str) -> Iterator[Span]:
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str) -> Iterator[Span]:
    for m in DIGITS.finditer(text):
        if 13 <= len(m[0]) <= 37 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def base_spans(text: str) -> dict[str, list[Span]]:
    return {"email": list(emails(text)), "ip": list(addresses(text)), "card": list(cards(text)), "phone": list(phones(text))}


# ---- generators of further kinds

AT = re.compile(r"\x20?[\[({<]\x20?(?:at|AT|@)\x20?[\])}>]\x20?|\x20(?:at|AT|@)\x20")
HOST = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({<]\x20?(?:dot|DOT|\.)\x20?[\])}>]\x20?|\x20(?:dot|DOT)\x20)[A-Za-z0-9-]{1,63}){1,4}")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9]){12,}")
LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{2,5}\)[\x20-]?|[0-9]{2,5}[\x20./-])[0-9]{2,8}(?:[\x20.-][0-9]{2,4}){0,4}(?![0-9])")
NATIONAL = re.compile(r"(?<![0-9A-Za-z-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{8}-?[A-Z])(?![0-9A-Za-z-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}::?){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
MAC = re.compile(r"(?<![0-9A-Fa-f:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![0-9A-Fa-f:-])")
DATE = re.compile(r"(?<![0-9./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![0-9./-]*[0-9])")
CODE = re.compile(r"(?<![A-Za-z0-9])(?=[A-Z]{0,11}[0-9])(?=[0-9]{0,11}[A-Z])[A-Z0-9]{7,12}(?![A-Za-z0-9])")


def spelled(text: str) -> Iterator[Span]:
    for m in AT.finditer(text):
        left, right = LOCAL.search(text[max(0, m.start() - 64) : m.start()]), HOST.match(text, m.end())
        if left and left[0] and right:
            yield m.start() - len(left[0]), right.end()


def chain_parts(text: str, low: int = 13, high: int = 19) -> Iterator[Span]:
    """Of each chain of digit groups, every run of whole groups with so many digits that passes its checksum; a whole chain is left to the base kind."""
    for m in CHAIN.finditer(text):
        groups = [g.span() for g in re.finditer("[0-9]+", m[0])]
        for i, (s, _) in enumerate(groups):
            n = 0
            for j in range(i, len(groups)):
                n += groups[j][1] - groups[j][0]
                if n > high:
                    break
                if n >= low and j - i < len(groups) - 1 and luhn(re.sub("[^0-9]", "", m[0][s : groups[j][1]])):
                    yield m.start() + s, m.start() + groups[j][1]


def mod_97(code: str) -> bool:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def ibans(text: str) -> Iterator[Span]:
    """Each length that ends with a group, as capitals or digits may follow."""
    for m in IBAN.finditer(text):
        ends = [m.end(), *(m.start() + g.start() for g in re.finditer(r"\x20", m[0]))]
        for end in ends:
            if 15 <= len(text[m.start() : end].replace(" ", "")) <= 34:
                yield m.start(), end


def found_by(pattern: re.Pattern[str]):
    return lambda text: (m.span() for m in pattern.finditer(text))


GENERATORS = {
    "email_spelled": spelled, "phone_local": found_by(LOCAL_PHONE), "card_part": chain_parts, "national_id": found_by(NATIONAL), "iban": ibans, "ipv6": found_by(IPV6), "mac": found_by(MAC),
    "birth_date": found_by(DATE), "document_id": found_by(CODE),
}

#: Words that speak for a kind, or (the last class) for something else; in the languages of the tables. They reach the trees as distances.
CUES = {
    "phone": "phone tel call mobile cell fax ring telefon handy anruf rufnummer téléphone appel portable teléfono móvil llamar",
    "card": "card visa mastercard amex credit debit karte kreditkarte carte tarjeta",
    "id": "ssn social security passport identity national dni nif license licence ausweis pass passeport pasaporte identité identidad",
    "mail": "email e-mail mail contact write correo courriel kontakt",
    "bank": "iban account bank konto compte cuenta transfer überweisung",
    "net": "ip ipv6 address host client device mac adresse dirección",
    "birth": "born birth birthday dob geboren geburtstag naissance né née nacido nacida nacimiento",
    "other": "order invoice version model part item sku isbn ref reference tracking ticket page score published meeting release ratio serial bestellung rechnung commande facture pedido factura since updated",
}
CUE = [re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, words.split()), key=len, reverse=True)) + r")(?!\w)") for words in CUES.values()]
NEAR = 48


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    s = text[start:end]
    before, after = text[max(0, start - NEAR) : start].lower(), text[end : end + NEAR // 2].lower()
    digits = re.sub("[^0-9]", "", s)
    groups = re.findall("[0-9]+", s)
    letters = sum(c.isalpha() for c in s)
    code = re.sub("[^A-Z0-9]", "", s)
    ymd = [int(g) for g in groups] if len(groups) == 3 and len(s) <= 10 else []
    if ymd and len(groups[0]) < 4:
        ymd = ymd[::-1]
    out = [
        kind, len(s), len(digits), letters, len(s) - len(digits) - letters, len(groups), len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0, max(map(len, groups), default=0),
        len(set(re.sub("[A-Za-z0-9]", "", s))), bool(digits) and luhn(digits[-40:]), kind == ADDED.index("iban") and mod_97(code), bool(ymd) and 1900 <= ymd[0] <= 2030 and max(ymd[1:]) <= 31 and 1 <= min(ymd[1:]) <= 12,
        s[0] == "0", s[0] == "(", "[" in s or "{" in s or "(" in s[1:], " dot " in s.lower(), "::" in s, len(set(s.lower())),
        before[-1:].isalnum() or before[-1:] in "#$€£/=_", after[:1].isalnum() or after[:1] in "%/=_" and bool(after), before[-1:] == ":" or before[-2:] == ": ",
        sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
    ]
    for cue in CUE:
        last = NEAR
        for m in cue.finditer(before):
            last = len(before) - m.end()
        m = cue.search(after)
        out += [last, m.start() if m else NEAR]
    return [float(v) for v in out]


def candidates(text: str, base: dict[str, list[Span]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of every proposal that overlaps no base span."""
    taken = sorted(s for spans in base.values() for s in spans)
    starts, reach = [s for s, _ in taken], []
    for _, e in taken:
        reach.append(max(e, reach[-1] if reach else 0))
    out = set()
    for k, kind in enumerate(ADDED):
        for s, e in GENERATORS[kind](text):
            i = bisect.bisect_left(starts, e)
            if not i or reach[i - 1] <= s:
                out.add((k, s, e))
    return sorted(out)


# ---- planted training data


def _numbers(r: random.Random, shape: str) -> str:
    return "".join(str(r.randrange(10)) if c == "9" else r.choice("ABCDEFGHJKLMNPRSTUVWXYZ") if c == "A" else r.choice("0123456789abcdef") if c == "f" else c for c in shape)


def _card(r: random.Random, valid: bool = True) -> str:
    d = str(r.choice((4, 5, 37))) + _numbers(r, "9" * r.choice((11, 14)))
    last = next(str(c) for c in range(10) if luhn(d + str(c)))
    return d + (last if valid else str((int(last) + r.randrange(1, 10)) % 10))


def _iban(r: random.Random) -> str:
    body, country = _numbers(r, "9" * 18), r.choice(("DE", "FR", "ES", "NL"))
    check = next(f"{c:02d}" for c in range(2, 99) if mod_97(f"{country}{c:02d}{body}"))
    return f"{country}{check}{body}"


def _fours(s: str, sep: str = " ") -> str:
    return sep.join(s[i : i + 4] for i in range(0, len(s), 4))


def _date(r: random.Random, low: int, high: int) -> str:
    y, m, d = r.randrange(low, high), r.randrange(1, 13), r.randrange(1, 29)
    return r.choice((f"{d:02d}.{m:02d}.{y}", f"{m}/{d}/{y}", f"{y}-{m:02d}-{d:02d}"))


def _person(r: random.Random) -> str:
    return r.choice(("anna", "jean", "maria", "k.schmidt", "j_doe", "luis")) + str(r.randrange(100))


def _right(r: random.Random, kind: str) -> tuple[str, str, str]:
    """Words before a made-up span, the span, and what follows."""
    at, dot = r.choice((" [at] ", "(at)", " at ", " {at} ")), r.choice((" [dot] ", "(dot)", " dot "))
    value = {
        "email_spelled": lambda: f"{_person(r)}{at}mail{r.randrange(9)}{dot}example{dot}{r.choice(('com', 'org', 'de'))}",
        "phone_local": lambda: _numbers(r, r.choice(("(999) 555-9999", "999-555-9999", "0999 9999999", "09 99 99 99 99", "099/99999999", "999 99 99 99"))),
        "card_part": lambda: _fours(_card(r), r.choice(" -")),
        "national_id": lambda: _numbers(r, "999-99-9999") if r.random() < 0.6 else (lambda n: f"{n:08d}" + "TRWAGMYFPDXBNJZSQVHLCKE"[n % 23])(r.randrange(10**8)),
        "iban": lambda: r.choice((_iban(r), _fours(_iban(r)))),
        "ipv6": lambda: ":".join(_numbers(r, "ffff") for _ in range(8)) if r.random() < 0.6 else "2001:db8::" + ":".join(_numbers(r, "fff") for _ in range(3)),
        "mac": lambda: ":".join(_numbers(r, "ff") for _ in range(6)),
        "birth_date": lambda: _date(r, 1930, 2010),
        "document_id": lambda: _numbers(r, r.choice(("A99999999", "AA9999999", "9999999AA", "A9A99A99A"))),
    }[kind]()
    classes = {"email_spelled": "mail", "phone_local": "phone", "card_part": "card", "national_id": "id", "iban": "bank", "ipv6": "net", "mac": "net", "birth_date": "birth", "document_id": "id"}
    cue = r.choice(CUES[classes[kind]].split())
    cue = r.choice((cue, cue.capitalize(), f"{cue} number", f"{cue} is", f"my {cue}")) + r.choice((": ", " ", " - "))
    after = f" {r.randrange(1, 13):02d}/{r.randrange(24, 34)}" if kind == "card_part" else r.choice(("", ".", ",", " or later"))
    return cue if r.random() < 0.8 else "", value, after


def _wrong(r: random.Random) -> tuple[str, str, str]:
    value = r.choice((
        lambda: _numbers(r, "999-555-9999"), lambda: _numbers(r, "999 999 999"), lambda: _numbers(r, "978-9-99-999999-9"), lambda: _numbers(r, "99/999999"), lambda: _fours(_card(r, False)) + " 12/27", lambda: _numbers(r, "9999 9999 9999 9999 99"),
        lambda: _numbers(r, "999-99-9999"), lambda: _numbers(r, "99999999A"), lambda: _numbers(r, "AA99 9999 9999 9999 9999 99"), lambda: _numbers(r, "AA99AAAA99999999999999"), lambda: ":".join(_numbers(r, "99") for _ in range(r.choice((3, 4, 6)))),
        lambda: "-".join(_numbers(r, "99") for _ in range(6)), lambda: _date(r, 1950, 2030), lambda: _numbers(r, "A999A99B"), lambda: _numbers(r, "AAA9999"), lambda: "look at page.two", lambda: "meet us at example.com", lambda: "open at nine dot five",
    ))()
    cue = r.choice(CUES["other"].split())
    return (cue + r.choice((" ", ": ", " no. ")) if r.random() < 0.8 else ""), value, r.choice(("", ".", ","))


def planted(text: str, seed: int, each: int = 6) -> tuple[str, set[tuple[int, int, int]]]:
    """text with made-up personal data and look-alikes put between its words, and the spans (kind, start, end) of the former."""
    r = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")) ^ seed)
    gaps = [m.end() for m in re.finditer(r"\s", text)] or [len(text)]
    out, at, n, spans = [], 0, 0, set()
    for gap in sorted(r.choices(gaps, k=each)):
        out.append(text[at:gap])
        n += gap - at
        at = gap
        kind = r.randrange(len(ADDED))
        good = r.random() < 0.5
        cue, value, after = _right(r, ADDED[kind]) if good else _wrong(r)
        if good:
            spans.add((kind, n + len(cue), n + len(cue) + len(value)))
        piece = f"{cue}{value}{after} "
        out.append(piece)
        n += len(piece)
    return "".join([*out, text[at:]]), spans


@dataclass(frozen=True)
class Detector:
    trees: Boosted
    thresholds: np.ndarray

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text (kind by KINDS, start, end): base spans and the selected candidates."""
        base = [base_spans(t) for t in texts]
        found = [candidates(t, b) for t, b in zip(texts, base)]
        rows = [features(t, *c) for t, cs in zip(texts, found) for c in cs]
        score = self.trees.score(np.array(rows)) if rows else np.zeros(0)
        out, at = [], 0
        for b, cs in zip(base, found):
            picked = []
            sure = [(x, c) for x, c in zip(score[at : at + len(cs)], cs) if x >= self.thresholds[c[0]]]
            at += len(cs)
            taken: list[Span] = []
            for _, (k, s, e) in sorted(sure, key=lambda z: (-z[0], z[1][1] - z[1][2], z[1])):
                i = bisect.bisect_left(taken, (s, e))
                if (i == len(taken) or taken[i][0] >= e) and (not i or taken[i - 1][1] <= s):
                    taken.insert(i, (s, e))
                    picked.append((len(BASE) + k, s, e))
            out.append(sorted([(k, s, e) for k, kind in enumerate(BASE) for s, e in b[kind]] + picked))
        return out


def labelled(texts: list[str], least: int = 0, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, label and document number of the candidates in texts with planted data; few texts are planted anew until there are `least`."""
    x, y, doc = [], [], []
    for n in range(max(least, len(texts))):
        again, i = divmod(n, len(texts))
        t, spans = planted(texts[i], seed + again)
        for c in candidates(t, base_spans(t)):
            x.append(features(t, *c))
            y.append(c in spans)
            doc.append(i)
    return np.array(x).reshape(len(y), -1), np.array(y, float), np.array(doc)


def fit_detector(texts: list[str], *, least: int = 1500, precision: float = 0.97) -> Detector:
    x, y, doc = labelled(texts, least)
    held = (doc if len(texts) > 1 else np.arange(len(y))) % 3 == 0
    trees = fit(x[~held], y[~held])
    score = trees.score(x[held])
    kind = x[held][:, 0].astype(int)
    return Detector(trees, np.array([threshold_for(score[kind == k], y[held][kind == k], precision) for k in range(len(ADDED))]))


def scan_personal(docs: DataFrame, *, id: str = "doc_id", text: str = "text", sample: int = 1500, excerpt: int = 1000, precision: float = 0.97) -> DataFrame:
    """id and spans (array of kind, start, end, by kind and start), one row for each row of docs. precision: what a kind's threshold must reach on held-out planted data."""
    plain = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    short = plain.select("id", F.substring(F.coalesce("text", F.lit("")), 1, excerpt).alias("text"))
    # about four times the sample, of which the least by hash: a share, so that what reaches the driver does not grow with the number of partitions
    share = min(1.0, 4 * sample / max(1, plain.count()))
    some = short.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).groupBy("id").agg(F.min("text").alias("text"))
    texts = [r.text for r in some.orderBy(F.xxhash64("id"), "id").limit(sample).collect()]
    detector = fit_detector(texts, least=sample, precision=precision) if texts else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
            found = detector.spans([t or "" for t in b.column(1).to_pylist()]) if detector else [[]] * b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([[{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans] for spans in found], kind)], ["id", "spans"])

    return plain.mapInArrow(run, f"id {docs.schema[id].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint>>")
