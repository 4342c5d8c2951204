"""Player blocks against a plain reading of the whole file, at any split size."""

import re

import pytest

from castellan.sources.lines import section_counts
from castellan.sources.players import block_counts, last_block_wins, read_players

SSP = """# banner
Nobody #- [100]
@PLAYER "., -_*"

Family, Given #GM+WGM USA [2402] 1975.??.??
  %Bio FIDE 1234567
  %Bio Edo 42
  %Elo 2001:2400,?,?,2410,?,?,?,?,?,?,?,2405,9999
  %Elo 2002:x
  %Elo 2001:1,?
  = Alias, Other
# inside
\t= Tabbed
   Deeper
Plain Name #- GER
  %Bio FIDE 19
Two Shapes #- [1900] 1980.05.??
  %Bio FIDE 0012345
  %Bio FIDE 19

Three Shapes # [x] ????.??.??
  %Bio fide 5555
  %Elo 2003:2000
A #b C #GM [2000]
  = lost
Short [2000]
Last One #WIM USA [2100]
  %Bio FIDE 1234567
@EVENT ",. -_"
Canonical Name
  = alias
@PLAYER again
Back Again #- [1]
  %Bio FIDE 98765
"""


def strict(text):
    """The blocks of the strict dialect, line by line."""
    out, section, block = [], None, None
    for n, raw in enumerate(text.split("\n"), 1):
        line, indented = raw.strip(), raw[:1] in (" ", "\t")
        if not line:
            continue
        if line.startswith("@"):
            section, block = line[1:].startswith("PLAYER"), None
        elif not indented and line.startswith("#") or not section:
            continue
        elif not indented:
            words = line.split()
            at = next((i for i, w in enumerate(words) if w.startswith("#")), None)
            rest = words[at + 1 :] if at is not None else []
            m = at is not None and re.fullmatch(r"(?:([A-Z]{3}) )?\[([^ ]*)\](?: ([0-9?]{4})\.[0-9?]{2}\.[0-9?]{2})?", " ".join(rest))
            n_of = lambda x: int(x) if x and re.fullmatch("[+-]?[0-9]+", x) else None
            block = {"line_no": n, "malformed": not m, "fide_id": None, "ids": [], "elo": {}, "aliases": []}
            block |= {"name": " ".join(words[:at]), "title_token": words[at][1:], "federation": m[1], "bracket_rating": n_of(m[2]), "birth_year": n_of(m[3])} if m else dict.fromkeys(("name", "title_token", "federation", "bracket_rating", "birth_year"))
            out.append(block)
        elif block and not block["malformed"]:
            if line.startswith("= "):
                block["aliases"].append(line[2:])
            elif line.startswith("%Bio "):
                source, _, value = line[5:].partition(" ")
                block["ids"].append((source, value.strip()))
                if source == "FIDE":
                    block["fide_id"] = str(int(value)) if re.fullmatch("[0-9]{4,12}", value.strip()) else None
            elif line.startswith("%Elo "):
                year, _, values = line[5:].partition(":")
                months = [n_of(v) for v in values.split(",")][:12]
                block["elo"][int(year)] = months + [None] * (12 - len(months))
    return out


def shown(rows):
    keys = ("line_no", "malformed", "name", "title_token", "federation", "bracket_rating", "birth_year", "fide_id", "ids", "elo", "aliases")
    return sorted((tuple([tuple(i) for i in r[k]] if k == "ids" else r[k] for k in keys) for r in rows), key=lambda x: x[0])


@pytest.mark.parametrize("split", ["128m", "9", "64", "300"])
def test_blocks_at_any_split(spark, tmp_path, split):
    (tmp_path / "a.ssp").write_text(SSP)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0" if split != "128m" else "4m")
    try:
        got = read_players(spark, f"file://{tmp_path}/a.ssp").cache()
        assert shown(got.collect()) == shown(strict(SSP))
        well = [r.record_no for r in got.orderBy("line_no").collect() if not r.malformed]
        assert well == list(range(1, 1 + len(well)))
        for limit in (0, 1, 3):
            first = read_players(spark, f"file://{tmp_path}/a.ssp", limit=limit).filter("not malformed")
            assert shown(first.collect()) == shown([b for b in strict(SSP) if not b["malformed"]][:limit])
        assert {r.fide_id: r.name for r in last_block_wins(got).collect()} == {"1234567": "Last One", "98765": "Back Again"}
        assert tuple(block_counts(got).first()) == (2, 2, 3)
        assert {r.kind: r.n for r in section_counts(spark, f"file://{tmp_path}/a.ssp").collect()}["record"] == 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def raw(text):
    """(line_no, name, title, federation, rating, year, fide_id, other ids, aliases, years) of the raw dialect."""
    out, now = [], None
    for n, line in enumerate(text.split("\n"), 1):
        if not line or line.startswith("@"):
            continue
        if not line.startswith(" "):
            m = re.match(r"^(.*?) #(\S*)(?:\s+([A-Z]{3}))?(?:\s+\[(\d+)\])?(?:\s+(\S+))?\s*$", line)
            year = m and m[5] and re.fullmatch(r"(\d{4})\.\?\?\.\?\?", m[5])
            now = m and {"at": n, "name": " ".join(m[1].split()), "t": m[2], "fed": m[3], "r": m[4] and int(m[4]), "y": int(year[1]) if year else None, "fide": None, "ids": [], "alias": [], "elo": {}}
            out += [now] if now else []
        elif now:
            if m := re.match(r"^  %Bio (\S+) (.+)$", line):
                s, v = m[1].lower(), m[2].strip()
                if s == "fide" and re.fullmatch(r"\d{4,12}", v):
                    now["fide"] = v
                else:
                    now["ids"].append(("fide-raw" if s == "fide" else s, v))
            elif m := re.match(r"^  %Elo (\d{4}):(.+)$", line):
                now["elo"][int(m[1])] = [v.strip() for v in m[2].split(",")]
            elif m := re.match(r"^  = (.+)$", line):
                now["alias"].append(" ".join(m[1].split()))
    return [tuple(x.values()) for x in out]


@pytest.mark.parametrize("split", ["128m", "40"])
def test_raw_dialect(spark, tmp_path, split):
    (tmp_path / "a.ssp").write_text(SSP.replace("\n", "\r\n") if split == "128m" else SSP)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        r = read_players(spark, f"file://{tmp_path}/a.ssp", "raw").filter("not malformed").orderBy("line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(x.line_no, x.name, x.title_token, x.federation, x.bracket_rating, x.birth_year, x.fide_id, [tuple(i) for i in x.ids], x.aliases, x.elo) for x in r] == raw(SSP)


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "a.ssp").write_text("")
    (tmp_path / "b.ssp").write_text("@EVENT\nx\n")
    assert read_players(spark, f"file://{tmp_path}/*.ssp").count() == 0
