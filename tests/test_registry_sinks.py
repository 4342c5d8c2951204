"""Registries written and read back; sections behind a base, byte by byte."""

import pytest

from castellan.operators.registries import player_records
from castellan.sinks.files import write_each
from castellan.sinks.registries import BANNER, CLOSING, place_shards, player_shards, write_enriched
from castellan.sources.players import read_players
from castellan.sources.registry import element_counts, read_player_registry

SSP = """@PLAYER "x"
Doe, John Paul Jr. #GM+IM USA [2402] 1970.??.??
  %Bio FIDE 100000
  %Bio Edo 4
  %Elo 2001:2400,?,?,2410,?,?,?,?,?,?,?,2405
  %Elo 1999:?,?,?,?,?,?,?,?,?,?,?,2300
  = Doe & Co
Doherty, Ann #WGM
Doe, J. #FM GER
  %Bio FIDE 100000
  %Elo 2001:?,2222
Élan #-
zed #-
"""


def test_players_come_back(spark, tmp_path):
    (tmp_path / "a.ssp").write_text(SSP)
    records = player_records(read_players(spark, f"file://{tmp_path}/a.ssp", "raw")).cache()
    shards = player_shards(records, shard_records=1)
    names = sorted(r.name for r in write_each(shards, f"file://{tmp_path}/players").collect())
    assert names == ["players-D", "players-D-2", "players-OTHER", "players-Z"]
    back = {r.ref: r for r in read_player_registry(spark, f"{tmp_path}/players/players-*.xml").collect()}
    own = {r.ref: r for r in records.collect()}
    assert set(back) == set(own) and len(own) == 4
    doe, was = back["player:fide:100000"], own["player:fide:100000"]
    assert (doe.display, doe.family, doe.given, doe.suffix) == ("Doe, John Paul Jr.", "Doe", ["John", "Paul"], "Jr.")
    assert (doe.federation, doe.titles, doe.birth_year, doe.ids, doe.female) == ("USA", ["GM", "IM", "FM"], 1970, ["edo:4"], False)
    assert [(a.family, a.given) for a in doe.aliases] == [("Co", ["Doe", "&"]), ("Doe", ["J."])]
    assert (doe.current_rating, doe.peak, doe.peak_year, doe.peak_month) == (2405, 2410, 2001, 4) == (was.current_rating, was.peak, was.peak_year, was.peak_month)
    assert [(y.year, [m.rating for m in y.months]) for y in doe.history] == [(1999, [None] * 11 + [2300]), (2001, [2400, 2222, None, 2410] + [None] * 7 + [2405])]
    ann = next(r for r in back.values() if r.family == "Doherty")
    assert ann.female and ann.titles == ["WGM"] and ann.history == [] and ann.peak is None


@pytest.mark.parametrize("base", [b"", b"@PLAYER\r\nDoe\r\n", "@PLAYER\né no end".encode()])
def test_sections_equal_a_sequential_writer(spark, tmp_path, base):
    (tmp_path / "base.ssp").write_bytes(base)
    entries = [(f"Name {i % 97:03d} {i}", [f"a{i}", f'b "{i}"'][: i % 3]) for i in range(400)]
    d = spark.createDataFrame(entries, "canonical string, aliases array<string>").repartition(7)
    rules = [("Prefix", 'II "x"', "a\\b")]
    out = f"file://{tmp_path}/out/enriched.ssp"
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "enriched.ssp").write_text("old")
    size = write_enriched(spark, f"file://{tmp_path}/base.ssp", out, {"SITE": (".,", [], d), "EVENT": (",. -_", rules, d.limit(0)), "ROUND": ("", [], d.filter("size(aliases) = 1"))})
    text = lambda keep: [x for c, aliases in sorted(entries, key=lambda e: (e[0].lower(), e[0])) if keep(aliases) for x in (c, *(f"  = {a}" for a in aliases))]
    lines = ["", *BANNER, '@SITE ".,"', *text(lambda a: True), "", '@EVENT ",. -_"', '%Prefix "II \\"x\\"" "a\\\\b"', "", '@ROUND ""', *text(lambda a: len(a) == 1), *CLOSING]
    want = base + (b"\r\n" if base and not base.endswith(b"\n") else b"") + "".join(f"{x}\r\n" for x in lines).encode()
    assert (tmp_path / "out" / "enriched.ssp").read_bytes() == want and size == len(want)
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")] == ["enriched.ssp"]


def test_place_shards_and_counts(spark, tmp_path):
    rows = [("r1", "country", "AAA"), ("r2", "admin1", "AAA"), ("r3", "city", "AAA"), ("r5", "admin2", "AAA"), ("r4", "city", "AAA"), ("r6", "city", None), ("r7", "city", "BBB")]
    p = spark.createDataFrame(rows, "ref string, kind string, country string").selectExpr("*", "'<ctml:place ref=\"' || ref || '\"><ctml:name/><!-- <ctml:place> --></ctml:place>' as xml")
    shards = place_shards(p, shard_records=2)
    written = write_each(shards, f"file://{tmp_path}/places")
    assert sorted(r.name for r in written.collect()) == ["places-cities-AAA", "places-cities-AAA-2", "places-cities-BBB", "places-cities-NONE", "places-countries", "places-states"]
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "places").iterdir()}
    assert written.count() == 6 and {f.name: f.stat().st_mtime_ns for f in (tmp_path / "places").iterdir()} == before
    n = {r.file.rpartition("/")[2]: (r.records, r.sub_records) for r in element_counts(spark, f"file://{tmp_path}/places/*.xml", "place", "name").collect()}
    assert n["places-cities-AAA.xml"] == (2, 2) and sum(x for x, _ in n.values()) == 7
    assert "r3" in (tmp_path / "places" / "places-cities-AAA.xml").read_text() and "r5" in (tmp_path / "places" / "places-cities-AAA-2.xml").read_text()
