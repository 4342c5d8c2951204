from pyspark.sql import functions as F

from castellan.chess.hashing import derived_keys
from castellan.functions import pages
from castellan.operators import documents, registries
from castellan.sources.registry import CROSSTABLE
from castellan.streaming.ingest import existing, ingest


def test_merge_players(spark):
    rows = [("123", 1, "Doe, J", ["IM"], False, None, "USA", 5, ["Doe, John"]), ("123", 2, "Doe, John", ["GM", "IM"], True, 1970, "GER", 9, ["Doe, J", "Dough"]), (None, 3, "Roe", [], False, None, "", 0, [])]
    d = spark.createDataFrame(rows, "fide_id string, line long, name string, titles array<string>, female boolean, birth_year int, federation string, rated_months int, aliases array<string>")
    m = {r.name: r for r in registries.merge_players(d).collect()}
    assert set(m) == {"Doe, J", "Roe"} and m["Doe, J"].titles == ["IM", "GM"] and m["Doe, J"].federation == "GER" and m["Doe, J"].birth_year == 1970 and m["Doe, J"].aliases == ["Doe, John", "Dough"]
    months = spark.createDataFrame([("k", 1, 2000, 1, 2400), ("k", 1, 2000, 2, 2410), ("k", 2, 2000, 1, 2500)], "key string, line long, year int, month int, rating int")
    get = lambda p: {(r.year, r.month): r.rating for r in registries.merge_rating_months(months, "key", p).collect()}
    assert get("sparse") == {(2000, 1): 2500, (2000, 2): 2410} and get("dense")[2000, 1] == 2400


def test_places_and_entries(spark):
    p = spark.createDataFrame([("r", 2, "b", "", "city", ["x"], False), ("r", 1, "B", "ABW", "", ["y", "x"], True)], "ref string, priority int, name string, country string, kind string, aliases array<string>, legacy boolean")
    assert tuple(registries.merge_places(p).first()) == ("r", 1, "B", "ABW", "city", ["x", "y"], True)
    n = spark.createDataFrame([("Paris Open", "P Open", 1), ("paris-open", None, 2), ("Rome", "P Open", 1), ("Rome", "Roma", 1), ("Oslo", "Rome", 1)], "canonical string, alias string, priority int")
    entries, problems = registries.canonical_entries(n)
    assert {r.canonical: r.aliases for r in entries.collect()} == {"Paris Open": ["paris-open"], "Rome": ["Roma"], "Oslo": []}
    assert {(r.name, r.problem) for r in problems.collect()} == {("P Open", "several targets"), ("Rome", "is a canonical name")}
    s = spark.createDataFrame([("E", 1, "A", None), ("E", 2, "a", None), ("E", 3, "A", "z"), ("E", 4, "B", "z"), ("E", 5, "C", "a")], "section string, line int, canonical string, alias string")
    assert sorted(tuple(r) for r in registries.section_problems(s).select("line", "problem").distinct().collect()) == [(1, "duplicate canonical"), (3, "alias of several"), (4, "alias without canonical"), (5, "alias is a canonical"), (5, "alias without canonical")]


def test_geo_and_frontier(spark):
    cities = spark.createDataFrame([(1, "T", None, 9, 5), (2, "U", "adm1", 9, 5), (3, "V", "adm2", 9, 6), (4, "W", None, 8, 5)], "id int, name string, type string, country_id int, state_id int")
    got = registries.place_rows(cities, spark.createDataFrame([(5, "AW-1")], "id int, code string"), spark.createDataFrame([(9, "ABW")], "id int, iso3 string"))
    assert sorted((r.ref, r.parent_ref) for r in got.collect()) == [("place:admin2:ABW-3", "place:country:ABW"), ("place:city:ABW-1", "place:admin1:AW-1")]
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "source string, target string")
    assert {(r.url, r.depth) for r in registries.expand_frontier(links, spark.createDataFrame([("a",)], "url string"), 2).collect()} == {("a", 0), ("b", 1), ("c", 2)}


def test_occurrences(spark):
    day = lambda y, m=None, d=None: (y, m, d)
    rows = [("Linares", day(1994, 2, 28), day(1994, 2, 3), "swiss", "s1", 1), ("LINARES", day(1994, 2, 3), day(1994, 2, 28), None, "s2", 0), ("?", day(1990), None, None, "s", 2), ("X", None, None, None, "s", 3), ("Y", None, day(1999, 13, 4), None, "s", 4)]
    d = spark.createDataFrame(rows, "name string, start struct<y:int,m:int,d:int>, end struct<y:int,m:int,d:int>, format string, source string, ord int")
    got = {r.ref: r for r in registries.occurrences(d).collect()}
    assert set(got) == {"event:19940203-19940228-linares", "event:19990000-19990000-y"} and got["event:19940203-19940228-linares"].name == "LINARES" and got["event:19940203-19940228-linares"].sources == ["s1", "s2"]


def test_documents(spark):
    import json
    from xml.etree import ElementTree

    player = {"rank": 1, "name": "Doe, John Jr.", "title": "g", "fed": "usa", "rating": 2500, "score": 7.5, "fide_id": "12345"}
    tables = [{"event": "Open <A>", "format": "Swiss", "source": "src", "ref": "r 1", "start": "2003-02-33", "players": [player, {"name": " "}], "cadence": "Blitz"}, {"event": "Open <A>", "format": "x", "ref": "r 1", "start": "2003", "players": [player]}, {"event": " ", "format": "x", "players": [player], "start": "2003"}, {"event": "E", "format": "x", "players": [], "start": "2003"}, {"event": "E", "format": "x", "players": [player]}]
    d = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(tables)], "ord int, j string").select("ord", F.from_json("j", CROSSTABLE).alias("t")).select("ord", "t.*")
    docs = documents.tournament_documents(d).orderBy("file_name").collect()
    assert [r.file_name for r in docs] == ["r-1-open-a", "r-1-open-a-2"] and docs[0].id == "t_src_r-1_20030233"
    root = ElementTree.fromstring(docs[0].xml)
    texts = {e.tag.split("}")[1]: e.text for e in root.iter()}
    assert texts["family"] == "Doe" and texts["suffix"] == "Jr." and root.find(".//{urn:ctml:2.0}playerRef").get("ref") == "player:fide:12345" and texts["title"] == "GM" and texts["score"] == "7.5" and texts["eventType"] == "swiss" and "cadence" not in texts and texts["notes"] == "rank=1"
    assert [r.skipped for r in documents.usable(d).orderBy("ord").collect()] == [None, None, "no event", "no named player", "no start date"]


def test_pages(spark):
    html = '<table class="CRs1"><tr><th>Name</th><th>Rtg</th></tr><tr><td>A</td><td><b>2400</b></td></tr><tr><td>B</td><td>2301</td></tr><tr><td>C</td><td>0</td></tr></table>'
    d = spark.createDataFrame([(html, bytearray(b"PK\x03\x04x"), "http://a/b/2003/x.html"), ("<p>", bytearray("﻿é".encode()), "http://a/x.PNG"), (None, bytearray(b"\xe9"), "http://a/cross.htm")], "h string, b binary, u string")
    got = d.select(pages.rating_mean(F.col("h")), pages.content_kind(F.col("b"), F.lit("")), pages.link_kind(F.col("u")), pages.decoded(F.col("b"))).collect()
    assert [tuple(r)[:3] for r in got] == [(2350, ".xlsx", "event"), (None, ".bin", "asset"), (None, ".bin", "crosstable")] and [r[3] for r in got[1:]] == ["é", "é"]


def test_stream_adds_only_what_is_new(spark, tmp_path):
    src, corpus, at = tmp_path / "in", f"file://{tmp_path}/corpus", f"file://{tmp_path}/at"
    src.mkdir()
    game = '[Event "Open"]\n[Round "1"]\n[White "Ann"]\n[Black "Bob"]\n\n1. e4 {} *\n'
    for name, moves in (("a", "e5"), ("b", "e5"), ("c", "c5")):
        (src / f"{name}.pgn").write_text(game.format(moves))
        ingest(spark, f"file://{src}", corpus, at, derived_keys()).awaitTermination()
    assert existing(spark, corpus).count() == 1 and spark.read.parquet(f"{corpus}/divergences").count() == 1
