import gzip
import hashlib
import json
import sqlite3

from pyspark.sql import functions as F

from castellan.functions import paths
from castellan.operators import checks, places, rated
from castellan.sources import events, facts, tables

PLAYERS = [{"name": " A  B ", "fide_id": "12345", "fed": "usa", "rating": 2400, "score": 1.5, "rank": 1}, {"name": " "}]


def test_facts_of_both_kinds_in_order(spark, tmp_path):
    site = tmp_path / "twic"
    site.mkdir()
    (site / "t.json").write_text(json.dumps([
        {"event": "No date", "format": "swiss", "players": PLAYERS}, {"event": " One ", "format": "swiss", "start": "2003-02", "players": PLAYERS},
        {"event": "Nobody", "format": "swiss", "start": "2003", "players": [{"name": ""}]}, {"event": "Two", "format": "swiss", "start": "2004-01-02", "end": "2004-01-05", "ref": "r2", "source": "own", "players": PLAYERS}]))
    docs = tmp_path / "edo"
    docs.mkdir()
    for name, start, source in (("b", '<ctml:start y="1901" m="3" precision="month"/>', '<ctml:source kind="edo"><ctml:uri>u</ctml:uri></ctml:source>'), ("a", "<ctml:start><ctml:day y='1900' m='2' d='3'/></ctml:start>", ""), ("c", "", "")):
        (docs / f"{name}.xml").write_text(f"""<?xml version="1.0"?>
<ctml:tournament xmlns:ctml="urn:ctml:1.0" id="t_{name}"><ctml:header><ctml:name>N {name}</ctml:name><ctml:dates>{start}</ctml:dates></ctml:header>
<ctml:participants><ctml:participant id="p1"><ctml:playerRef ref="player:x"><ctml:name display="X, Y"/></ctml:playerRef><ctml:ratingSnapshot><ctml:value>2100</ctml:value></ctml:ratingSnapshot><ctml:score>2</ctml:score><ctml:notes>rank=3; x</ctml:notes></ctml:participant></ctml:participants>{source}
</ctml:tournament>""")
    got = facts.collected_facts(spark, [str(site / "t.json"), str(tmp_path / "absent.json")], [str(docs / "*.xml")], str(tmp_path)).orderBy("idx").collect()
    assert [(r.tid, r["name"], r.source, r.row_index) for r in got] == [("t-2", "One", "twic", 2), ("r2", "Two", "own", 4), ("t_a", "N a", "edo", 1), ("t_b", "N b", "edo", 1)]
    assert got[0].end == got[0].start and (got[1].end.y, got[1].end.m, got[1].end.d) == (2004, 1, 5)
    assert [p.asDict() for p in got[0].participants] == [{"ref": "player:fide:12345", "name": "A B", "fed": "USA", "title": "", "fide_id": "12345", "rating": 2400, "score": 1.5, "rank": 1}]
    assert [(p.ref, p.name, p.rating, p.score, p.rank) for p in got[3].participants] == [("player:x", "X, Y", 2100, 2.0, 3)]
    assert (got[2].start.y, got[2].start.m, got[2].start.d) == (1900, 2, 3)


def test_scores(spark):
    df = spark.createDataFrame([("1,5",), ("½",), ("2½",), ("x",), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(facts.points(F.col("s"))).collect()] == [1.5, 0.5, 2.5, None, None, None]


def test_delimited_files(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes("﻿DB-Key,Name\n7,first\nx,no\n 7 ,second\n8,\"a, \"\"b\"\"\"\n".encode())
    assert tables.read_table(spark, str(tmp_path / "m.csv")).columns == ["DB-Key", "Name"]
    assert sorted(map(tuple, tables.read_manifest(spark, str(tmp_path / "m.csv")).collect())) == [("7", "first"), ("8", 'a, "b"')]
    for n in ("a-1.ssp", "a-3.ssp", "a-2.ssp"):
        (tmp_path / n).write_text("")
    assert tables.newest(spark, str(tmp_path / "*.ssp")).endswith("a-3.ssp")


def test_pages_and_database(spark, tmp_path):
    for page, links in (("p1", "m1 m2 m1"), ("p2", "m2"), ("q3", "m9")):
        (tmp_path / f"{page}.html").write_text("".join(f'<a href="../matches/{m}.html">x</a>\n' for m in links.split()))
    assert {r.target: r.pages for r in tables.page_index(spark, str(tmp_path / "p*.html")).collect()} == {"m1": ["p1"], "m2": ["p1", "p2"]}
    with sqlite3.connect(tmp_path / "x.db") as con:
        con.execute("create table t (id integer, name text, score real, odd int)")
        con.executemany("insert into t values (?, ?, ?, ?)", [(i, f"n{i}", i / 2, "seven" if i == 3 else None) for i in range(100)])
        con.execute("create table none (a text)")
    df = tables.read_database(spark, str(tmp_path / "x.db"), "t")
    assert df.dtypes == [("id", "bigint"), ("name", "string"), ("score", "double"), ("odd", "bigint")]
    assert sorted(map(tuple, df.collect())) == [(i, f"n{i}", i / 2, None) for i in range(100)]
    assert tables.read_database(spark, str(tmp_path / "x.db"), "none").count() == 0


def test_geography(spark, tmp_path):
    with gzip.open(tmp_path / "c.json.gz", "wt") as f:
        json.dump([{"id": 1, "iso2": "AA", "iso3": "AAA", "name": "A", "translations": {"fr": "Af", "de": "Ad"}, "states": [{"id": 5, "name": "S", "iso3166_2": "AA-S"}, {"id": 6, "name": "T"}]}, {"id": 2, "iso3": "BBB", "name": "B"}], f)
    with gzip.open(tmp_path / "cities.csv.gz", "wt") as f:
        f.write("id,name,type,country_id,state_id\n10,X,city,1,5\n11,Y,,1,\n")
    countries, states = tables.read_countries(spark, str(tmp_path / "c.json.gz"))
    assert sorted((r.id, r.code) for r in states.collect()) == [(5, "AA-S"), (6, "AAA-6")]
    named = countries.select("id", tables.alternative_names(F.col("translations")).alias("n"))
    assert {r.id: [tuple(x) for x in r.n] for r in named.collect()} == {1: [("de", "Ad"), ("fr", "Af")], 2: []}
    assert sorted(map(tuple, tables.read_cities(spark, str(tmp_path / "cities.csv.gz")).collect())) == [("10", "X", "city", 1, 5), ("11", "Y", None, 1, None)]
    xml = countries.filter("id = 1").select(places.place_element(F.concat(F.lit("place:country:"), "iso3"), F.lit("country"), F.col("name"), {"iso2": F.col("iso2"), "iso3": F.col("iso3"), "latitude": F.col("latitude")}, tables.alternative_names(F.col("translations")))).first()[0]
    assert xml == '  <ctml:place ref="place:country:AAA" kind="country">\n    <ctml:name>A</ctml:name>\n    <ctml:iso2>AA</ctml:iso2>\n    <ctml:iso3>AAA</ctml:iso3>\n    <ctml:altNames>\n      <ctml:altName lang="de">Ad</ctml:altName>\n      <ctml:altName lang="fr">Af</ctml:altName>\n    </ctml:altNames>\n  </ctml:place>'


def test_event_records(spark, tmp_path):
    (tmp_path / "e.xml").write_text("""<?xml version="1.0"?><ctml:events xmlns:ctml="urn:ctml:2.0">
<ctml:eventSeries ref="s1"><ctml:name>Series  One</ctml:name></ctml:eventSeries><ctml:eventSeries ref="s2"><ctml:name> </ctml:name></ctml:eventSeries>
<ctml:eventOccurrence ref="o1"><ctml:seriesRef>s1</ctml:seriesRef><ctml:aliases><ctml:alias source="x" site="Paris">S1</ctml:alias><ctml:alias> </ctml:alias></ctml:aliases><ctml:notes>Edo tournament t12</ctml:notes></ctml:eventOccurrence>
<ctml:eventOccurrence ref="o2"><ctml:seriesRef>s9</ctml:seriesRef></ctml:eventOccurrence>
<ctml:eventOccurrence ref="o3"><ctml:seriesRef>s1</ctml:seriesRef><ctml:name>Own</ctml:name><ctml:placeRef ref="place:1"><ctml:name>Rome</ctml:name></ctml:placeRef></ctml:eventOccurrence></ctml:events>""")
    e = events.read_event_records(spark, str(tmp_path / "e.xml"))
    assert {r.ref: (r["name"], r.aliases, r.sites, r.place_refs, r.place_names) for r in e.collect()} == {"s1": ("Series One", [], [], [], []), "o1": ("Series One", ["S1"], ["Paris"], [], []), "o3": ("Own", [], [], ["place:1"], ["Rome"])}
    assert [tuple(r) for r in events.referenced(e).collect()] == [("t12", "o1")]


def test_locations(spark):
    rows = [("Bath", "Events taking place in Bath, Somerset, England (UK)"), ("", "Paris, France"), ("X", None), (None, None), ("Rome", "Rome"), ("Y", "A, B, C")]
    got = [tuple(r.p) for r in spark.createDataFrame(rows, "n string, h string").select(places.parse_location(F.col("n"), F.col("h")).alias("p")).collect()]
    assert got == [("Bath", "Somerset", "England"), ("Paris", None, "France"), ("X", None, None), ("", None, None), ("Rome", None, "Rome"), ("Y", "A, B", "C")]


PLACES = "ref string, name string, country string, kind string, priority int, aliases array<string>, legacy boolean"


def test_site_entries(spark):
    p = spark.createDataFrame([
        ("c1", "France", "FRA", "country", 0, ["Frankreich"], False), ("p1", "Paris", "FRA", "city", 0, ["Lutetia"], False), ("p2", "paris", "", "city", 1, [], True),
        ("p3", "Lyon", "", "city", 0, ["Lyon, Frankreich"], False), ("p4", "York", "GBR", "city", 0, [], False), ("p5", "York", "USA", "city", 0, [], False), ("p6", "Unused", "GBR", "city", 0, [], False)], PLACES)
    assert {r.ref: r.country for r in places.infer_countries(p).collect()} == {"c1": "FRA", "p1": "FRA", "p2": "FRA", "p3": "FRA", "p4": "GBR", "p5": "USA", "p6": "GBR"}
    e = spark.createDataFrame([(["York", "online", "http://x", "Nowhere", "#1"], [], ["p3"]), ([], ["Lutetia"], [])], "sites array<string>, place_names array<string>, place_refs array<string>")
    entries, problems = places.site_entries(p, e)
    assert {r.canonical: r.aliases for r in entries.collect()} == {
        "Paris FRA": ["Lutetia", "Lutetia FRA", "Paris", "paris", "paris FRA"], "Lyon FRA": ["Lyon", "Lyon, Frankreich", "Lyon, Frankreich FRA"], "Nowhere": []}
    assert {(r.name, r.problem) for r in problems.collect()} == {("York", "ambiguous"), ("online", "not a place"), ("http://x", "not a place"), ("Nowhere", "standalone"), ("#1", "unusable")}
    assert sorted(map(tuple, places.country_suffixes(p).collect())) == [("(France)", "FRA"), ("(Frankreich)", "FRA")]
    rounds = {r.canonical: r.aliases for r in places.round_entries(spark, 10).collect()}
    assert len(rounds) == 10 and rounds["1"] == ["(01)", "(1)", "01"] and rounds["10"] == ["(10)"]
    ev = spark.createDataFrame([("Final", ["The Final"], 0), ("Cup", [], 0)], "name string, aliases array<string>, priority int")
    assert {r.canonical: r.aliases for r in places.event_entries(ev, {"final": ["end"]})[0].collect()} == {"final": ["end", "Final", "The Final"], "Cup": []}


def test_screening(spark):
    t = spark.createDataFrame([(1, [(2000,), (2100,)]), (2, [(2000,)]), (3, [(2000,), (None,)]), (4, [(1999,), (2100,)]), (5, None)], "id int, players array<struct<rating:bigint>>")
    assert {r.id: (r.kept, r.reason, r.lowest) for r in rated.screened_crosstables(t, 2000).collect()} == {
        1: (True, "all 2 players rated 2000+", 2000), 2: (False, "fewer than 2 players", None), 3: (False, "1 of 2 players unrated", 2000), 4: (False, "1 of 2 players below 2000", 1999), 5: (False, "fewer than 2 players", None)}
    e = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "EventID string")
    r = spark.createDataFrame([("a", 2000), ("a", 2200), ("b", None), ("b", 10), ("c", 10), ("z", 9000)], "EventID string, Rating int")
    s = rated.screened_events(e, r, "EventID", "Rating", 2000)
    assert {x.EventID: (x.kept, x.reason, x.least) for x in s.collect()} == {"a": (True, "all 2 player ratings >= 2000", 2000), "b": (False, "1 missing/unrated player ratings", 10), "c": (False, "1 player ratings below 2000", 10), "d": (False, "no player rows", None)}
    assert rated.kept_rows(r, s, "EventID").count() == 2


def test_game_participants(spark):
    g = spark.createDataFrame([("e", 1, "A", "B"), ("e", 2, "C", "A"), ("e", 3, "A", "A"), ("e", 4, None, "D"), ("f", 5, "B", "")], "event string, n int, white string, black string")
    people, games = rated.game_participants(g, ["event"], "n")
    assert sorted(map(tuple, people.collect())) == [("e", "A", "p0001"), ("e", "B", "p0002"), ("e", "C", "p0003"), ("e", "D", "p0004"), ("f", "B", "p0001")]
    assert {r.n: (r.white_id, r.black_id) for r in games.collect()} == {1: ("p0001", "p0002"), 2: ("p0003", "p0001"), 3: (None, None), 4: (None, None), 5: (None, None)}


def test_rated_documents(spark):
    t = spark.createDataFrame([("t1", "Page & Co", "Named", "l1", "3 Mar 1901", "", "n1", "u", "s"), ("t2", "P", "P", None, "bad date", None, None, None, None), ("t3", None, "Only", None, "1902", None, None, "u", None)],
        "tournament_id string, page_title string, name string, place_id string, start_date_raw string, end_date_raw string, notes string, source_url string, source_path string")
    r = spark.createDataFrame([("t1", 2, "score", None, "Doe, John", None, 1.5, None, None, None, None), ("t1", 1, "score", "p7", "Roe, Jane", 2300, 2.0, 5, None, "A", "x"), ("t1", 0, "head", None, "No", None, None, None, None, None, None)],
        "tournament_id string, row_index int, row_kind string, player_id string, player_name string, edo int, score double, games int, dev int, class string, note string")
    places_of = spark.createDataFrame([("l1", "Bath", "Bath, England")], "location_id string, name string, heading string")
    docs = {x.tournament_id: x.xml for x in rated.rated_documents(t, r, places_of, spark.createDataFrame([("t1", "event:1")], "key string, ref string")).collect()}
    assert set(docs) == {"t1", "t3"}
    assert docs["t1"].startswith('<?xml version="1.0" encoding="UTF-8"?>\n<ctml:tournament xmlns:ctml="urn:ctml:1.0" ctmlVersion="1.3" id="t_edo_t1">\n  <ctml:header>\n    <ctml:name>Page &amp; Co</ctml:name>\n    <ctml:eventRef ref="event:1">\n')
    for part in ('      <ctml:start y="1901" m="3" d="3" precision="day"/>', "      <ctml:name>Bath</ctml:name>", '    <ctml:participant id="p0001">\n      <ctml:playerRef ref="player:edo:7"', "<ctml:value>2300</ctml:value>", "<ctml:score>2</ctml:score>",
                 "<ctml:notes>games=5; class=A; x</ctml:notes>", "<ctml:score>1.5</ctml:score>", '<ctml:resolution method="unresolved"', "  <ctml:notes>Edo event name: Named n1</ctml:notes>", "<ctml:note>tournament_id=t1; source_path=s</ctml:note>"):
        assert part in docs["t1"], part
    assert "  <ctml:participants>\n  </ctml:participants>" in docs["t3"] and "<ctml:notes>" in docs["t3"]


def test_safe_names(spark):
    one = lambda f, *xs: [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x string").select(f(F.col("x"))).collect()]
    assert one(paths.safe_segment, "a%20b+c", " CON ", "a<b>|c", "", "100%", "%E9t", None) == ["a b+c", "_CON", "a_b__c", "_", "100%", "\ufffdt", None]
    assert one(paths.local_path, "https://Ex.org:80/a/b%2Fc.htm?x=1#y", "http://e.org", "http://e.org/a;p/b;q", "http://e.org/a.b.txt?q") == [
        f"html/ex.org_80/a/b_c-{hashlib.sha1(b'x=1').hexdigest()[:10]}.htm", "html/e.org/index.html", "html/e.org/a;p/b.html", f"html/e.org/a.b-{hashlib.sha1(b'q').hexdigest()[:10]}.txt"]
    assert one(paths.safe_file_part, " a:  b?. ", "...", "x" * 100) == ["a_ b", "untitled", "x" * 80]
    assert one(paths.file_name_of_url, "http://e.org/x/a%3Ab.html?q", "http://e.org/") == ["a_b.html", f"crosstable-{hashlib.sha1(b'http://e.org/').hexdigest()[:12]}.html"]


def test_value_and_base_checks(spark):
    rows = spark.createDataFrame([(1, 4001, 1, 1, 1900), (2, 0, 32, 13, 1900), (3, None, 1, None, None), (4, -1, None, 2, None), (5, None, None, None, None)], "id int, rating int, d int, m int, y int")
    assert sorted((r.id, r.problem) for r in checks.value_problems(rows, "rating", "d", "m", "y").collect()) == [
        (1, "rating out of range"), (2, "day out of range"), (2, "month out of range"), (3, "day without a month"), (4, "month without a year"), (4, "rating out of range")]
    text = lambda *ls: spark.createDataFrame([(x,) for x in ls], "value string")
    assert checks.base_problems(text('@PLAYER "x"', "A\ufffd\ufffd", None, "")).first().asDict() == {"markers": 1, "has_players": True, "generated": [], "replacement_characters": 2, "usable": True}
    assert checks.base_problems(text("@player", " @Site x", "@EVENT")).first().asDict() == {"markers": 3, "has_players": True, "generated": ["@EVENT", "@SITE"], "replacement_characters": 0, "usable": False}
    assert not checks.base_problems(text().limit(0)).first().usable
