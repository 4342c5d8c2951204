"""Clusters, player comparison, line counts, screening and sinks, each on the cases that tell a right rule from a wrong one."""

import json
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from castellan.functions import dates, names, pages, text, vocabulary
from castellan.operators import admission, clustering, documents, players, registries, screening
from castellan.sinks import files
from castellan.sources import lines
from castellan.sources.players import last_block_wins, read_players
from castellan.sources.registry import read_player_registry


def values(spark, cells, *columns):
    d = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, x string")
    return [tuple(r)[1:] for r in d.select("i", *(c(F.col("x")) for c in columns)).orderBy("i").collect()]


def test_rules_of_text(spark):
    assert [r[0] for r in values(spark, ["64 Masters", "3rd London Open 1862", "Final", "A & B 2099 x", None], text.name_key)] == ["64 masters", "london", "", "a and b x", None]
    assert [r[0] for r in values(spark, ["12", "20250", "2025.0", "099", "x2431*", "", "no"], text.rating_value)] == [0, 2025, 2025, 0, 2431, 0, 0]
    got = values(spark, ["12 Mar 1901", "45 Mar 1901", "12 Foo 1901", "Sept. 1901", "March 850", "1901", "850", "2 3 4 5", ""], dates.parse_day_month_year)
    assert [tuple(r[0]) if r[0] else None for r in got] == [(1901, 3, 12), None, None, (1901, 9, None), (850, 3, None), (1901, None, None), None, None, None]
    assert [tuple(r[0]) for r in values(spark, ["gm", " g ", "Wgm", "hm ", ""], names.normalize_title)] == [("GM", ""), ("GM", ""), ("WGM", ""), ("", "HM"), ("", "")]
    assert [r[0] for r in values(spark, ["classical", " mixed", "Rapid", "", None], lambda x: vocabulary.event_cadence(x, F.lit("a blitz")))] == ["classical", "mixed", "blitz", "blitz", "blitz"]
    assert [r[0] for r in values(spark, ["fide", "FIDE", "", None], vocabulary.rating_system)] == ["fide", "unknown", "unknown", "unknown"]
    assert [r[0] for r in values(spark, ["<p>&eacute;&nbsp;x &hellip;&#233;</p><script>1<2</script>"], text.html_text)] == ["é x …é"]
    n = spark.createDataFrame([(12345678.5,), (1e15,), (7.0,), (0.25,), (1.5e-7,), (-0.5,)], "x double").select(text.format_g(F.col("x"))).collect()
    assert [r[0] for r in n] == ["12345678.5", "1000000000000000", "7", "0.25", "0.00000015", "-0.5"]


def test_anchors(spark):
    html = '<a href="x/y.html#f"> One <b>two</b></a><a name="q">no</a><A HREF=\'/z\'><img alt="Pic"></A><a href=w title="T"></a>'
    d = spark.createDataFrame([(html, "http://h.org/a/b.html"), (None, None)], "h string, u string")
    got = [[tuple(a) for a in r[0]] for r in d.select(text.anchors(F.col("h"), F.col("u"))).collect()]
    assert got == [[("http://h.org/a/x/y.html#f", "One two"), ("http://h.org/z", "Pic"), ("http://h.org/a/w", "T")], []]


def test_content_kinds(spark):
    cases = [(b"PK\x03\x04", "text/html", ".xlsx"), (b"x", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", ".xlsx"), (b"\xd0\xcf\x11\xe0", "application/vnd.ms-excel", ".xls"), (b"\xd0\xcf\x11\xe0", "", ".bin"), (b" \n<!DOCTYPE html>", None, ".html"), (b"a <html>", "", ".html"), (b"%PDF-1", "", ".pdf"), (b"text", "text/html", ".bin")]
    d = spark.createDataFrame([(i, bytearray(b), h) for i, (b, h, _) in enumerate(cases)], "i int, b binary, h string")
    assert [r[0] for r in d.orderBy("i").select(pages.content_kind(F.col("b"), F.col("h"))).collect()] == [k for *_, k in cases]
    raw = ["é".encode("utf-8-sig"), b"\xe9\x9a", b"\x81"]
    d = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(raw)], "i int, b binary")
    assert [r[0] for r in d.orderBy("i").select(pages.decoded(F.col("b"))).collect()] == ["é", "éš", "\x81"]


def test_gates(spark):
    rows = spark.createDataFrame([("a", 0), ("a", 0), ("b", 2300), ("b", 0)], "g string, r int")
    p = admission.rating_profile(rows, ["g"], "r", 2200, 2000).withColumn("html_avg", F.when(F.col("g") == "b", 2150))
    passed = lambda n, t: {r.g: r.passes for r in admission.gate(p, n, t).collect()}
    assert passed("avg_rated", 0) == {"a": False, "b": True} and passed("top_avg", 0) == {"a": False, "b": True} and passed("html_tour_avg", 2150) == {"a": False, "b": True} and passed("avg_all", 1150) == {"a": False, "b": True}
    assert "median_rated" not in admission.GATES


def test_merged_players_keep_other_names(spark):
    rows = [("1", 1, "Doe, J", ["IM"], False, None, "USA", 5, ["Jack"]), ("1", 2, "Doe, John", ["GM"], True, 1970, "GER", 9, ["Doe, J", "Dough"]), (None, 3, "Roe", [], False, None, "", 0, ["R"])]
    d = spark.createDataFrame(rows, "fide_id string, line long, name string, titles array<string>, female boolean, birth_year int, federation string, rated_months int, aliases array<string>")
    assert {r.name: r.aliases for r in registries.merge_players(d).collect()} == {"Doe, J": ["Jack", "Doe, John", "Dough"], "Roe": ["R"]}


def test_entries_keep_all_spellings(spark):
    rows = [("Paris Open", "P Open", 1), ("paris-open", "PARIS.OPEN", 2), ("Rome", "P Open", 1), ("Rome", "Roma", 1), ("Rome", "ROMA ", 1), ("Oslo", "Rome", 1), ("a#b", None, 1), ("Oslo", "=x", 1), ("Café", "Café", 1), ("-. ", None, 1)]
    entries, problems = registries.canonical_entries(spark.createDataFrame(rows, "canonical string, alias string, priority int"))
    assert {r.canonical: r.aliases for r in entries.collect()} == {"Paris Open": ["paris-open", "PARIS.OPEN"], "Rome": ["ROMA", "Roma"], "Oslo": [], "Café": ["Café"]}
    assert {(r.name, r.problem) for r in problems.collect()} == {("P Open", "several targets"), ("Rome", "is a canonical name"), ("a#b", "contains #"), ("=x", "reserved first character"), ("-.", "nothing but marks")}


def test_names_of_files_never_meet(spark):
    bases = ["a", "a", "a-2", "x" * 160 + "1", "x" * 160 + "2"]
    got = registries.unique_names(spark.createDataFrame([(i, b) for i, b in enumerate(bases)], "ord int, base string"), "base", "ord").orderBy("ord").collect()
    assert [r.file_name for r in got][:2] == ["a", "a-2"] and got[3].file_name == "x" * 150 and len({r.file_name for r in got}) == 5


def by_hand(facts):
    root = {f[0]: f[0] for f in facts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in facts:
        for b in facts:
            if a[0] >= b[0]:
                continue
            if a[1] and a[1] == b[1]:
                ok = True
            elif a[1] or b[1] or a[2] != b[2] or a[4].split(" ")[0] != b[4].split(" ")[0] or (a[3] and b[3] and abs(a[3] - b[3]) > 1):
                ok = False
            else:
                x, y = set(a[4].split()), set(b[4].split())
                sim = 0.65 * SequenceMatcher(None, a[4], b[4]).ratio() + 0.35 * len(x & y) / len(x | y) if a[4] and b[4] else 0.0
                ok = sim >= 0.94 or (sim >= 0.62 and a[5] and b[5] and len({*a[5]} & {*b[5]}) / min(len(a[5]), len(b[5])) >= 0.5)
            if ok:
                root[max(find(a[0]), find(b[0]))] = min(find(a[0]), find(b[0]))
    return {f[0]: find(f[0]) for f in facts}


def test_clusters_match_brute_force(spark):
    import random

    rng = random.Random(4)
    words = ["linares", "masters", "city", "spring", "cup", "memorial"]
    facts = []
    for i in range(90):
        key = " ".join(["linares" if i % 3 else "tilburg", *rng.sample(words[1:], rng.randint(0, 3))])
        facts.append((i, rng.choice([None, None, None, "e1", "e2"]), rng.choice([1990, 1991]), rng.choice([None, 1, 2, 5]), key, [f"p{rng.randint(0, 6)}" for _ in range(rng.randint(0, 4))]))
    facts = [(*f[:5], sorted(set(f[5]))) for f in facts]
    d = spark.createDataFrame(facts, "idx long, event_ref string, year int, month int, key string, roster array<string>")
    got = clustering.clusters(d.withColumn("name", F.col("key")), clustering.linked_facts(d))
    assert {r.idx: r.cluster for r in got.collect()} == by_hand(facts)
    sizes = [r.size for r in got.select("cluster_id", "size").distinct().orderBy("cluster_id").collect()]
    assert sizes == sorted(sizes, reverse=True)


def test_components_of_long_chains(spark):
    n = 3000
    d = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 7).alias("b"))
    assert {(r.node, r.root) for r in clustering.components(d).collect()} == {(i, i % 7) for i in range(n + 7)}


def test_best_and_merged(spark):
    who = "array<struct<ref:string,name:string,fed:string,title:string,fide_id:string,rating:int,score:double,rank:int>>"
    facts = [(0, "edo", [("r1", "Ann", "", None, None, 2400, None, 2), (None, "Bob", "USA", "", None, None, 1.0, None)]), (1, "twic", [("r1", "Anne", "GER", "IM", "77777", None, 3.0, None), ("r9", "Cid", "", None, None, None, None, 1)]), (2, "twic", [("r1", "A", "", None, None, None, None, None)])]
    f = spark.createDataFrame(facts, f"idx long, source string, participants {who}")
    member = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "idx long, cluster long")
    assert clustering.best_facts(f, member).first().idx == 1
    got = clustering.merged_players(f, member).first().players
    assert [(p["name"], p["fed"], p["rating"], p["score"], p["rank"]) for p in got] == [("Cid", None, None, None, 1), ("Anne", "GER", 2400, 3.0, 2), ("Bob", "USA", None, 1.0, None)]


REGISTRY = """<?xml version="1.0" encoding="UTF-8"?>
<ctml:players xmlns:ctml="urn:ctml:2.0">
  <ctml:player ref="player:fide:1000"><ctml:name display="Doe, John Paul"><ctml:family>Doe</ctml:family><ctml:given>John</ctml:given><ctml:given>Paul</ctml:given></ctml:name><ctml:federation>USA</ctml:federation><ctml:title>GM</ctml:title><ctml:ids><ctml:fideId>1000</ctml:fideId><ctml:internalId>edo:4</ctml:internalId></ctml:ids>
    <ctml:birthDate><ctml:year y="1970"/></ctml:birthDate><ctml:aliases><ctml:alias display="Doe, J"><ctml:family>Doe</ctml:family><ctml:given>J</ctml:given></ctml:alias></ctml:aliases>
    <ctml:ratingHistory><ctml:ratingTrack system="fide"><ctml:current>2405</ctml:current><ctml:peak><ctml:value>2410</ctml:value><ctml:achieved><ctml:month y="2001" m="4"/></ctml:achieved></ctml:peak><ctml:history><ctml:year value="2001"><ctml:month num="1">2400</ctml:month><ctml:month num="2">?</ctml:month><ctml:month num="4">2410</ctml:month><ctml:month num="12">2405</ctml:month></ctml:year></ctml:history></ctml:ratingTrack></ctml:ratingHistory></ctml:player>
  <ctml:player ref="player:fide:2000"><ctml:name display="Roe"><ctml:family>Row</ctml:family></ctml:name><ctml:sex>F</ctml:sex><ctml:ids><ctml:fideId>2000</ctml:fideId></ctml:ids></ctml:player>
  <ctml:player ref="player:fide:3000"><ctml:name display="Poe"><ctml:family>Poe</ctml:family></ctml:name><ctml:ids><ctml:fideId>3000</ctml:fideId></ctml:ids></ctml:player>
</ctml:players>"""
BLOCKS = """@PLAYER "., -_*"

Doe, John Paul #GM USA [2402] 1970.??.??
  %Bio FIDE 1000
  %Elo 2001:2400,?,?,2410,?,?,?,?,?,?,?,2405
  = Doe, J
# a banner
Roe #W [2300]
\t%Bio FIDE 2000
  %Elo 2002:2300,2300
Noe
@EVENT ",. -_"
Linares
  = Linares Open
@SITE ".,"
New York
@OTHER
thing
"""


def test_registry_against_lines(spark, tmp_path):
    (tmp_path / "players-D.xml").write_text(REGISTRY)
    (tmp_path / "p.ssp").write_text(BLOCKS)
    x = read_player_registry(spark, f"{tmp_path}/players-*.xml").withColumn("grid", players.grid_of_points(F.col("history")))
    assert [(r.fide_id, r.family, r.given, r.female, r.birth_year, r.peak, r.ids) for r in x.orderBy("fide_id").collect()][0] == ("1000", "Doe", ["John", "Paul"], False, 1970, 2410, ["edo:4"])
    b = last_block_wins(read_players(spark, f"{tmp_path}/p.ssp"))
    n, t = names.split_name(F.col("name")), names.title_tokens(F.coalesce("title_token", F.lit("")))
    one = lambda a: F.struct(names.split_name(a)["family"].alias("family"), names.split_name(a)["given"].alias("given"), names.split_name(a)["suffix"].alias("suffix"))
    own = b.select("fide_id", n["family"].alias("family"), n["given"].alias("given"), n["suffix"].alias("suffix"), "federation", t["titles"].alias("titles"), t["female"].alias("female"), "birth_year", F.transform("aliases", one).alias("aliases"), players.history_grid(F.col("elo")).alias("grid"))
    c = {r.fide_id: r.asDict() for r in players.compare_players(own, x).collect()}
    assert {k: v["side"] for k, v in c.items()} == {"1000": "both", "2000": "both", "3000": "registry"}
    assert [f for f in players.FIELDS if c["1000"][f"differs_{f}"]] == []
    assert [f for f in players.FIELDS if c["2000"][f"differs_{f}"]] == ["family", "current_rating", "peak", "history"]
    report = {r.measure: r.n for r in players.comparison_report(players.compare_players(own, x)).collect()}
    assert report["side both"] == 2 and report["family"] == 1 and "given" not in report


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_line_counts(spark, tmp_path, block):
    (tmp_path / "p.ssp").write_text(BLOCKS.replace("Noe\n", "Noe\r\n"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = {r.kind: r.n for r in lines.section_counts(spark, f"{tmp_path}/p.ssp").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {"line": 18, "comment": 1, "record": 3, "alias": 1, "elo": 2, "fide_id": 2, "event_rule": 2, "site_rule": 1}


def test_screening(spark):
    sheet = [["Open 2020"], ["No.", "Name", "FED", "RtgI", "Rtg\xa0"], ["1", "Ann", "GER", "2500", "2400"], ["2.", "", "", "", "x"], ["", "chess-results.com"], ["", "Bo", "", "", "2025*"], ["", "Last update 3"], ["", "Z"]]
    other = [["Name", "FED", "Elo", "RtgN"], ["Cy", "USA", "1900", "2100"], ["Di", "", "", ""]]
    none = [["No.", "Name"], ["1", "Ed"]]
    rows = [(f, i, c) for f, s in (("a", sheet), ("b", other), ("c", none), ("d", [["x"]])) for i, c in enumerate(s)]
    got = screening.starting_ranks(spark.createDataFrame(rows, "file string, row int, cells array<string>"))
    assert sorted((r.file, r.row, r.rating) for r in got.collect()) == [("a", 2, 2400), ("a", 3, 0), ("a", 5, 2025), ("b", 1, 2100), ("b", 2, 0)]
    m = screening.manifest(spark.createDataFrame([(0, " 12 ", "A"), (1, "12", "B"), (2, "x", "C")], "at int, key string, name string"), F.col("key"), "at").collect()
    assert [(r["name"], r.crosstable_url) for r in m] == [("A", "https://chess-results.com/tnr12.aspx?lan=1&art=4")]
    assert values(spark, ["3.0", " x ", None, "3.5"], screening.clean_value) == [("3",), ("x",), ("",), ("3.5",)]


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([("a", "<é/>"), ("b", None)], "file_name string, xml string")
    sizes = {r.name: r.bytes for r in files.write_each(d, f"file://{tmp_path}/docs").collect()}
    assert sizes == {"a": 5, "b": 0} and sorted(p.name for p in (tmp_path / "docs").iterdir()) == ["a.xml", "b.xml"] and (tmp_path / "docs/a.xml").read_text() == "<é/>"
    files.wipe(spark, f"file://{tmp_path}/docs")
    assert not (tmp_path / "docs").exists()
    t = spark.createDataFrame([("c1", ["x", "y"], None)], "cluster string, members array<string>, place string").coalesce(1)
    files.write_table(t, f"file://{tmp_path}/t")
    files.write_lines(t, f"file://{tmp_path}/j")
    files.write_report({"clusters": 1}, spark, f"file://{tmp_path}/summary.json")
    assert next((tmp_path / "t").glob("*.csv")).read_text() == "cluster\tmembers\tplace\nc1\tx,y\t\n"
    assert json.loads(next((tmp_path / "j").glob("*.json")).read_text()) == {"cluster": "c1", "members": ["x", "y"], "place": None} and json.loads((tmp_path / "summary.json").read_text()) == {"clusters": 1}
    e = spark.createDataFrame([("b", []), ("A", ["x", "y"])], "canonical string, aliases array<string>")
    assert [r.line for r in files.section_text(e, "EVENT", ",. -_", ("II ", "2. ")).collect()] == ['@EVENT ",. -_"', '%Prefix "II " "2. "', "A", "  = x", "  = y", "b"]
    assert {r.measure: r.n for r in files.metrics(a=t, b=e).collect()} == {"a": 1, "b": 2}
    r = spark.createDataFrame([("p:2", "Bern", "CHE"), ("p:1", "basel", ""), ("p:3", "Ö<", "AUT")], "ref string, name string, country string")
    shards = {x.file_name: (x.records, x.xml) for x in files.registry_shards(r, "place", parts=("country",)).collect()}
    assert {k: v[0] for k, v in shards.items()} == {"places-B": 2, "places-OTHER": 1}
    assert shards["places-B"][1].index("p:1") < shards["places-B"][1].index("p:2") and "<ctml:name>Ö&lt;</ctml:name>" in shards["places-OTHER"][1] and "<ctml:country></" not in shards["places-B"][1]


def test_unknown_person_and_counts(spark):
    blank, comma = (r[0] for r in values(spark, ["  ", ","], documents.person_element))
    assert "<ctml:family>Unknown</ctml:family>" in blank and "<ctml:unstructured>Unknown</ctml:unstructured>" in comma
    t = spark.createDataFrame([("E", [("A",)], "2003"), (" ", [("A",)], "2003"), ("E", [(" ",)], "2003")], "event string, players array<struct<name:string>>, start string")
    assert {r.skipped: r.tables for r in documents.skip_counts(t).collect()} == {None: 1, "no event": 1, "no named player": 1}
