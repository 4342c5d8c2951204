"""Documents of games, whole texts compared."""

import datetime as dt

from pyspark.sql import functions as F

from castellan.operators import gamedocs

GAME = "n int, event string, site string, date struct<y:int,m:int,d:int>, round string, white string, black string, result string, eco string, start_fen string, ucis array<string>, termination string, trajectory_fp string, final_position_fp string"


def game(n, date, white, black, **more):
    g = {"event": "Town <Open>", "site": "Oslo", "round": str(n), "result": "1-0", "eco": None, "start_fen": None, "ucis": [], "termination": None, "trajectory_fp": f"t{n}", "final_position_fp": f"f{n}"} | more
    return (n, g["event"], g["site"], date, g["round"], white, black, g["result"], g["eco"], g["start_fen"], g["ucis"], g["termination"], g["trajectory_fp"], g["final_position_fp"])


GAMES = [
    game(1, (1994, 5, 3), "Ann Lee", "Poe, Bob", eco="C42", ucis=["e2e4", "e7e5"], termination="normal"), game(2, (1994, 5, None), "Poe, Bob", "Cid", result="?", event="TOWN  Open"), game(3, (1994, 7, 1), "Ann Lee", "Cid", event="town open"),
    game(4, None, "Cid", "Dan", event="Alone", site=None, round=None), game(5, (1994, 5, 20), "Ann Lee", "Ann Lee"), game(6, (1994, 5, 21), "Ann Lee", None),
]

FIRST = """<?xml version="1.0" encoding="UTF-8"?>
<ctml:tournament xmlns:ctml="urn:ctml:2.0" ctmlVersion="2.0" id="t_town-open_19940500">
  <ctml:header>
    <ctml:name>TOWN Open</ctml:name>
    <ctml:eventRef ref="e1"><ctml:name>TOWN Open</ctml:name></ctml:eventRef>
    <ctml:dates>
      <ctml:start><ctml:month y="1994" m="5"/></ctml:start>
      <ctml:end><ctml:day y="1994" m="5" d="21" iso="1994-05-21"/></ctml:end>
    </ctml:dates>
    <ctml:placeRef ref="place:oslo"><ctml:name>Oslo</ctml:name></ctml:placeRef>
  </ctml:header>
  <ctml:participants>
    <ctml:participant id="p0001">
      <ctml:playerRef ref="player:bob">
        <ctml:name display="Poe, Bob">
          <ctml:family>Poe</ctml:family>
          <ctml:given>Bob</ctml:given>
        </ctml:name>
        <ctml:resolution method="name-exact"/>
      </ctml:playerRef>
    </ctml:participant>
    <ctml:participant id="p0002">
      <ctml:playerRef ref="player:syn:SYN-CID">
        <ctml:name display="Cid">
          <ctml:family>Cid</ctml:family>
        </ctml:name>
        <ctml:resolution method="unresolved"/>
      </ctml:playerRef>
    </ctml:participant>
    <ctml:participant id="p0003">
      <ctml:playerRef ref="player:syn:SYN-ANN">
        <ctml:name display="Ann Lee">
          <ctml:family>Lee</ctml:family>
          <ctml:given>Ann</ctml:given>
        </ctml:name>
        <ctml:resolution method="unresolved"/>
      </ctml:playerRef>
    </ctml:participant>
  </ctml:participants>
  <ctml:games>
    <ctml:game round="2" white="p0001" black="p0002" result="*">
      <ctml:fingerprints>
        <ctml:fingerprint scheme="zobrist-polyglot-1" scope="trajectory" value="t2"/>
        <ctml:fingerprint scheme="zobrist-polyglot-1" scope="finalPosition" value="f2"/>
      </ctml:fingerprints>
      <ctml:source kind="pgn"/>
    </ctml:game>
    <ctml:game round="1" white="p0003" black="p0001" result="1-0">
      <ctml:eco>C42</ctml:eco>
      <ctml:moves notation="uci">
        <ctml:move ply="1" value="e2e4"/>
        <ctml:move ply="2" value="e7e5"/>
      </ctml:moves>
      <ctml:termination>normal</ctml:termination>
      <ctml:fingerprints>
        <ctml:fingerprint scheme="zobrist-polyglot-1" scope="trajectory" value="t1"/>
        <ctml:fingerprint scheme="zobrist-polyglot-1" scope="finalPosition" value="f1"/>
      </ctml:fingerprints>
      <ctml:source kind="pgn"/>
    </ctml:game>
  </ctml:games>
  <ctml:source kind="pgn"/>
</ctml:tournament>
"""


def made(spark, rows):
    import hashlib

    players = spark.createDataFrame([("player:bob", "Poe, Bob", None, [])], "ref string, name string, fide_id string, aliases array<string>")
    occurrences = spark.createDataFrame([("e1", ["Town Open"], dt.date(1994, 5, 1), dt.date(1994, 5, 31))], "ref string, names array<string>, start date, end date")
    places = spark.createDataFrame([("Oslo", "place:oslo")], "site string, ref string")
    parts, documents = gamedocs.document_parts(spark.createDataFrame(rows, GAME), "n", players, occurrences, places, "pgn")
    for name in ("Cid", "Ann Lee"):
        yield name, hashlib.sha1(name.lower().encode()).hexdigest()[:16]
    yield "documents", {(r.event_slug, r.site_slug, r.session): r for r in gamedocs.whole_documents(parts, documents).collect()}


def test_documents_of_games(spark):
    got = dict(made(spark, GAMES))
    docs = got["documents"]
    assert set(docs) == {("town-open", "oslo", 1), ("town-open", "oslo", 2), ("alone", "unknown", 0)}
    first = docs["town-open", "oslo", 1]
    assert first.xml == FIRST.replace("SYN-CID", got["Cid"]).replace("SYN-ANN", got["Ann Lee"]) and first.event_resolved
    later, alone = docs["town-open", "oslo", 2], docs["alone", "unknown", 0]
    assert (later.id, later.event_ref, later.event_resolved) == ("t_town-open_19940701", "event:19940701-19940701-town-open", False)
    assert gamedocs.UNDATED in alone.xml and "placeRef" not in alone.xml and 'round="?"' in alone.xml and alone.id == "t_alone_19700101"


def test_participants_beyond_9999_stay_in_order(spark):
    rows = [game(i, (2000, 1, 1), f"W {i:05d}", f"B {i:05d}") for i in range(1, 5101)]
    (doc,) = dict(made(spark, rows))["documents"].values()
    import re

    assert [int(x) for x in re.findall(r'participant id="p(\d+)"', doc.xml)] == list(range(1, 10201))


def test_fragment_with_start_and_plies(spark):
    g = spark.createDataFrame([game(1, None, "a", "b", start_fen="8/8 w & x", ucis=["a2a3"], result="1/2-1/2", round="4.1")], GAME)
    assert g.select(gamedocs.game_fragment(F.lit("p1"), F.lit("p2"), F.lit("s"), 2)).first()[0] == """  <ctml:game round="4.1" white="p1" black="p2" result="1/2-1/2">
    <ctml:start standard="false"><ctml:fen>8/8 w &amp; x</ctml:fen></ctml:start>
    <ctml:moves notation="uci" plyCount="1">
      <ctml:move ply="1" value="a2a3"/>
    </ctml:moves>
    <ctml:fingerprints>
      <ctml:fingerprint scheme="zobrist-polyglot-1" scope="trajectory" value="t1"/>
      <ctml:fingerprint scheme="zobrist-polyglot-1" scope="finalPosition" value="f1"/>
    </ctml:fingerprints>
    <ctml:source kind="s"/>
  </ctml:game>"""
