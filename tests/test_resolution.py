"""Player and event references: unique or unresolved, at any bucket size."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from castellan.operators import resolution

PLAYERS = [("p1", "Carlsen, Magnus", "1503014", ["Carlsen, M.", "DrNykterstein"]), ("p2", "Polgar, Judit", "700070", None), ("p3", "Polgar, Susan", None, ["Polgar, Zsuzsa"]), ("p4", "Ivanov, A", None, ["Ivanov, Alexander"]), ("p5", "Ivanov, A", None, ["The Other Ivanov"]), ("p6", "van der Wiel, John", " 1000039 ", []), (None, "Nobody", None, [])]


@pytest.fixture(scope="module")
def players(spark):
    return spark.createDataFrame(PLAYERS, "ref string, name string, fide_id string, aliases array<string>")


def resolved(spark, players, rows, **more):
    df = spark.createDataFrame(rows, "name string, id string")
    return {(r.name, r.id): (r.player_ref if r.method != "unresolved" else None, r.method, r.candidates) for r in resolution.resolve_players(df, players, fide_id="id", **more).collect()}


def test_players_by_tier(spark, players):
    want = {
        ("Carlsen, Magnus", None): ("p1", "name-exact", 1), ("magnus  CARLSEN", None): ("p1", "name-exact", 1), ("drnykterstein", None): ("p1", "name-alias", 1), ("Carlsen", None): ("p1", "surname-unique", 1),
        ("Polgar", None): (None, "unresolved", 2), ("Ivanov, A", None): (None, "unresolved", 2), ("Zsuzsa Polgar", None): ("p3", "name-alias", 1), ("Whoever", "700070"): ("p2", "fide-id", 1), ("Carlsen", "999999"): ("p1", "surname-unique", 1),
        ("Wiel", None): (None, "unresolved", 0), ("Kasparov, G", None): (None, "unresolved", 0), (None, None): (None, "unresolved", 0), ("", ""): (None, "unresolved", 0), ("J. v. d. Wiel", "1000039"): ("p6", "fide-id", 1),
    }
    assert resolved(spark, players, list(want)) == want


def test_an_ambiguous_tier_falls_through_only_on_request(spark, players):
    more = players.unionByName(spark.createDataFrame([("p7", "Zed", None, ["Ivanov, A"])], players.schema))
    assert resolved(spark, more, [("Ivanov, A", None)]) == {("Ivanov, A", None): (None, "unresolved", 2)}
    assert resolved(spark, more, [("Ivanov, A", None)], fall_through=True) == {("Ivanov, A", None): ("p7", "name-alias", 1)}


def test_rows_and_columns_stay(spark, players):
    rows = spark.createDataFrame([("Polgar, Judit", 1, "x")] * 3 + [("a", 2, "y")], "name string, key int, ref string")
    got = resolution.resolve_players(rows, players)
    assert got.columns == ["name", "key", "ref", "player_ref", "method", "candidates"] and got.count() == 4
    assert resolution.resolve_players(rows.limit(0), players).count() == 0
    (made,) = {r.player_ref for r in got.collect() if r.method == "unresolved"}
    assert made == "player:syn:86f7e437faa5a7fc"


@pytest.mark.parametrize("days", [1, 7, 400])
def test_overlap_equals_brute_force(spark, days):
    rnd = random.Random(days)
    day = lambda: dt.date(1969, 12, 1) + dt.timedelta(rnd.randrange(90))
    make = lambda n: [(rnd.choice("aab"), i, s, s + dt.timedelta(rnd.choice([0, 0, 3, 40]))) for i in range(n) for s in [day()]]
    a, b = make(120), make(150)
    schema = "key string, id int, start date, end date"
    got = resolution.overlap_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), "key", "start", "end", days)
    want = sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] <= y[3] and x[3] >= y[2])
    assert sorted((r.id, r.r_id) for r in got.collect()) == want and len(want) > 500


def test_events(spark):
    occurrences = spark.createDataFrame(
        [("e1", ["Linares", "Ciudad de Linares"], dt.date(1994, 2, 23), dt.date(1994, 3, 14)), ("e2", ["Linares"], dt.date(1995, 2, 1), None), ("e3", ["City Open"], dt.date(1994, 1, 1), dt.date(1994, 1, 9)), ("e4", ["City  open!"], dt.date(1994, 1, 5), dt.date(1994, 1, 12)), ("e5", [None, ""], dt.date(1994, 1, 1), None)],
        "ref string, names array<string>, start date, end date")
    rows = [
        ("LINARES", dt.date(1994, 3, 14), None, "e1", 1), ("Ciudad de Linares", dt.date(1994, 1, 1), dt.date(1994, 12, 31), "e1", 1), ("Linares", dt.date(1994, 3, 15), dt.date(1995, 1, 31), None, 0), ("Linares", dt.date(1994, 1, 1), dt.date(1996, 1, 1), None, 2),
        ("city open", dt.date(1994, 1, 6), dt.date(1994, 1, 7), None, 2), ("city open", dt.date(1994, 1, 10), None, "e4", 1), ("Linares", None, None, None, 0), (None, dt.date(1994, 1, 1), None, None, 0), ("", dt.date(1994, 1, 1), None, None, 0)]
    df = spark.createDataFrame(rows, "event string, start date, end date, want string, n int")
    got = resolution.resolve_events(df, occurrences).collect()
    assert len(got) == len(rows) and all(r.event_ref == r.want and r.candidates == r.n for r in got)
    made = df.limit(1).select(resolution.event_ref_or_made(F.lit(None), F.col("event"), F.col("start"), F.col("end"))).first()[0]
    assert made == "event:19940314-19940314-linares"
