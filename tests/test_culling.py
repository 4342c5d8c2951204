"""Culling against sets in plain Python, on tables with nulls, repeats and every reason; versions of several tables."""

import random

import pytest

from castellan.operators import culling

TYPES = {
    "tournaments": "tournament_id string, page_title string, place_id string", "tournament_result_rows": "tournament_id string, row_kind string, player_id string, edo int", "year_events": "year int, event_id string, event_kind string, event_text string",
    "year_ratings": "year int, player_id string, edo int", "location_events": "location_id string, event_kind string, event_id string", "player_ratings": "player_id string, x int", "players": "player_id string, name string", "locations": "location_id string, rows int", "registry_entries": "kind string, native_id string",
}


def made(seed):
    r = random.Random(seed)
    t = [f"t{i}" for i in range(40)]
    m = [f"m{i}" for i in range(30)]
    p, pl = [f"p{i}" for i in range(25)], [f"l{i}" for i in range(8)]
    rate = lambda: r.choice([None, 1900, 2000, 2100, 2200, 2300, 2400, 2400, 2400, 2400])
    return {
        "tournaments": [(x, f"title {x}", r.choice([None, "", *pl])) for x in t], "tournament_result_rows": [(r.choice([*t, None, "t99"]), r.choice(["score", "score", "note"]), r.choice([*p, None]), rate()) for _ in range(70)],
        "year_events": [(r.choice([1900, 1901]), x, "match", f"text {x}") for x in m] + [(1902, x, "tournament", "") for x in [*t, None]] + [(1903, "z", "other", "")],
        "year_ratings": [(y, x, rate()) for y in (1900, 1901) for x in p if r.random() < 0.9], "location_events": [(r.choice(pl), "match", r.choice(m)) for _ in range(20)] + [(r.choice(pl), "tournament", r.choice(t)) for _ in range(20)] + [(r.choice(pl), "x", "y")],
        "player_ratings": [(r.choice([*p, None]), i) for i in range(40)], "players": [(x, "n") for x in p], "locations": [(x, 1) for x in pl], "registry_entries": [(k, r.choice([*v, None])) for k, v in (("tournament", t), ("player", p), ("location", pl), ("other", t)) for _ in range(12)],
    }, [(x, y) for x in m for y in r.sample(p, r.choice([0, 1, 2, 2, 2, 2, 3]))]


def by_hand(t, links, floor):
    scores = {x: [e[3] for e in t["tournament_result_rows"] if e[0] == x and e[1] == "score"] for x, *_ in t["tournaments"]}
    kt = {x for x, s in scores.items() if s and all(e is not None and e >= floor for e in s)}
    rating = {(y, p): e for y, p, e in t["year_ratings"]}
    games = {(y, x): [rating.get((y, p)) for m, p in links if m == x] for y, x, k, _ in t["year_events"] if k == "match"}
    km = {x for (_, x), s in games.items() if len(s) == 2 and all(e is not None and e >= floor for e in s)}
    kp = {p for x, k, p, _ in t["tournament_result_rows"] if x in kt and k == "score" and p} | {p for x, p in links if x in km}
    kl = {p for x, _, p in t["tournaments"] if x in kt and p} | {p for p, k, x in t["location_events"] if k == "match" and x in km}
    event = lambda k, x: x is None or x in {"tournament": kt, "match": km}.get(k, {x})
    kept = {
        "tournaments": lambda r: r[0] in kt, "tournament_result_rows": lambda r: r[0] is None or r[0] in kt, "year_events": lambda r: event(r[2], r[1]), "year_ratings": lambda r: r[1] in kp, "location_events": lambda r: r[0] in kl and event(r[1], r[2]),
        "player_ratings": lambda r: r[0] is None or r[0] in kp, "players": lambda r: r[0] in kp, "locations": lambda r: r[0] in kl, "registry_entries": lambda r: r[1] is None or r[1] in {"tournament": kt, "player": kp, "location": kl}.get(r[0], {r[1]}),
    }
    rows = {n: sorted((r for r in t[n] if kept[n](r)), key=str) for n in t}
    both = [*scores.values(), *games.values()]
    low = sum(e is not None and e < floor for s in both for e in s)
    none = sum(e is None for s in both for e in s) + sum(max(0, 2 - len(s)) for s in games.values())
    return rows, {"events": len(both), "kept_events": len(kt) + sum(x in km for _, x in games), "rows": sum(map(len, both)), "missing": none, "below": low}


@pytest.mark.parametrize(("seed", "floor"), [(1, 2000), (2, 2200), (3, 9999), (4, 0)])
def test_culled_equals_sets(spark, seed, floor):
    t, links = made(seed)
    tables = {n: spark.createDataFrame(rows, TYPES[n]) for n, rows in t.items()}
    c = culling.cull(tables, spark.createDataFrame(links, "event_id string, player_id string"), floor)
    rows, totals = by_hand(t, links, floor)
    for n, df in c.tables.items():
        assert df.columns == tables[n].columns and sorted(map(tuple, df.collect()), key=str) == rows[n], n
    s = c.summary.first().asDict()
    assert {k: s[k] for k in totals} == totals and s["rejected_events"] == s["events"] - s["kept_events"]
    reasons = {r.reason.lstrip("0123456789 ") for r in c.tournaments.collect()} | {r.reason.lstrip("0123456789 ") for r in c.matches.collect()}
    assert {"no score rows", "no linked player pages", "fewer than two linked player pages", "more than two linked player pages"} <= reasons


def test_versions(spark, tmp_path):
    root = f"file://{tmp_path}/db"
    one = {"a": spark.range(3), "b": spark.range(2)}
    assert culling.write_version(spark, one, root) == 1 and culling.write_version(spark, {"a": spark.range(9)}, root) == 2
    assert {n: d.count() for n, d in culling.read_version(spark, root, 1).items()} == {"a": 3, "b": 2}
    (tmp_path / "db" / "v3").mkdir()  # begun and not committed
    assert {n: d.count() for n, d in culling.read_version(spark, root).items()} == {"a": 9}
