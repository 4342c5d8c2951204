"""Conversation repair against dynamic programming over all edit sequences, and the hard cases of its docstring."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from castellan.llm import ordered, repair
from castellan.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
STEP = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def damaged(rows):
    out = []
    for c, n, role, text in rows:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if n is None else n}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role, text = "user" if d == 4 else role, "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(c, n, role, text)] * {0: 0, 3: 2}.get(d, 1)
    return out


def order(r):
    key = hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
    return (r[1] is not None, r[1] or 0, r[2].encode(), key)


def brute(rows):
    """Cheapest cost and least audit by the best (cost, audit) in each state, over whole audit strings: no vectors, no table, no trace."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {0: (0, "")}

    def insert(best):
        for _ in range(4):
            for p, (cost, audit) in list(best.items()):
                for x, q in STEP[p].items():
                    if x != "s":
                        best[q] = min(best.get(q, (1 << 40, "")), (cost + 5, audit + "I"))
        return best

    for (_, _, role, _), f in zip(rows, faults):
        after = {}
        for p, (cost, audit) in insert(best).items():
            arcs = [("D", p, 2)]
            if f not in ("b", "d"):
                arcs += [("K", STEP[p][role[:1]], 5 * (f == "t"))] if role[:1] in STEP[p] else []
                arcs += [("R", q, 1 + 5 * (f == "t")) for x, q in STEP[p].items() if x != "s"]
            for e, q, c in arcs:
                after[q] = min(after.get(q, (1 << 40, "")), (cost + c, audit + e))
        best = after
    cost, audit = min(v for p, v in insert(best).items() if p in (0, 3))
    state, lines, it = 0, [], iter(rows)
    for e in audit:
        role, text = ("", "") if e == "I" else next(it)[2:]
        if e in "IR":
            role = "assistant" if state == 2 else "user"
        if e != "D":
            state = STEP[state][role[0]]
            lines.append(f"{role}:{text}")
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(faults.count, "bdt"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def wanted(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    return {c: brute(sorted(x, key=order)) for c, x in by.items()}


def test_op11_repair(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    want = {r[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in rows} | wanted(damaged(rows))
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_repair"](spark, SF).collect()}
    assert got == want and {e for x in want.values() for e in x[6]} >= set("DKR")


def made(n, seed, convs):
    rnd = random.Random(seed)
    roles, texts = ["system", "user", "assistant", "tool", "User", "", "admin", None], ["Yes.", "no", " ", "", None, "What?\n", "été!", "x" * 50]
    return [(rnd.choice(convs), rnd.choice([None, *range(60)]), rnd.choice(roles[: rnd.choice([3, 8])]), rnd.choice(texts) or (f"{i}." if rnd.random() < 0.9 else None)) for i in range(n)]


COLUMNS = "conv_id bigint, turn bigint, role string, text string"


def spaced(rows):
    return [(c, n, " " if r is None else r, " " if t is None else t) for c, n, r, t in rows]


@pytest.mark.parametrize("run", [12, 2])
def test_any_rows_at_any_run(spark, monkeypatch, run):
    """Runs of 4 rows join to the same repairs as runs that hold whole conversations."""
    monkeypatch.setattr(ordered, "RUN", run)
    monkeypatch.setattr(repair, "RUN", run)
    rows = made(700, 5, [*range(25), None]) + [(100, i, "user assistant".split()[i % 2], f"{i}.") for i in range(90)]
    rows += [(101, None, "user", "same.")] * 40 + [(102, 7, "system", f"{i}.") for i in range(30)]
    got = {r[0]: tuple(r)[1:] for r in repair.repair_conversations(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert got == wanted(spaced(rows))


def test_rows_as_edited(spark):
    rows = made(300, 9, list(range(12)))
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'x' as conv", "1 as run", "2 as cost")
    edited = defaultdict(list)
    for r in sorted(repair.repair_conversations(df, rows=True).collect(), key=lambda r: (r.conv, r.nth)):
        edited[r.conv].append(r)
    for c, want in wanted(spaced(rows)).items():
        assert "".join(r.edit for r in edited[c]) == want[6]
        kept = [f"{r.role}:{r.text}" for r in edited[c] if r.edit != "D"]
        assert hashlib.sha256("\n".join(kept).encode()).hexdigest() == want[7] and re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in kept))


def test_empty_and_long(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert repair.repair_conversations(none).count() == repair.repair_conversations(none, rows=True).count() == 0
    n = 30_000
    long = spark.range(n).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat(id, '.') as text")
    got = repair.repair_conversations(long).collect()
    assert got[0].audit == "K" * n and got[0].cost == 0


def test_damage_is_the_contracts(spark):
    rows = [(c, n, r, t) for c in [None, *range(8)] for n in [None, *range(12)] for r, t in [("user", "Hi. There!"), (None, None)]]
    got = [tuple(r) for r in repair.damage(spark.createDataFrame(rows, COLUMNS)).collect()]
    assert sorted(got, key=str) == sorted(damaged(rows), key=str)


def test_vectors_stay_few():
    auto = repair.Determinised()
    rnd = random.Random(1)
    auto.scan(repair.START, "".join(rnd.choice("ABCDEFGHIJKL") for _ in range(200_000)))
    assert len(auto.vectors) < 200
