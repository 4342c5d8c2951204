"""Prefix tries against a dictionary of whole prefixes, and the hard cases of its docstring."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from castellan.llm import ordered, trie
from castellan.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = "conv_id bigint, turn bigint, role string, text string"


def original(rows):
    by = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append(((n is not None, n or 0, role.encode(), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()), (role, text)))
    return {c: [x[1] for x in sorted(v)] for c, v in by.items()}


def heads(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children, below = defaultdict(int), defaultdict(lambda: [0, 0])
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        gain = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            below[p[:d]][0] += p not in children
            below[p[:d]][1] += gain
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p] if p in children else 0, below[p][0], below[p][1], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items())


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_op12_trie(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    assert rows_of(QUERIES["op12_trie"](spark, SF)) == brute(heads(original(rows)))


def made(n, seed):
    rnd = random.Random(seed)
    texts = ["a b", "c", None, "", "é ü  x", "\x0b", "a b"]
    rows = []
    for c in range(n):
        size, same = rnd.choice([1, 2, 3, 5, 9]), rnd.random() < 0.4
        rows += [(c, i, "user assistant".split()[i % 2], texts[0] if same else rnd.choice(texts)) for i in range(size)]
    rows += [(c, i, "user", "always the same turn") for c in range(n, n + 40) for i in range(7)]
    rows += [(700, None, None, "x")] * 3 + [(701, 1, "user", "y"), (701, None, "user", "z"), (None, 0, "user", "w")]
    rows += [(800, i, "user", f"deep {i}") for i in range(60)] + [(801, i, "user", f"deep {i}") for i in range(50)]
    return rows


@pytest.mark.parametrize(("shard_nodes", "run"), [(1_000_000, 12), (9, 2)])
def test_shards_make_no_difference(spark, monkeypatch, shard_nodes, run):
    """Nodes are the same from one shard and from many, whose upper levels are merged, and whether runs hold 4 rows or 4,096."""
    monkeypatch.setattr(ordered, "RUN", run)
    monkeypatch.setattr(trie, "RUN", run)
    rows = made(150, 3)
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'x' as conv", "1 as nth", "2 as depth", "3 as words")
    numbered = trie.numbered_turns(df)
    assert rows_of(trie.prefix_trie(numbered, shard_nodes=shard_nodes)) == brute(original(rows))
    assert rows_of(trie.prefix_trie(trie.rebuilt(numbered), shard_nodes=shard_nodes)) == brute(heads(original(rows)))


def test_one_and_none(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert trie.prefix_trie(trie.rebuilt(trie.numbered_turns(none))).count() == 0
    one = [(5, 0, "user", "a b c"), (5, 1, "user", "d")]
    assert rows_of(trie.prefix_trie(trie.numbered_turns(spark.createDataFrame(one, COLUMNS)))) == brute(original(one))
    turnless = [(1, 0, "user", "a"), (21, 0, "user", "b")]  # both lose their only turn if h is not 0 and no head is there
    assert rows_of(trie.prefix_trie(trie.rebuilt(trie.numbered_turns(spark.createDataFrame(turnless, COLUMNS))))) == brute(heads(original(turnless)))


def test_level_order_bits():
    """Parents read off the bits equal those of the paths."""
    k = np.array([1, 2, 1, 3, 4, 5], np.int64)
    found = trie.shard_trie([k, k, np.ones(6, np.int64)], np.array([0, 2, 4, 6]), np.array([1, 2, 3]), np.array([7, 5, 6]), np.zeros(3, np.int64))
    assert found["depth"].tolist() == [0, 1, 1, 2, 2, 2] and found["p1"].tolist() == [0, 0, 0, 1, 1, 4]
    assert found["n"].tolist() == [6, 3, 3, 1, 2, 3] and found["conv"].tolist() == [5, 5, 6, 7, 5, 6]
    assert found["s1"].tolist() == [12, 6, 6, 1, 2, 3] and found["leaves"].tolist() == [3, 2, 1, 1, 1, 1]


def test_sql_gives_the_same_nodes(spark):
    from castellan.llm.oracles import ORACLES

    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{SF}/conversations.parquet'")
    df = QUERIES["op12_trie"](spark, SF)
    want = con.sql(f"select {', '.join(df.columns)} from ({ORACLES['op12_trie']})").fetchall()
    assert rows_of(df) == sorted(want)
