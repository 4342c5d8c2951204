"""Clusters of large blocks against all pairs, by matrices: nothing is left out, whatever the block's size."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest

from castellan.operators import clustering

SCHEMA = "idx long, event_ref string, year int, month int, key string, roster array<string>"


def by_matrices(facts):
    """The least record reachable from each, over every pair of records."""
    n = len(facts)
    keys = sorted({f[4] for f in facts})
    at = {k: i for i, k in enumerate(keys)}
    sim = np.zeros((len(keys), len(keys)))
    for i, k in enumerate(keys):
        for j, l in enumerate(keys):
            x, y = set(k.split()), set(l.split())
            bound = 0.65 * 2 * min(len(k), len(l)) / max(1, len(k) + len(l)) + 0.35 * len(x & y) / max(1, len(x | y))
            if k and l and bound >= 0.6:
                sim[i, j] = 0.65 * SequenceMatcher(None, k, l).ratio() + 0.35 * len(x & y) / len(x | y)
    people = sorted({p for f in facts for p in f[5] or []})
    has = np.zeros((n, len(people)), np.float32)
    for i, f in enumerate(facts):
        for p in f[5] or []:
            has[i, people.index(p)] = 1
    size = has.sum(axis=1)
    k, year, month = np.array([at[f[4]] for f in facts]), np.array([f[2] for f in facts]), np.array([f[3] or 0 for f in facts])
    block = np.unique([f[4].split(" ")[0] for f in facts], return_inverse=True)[1]
    ref = np.array([f[1] or "" for f in facts])
    root = np.arange(n)

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(n):
        later = slice(i + 1, n)
        s = sim[k[i], k[later]]
        least = np.minimum(size[i], size[later])
        shared = np.divide(has[later] @ has[i], least, out=np.zeros(n - i - 1, np.float32), where=least > 0) >= 0.5
        ok = (ref[i] == "") & (ref[later] == "") & (year[later] == year[i]) & (block[later] == block[i]) & ((month[i] == 0) | (month[later] == 0) | (abs(month[later] - month[i]) <= 1))
        ok &= (s >= 0.94) | (shared & (s >= 0.62))
        ok |= (ref[i] != "") & (ref[later] == ref[i])
        for j in np.flatnonzero(ok) + i + 1:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {facts[i][0]: facts[find(i)][0] for i in range(n)}


def made(n, seed, words, people):
    rnd = random.Random(seed)
    vocabulary = ["linares", "masters", "spring", "cup", "memorial", "invitational", "zonal", "young", "ladies", "veterans"][:words]
    facts = []
    for i in range(n):
        some = rnd.sample(vocabulary, rnd.randint(0, min(6, words)))
        key = " ".join(["city", *(some if n < 1000 else sorted(some))])
        key += rnd.choice(["", "", "", " a", " ii", "s"])
        facts.append((i, rnd.choice([None] * 12 + ["", "e1", "e2"]), rnd.choice([1990, 1990, 1991]), rnd.choice([None, *range(1, 13)]), key if rnd.random() < 0.97 else "", sorted({f"p{rnd.randint(0, people)}" for _ in range(rnd.choice([0, 0, 1, 3, 6]))}) if rnd.random() < 0.9 else None))
    return facts


def clusters(spark, facts):
    d = spark.createDataFrame(facts, SCHEMA).cache()
    found = {r.node: r.root for r in clustering.components(clustering.linked_in_large_blocks(d)).collect()}
    return {f[0]: found.get(f[0], f[0]) for f in facts}


@pytest.mark.parametrize(("n", "seed", "words", "people"), [(150, 1, 4, 8), (400, 2, 8, 40), (400, 3, 10, 900)])
def test_equals_all_pairs(spark, n, seed, words, people):
    facts = made(n, seed, words, people)
    want = by_matrices(facts)
    assert clusters(spark, facts) == want and 5 < len(set(want.values())) < n


def test_a_block_of_5000(spark):
    """One year and first word: 5,000 records, a third of them of one name and roster."""
    rnd = random.Random(6)
    facts = [(i, None, 1990, m, k, r) for i, (_, _, _, m, k, r) in enumerate(made(5000, 6, 6, 4000)) for k in [k or "city"]]
    facts = [(i, None, 1990, 5, "city open air", ["p1", "p2"]) if rnd.random() < 0.33 else f for i, f in enumerate(facts)]
    assert clusters(spark, facts) == by_matrices(facts)


def test_same_as_the_blocked_join(spark):
    facts = made(200, 8, 6, 30)
    d = spark.createDataFrame(facts, SCHEMA).cache()
    assert {(r.node, r.root) for r in clustering.components(clustering.linked_facts(d, None)).collect()} == {(r.node, r.root) for r in clustering.components(clustering.linked_in_large_blocks(d)).collect()}
    assert clustering.linked_in_large_blocks(d.limit(0)).count() == 0
