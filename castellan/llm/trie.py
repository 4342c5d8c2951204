"""Conversation prefix tries: what conversations share from their first turn on, as succinct level-order tries (LOUDS).

Every distinct beginning of a conversation is a node, keyed by its depth and 128 bits: the exclusive or of a hash of each turn with its position. Beginnings of
one conversation only need no trie, all their figures being plain, so only what several conversations share goes into one. Conversations with the same
last shared node are counted together first, so a group of copies is one path however large. The paths are sorted and dealt by range: any prefix, the
root too, may go on from one shard to the next, so a first turn that a third of all conversations have splits like any other.

A shard (mapInArrow, numpy) builds its level-order bits (for each node a one per child, then a zero) and label arrays, reads the parents off the bits,
and adds up its figures from the last level to the first by add.at. The nodes on a shard's first and last path may lie in its neighbours too: those that
do (at most depth times shards) are the upper levels, merged separately, where sums add up and what was counted in several shards is taken off along the paths.

The ids that end at a node are sorted by range and hashed as a stream of pieces of 4,096.

Cases: null roles and texts are empty; turns go by number, null first, then by role and by a hash of role and text; repeated rows are turns of their own; rows whose conversation is null belong to
no conversation and are left out; an empty table gives no rows, not even a root; further columns are not read. A shared path of n turns is one row of 20 n bytes.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castellan.llm.common import WORD
from castellan.llm.ordered import RUN, in_order, running
from castellan.workspace import keep

KEY = ["depth", "k1", "k2"]
FIGURES = "depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, conv bigint, parent bigint, n bigint, children bigint, leaves bigint, s1 bigint, s2 bigint, words bigint"


def numbered_turns(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, nth (from 0), h (of role and text), words: the turns of each conversation in order, without their texts."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    h = F.unhex(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256))
    rows = turns.filter(F.col(conv).isNotNull()).select(F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"), r.alias("role"), h.alias("h"), F.regexp_count(t, F.lit(WORD)).cast("bigint").alias("words"))
    placed = in_order(rows, ["conv", "turn", "role", "h"], "turns-in-order")
    return running(placed, "conv", "pos", {"nth": F.lit(1)}, F.sum, lambda a, b: a + b - 1).select("conv", "nth", "h", "words")


def rebuilt(turns: DataFrame, *, block: int = 20, most: int = 4) -> DataFrame:
    """Of numbered turns, those of each conversation after its first h are put behind the first h of its block's conversation (conv - conv % block); h is the CRC-32
    of the decimal conv modulo `most`. Columns as in numbered_turns; a conversation without a turn left has one row of null nth."""
    head, h = F.col("conv") - F.col("conv") % block, (F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % most).alias("take")
    first = turns.filter((F.col("conv") % block == 0) & (F.col("nth") < most - 1))
    lengths = first.groupBy(F.col("conv").alias("head")).agg(F.count("*").alias("heads"))
    convs = turns.select("conv").distinct().select("conv", head.alias("head"), h)
    begun = convs.join(first.select(F.col("conv").alias("head"), "nth", "h", "words"), "head").filter("nth < take").select("conv", "nth", "h", "words")
    own = turns.select("*", head.alias("head"), h).filter("nth >= take").join(lengths, "head", "left")
    own = own.select("conv", (F.least("take", F.coalesce("heads", F.lit(0))) + F.col("nth") - F.col("take")).alias("nth"), "h", "words")
    return begun.unionByName(own).unionByName(convs.select("conv"), allowMissingColumns=True)


def shard_trie(paths: list[np.ndarray], starts: np.ndarray, weight: np.ndarray, least: np.ndarray, tails: np.ndarray) -> dict[str, np.ndarray]:
    """The nodes of sorted distinct paths in level order, and their figures. paths: k1, k2, words of all paths one behind the other; starts: where each begins, and the end."""
    k1, k2, words = paths
    size = np.diff(starts)
    label, levels, degree = [np.zeros((3, 1), np.int64)], [0, 1], [np.zeros(1, np.int64)]
    node, last = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    for d in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > d)
        at = starts[on] + d
        new = np.ones(len(on), bool)
        new[1:] = (node[on][1:] != node[on][:-1]) | (k1[at][1:] != k1[at][:-1]) | (k2[at][1:] != k2[at][:-1])
        np.add.at(degree[-1], node[on][new] - levels[-2], 1)
        node[on] = levels[-1] + np.cumsum(new) - 1
        last[on] = node[on]
        label.append(np.stack([k1[at][new], k2[at][new], words[at][new]]))
        levels.append(levels[-1] + int(new.sum()))
        degree.append(np.zeros(int(new.sum()), np.int64))
    k, deg = np.concatenate(label, axis=1), np.concatenate(degree)
    nodes = len(deg)
    bits = np.ones(2 * nodes - 1, bool)
    bits[np.cumsum(deg) + np.arange(nodes)] = False
    louds = np.packbits(bits)
    ones = np.flatnonzero(np.unpackbits(louds, count=len(bits)))
    parent = np.concatenate([[0], ones - np.arange(len(ones))])  # zeros before a node's one
    depth = np.repeat(np.arange(len(levels) - 1), np.diff(levels))
    n, conv, direct = np.zeros(nodes, np.int64), np.full(nodes, np.iinfo(np.int64).max), np.zeros(nodes, np.int64)
    np.add.at(n, last, weight)
    np.minimum.at(conv, last, least)
    np.add.at(direct, last, tails)
    children = deg + direct
    leaves, s1, s2 = np.where(children == 0, 1, direct), np.zeros(nodes, np.int64), k[2].copy()
    for a, b in reversed(list(itertools.pairwise(levels))):
        s1[a:b] += n[a:b] * k[2, a:b]
        if a:
            for v in (n, leaves, s1, s2):
                np.add.at(v, parent[a:b], v[a:b])
            np.minimum.at(conv, parent[a:b], conv[a:b])
    edge = np.zeros(nodes, bool)
    for end in (last[0], last[-1]):
        while not edge[end]:
            edge[end] = True
            end = parent[end]
    return {
        "depth": depth, "k1": k[0], "k2": k[1], "p1": k[0][parent], "p2": k[1][parent], "conv": conv, "parent": conv[parent], "n": n, "children": children, "leaves": leaves,
        "s1": s1, "s2": s2, "words": k[2], "edge": edge, "below_edge": edge[parent]}


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if not table or not len(table):
        return
    table = table.combine_chunks()
    path = table.column("path").chunk(0)
    values = path.flatten()
    starts = np.concatenate([[0], np.cumsum(path.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    numbers = lambda c: c.to_numpy().astype(np.int64)
    found = shard_trie([values.field(i).to_numpy(zero_copy_only=False) for i in range(3)], starts, *(numbers(table.column(c)) for c in ("weight", "least", "tails")))
    out = pa.Table.from_pydict(found)
    yield from out.to_batches(max_chunksize=10_000)


def _upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of several shards: what each shard counted of them and of those below them is taken off but once. Such a node has children, so it is no leaf, though a shard that
    holds only the path that ends there (bare) took it for one."""
    rows = pa.Table.from_batches(batches).sort_by("depth") if (batches := list(batches)) else None
    if not rows or not len(rows):
        return
    c = {n: rows.column(n).to_numpy().copy() for n in rows.column_names}
    number = {key: i for i, key in enumerate(zip(c["depth"], c["k1"], c["k2"]))}
    parent = np.array([number.get((d - 1, a, b), 0) for d, a, b in zip(c["depth"], c["p1"], c["p2"])])
    over = c["parts"] - 1
    twice, bare = over * c["words"], c["bare"]
    levels = np.searchsorted(c["depth"], np.arange(c["depth"][-1] + 2))
    for a, b in reversed(list(itertools.pairwise(levels))):
        if a:
            np.add.at(twice, parent[a:b], twice[a:b])
            np.add.at(bare, parent[a:b], bare[a:b])
            np.subtract.at(c["children"], parent[a:b], over[a:b])
    c["s2"] -= twice
    c["leaves"] -= bare
    c["parent"] = c["conv"][parent]
    yield pa.RecordBatch.from_pydict({n.split()[0]: c[n.split()[0]] for n in FIGURES.split(", ")})


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for r in b.to_pylist())
    out = []
    for key, group in itertools.groupby(rows, key=lambda r: (r["depth"], r["k1"], r["k2"])):
        digest = hashlib.sha256()
        for i, r in enumerate(group):
            digest.update((("," if i else "") + r["ids"]).encode())
        out.append((*key, digest.hexdigest()))
        if len(out) == 10_000:
            yield _keyed(out)
            out = []
    if out:
        yield _keyed(out)


def _keyed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()])], [*KEY, "ends"])


def prefix_trie(turns: DataFrame, *, shard_nodes: int = 1_000_000) -> DataFrame:
    """Of rows conv, nth, h, words (a row of null nth names a conversation without adding a turn): one row a node with conv (its smallest member), depth, parent (its
    parent's conv), n, children, leaves, saved ((n - 1) * words added up over its subtree), ends (SHA-256 of the ids of conversations that end there, ascending, comma-joined)."""
    x, y = F.xxhash64("nth", "h"), F.xxhash64("h", "nth", F.lit(1))
    rows = running(turns.filter("nth is not null").select("*", x.alias("e1"), y.alias("e2")), "conv", "nth", {"k1": F.col("e1"), "k2": F.col("e2")}, F.bit_xor, lambda a, b: a.bitwiseXOR(b))
    rows = rows.select("conv", (F.col("nth") + 1).alias("depth"), "k1", "k2", F.col("k1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("e2")).alias("p2"), "words")
    zero = F.lit(0).cast("bigint")
    roots = turns.select("conv").distinct().select("conv", *[zero.alias(c) for c in ("depth", "k1", "k2", "p1", "p2", "words")])
    rows = keep(rows.unionByName(roots), "beginnings")

    counted = rows.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    lone = keep(counted.filter("n = 1").drop("n"), "lone")
    first_lone = lone.groupBy("conv").agg(F.min("depth").alias("lone_from"))
    convs = rows.groupBy("conv").agg(F.max("depth").alias("length")).join(first_lone, "conv", "left")
    convs = convs.select("conv", "length", (F.coalesce("lone_from", F.col("length") + 1) - 1).alias("shared"))
    ended = keep(rows.join(convs, "conv").filter("depth = shared").select("conv", "length", *KEY), "last-shared")

    groups = ended.groupBy(*KEY).agg(F.min("conv").alias("least"), F.count("*").alias("weight"), F.count_if(F.col("length") > F.col("depth")).alias("tails"))
    step = F.struct("depth", "k1", "k2", "words")
    path = rows.join(groups.select(F.col("least").alias("conv"), F.col("depth").alias("upto")), "conv").filter("depth > 0 and depth <= upto").groupBy(F.col("conv").alias("least")).agg(F.array_sort(F.collect_list(step)).alias("p"))
    path = path.select("least", F.expr("transform(p, x -> struct(x.k1, x.k2, x.words))").alias("path"))
    paths = keep(groups.join(path, "least", "left").select(F.coalesce("path", F.expr("cast(array() as array<struct<k1:bigint,k2:bigint,words:bigint>>)")).alias("path"), "weight", "least", "tails"), "paths")
    total = paths.agg(F.sum(F.size("path"))).first()[0] or 0
    sharded = paths.repartitionByRange(1 + total // shard_nodes, "path").sortWithinPartitions("path").mapInArrow(_shards, FIGURES + ", edge boolean, below_edge boolean")
    nodes = keep(sharded, "shards")

    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "s1", "s2")]
    parts = nodes.filter("edge").groupBy(*KEY).agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv").alias("conv"), *sums, F.min("words").alias("words"), F.count("*").alias("parts"), F.count_if(F.col("children") == 0).alias("bare"))
    upper = keep(parts.filter("parts > 1").repartition(1).mapInArrow(_upper, FIGURES), "upper-levels")
    plain = nodes.join(upper.select(*KEY), KEY, "left_anti")
    above = upper.select(*[F.col(k).alias(f"u_{k}") for k in KEY], F.col("conv").alias("u_conv"))
    met = F.col("below_edge") & (F.col("u_depth") == F.col("depth") - 1) & (F.col("u_k1") == F.col("p1")) & (F.col("u_k2") == F.col("p2"))
    plain = plain.join(above, met, "left").withColumn("parent", F.coalesce("u_conv", "parent"))
    shared = keep(upper.unionByName(plain.select(*upper.columns)), "shared-nodes")

    finished = in_order(ended.filter("length = depth").select(*KEY, "conv"), [*KEY, "conv"], "ends")
    pieces = finished.groupBy(*KEY, F.shiftright("pos", RUN).alias("run")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    ends = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "run").mapInArrow(_ends, "depth bigint, k1 bigint, k2 bigint, ends string")

    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    parent = F.when(F.col("depth") > 0, F.col("parent")).alias("parent")
    a = shared.join(ends, KEY, "left").select("conv", "depth", parent, "n", "children", "leaves", (F.col("s1") - F.col("s2")).alias("saved"), F.coalesce("ends", digest(F.lit(""))).alias("ends"))
    tail = lone.join(convs, "conv")
    holders = shared.select(F.col("depth").alias("h_depth"), F.col("k1").alias("h1"), F.col("k2").alias("h2"), F.col("conv").alias("holder"))
    begins = tail.filter("depth = shared + 1").join(holders, F.expr("h_depth = depth - 1 and h1 = p1 and h2 = p2"), "left")
    tail = begins.select("conv", "depth", "length", F.col("holder").alias("parent")).unionByName(tail.filter("depth > shared + 1").select("conv", "depth", "length", F.col("conv").alias("parent")))
    one = F.lit(1).cast("bigint")
    b = tail.select("conv", "depth", parent, one.alias("n"), (F.col("depth") < F.col("length")).cast("bigint").alias("children"), one.alias("leaves"), zero.alias("saved"), digest(F.when(F.col("depth") == F.col("length"), F.col("conv").cast("string")).otherwise("")).alias("ends"))
    return a.unionByName(b)
