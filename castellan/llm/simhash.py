"""SimHash near-duplicates: sharded BK-trees over the distinct fingerprints, then connected components.

A fingerprint has 64 bits, each 1 if it is set in over half of the XXH64 values of the text's word shingles. Each shard is a BK-tree of
about ``tree_rows`` fingerprints, each a node whose children are keyed by their integer Hamming distance to it; a search follows only the edges
within the radius of its own distance. Two fingerprints within ``radius`` bits agree on at least ``blocks - radius`` of ``blocks`` equal
bit ranges; so each fingerprint goes to one tree for each such choice of ranges, by their first bits, and only the queries that a tree can
answer travel to it. All trees together are all fingerprints, which have no size bound and must not pass through the driver; so trees are
not broadcast to every task but meet their queries by key. A tree reports a forest of links and never all pairs: what is
linked twice within it is linked once. A shard of over ``shard_rows`` fingerprints is cut in parts, and each pair of parts gets a
tree and its queries: no link is lost and no task holds more than two parts.

Equal texts have equal fingerprints, so copies meet in one group-by and are one node from there on.

``near_groups`` and ``one_of_each`` take near copies by the similarity of whole texts instead of a fixed radius: the same trees, over wider
fingerprints and in shards that near copies share, find the candidates.

Cases: a null or blank text has fingerprint zero and links like any other; a text of fewer words than a shingle has one shingle; repeated
rows share a fingerprint; rows without an id are never a component's id unless it has no other; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castellan.llm.common import numbered
from castellan.llm.components import connected_components
from castellan.workspace import keep

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
TO_LOWER = bytes.maketrans(UPPER, LOWER)


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(TO_LOWER).split()  # bytes split at the six ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[:n].tolist()
    ends = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    of = xxhash.xxh64_intdigest
    hashes = np.fromiter((of(joined[a:b], seed) for a, b in zip(starts, ends)), np.uint64, n)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounds the bits of a very long text
        set_bits += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((set_bits * 2 > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """id, fp: the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((simhash(t.as_py(), shingle, seed) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, fp bigint")


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints, whose words are the last axis."""
    d = np.bitwise_count(x ^ y)
    return d[..., 0].astype(np.int16) if d.shape[-1] == 1 else d.sum(axis=-1, dtype=np.int16)


class BKTree:
    """A BK-tree over fingerprints (rows of 64-bit words): each is a node, its children keyed by their integer distance to it.

    Built and searched a level at a time. ``visited`` counts the nodes that searches looked at, over all queries."""

    def __init__(self, fps: np.ndarray):
        self.fps, self.visited = fps, 0
        parent, edge = np.full(len(fps), -1), np.zeros(len(fps), np.int64)
        members, group = np.arange(len(fps)), np.zeros(len(fps), np.int64)
        while len(members):  # the first of each group is its node, the others go by their distance to it
            opens = np.r_[True, group[1:] != group[:-1]]
            over = members[opens][np.cumsum(opens) - 1][~opens]
            members = members[~opens]
            d = apart(fps[members], fps[over]).astype(np.int64)
            order = np.lexsort((d, over))
            members, over, d = members[order], over[order], d[order]
            parent[members], edge[members] = over, d
            group = over << 16 | d
        order = np.lexsort((edge, parent))[int(len(fps) > 0) :]
        self.children, self.keys = order, parent[order] << 16 | edge[order]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays of query positions and tree positions at most radius apart; only edges within the radius of a query's distance are followed."""
        n = len(self.fps)
        for at in range(0, len(queries) if n else 0, some := max(1, (1 << 21) // max(n, 1))):
            q = np.arange(at, min(at + some, len(queries)))
            node = np.zeros(len(q), np.int64)
            while len(q):
                d = apart(queries[q], self.fps[node]).astype(np.int64)
                self.visited += len(q)
                near = d <= radius
                yield q[near], node[near]
                low = np.searchsorted(self.keys, node << 16 | np.maximum(d - radius, 0))
                many = np.searchsorted(self.keys, node << 16 | d + radius, "right") - low
                q = np.repeat(q, many)
                node = self.children[np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)]


class Shard:
    """The fingerprints of one cell, those of the tree (part 0) and those that search it (part 1); in a shard in one part all do both."""

    def __init__(self, fps: np.ndarray, parts: np.ndarray):
        self.tree_at = np.flatnonzero(parts == 0)
        self.search_at = np.flatnonzero(parts == 1) if parts.any() else self.tree_at
        self.searching = fps[self.search_at]
        self.tree = BKTree(fps[self.tree_at])
        self.root = list(range(len(fps)))
        self.label = np.arange(len(fps))

    def _find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    def pairs(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays of positions at most radius apart and not yet known to be joined."""
        for q, t in self.tree.within(self.searching, radius):
            a, b = self.search_at[q], self.tree_at[t]
            live = self.label[a] != self.label[b]
            yield a[live], b[live]

    def forest(self, radius: int, may=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links, at most one fewer than the fingerprints, that join just what pairs within the radius (for which may(a, b) holds) join."""
        since = 0
        for a, b in self.pairs(radius):
            if may is not None:
                ok = may(a, b)
                a, b = a[ok], b[ok]
            links = []
            for i, j in zip(a.tolist(), b.tolist()):
                if (x := self._find(i)) != (y := self._find(j)):
                    self.root[x] = y
                    links.append((i, j))
            if links:
                yield tuple(np.array(links).T)
            if (since := since + len(links)) > len(self.root) // 8:
                self._relabel()
                since = 0

    def _relabel(self) -> None:
        self.label = np.fromiter(map(self._find, range(len(self.root))), np.int64, len(self.root))


def links_in_shards(
    keyed: DataFrame, link: Callable[[list[np.ndarray], np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]], more: DataFrame | None = None
) -> DataFrame:
    """a, b: the links that link(columns, parts) finds in each shard, in values of the column node.

    keyed: key (the shard), parts (how many parts the shard is cut in) and node, a long. more: further columns by node. link gets node and these."""
    part = F.expr("pmod(xxhash64(node, 1), parts)")
    # cells (i, j) of a large shard: part i is its tree and part j searches it; a small shard is its only cell
    cells = keyed.withColumn("part", part).withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
    cells = cells.select(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("cell"), F.when(F.col("part") > F.col("other"), 1).otherwise(0).cast("int").alias("searches"), "node")
    if more is not None:
        cells = cells.join(more, "node").select("cell", "searches", *more.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches come sorted by cell; only the last, still open cell is carried over."""
        held = None
        for b in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            yield from solve([c[:cut] for c in held])
            held = [c[cut:] for c in held]
        if held is not None:
            yield from solve(held)

    def solve(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cell, searches, node = held[:3]
        if not len(cell):
            return
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        ends = np.r_[starts[1:], len(cell)]
        for x, y in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            for a, b in link([c[x:y] for c in held[2:]], searches[x:y]):
                yield pa.RecordBatch.from_arrays([pa.array(node[x:y][a]), pa.array(node[x:y][b])], ["a", "b"])

    return cells.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(run, "a bigint, b bigint")


def links_of(nodes: DataFrame, radius: int, blocks: int, tree_rows: int, shard_rows: int) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) within the radius that keep every component whole.

    Of each range of bits a key reads as many as make shards of about tree_rows fingerprints: fewer bits lose no pair."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    bits = max(0, math.floor(math.log2(max(1, nodes.count()) / tree_rows)))
    each = -(-bits // (blocks - radius))

    def first_bits(i: int) -> str:
        return f"(shiftrightunsigned(fp, {edges[i]}) & {(1 << min(each, edges[i + 1] - edges[i])) - 1}L)"

    def link(columns: list[np.ndarray], parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return Shard(columns[0].view(np.uint64)[:, None], parts).forest(radius)

    choices = [f"xxhash64({n}, {', '.join(map(first_bits, some))})" for n, some in enumerate(combinations(range(blocks), blocks - radius))]
    choices = choices if bits else ["0L"]  # one tree holds all
    keyed = nodes.select(F.col("fp").alias("node"), F.explode(F.expr(f"array({', '.join(choices)})")).alias("key"))
    large = keep(keyed.groupBy("key").agg(F.count("*").alias("rows")).filter(F.col("rows") > shard_rows), "large")
    parts = F.expr(f"if(rows is null, 1L, cast(ceil(rows / {shard_rows}) as bigint))")
    return links_in_shards(keyed.join(large, "key", "left").select("key", parts.alias("parts"), "node"), link)


def simhash_components(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2, blocks: int = 3, tree_rows: int = 1_024, shard_rows: int = 20_000, seed: int = 42) -> DataFrame:
    """id, fp (signed long), component (the smallest id reachable), one row for each row of docs."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("blocks must exceed radius, or near fingerprints could share no range of bits")
    fps = keep(fingerprints(docs, id=id, text=text, shingle=shingle, seed=seed), "fingerprints")
    nodes = keep(fps.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    member = connected_components(links_of(nodes, radius, blocks, tree_rows, shard_rows))
    named = nodes.join(member, nodes["fp"] == member["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(least, "root").select("fp", "component")
    return fps.join(named, "fp").select("id", "fp", "component")


#: Of a near-duplicate sketch: words of 64 bits in a fingerprint, and the keys, each from as many minima of the shingles' hashes.
SKETCH_WORDS, SKETCH_KEYS, KEY_MINIMA = 4, 16, 3


def shingle_hashes(text: str | None, shingle: int, seed: int = 42) -> np.ndarray:
    """Sorted distinct XXH64 values of a whole text's word shingles (fewer words: the whole sequence; none: none), A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(TO_LOWER).split()
    if not words:
        return np.array([], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    starts = np.r_[0, ends[: n - 1]].tolist()
    ends = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    of = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((of(joined[a:b], seed) for a, b in zip(starts, ends)), np.uint64, n))


def mixed(h: np.ndarray, nth: int) -> np.ndarray:
    """The nth set of 64 bits that belongs to hashes (the finalizer of SplitMix64)."""
    h = h + np.uint64(0x9E3779B97F4A7C15 * (nth + 1) & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Each minimum is over one linear order of the hashes modulo 2 ** 64.
FACTORS, SHIFTS = np.split(mixed(np.arange(2 * SKETCH_KEYS * KEY_MINIMA, dtype=np.uint64), 0) | np.uint64(1), 2)


def sketch(hashes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The fingerprint of a set of shingles, in words, and the keys of the shards it goes to (an empty set to none)."""
    if not len(hashes):
        return np.zeros(SKETCH_WORDS, np.uint64), []
    set_bits = np.zeros(64 * SKETCH_WORDS, np.int64)
    least = np.full(SKETCH_KEYS * KEY_MINIMA, (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), 1 << 13):  # bounds the bits of a very long text
        some = hashes[at : at + (1 << 13)]
        words = np.stack([mixed(some, i) for i in range(SKETCH_WORDS)], axis=1)
        set_bits += np.unpackbits(words.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        least = np.minimum(least, (some[:, None] * FACTORS + SHIFTS).min(axis=0))
    fp = np.packbits((set_bits * 2 > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")
    return fp, [xxhash.xxh64_intdigest(m.tobytes(), i) for i, m in enumerate(least.reshape(SKETCH_KEYS, KEY_MINIMA))]


def widest(similarity: float) -> int:
    """The distance between sketches beyond which sets are surely not of the similarity: a bit differs with chance angle / pi at the cosine
    2s / (1 + s); six standard deviations above."""
    bits, chance = 64 * SKETCH_WORDS, math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * chance + 6 * math.sqrt(bits * chance * (1 - chance)))


class Sets:
    """Sets of hashes (sorted distinct 64-bit values as bytes), compared in batches."""

    def __init__(self, sets: np.ndarray):
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets)) // 8
        self.starts = np.cumsum(self.sizes) - self.sizes
        distinct, self.ids = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)
        self.marked = np.zeros(len(distinct), bool)

    def _shared(self, one: int, others: np.ndarray) -> np.ndarray:
        """How many hashes of one set each of the others has."""
        self.marked[self.ids[self.starts[one] : self.starts[one] + self.sizes[one]]] = True
        out = np.zeros(len(others), np.int64)
        ends = np.cumsum(self.sizes[others])
        cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1], 1 << 20)))  # bounds what is compared at once
        for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(others)]):
            sizes = self.sizes[others[x:y]]
            first = np.cumsum(sizes) - sizes
            at = np.arange(sizes.sum()) + np.repeat(self.starts[others[x:y]] - first, sizes)
            out[x:y] = np.add.reduceat(self.marked[self.ids[at]], first, dtype=np.int64)
        self.marked[self.ids[self.starts[one] : self.starts[one] + self.sizes[one]]] = False
        return out

    def alike(self, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
        """Whether the (Jaccard) similarity of each pair of sets, none empty, is reached."""
        ok = np.minimum(self.sizes[a], self.sizes[b]) >= similarity * np.maximum(self.sizes[a], self.sizes[b]) - 1e-6
        at = np.flatnonzero(ok)
        a, b = a[at], b[at]
        if len(np.unique(a)) > len(np.unique(b)):
            a, b = b, a
        order = np.argsort(a, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
            if len(some):
                both = self._shared(int(a[some[0]]), b[some])
                ok[at[some]] = both / (self.sizes[a[some]] + self.sizes[b[some]] - both) >= similarity
        return ok


def placed_in_shards(nodes: DataFrame, shard_hashes: int) -> DataFrame:
    """key, parts, node for the nodes (node, n, keys) of each shard that holds several; of shards that hold the same nodes, one."""
    keyed = nodes.select("node", "n", F.explode("keys").alias("key"))
    shards = keyed.groupBy("key").agg(F.count("*").alias("rows"), F.sum("n").alias("hashes"), F.min("node").alias("least"), *(F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"x{i}") for i in (1, 2)))
    shards = shards.filter("rows > 1").groupBy("rows", "hashes", "least", "x1", "x2").agg(F.min("key").alias("key"))
    shards = keep(shards.select("key", F.expr(f"cast(ceil(hashes / {shard_hashes}) as bigint)").alias("parts")), "shards")
    return keep(keyed.join(shards, "key").select("key", "parts", "node"), "placed")


def near_links(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """a, b: links that join just the nodes that pairs of the similarity within a shard join. sets: node, f0..., hashes."""
    radius = widest(similarity)

    def link(columns: list[np.ndarray], parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        fps, sets = np.stack([c.astype(np.int64) for c in columns[1 : 1 + SKETCH_WORDS]], axis=1).view(np.uint64), Sets(columns[-1])
        return Shard(fps, parts).forest(radius, lambda a, b: sets.alike(a, b, similarity))

    return links_in_shards(placed, link, sets)


def near_groups(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8, shard_hashes: int = 1_000_000) -> DataFrame:
    """digest (of a set of shingles), least (struct: the least row that has it) and component (struct: the least row reachable).

    A row is (no_id, id, doc), doc being a hash of its id and text; rows without an id come last. Texts are linked if their sets of word
    shingles have the similarity; copies, that is equal sets, are one node. Near copies meet in a shard with a chance of 99.999 % at a similarity
    of 0.8 and more above it (16 keys, each from three minima of the shingles' hashes); within a shard a BK-tree over 256-bit SimHash
    fingerprints finds candidates, and the whole sets, which lie in the same task, decide each at once. So a shard emits a forest of decided
    links and no pairs. A shard of over ``shard_hashes`` hashes is cut in parts; only nodes that share a shard with another have their sets sent."""
    fs = [f"f{i}" for i in range(SKETCH_WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, ns, fps, keys = [], [], np.zeros((b.num_rows, SKETCH_WORDS), np.uint64), []
            for i, t in enumerate(b.column(1)):
                h = shingle_hashes(t.as_py(), shingle)
                fps[i], k = sketch(h)
                digests.append(xxhash.xxh3_128_digest(h.tobytes()))
                ns.append(len(h))
                keys.append(np.array(k, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(digests, pa.binary()), pa.array(ns, pa.int64()), pa.array(keys, pa.list_(pa.int64())), *(pa.array(fps[:, i].copy().view(np.int64)) for i in range(SKETCH_WORDS))],
                ["row", "digest", "n", "keys", *fs],
            )

    row = F.struct(F.isnull(id).alias("no_id"), F.col(id).alias("id"), F.xxhash64(id, text).alias("doc"))
    rows = docs.select(row.alias("row"), F.col(text).alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    sketches = rows.mapInArrow(run, f"row struct<no_id:boolean,id:{kind},doc:bigint>, digest binary, n bigint, keys array<bigint>, {', '.join(f'{f} bigint' for f in fs)}")
    nodes = sketches.groupBy("digest").agg(F.min("row").alias("least"), *(F.first(c).alias(c) for c in ("n", "keys", *fs)))
    nodes = keep(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    placed = placed_in_shards(nodes, shard_hashes)
    met = keep(nodes.join(placed.select("node").distinct(), "node").select("node", "least.doc", *fs), "met")
    met = rows.select("row.doc", "text").join(met, "doc").groupBy("node").agg(F.first("text").alias("text"), *(F.first(f).alias(f) for f in fs))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = pa.array((shingle_hashes(t.as_py(), shingle).tobytes() for t in b.column(1)), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], sets], ["node", *fs, "hashes"])

    sets = met.mapInArrow(hashed, f"node bigint, {', '.join(f'{f} bigint' for f in fs)}, hashes binary")
    member = connected_components(near_links(placed, sets, similarity))
    named = nodes.join(member, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root"))
    return named.join(named.groupBy("root").agg(F.min("least").alias("component")), "root").select("digest", "least", "component")


def one_of_each(docs: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that stay when each group of near copies (near_groups) keeps one row: the one of its smallest id (repeated rows are one)."""
    d, names = numbered(docs)
    kept = near_groups(d, id=names[id], text=names[text], **options).filter("least <=> component").select(F.col("least.id").alias("kept_id"), F.col("least.doc").alias("kept_doc"))
    d = d.withColumn("doc", F.xxhash64(names[id], names[text]))
    d = d.join(kept, (d["doc"] == kept["kept_doc"]) & d[names[id]].eqNullSafe(kept["kept_id"]))
    return d.dropDuplicates(["doc", names[id]]).select(*[F.col(v).alias(k) for k, v in names.items()])
