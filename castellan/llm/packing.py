"""Lexical retrieval packing: each window is a seed document and its BM25 neighbours that no window has used yet.

Documents become token ids once, stored as two bytes an id with the end id behind them. Token frequencies count over all documents; the
tokenizer's vocabulary bounds them, so every task gets the whole table. The inverted index is sharded by subject, so that a seed's
neighbours lie in its own shard wherever they come from: a document's vector (its tokens' idf, folded into ``DIMENSIONS``) is coded by residual
codebooks of ``CODES`` centroids each, as many levels as the number of shards asks for; documents in the order of their codes are cut into shards of
about ``shard_tokens`` ids, and a code that holds more is dealt over several shards by hash. The codebooks are fitted on a sample of about
``SAMPLE`` documents; every document is coded and indexed. A task holds one shard's index, takes its documents by hash order as seeds, ranks the
unused documents of the shard by BM25 against all terms of the seed, and fills the window with them, or with the next unused ones
once none shares a term. The document that overflows a window is cut and its rest seeds the next one. The last window of a shard is cut
into sequences whose lengths are powers of two, so nothing is padded.

Cases: a null or empty text is its end id alone; repeated rows are documents of their own; a document of many windows fills them one after
another; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from castellan.workspace import keep

#: Of the vectors that deal documents to shards: their length, the centroids of a codebook, and the documents (about) it is fitted on.
DIMENSIONS, CODES, SAMPLE = 128, 64, 8192
#: Texts are tokenised by so many bytes at once.
AT_ONCE = 16 << 20
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker on each core already


def byte_letters() -> dict[int, str]:
    """The letters by which byte-level tokenizers write bytes: printable Latin-1 as itself, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def joined(words: pa.Array, mark: str) -> str:
    """All words with the mark behind each."""
    parts = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(parts, mark)[0].as_py() + mark if len(words) else ""


def gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """pool[s : s + n] of each start and size, one after another."""
    first = np.cumsum(sizes) - sizes
    return pool[np.arange(sizes.sum()) + np.repeat(starts - first, sizes)]


class WordIds:
    """Token ids of texts, made once for each distinct word of a batch.

    A tokenizer that lower-cases, drops white space and splits words by a pattern into pieces for a BPE model with word ends may be
    asked about distinct pieces alone. Words beyond Latin letters, or with a special token in them, go through the whole tokenizer; so does every text
    if the tokenizer is of another kind or the short way gives other ids for a few words."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.specials = [t["content"] for t in made["added_tokens"]]
        self.letters = {ord(chr(b)): c for b, c in byte_letters().items() if b != 32}
        self.by_word = False
        try:
            split, as_bytes = made["pre_tokenizer"]["pretokenizers"]
            steps = [n["type"] for n in made["normalizer"]["normalizers"]]
            self.pattern = regex.compile(split["pattern"]["Regex"] + "|\n")
            end = made["model"]["end_of_word_suffix"]
            plain = steps == ["NFC", "Replace", "Lowercase"] and split["behavior"] == "Removed" and split["invert"] and not as_bytes["use_regex"] and not as_bytes["add_prefix_space"]
        except (KeyError, TypeError, ValueError):
            return
        if plain and end:
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.ends_word = np.zeros(1 << 16, bool)
            self.ends_word[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(end)]] = True
            samples = ["word", "Word.", "it's", "élÈve,", "a1b22", "½§x", "###", "don't''ll", "<|x", "říč", "xqzzv@x.org"]
            pool, sizes = self.of_words(pa.array(samples))
            self.by_word = [p.tolist() for p in np.split(pool, np.cumsum(sizes)[:-1])] == [self.in_full(w).tolist() for w in samples]

    def in_full(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16)

    def of_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all pieces, and how many each has."""
        text = joined(pieces, " ")
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.letters)
        pool = np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint16)
        return pool, np.diff(np.flatnonzero(self.ends_word[pool]) + 1, prepend=0)

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all words, which hold no white space, one after another, and how many each has."""
        short = pc.match_substring_regex(words, "^[!-~¡-įı-ſ]+$")
        for s in self.specials:
            short = pc.and_not(short, pc.match_substring(words, s))
        whole = pc.and_(short, pc.utf8_is_alpha(words))  # of letters alone: one piece
        short = pc.and_not(short, whole)
        split = self.pattern.findall(joined(words.filter(short), "\n").lower())
        pieces = pa.concat_arrays([pc.utf8_lower(words.filter(whole)), pa.array(split, pa.string())]).dictionary_encode()
        line_end = pc.index(pieces.dictionary, "\n").as_py()
        pool, sizes = self.of_pieces(pieces.dictionary.filter(pc.not_equal(pieces.dictionary, "\n")))
        if line_end >= 0:
            sizes = np.insert(sizes, line_end, 0)
        at = pieces.indices.to_numpy()
        ids = gathered(pool, (np.cumsum(sizes) - sizes)[at], sizes[at])
        first_split = len(at) - len(split)
        upto = np.cumsum(sizes[at])[np.r_[:first_split, first_split + np.flatnonzero(at[first_split:] == line_end)]]
        full = pc.invert(pc.or_(whole, short))
        others = [self.in_full(w) for w in words.filter(full).to_pylist()]
        n, order = np.empty(len(words), np.int64), np.concatenate([np.flatnonzero(m.to_numpy(zero_copy_only=False)) for m in (whole, short, full)])
        n[order] = each = np.concatenate([np.diff(upto, prepend=0), [len(x) for x in others]]).astype(np.int64)
        first = np.empty(len(words), np.int64)
        first[order] = np.cumsum(each) - each
        return gathered(np.concatenate([ids, *others]), first, n), n

    def of_texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts, each with end_id behind it, and how many each has."""
        texts = texts.fill_null("")
        if not self.by_word:
            each = [np.append(self.in_full(t), np.uint16(end_id)) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, np.uint16), *each]), np.array([len(x) for x in each], np.int64)
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        ids, sizes = self.of_words(words.dictionary)
        ids, sizes = np.append(ids, np.uint16(end_id)), np.append(sizes, 1)
        upto = np.cumsum(pc.list_value_length(split).to_numpy())
        at = np.insert(words.indices.to_numpy(), upto, len(sizes) - 1)
        n = np.diff(np.cumsum(sizes[at])[upto + np.arange(len(upto))], prepend=0)
        return gathered(ids, (np.cumsum(sizes) - sizes)[at], sizes[at]), n


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One for each worker process, which serves many tasks."""
    return WordIds(path)


def cut_by_bytes(texts: pa.Array) -> list[tuple[int, int]]:
    """Ranges of rows with about AT_ONCE bytes."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    cuts = np.unique(np.searchsorted(upto, np.arange(0, upto[-1], AT_ONCE))) if len(upto) else np.array([], int)
    return list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(texts)]))


def as_binary(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(sizes * 2)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u2", copy=False))])


def flat(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of them, and how many each row has."""
    offsets = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
    data = ids.buffers()[2]
    return np.frombuffer(data or b"", "<u2")[offsets[0] // 2 : offsets[-1] // 2], np.diff(offsets) // 2


def tokenized(docs: DataFrame, *, tokenizer_path: str, end_id: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, ids (binary, unsigned 16-bit little-endian, end_id last), n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_ids(tokenizer_path)
        if own.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the tokenizer's ids do not fit in 16 bits")
        for b in batches:
            for x, y in cut_by_bytes(b.column(1)):
                some = b.slice(x, y - x)
                ids, n = own.of_texts(some.column(1), end_id)
                yield pa.RecordBatch.from_arrays([some.column(0), as_binary(ids, n), pa.array(n, pa.int64())], ["id", "ids", "n"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, ids binary, n bigint")


def distinct_ids(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, id and count of the distinct ids of each row, in this order."""
    keys = np.repeat(np.arange(len(sizes), dtype=np.int64) << 16, sizes) | ids
    keys, n = np.unique(keys, return_counts=True)
    return keys >> 16, keys & 0xFFFF, n


def token_frequencies(tokens: DataFrame) -> DataFrame:
    """token, df: in how many documents each token occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 16, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                seen += np.bincount(distinct_ids(*flat(b.column(0).slice(at, 1024)))[1], minlength=1 << 16)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], ["token", "df"])

    return tokens.select("ids").mapInArrow(run, "token int, df bigint").groupBy("token").agg(F.sum("df").alias("df"))


def vectors(ids: np.ndarray, sizes: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """A row of unit length for each document: its tokens' idf, each token in one of the dimensions with a sign of its own."""
    token = np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    place, signed = (token % DIMENSIONS).astype(np.int64), np.where(token >> np.uint64(20) & np.uint64(1), 1.0, -1.0) * idf
    at = np.repeat(np.arange(len(sizes), dtype=np.int64) * DIMENSIONS, sizes) + place[ids]
    v = np.bincount(at, signed[ids], len(sizes) * DIMENSIONS).reshape(-1, DIMENSIONS)
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def nearest(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (v @ centroids.T - (centroids**2).sum(axis=1) / 2).argmax(axis=1)


def codebooks(sample: np.ndarray, first: int, levels: int, rounds: int = 12) -> list[np.ndarray]:
    """Centroids of the sample (of the first book: at most ``first``), of what they leave of it, and so on; those of one book go along a chain of near ones."""
    rng, books = np.random.default_rng(7), []
    for level in range(levels):
        c = sample[rng.choice(len(sample), min(CODES, len(sample), *([] if level else [first])), replace=False)]
        for _ in range(rounds):
            own = nearest(sample, c)
            n = np.bincount(own, minlength=len(c))
            sums = np.zeros_like(c)
            np.add.at(sums, own, sample)
            c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
        chain, left = [0], set(range(1, len(c)))
        while left:
            chain.append(min(left, key=lambda i: float(((c[i] - c[chain[-1]]) ** 2).sum())))
            left.remove(chain[-1])
        books.append(c[chain])
        sample = sample - books[-1][nearest(sample, books[-1])]
    return books


def codes_of(v: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """The codes of all levels as one number."""
    code = np.zeros(len(v), np.int64)
    for c in books:
        own = nearest(v, c)
        code, v = code * CODES + own, v - c[own]
    return code


class Bm25Index:
    """Postings of one shard's documents: for each token the documents that hold it and their weights; in a full row where an eighth of them do."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, idf: np.ndarray, mean_length: float, k1: float = 1.2, b: float = 0.75):
        self.docs = len(sizes)
        doc, token, n = distinct_ids(ids, sizes)
        self.tokens, self.first = token, np.searchsorted(doc, np.arange(self.docs + 1))
        weight = idf[token] * n * (k1 + 1) / (n + k1 * (1 - b + b * sizes[doc] / mean_length))
        order = np.argsort(token.astype(np.uint16), kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.starts = np.searchsorted(token[order], np.arange((1 << 16) + 1))
        often = np.flatnonzero(np.diff(self.starts) * 8 > self.docs)
        self.row = np.full(1 << 16, -1)
        self.row[often] = np.arange(len(often))
        self.full = np.zeros((len(often), self.docs))
        for i, t in enumerate(often):
            at = slice(self.starts[t], self.starts[t + 1])
            self.full[i, self.doc[at]] = self.weight[at]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for all terms of the seed."""
        t = self.tokens[self.first[seed] : self.first[seed + 1]]
        rows = self.row[t]
        total = self.full[rows[rows >= 0]].sum(axis=0)
        rare = [slice(self.starts[x], self.starts[x + 1]) for x in t[rows < 0].tolist()]
        if rare:
            total = total + np.bincount(np.concatenate([self.doc[s] for s in rare]), np.concatenate([self.weight[s] for s in rare]), self.docs)
        return total

    def ranked(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, best first; ties in shard order."""
        score = self.scores(seed)
        found = np.flatnonzero((score > 0) & unused)
        return found[np.argsort(-score[found], kind="stable")]


def pack_shard(sizes: list[int], index: Bm25Index, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard; each id in one piece, every sequence full or a power of two."""
    unused = np.ones(len(sizes), bool)
    order = iter(range(len(sizes)))
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, carried = 0, None

    def next_unused() -> int | None:
        return next((d for d in order if unused[d]), None)

    while True:
        seed, start = carried or (next_unused(), 0)
        if seed is None:
            return pieces
        unused[seed] = False
        carried, room = None, window
        neighbours: Iterator[int] | None = None
        d: int | None = seed
        opened = len(pieces)
        while d is not None:
            take = min(sizes[d] - start, room)
            pieces.append((d, start, take, sequence, window - room))
            room -= take
            if start + take < sizes[d]:
                carried = (d, start + take)
            if not room:
                break
            if neighbours is None:
                neighbours = iter(index.ranked(seed, unused).tolist())
            d, start = next((x for x in neighbours if unused[x]), None), 0
            if d is None:
                d = next_unused()
            if d is not None:
                unused[d] = False
        if room:  # nothing is left: cut the last window at powers of two
            tail, pieces[opened:] = pieces[opened:], []
            size = 1 << (window - room).bit_length() - 1
            left, offset = window - room, 0
            for d, start, length, *_ in tail:
                while length:
                    take = min(length, size - offset)
                    pieces.append((d, start, take, sequence, offset))
                    start, length, offset, left = start + take, length - take, offset + take, left - take
                    if offset == size and left:
                        sequence, offset, size = sequence + 1, 0, 1 << left.bit_length() - 1
        sequence += 1


def deal(tokens: DataFrame, count: int, idf, shards: int, shard_tokens: int, seed: int) -> DataFrame:
    """tokens (id, ids, n) with h and shard: documents in the order of their codes, cut into shards; a code of more than a shard in several.

    idf: a broadcast array. Shards are numbered within the first code, codes of several shards oddly, the others evenly."""
    levels = max(2, ceil(log(4 * shards, CODES)))
    hashed = tokens.withColumn("h", F.xxhash64(F.lit(seed), "id", "ids"))
    if shards == 1:
        return hashed.withColumn("shard", F.lit(0).cast("long"))

    def as_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in vectors(*flat(b.column(0)), idf.value)], pa.binary())], ["v"])

    one_in = max(1, count // SAMPLE)
    sampled = hashed.filter(F.pmod(F.xxhash64("h"), F.lit(one_in)) == 0).select("ids").mapInArrow(as_vectors, "v binary").orderBy("v").limit(4 * SAMPLE).collect()
    books = codebooks(np.stack([np.frombuffer(r.v, np.float32) for r in sampled]) if sampled else np.zeros((1, DIMENSIONS), np.float32), ceil(shards / 2), levels)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [codes_of(vectors(*flat(b.column("ids").slice(at, 1024)), idf.value), books) for at in range(0, b.num_rows, 1024)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate([np.zeros(0, np.int64), *codes]))], [*b.schema.names, "code"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in hashed.schema)
    with_code = hashed.mapInArrow(coded, f"{kinds}, code bigint")
    cells = with_code.groupBy("code").agg(F.sum("n").alias("n")).withColumn("top", F.expr(f"code div {CODES ** (levels - 1)}"))
    cells = cells.withColumn("parts", F.ceil(F.col("n") / shard_tokens))
    before = Window.partitionBy("top").orderBy("code").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("large", F.coalesce(F.sum(F.when(F.col("parts") > 1, F.col("parts"))).over(before), F.lit(0)))
    cells = cells.withColumn("chunk", F.expr("coalesce(sum(if(parts > 1, 0, n)) over (partition by top order by code rows between unbounded preceding and 1 preceding), 0)"))
    number = F.when(F.col("parts") > 1, 2 * F.col("large") + 1).otherwise(2 * (F.col("large") + F.expr(f"chunk div {shard_tokens}")))
    cells = keep(cells.select("code", "parts", (F.shiftleft("top", 32) + number).alias("first")), "cells")
    dealt = with_code.join(cells, "code")
    return dealt.select("id", "ids", "n", "h", (F.col("first") + F.when(F.col("parts") > 1, 2 * F.pmod(F.xxhash64("h"), "parts")).otherwise(0)).alias("shard"))


def pack(docs: DataFrame, *, tokenizer_path: str, end_id: int = 2, window: int = 4096, shard_tokens: int = 2_000_000, id: str = "doc_id", text: str = "text", seed: int = 11) -> DataFrame:
    """A row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (binary, unsigned 16-bit)."""
    tokens = keep(tokenized(docs, tokenizer_path=tokenizer_path, end_id=end_id, id=id, text=text), "tokens")
    count, total = tokens.agg(F.count("*"), F.sum("n")).first()
    frequency = np.zeros(1 << 16)
    for token, df in token_frequencies(tokens).collect():  # at most one row for each id of the vocabulary
        frequency[token] = df
    shared = docs.sparkSession.sparkContext.broadcast(np.log1p((max(count, 1) - frequency + 0.5) / (frequency + 0.5)))
    mean_length = (total or 1) / max(count, 1)
    dealt = deal(tokens, count, shared, max(1, ceil((total or 0) / shard_tokens)), shard_tokens, seed)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "id"], kind="stable")
        sizes = pdf["n"].to_numpy()
        ids = np.frombuffer(b"".join(pdf["ids"]), "<u2")
        pieces = pack_shard(sizes.tolist(), Bm25Index(ids, sizes, shared.value, mean_length), window)
        d, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces))
        at = (np.cumsum(sizes) - sizes)[d] + start
        cut = [ids[a : a + n] for a, n in zip(at.tolist(), length.tolist())]
        return pd.DataFrame({
            "id": pdf["id"].to_numpy()[d], "start": start, "length": length, "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in cut], "doc_tokens": sizes[d],
            "sequence_id": (int(pdf["shard"].iloc[0]) << 22) + sequence, "offset": offset, "ids": [x.tobytes() for x in cut],
        })

    kind = docs.schema[id].dataType.simpleString()
    return dealt.groupBy("shard").applyInPandas(run, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
