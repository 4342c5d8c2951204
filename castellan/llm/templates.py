"""Line dedup by a log-template tree of fixed depth, after Drain (He et al., 2017).

A line is its words. Words with a digit or an at sign, addresses and the like are variable fields and read ``<*>``. A leaf of the tree is a
number of words with the ``depth`` leading ones. Within a leaf, lines join the template that they share at least ``similarity`` of
their words with, position by position; where they differ the template becomes variable. A template that occurs in ``least_docs``
documents or more is dropped everywhere but at its first occurrence, by document id and line. Lines of fewer than ``least_words`` words, where one
word is a large share, are compared by equality of their own words, nothing masked, and recur from ``least_short_docs`` documents on: chance repeats few of them.

Only leaves with different lines from different documents go through the matching, and only their distinct lines; a line that recurs word by
word is its own template by its hash. A leaf is matched whole at any size. Once it has over ``leaf_rows`` templates they are found by an index:
a line that misses a template at m words at most equals it in one of m + 1 ranges of positions, so the index finds what a look at all would.

Cases: a null or empty text has no lines to drop and stays as it is; a line that recurs within one document only stays; repeated rows are one
document; null ids are one document, the first; an empty table gives no rows; further columns stay and may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castellan.llm.common import BLANKS, numbered
from castellan.workspace import keep

VARIABLE = r"(?<!\S)(?:[^\s0-9@]*[0-9@]\S*|https?://\S+)"
FIELD = "<*>"


def masked_lines(docs: DataFrame, id: str, text: str, least_words: int) -> DataFrame:
    """doc, id, pos, line (words joined by a blank, variable fields masked if there are least_words words or more), n: the lines that are not blank."""
    d = docs.select(F.col(id).alias("id"), F.xxhash64(F.col(id), F.col(text)).alias("doc"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    # most lines have single blanks and no variable field: a look at the characters spares them the replacements
    d = d.withColumn("line", F.trim(F.when(F.col("line").rlike(r"[\x09-\x0D]|\x20\x20"), F.regexp_replace("line", BLANKS, " ")).otherwise(F.col("line"))))
    d = d.withColumn("n", F.length("line") - F.length(F.translate("line", " ", "")) + 1).filter(F.col("line") != "")
    return d.withColumn("line", F.when((F.col("n") >= least_words) & (F.col("line").rlike("[0-9@]") | F.col("line").contains("://")), F.regexp_replace("line", VARIABLE, FIELD)).otherwise(F.col("line")))


class Leaf:
    """The templates of one leaf: positions that vary are None. Over leaf_rows of them are found by the words of a range of positions."""

    def __init__(self, similarity: float, depth: int, leaf_rows: int):
        self.similarity, self.depth, self.leaf_rows = similarity, depth, leaf_rows
        self.templates: list[list[str | None]] = []
        self.ranges: list[slice] | None = None
        self.holders: dict[tuple, set[int]] = {}

    def keys(self, words: list[str | None]) -> list[tuple]:
        """A key for each range; none where the template varies, which no line equals."""
        return [(i, *words[r]) for i, r in enumerate(self.ranges or []) if None not in words[r]]

    def build(self, n: int) -> None:
        """Ranges of the positions behind the leading words, which all lines of a leaf share. Without positions for all, one empty range holds every template."""
        most = max(m for m in range(n + 1) if m == 0 or (n - m) / n >= self.similarity)
        first = min(self.depth, n)
        cuts = [first + (n - first) * i // (most + 1) for i in range(most + 2)]
        self.ranges = [slice(a, b) for a, b in zip(cuts, cuts[1:])] if n - first > most else [slice(0, 0)]
        for i, t in enumerate(self.templates):
            for k in self.keys(t):
                self.holders.setdefault(k, set()).add(i)

    def place(self, words: list[str]) -> int:
        if self.ranges is None and len(self.templates) > self.leaf_rows:
            self.build(len(words))
        own = self.keys(words)
        near = range(len(self.templates)) if self.ranges is None else sorted(set().union(*(self.holders.get(k, ()) for k in own)))
        best, share = -1, -1.0
        for i in near:
            same = sum(a == b for a, b in zip(self.templates[i], words)) / len(words)
            if same > share:
                best, share = i, same
        if share < self.similarity:
            self.templates.append(list(words))
            for k in own:
                self.holders.setdefault(k, set()).add(len(self.templates) - 1)
            return len(self.templates) - 1
        before = self.keys(self.templates[best])
        self.templates[best] = [a if a == b else None for a, b in zip(self.templates[best], words)]
        for k in set(before) - set(self.keys(self.templates[best])):
            self.holders[k].discard(best)
        return best


def matched(lines: DataFrame, similarity: float, depth: int, leaf_rows: int) -> DataFrame:
    """m, template for distinct lines (leaf, m, line): leaves come whole and sorted, one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, leaf = None, Leaf(similarity, depth, leaf_rows)
        for b in batches:
            out = np.empty(b.num_rows, np.int64)
            for i, (at, line) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist())):
                if at != current:
                    current, leaf = at, Leaf(similarity, depth, leaf_rows)
                out[i] = leaf.place(line.split(" "))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out)], ["leaf", "m", "nth"])

    placed = lines.select("leaf", "m", "line").repartition("leaf").sortWithinPartitions("leaf", "line").mapInArrow(run, "leaf bigint, m bigint, nth bigint")
    return placed.select("m", F.xxhash64("leaf", "nth").alias("template"))


def recurring_lines(docs: DataFrame, *, id: str = "doc_id", text: str = "text", depth: int = 3, similarity: float = 0.7, least_docs: int = 2, least_words: int = 6, least_short_docs: int = 6, leaf_rows: int = 5_000) -> DataFrame:
    """doc (hash of id and text) and drop, the positions of its lines to drop: documents with such lines only."""
    lines = masked_lines(docs, id, text, least_words)
    short = F.col("n") < least_words
    # a short line is a leaf of its own
    leaf = F.xxhash64("n", F.when(short, F.col("line")).otherwise(F.substring_index("line", " ", depth))).alias("leaf")
    lines = lines.select("id", "doc", "pos", leaf, F.xxhash64("line").alias("m"), "line", short.alias("short"))
    lines = keep(lines, "lines")  # columnar: what needs no line does not read it
    found = lines.drop("line")

    leaves = found.groupBy("leaf").agg(F.min("doc").alias("d0"), F.max("doc").alias("d1"), F.min("m").alias("m0"), F.max("m").alias("m1"), F.bool_or("short").alias("short")).filter("d0 <> d1")
    leaves = keep(leaves.select("leaf", "short", (F.col("m0") != F.col("m1")).alias("mixed")), "leaves")
    mixed = leaves.filter("mixed").select("leaf")
    distinct = keep(lines.select("leaf", "m", "line").join(mixed, "leaf", "left_semi").groupBy("leaf", "m").agg(F.min("line").alias("line")), "distinct")
    templates = keep(matched(distinct, similarity, depth, leaf_rows), "templates")

    seen = found.drop("short").join(leaves, "leaf").join(templates, "m", "left").select("id", "doc", "pos", "short", F.coalesce("template", "m").alias("template"))
    seen = keep(seen, "seen")
    order = F.struct(F.coalesce("id", F.lit(-(1 << 63)).cast("long")).alias("id"), "doc", "pos")
    per_doc = seen.groupBy("template", "id").agg(F.min(order).alias("first"), F.bool_or("short").alias("short"))
    recurring = per_doc.groupBy("template").agg(F.count("*").alias("docs"), F.min("first").alias("first"), F.bool_or("short").alias("short"))
    recurring = recurring.filter(F.col("docs") >= F.when(F.col("short"), max(least_docs, least_short_docs)).otherwise(least_docs)).drop("short")
    recurring = keep(recurring, "recurring")  # both sides of the join are plain exchanges then, and a hot template can be split
    dropped = seen.join(recurring, "template").filter((F.col("doc") != F.col("first.doc")) | (F.col("pos") != F.col("first.pos")))
    return dropped.groupBy("doc").agg(F.array_sort(F.collect_set("pos")).alias("drop"))


def drop_recurring_lines(docs: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with the recurring lines gone from text; n_chars, where there is such a column, follows."""
    drops = recurring_lines(docs, id=id, text=text, **options)
    d, names = numbered(docs)
    t = F.col(names[text])
    d = d.withColumn("doc", F.xxhash64(F.col(names[id]), t)).join(drops, "doc", "left")
    cut = F.when(F.isnull("drop"), t).otherwise(F.array_join(F.filter(F.split(t, "\n"), lambda line, i: ~F.array_contains(F.col("drop"), i)), "\n"))
    out = {text: cut}
    if "n_chars" in names and text != "n_chars":
        out["n_chars"] = F.when(F.isnull("drop"), F.col(names["n_chars"])).otherwise(F.length(cut).cast(docs.schema["n_chars"].dataType))
    return d.select(*[out.get(c, F.col(v)).alias(c) for c, v in names.items()])


def line_report(docs: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """id, n_lines, n_dropped, dropped (positions, comma-joined), clean (the text that stays): a row for each row of docs."""
    drops = recurring_lines(docs, id=id, text=text, **options)
    d = docs.select(F.col(id).alias("id"), F.col(text).alias("t")).withColumn("doc", F.xxhash64("id", "t")).join(drops, "doc", "left")
    lines = F.split(F.coalesce("t", F.lit("")), "\n")
    drop = F.coalesce("drop", F.array().cast("array<int>"))
    clean = F.when(F.isnull("drop"), F.coalesce("t", F.lit(""))).otherwise(F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(F.col("drop"), i)), "\n"))
    return d.select("id", F.size(lines).cast("long").alias("n_lines"), F.size(drop).cast("long").alias("n_dropped"), F.array_join(drop.cast("array<string>"), ",").alias("dropped"), clean.alias("clean"))
