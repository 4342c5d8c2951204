"""I-Match fingerprints: distinct terms of a middle document-frequency band, sorted and hashed in randomised subsets of the lexicon.

Document frequencies count every term of every document. The lexicon keeps the terms that occur in a share ``lowest`` to
``highest`` of the documents: the words that every text has and the ones that hardly any has say nothing. It holds at most
(mean number of distinct terms of a document) / ``lowest`` terms however many documents there are, and is refused over
``most_terms``; so it travels with the plan as a constant table and no exploded term is shuffled or joined. A hash deals the lexicon out to 128 disjoint random subsets; a
text's distinct terms in each, in order, give that subset's hash, and those of its non-empty subsets are the fingerprint. A text without a term in
the band is fingerprinted by all its terms, in a slot of its own. The likeness of two fingerprints is the share of subsets, of those
that either has, whose hashes agree.

Cases: a null text is empty; texts without words share one fingerprint; documents go by id, null first, then by text; repeated rows are documents of their own; a
single document is its own next one; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import json
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castellan.llm.common import let, words_of
from castellan.workspace import keep

SLOTS = 128
TABLE = 1 << 14
MARKS = ".,;:!?()\"'"


def terms_of(text: Column) -> Column:
    """Distinct lower-case words without punctuation."""
    return F.array_distinct(words_of(F.translate(F.lower(text), MARKS, " " * len(MARKS))))


def lexicon(docs: DataFrame, text: str = "text", *, lowest: float = 0.002, highest: float = 0.05, most_terms: int = 2_000_000) -> list[list[int]]:
    """A hash table of the XXH64 values of the terms in the band: those of value h are in row h mod TABLE."""
    n = docs.count()
    counts = docs.select(F.explode(terms_of(F.col(text))).alias("t")).groupBy(F.xxhash64("t").alias("h")).agg(F.count("*").alias("df"))
    band = counts.filter((F.col("df") >= lowest * n) & (F.col("df") <= max(highest * n, 1)))
    rows = keep(band.select("h"), "lexicon")
    if (size := rows.count()) > most_terms:
        raise ValueError(f"the band holds {size} terms, over most_terms; raise lowest")
    table: list[list[int]] = [[] for _ in range(TABLE)]
    for (h,) in rows.collect():
        table[h % TABLE].append(h)
    return [sorted(x) for x in table]


def fingerprint(terms: Column, table: list[list[int]]) -> Column:
    """Eight hexadecimal digits for each non-empty subset: its number and the hash of its sorted terms."""
    known = F.from_json(F.lit(json.dumps(table)), "array<array<bigint>>")  # folded into one constant
    hashed = F.transform(terms, lambda t: F.struct(F.xxhash64(t).alias("h"), t.alias("t")))
    inside = F.filter(hashed, lambda x: F.array_contains(F.get(known, F.pmod(x["h"], F.lit(TABLE)).cast("int")), x["h"]))
    placed = F.array_sort(F.transform(inside, lambda x: F.struct(F.pmod(F.shiftrightunsigned(x["h"], 40), F.lit(SLOTS)).cast("int").alias("slot"), x["t"].alias("t"))))
    code = lambda slot, h: F.concat(F.lpad(F.hex(slot), 2, "0"), F.lpad(F.hex(h.bitwiseAND(0xFFFFFF)), 6, "0"))

    def subsets(p: Column) -> Column:
        start = F.struct(F.lit(-1).alias("slot"), F.lit(0).cast("long").alias("h"), F.array().cast("array<string>").alias("out"))
        closed = lambda s: F.when(s["slot"] >= 0, F.concat(s["out"], F.array(code(s["slot"], s["h"])))).otherwise(s["out"])
        step = lambda s, x: F.struct(
            x["slot"].alias("slot"), F.xxhash64(F.when(s["slot"] == x["slot"], s["h"]).otherwise(F.lit(0).cast("long")), x["t"]).alias("h"), F.when(s["slot"] == x["slot"], s["out"]).otherwise(closed(s)).alias("out"))
        return F.aggregate(p, start, step, closed)

    whole = F.array(F.lower(code(F.lit(255), F.xxhash64(F.array_join(F.array_sort(terms), " ")))))
    return let(placed, lambda p: F.when(F.size(p) > 0, F.transform(subsets(p), F.lower)).otherwise(whole))


def likeness(a: Column, b: Column) -> Column:
    slots = lambda x: F.transform(x, lambda c: F.substr(c, F.lit(1), F.lit(2)))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(slots(a), slots(b)))


def in_order_buckets(docs: DataFrame, *, id: str, text: str, bucket_chars: int) -> DataFrame:
    """docs as id, t, and bucket (consecutive ids) with guard 0; and the first rows of each bucket once more, with guard 1, at the end
    of the bucket before it (of the first bucket: the last), so that a window over a bucket sees each row's successor.

    Bounds are quantiles of the ids, 100 of them and 100 within each, and equal steps within these."""
    d = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    chars = d.agg(F.sum(F.length("t"))).first()[0] or 0
    buckets = max(1, ceil(chars / bucket_chars))
    quantiles = min(10_000, buckets)
    inner = ceil(quantiles / 100)
    steps = ceil(buckets / quantiles)
    cuts = d.agg(F.percentile_approx("id", [i / quantiles for i in range(1, quantiles)] or [0.5], 100_000)).first()[0] or []
    cuts = sorted(set(cuts)) if quantiles > 1 else []
    groups = [cuts[i : i + inner] for i in range(0, len(cuts), inner)]
    if groups:
        outer = F.expr(f"size(filter(array({', '.join(f'{g[0]}L' for g in groups)}), x -> x <= id))")
        nested = F.from_json(F.lit(json.dumps([[]] + groups)), "array<array<bigint>>")
        q = F.when(outer == 0, 0).otherwise((outer - 1) * inner + F.size(F.filter(F.get(nested, outer), lambda x: x <= F.col("id"))))
        low = F.coalesce(F.get(F.lit(cuts).cast("array<bigint>"), q - 1), F.col("id"))
        high = F.coalesce(F.get(F.lit(cuts).cast("array<bigint>"), q), F.col("id") + 1)
        part = F.floor((F.col("id") - low) * steps / F.greatest(F.lit(1), high - low)) if steps > 1 else F.lit(0)
        d = d.withColumn("bucket", F.coalesce(q.cast("long") * steps + part, F.lit(0)))
    else:
        d = d.withColumn("bucket", F.lit(0).cast("long"))
    # null ids come first of all, so they lead the first bucket
    firsts = d.groupBy("bucket").agg(F.min("id").alias("first"), F.count_if(F.isnull("id")).alias("nulls"))
    order = Window.orderBy("bucket")
    firsts = firsts.withColumn("goes_to", F.lag("bucket").over(order)).withColumn("last", F.max("bucket").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = keep(firsts.select(F.when(F.col("nulls") == 0, F.col("first")).alias("first"), F.coalesce("goes_to", "last").alias("goes_to")), "firsts")
    d = d.join(firsts, d["id"].eqNullSafe(firsts["first"]), "left")
    places = F.when(F.isnull("goes_to"), F.array(F.struct("bucket", F.lit(0).alias("guard")))).otherwise(F.array(F.struct("bucket", F.lit(0).alias("guard")), F.struct(F.col("goes_to").alias("bucket"), F.lit(1).alias("guard"))))
    return d.withColumn("p", F.explode(places)).select("id", "t", "p.bucket", "p.guard")


def imatch_with_edits(docs: DataFrame, *, id: str = "doc_id", text: str = "text", bucket_chars: int = 8_000_000, **band) -> DataFrame:
    """id, n_chars, edited (the text whose last quarter gave way to the next document's start), fp, edited_fp, and whether the texts are
    equal: one row for each row of docs, with its likenesses."""
    table = lexicon(docs.select(F.col(text).alias("text")), **band)
    d = in_order_buckets(docs, id=id, text=text, bucket_chars=bucket_chars)
    by_id = Window.partitionBy("bucket").orderBy("guard", F.col("id").asc_nulls_first(), "t")
    n, cut = F.length("t"), F.floor(F.length("t") / 4)
    d = d.withColumn("after", F.lead("t").over(by_id))
    d = d.withColumn("edited", F.concat(F.substr("t", F.lit(1), (n - cut).cast("int")), F.substr(F.coalesce("after", F.lit("")), F.lit(1), cut.cast("int"))))
    d = d.select("id", "bucket", "guard", "t", n.alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), fingerprint(terms_of(F.col("t")), table).alias("fp"), fingerprint(terms_of(F.col("edited")), table).alias("edited_fp"))
    d = d.withColumn("next_fp", F.lead("fp").over(by_id)).filter("guard = 0")
    return d.select("id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", "fp", "edited_fp", likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
