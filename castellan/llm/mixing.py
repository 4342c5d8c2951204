"""Mixing sources to target weights: exact block quotas dealt to output shards by a multivariate-hypergeometric splitting tree.

Each source is cut by hash into blocks of bounded size. Weights and sizes give each source a target of words, at most
``max_repeats`` times its size; whole passes over its blocks and one partial pass, in an order permuted anew for each pass,
make up the target to the word, the last document being cut. So each source has an exact quota of block draws. A tree over the
output shards splits the quotas: at each node, selection sampling over the node's draws, the sequential form of the multivariate
hypergeometric law, says how many draws of each source go left. A leaf then owns a disjoint run of each source's permuted draws,
and its documents are shuffled by hash within it.

Everything is hashed from ids and a seed: reruns agree. Cases: a null source is a source of its own, ranked last; a null or blank
text has size 0 and is taken 0 words; repeated rows count as rows of their own; an empty table gives no rows; further columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castellan.llm.common import BLANKS, numbered, words_of
from castellan.workspace import keep


@dataclass(frozen=True)
class Mix:
    """rows: id, source, size, source_size, target, taken, copies (whole passes), part (words of the partial pass), shards, place
    (order within the first shard). sources: one row each. shards: how many."""

    rows: DataFrame
    sources: DataFrame
    shards: int


def source_targets(sized: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """One row a source, g being its rank by code point, null last: target shares all words by weight under the cap.

    Sharing an excess again and again by weight ends at one level L with target = min(cap, L * weight), where the capped sources are
    those of the smallest cap to weight ratio; so one ordered pass over the sources finds it."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "g")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    s = s.withColumn("g", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("g") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * max_repeats).withColumn("total", F.sum("source_size").over(everything))
    s = s.withColumn("capped_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
    s = s.withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    s = s.withColumn("level_here", (F.col("total") - F.col("capped_before")) / F.col("weight_left"))
    s = s.withColumn("over", F.col("cap") > F.col("level_here") * F.col("weight"))
    s = s.withColumn("level", F.min_by("level_here", F.when(F.col("over"), F.struct(F.col("cap") / F.col("weight"), F.col("g")))).over(everything))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    return s.select("g", "source", "source_size", "source_rows", target.alias("target"))


def split_once(nodes: DataFrame, seed: int) -> DataFrame:
    """Both children of each node (lo, hi: its shards; quotas: draws by source). A node of one shard stays.

    The inner fold takes each draw of a source for the left with probability places left / draws left."""
    pick = f"""aggregate(
        sequence(0, size(quotas) - 1), named_struct('n', total, 'l', to_left, 'out', cast(array() as array<bigint>)),
        (s, g) -> aggregate(
            if(quotas[g] > 0, sequence(1L, quotas[g]), cast(array() as array<bigint>)), named_struct('n', s.n, 'l', s.l, 'c', 0L),
            (t, i) -> if(pmod(xxhash64({seed}L, lo, hi, g, i), t.n) < t.l,
                         named_struct('n', t.n - 1, 'l', t.l - 1, 'c', t.c + 1), named_struct('n', t.n - 1, 'l', t.l, 'c', t.c)),
            t -> named_struct('n', t.n, 'l', t.l, 'out', concat(s.out, array(t.c)))),
        s -> s.out)"""
    n = nodes.withColumn("total", F.expr("aggregate(quotas, 0L, (a, q) -> a + q)"))
    n = n.withColumn("mid", F.expr("lo + (hi - lo) div 2")).withColumn("to_left", F.expr("total * (mid - lo) div (hi - lo)"))
    n = n.withColumn("left", F.when(F.col("hi") - F.col("lo") > 1, F.expr(pick)))
    child = F.explode(
        F.expr("""if(left is null, array(named_struct('lo', lo, 'hi', hi, 'quotas', quotas)), array(
            named_struct('lo', lo, 'hi', mid, 'quotas', left),
            named_struct('lo', mid, 'hi', hi, 'quotas', zip_with(quotas, left, (q, l) -> q - l))))""")
    )
    return n.select(child.alias("c")).select("c.lo", "c.hi", "c.quotas")


def mix_sources(docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, block_words: int = 500_000, shard_words: int = 16_000_000, least_shards: int = 8, blocks_a_shard: int = 32, seed: int = 20240607) -> Mix:
    """Plan the mix; see the module. shard_words and least_shards set the number of shards, blocks_a_shard and block_words the size of blocks (words and
    rows together), so that the tree has draws to split at any size."""
    size = F.size(words_of(F.col(text))).cast("long")
    sized = keep(docs.select(F.col(id).alias("id"), F.col(source).alias("source"), size.alias("size"), F.xxhash64(F.lit(seed), F.col(id), F.col(text)).alias("h")), "sizes")

    total, rows_in = sized.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()  # all targets together are all words
    shards = max(least_shards, ceil(total / shard_words))
    block = max(1, min(block_words, (total + rows_in) // (blocks_a_shard * shards)))
    src = source_targets(sized, weights, max_repeats)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    src = src.withColumn("copies", whole).withColumn("rest", F.round("target").cast("long") - F.col("copies") * F.col("source_size"))
    src = src.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil((F.col("source_size") + F.col("source_rows")) / block)))
    src = keep(src, "sources")

    rows = sized.join(src, sized["source"].eqNullSafe(src["source"])).drop(src["source"]).withColumn("block", F.pmod("h", F.col("n_blocks")))

    # every block's draws: the whole passes, then the partial one as far as it goes
    blocks = rows.groupBy("g", "block").agg(F.sum("size").alias("words"), F.first("copies").alias("copies"), F.first("rest").alias("rest"))
    draws = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies"))))
    permuted = Window.partitionBy("g", "epoch").orderBy(F.xxhash64(F.lit(seed), F.lit("block"), "g", "block", "epoch"), "block")
    draws = draws.withColumn("before", F.coalesce(F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    draws = draws.withColumn("part", F.when(F.col("epoch") == F.col("copies"), F.least(F.col("words"), F.col("rest") - F.col("before"))))
    draws = draws.filter("part is null or part > 0")
    in_order = Window.partitionBy("g").orderBy("epoch", "before", F.xxhash64(F.lit(seed), F.lit("block"), "g", "block", "epoch"), "block")
    draws = keep(draws.select("g", "block", "epoch", "words", "part", (F.row_number().over(in_order) - 1).cast("long").alias("draw")), "draws")

    quotas = src.join(draws.groupBy("g").agg(F.count("*").alias("n")), "g", "left").select("g", F.coalesce("n", F.lit(0)).alias("n"))
    by_source = F.transform(F.array_sort(F.collect_list(F.struct("g", "n"))), lambda x: x["n"])
    nodes = quotas.agg(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), by_source.alias("quotas")).filter(F.size("quotas") > 0)
    for level in range(ceil(log2(shards))):
        nodes = split_once(nodes, seed)
        if level % 6 == 5:
            nodes = keep(nodes.repartition("lo"), "nodes")
    leaf = nodes.select(F.col("lo").alias("shard"), F.posexplode("quotas").alias("g", "n"))
    upto = Window.partitionBy("g").orderBy("shard")
    leaf = leaf.withColumn("to", F.sum("n").over(upto)).filter("n > 0")
    leaf = leaf.select("g", "shard", F.explode(F.expr("sequence(to - n, to - 1)")).alias("draw"))
    owned = draws.join(leaf, ["g", "draw"]).groupBy("g", "block").agg(
        F.array_sort(F.collect_list(F.struct("epoch", "shard"))).alias("owners"), F.count(F.when(F.isnull("part"), 1)).alias("passes"),
        F.max("part").alias("part"), F.max(F.when(F.col("part") < F.col("words"), F.col("part"))).alias("cut_at"),
    )
    owned = keep(owned, "owned")

    rows = rows.join(owned, ["g", "block"], "left").withColumn("local", F.xxhash64(F.lit(seed), F.lit("local"), "h"))
    # only a block that the quota cuts needs its documents in order; block_words bounds it
    cut = rows.filter("cut_at is not null")
    local = Window.partitionBy("g", "block").orderBy("local", "id", "size")
    cut = cut.withColumn("so_far", F.coalesce(F.sum("size").over(local.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    cut = cut.withColumn("part_words", F.greatest(F.lit(0), F.least(F.col("size"), F.col("cut_at") - F.col("so_far")))).drop("so_far")
    plain = rows.filter("cut_at is null").withColumn("part_words", F.when(F.col("part") > 0, F.col("size")).otherwise(0))
    rows = plain.unionByName(cut)
    passes = F.coalesce("passes", F.lit(0))
    rows = rows.select(
        "id", "source", "h", "size", "source_size", "target", (F.col("size") * passes + F.col("part_words")).cast("long").alias("taken"), passes.alias("copies"), F.col("part_words").cast("long").alias("part"),
        F.transform(F.coalesce("owners", F.array().cast("array<struct<epoch:bigint,shard:bigint>>")), lambda x: x["shard"]).alias("shards"), F.col("local").alias("place"),
    )
    return Mix(rows, src, shards)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    lead = F.length(text) - F.length(F.ltrim(text, F.lit(" \t\n\x0b\f\r")))
    body = F.substr(text, lead + 1)
    rest = F.element_at(F.split(body, BLANKS, (n + 1).cast("int")), -1)
    return F.rtrim(F.substr(text, F.lit(1), F.length(text) - F.length(rest)), F.lit(" \t\n\x0b\f\r"))


def mixed_documents(docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 20240607, **options) -> DataFrame:
    """The documents of the mix: a row for each pass over a document, the partial pass's last one cut to its words, in the columns of docs.

    Rows of one id and text are alike to the mix; each stays a row."""
    mix = mix_sources(docs, id=id, text=text, source=source, seed=seed, **options)
    same = Window.partitionBy("h").orderBy("taken", "part")
    plan = mix.rows.filter("taken > 0").select("h", "size", "taken", "copies", "part").withColumn("nth", F.row_number().over(same))
    d, names = numbered(docs)
    d = d.withColumn("h", F.xxhash64(F.lit(seed), F.col(names[id]), F.col(names[text])))
    d = d.withColumn("nth", F.row_number().over(Window.partitionBy("h").orderBy(F.xxhash64(*names.values()))))
    d = d.join(plan, ["h", "nth"])
    parts = F.concat(F.array_repeat(F.lit(None).cast("long"), F.col("copies").cast("int")), F.when(F.col("part") > 0, F.array("part")).otherwise(F.array().cast("array<bigint>")))
    d = d.withColumn("words", F.explode(parts))
    t = F.col(names[text])
    cut = F.when(F.col("words") < F.col("size"), first_words(t, F.col("words"))).otherwise(t)
    out = [(cut if c == text else F.length(cut).cast(docs.schema[c].dataType) if c == "n_chars" else F.col(names[c])).alias(c) for c in docs.columns]
    return d.select(*out)
