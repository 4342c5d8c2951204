"""Clusters of records that describe one tournament."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castellan.functions.text import name_key, token_jaccard
from castellan.workspace import drop_kept, keep


def sequence_ratio(a: Column, b: Column) -> Column:
    """The matcher's ratio; it depends on the order of its arguments, so the earlier record goes first."""

    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(left, right)])

    return F.pandas_udf(run, "double")(a, b)


def similarity(a: Column, b: Column) -> Column:
    """0.65 of the sequence ratio and 0.35 of the word overlap of two name keys; 0 if either is empty."""
    return F.when((a == "") | (b == ""), 0.0).otherwise(0.65 * sequence_ratio(a, b) + 0.35 * token_jaccard(a, b))


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node reachable from each node of edges (a, b), by alternating stars with a checkpoint a round."""
    pairs = keep(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        out = pairs.select("a", "b").union(pairs.select("b", "a"))
        least = out.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = out.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m")).filter("a <> b").distinct()
        after = keep(small, "edges")
        drop_kept(pairs)
        pairs = after
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(pairs.select("b", "b")).distinct()
        seen = state


#: Records of a block that meet in one cell, ids of a key that are multiplied out at a time, and pairs of a task.
SLICE, PIECE, PAIRS_A_TASK = 1024, 32, 1 << 23


def scored_pairs(records: DataFrame, block: list[str], idx: str, key: str, score: Callable[[Column, Column], Column], name: str) -> DataFrame:
    """a, b and a score: all pairs a < b of the records of a block, scored by a symmetric function of their keys.

    Two keys are scored once and the score goes to all pairs of their ids. A block is dealt into slices and every two slices, or one with
    itself, meet in a cell of their own, so neither a frequent key nor a large block lies in one task. Both sides cut the ids of a key into
    the same pieces, as they are sorted."""
    per_block = records.groupBy(*block).agg(F.count("*").alias("n"))
    pairs = per_block.agg(F.sum(F.col("n").cast("double") * F.col("n") / 2)).first()[0] or 0
    tasks = max(records.sparkSession.sparkContext.defaultParallelism, int(pairs / PAIRS_A_TASK))
    sliced = records.join(per_block.select(*block, F.ceil(F.col("n") / SLICE).alias("slices")), block).withColumn("slice", F.pmod(F.xxhash64(idx), "slices"))
    groups = sliced.groupBy(*block, "slices", "slice", F.col(key).alias("key")).agg(F.sort_array(F.collect_list(idx)).alias("all"))
    pieces = groups.select(*block, "slices", "slice", "key", F.posexplode(F.expr(f"transform(sequence(0, (size(all) - 1) div {PIECE}), i -> slice(all, i * {PIECE} + 1, {PIECE}))")).alias("piece", "ids"))
    held = pieces.withColumn("piece", F.struct("slice", "key", "piece"))
    cell = [*block, "low", "high"]
    x = held.withColumn("high", F.explode(F.expr("sequence(slice, slices - 1)"))).select(*block, F.col("slice").alias("low"), "high", F.col("piece").alias("x"), F.col("ids").alias("xs"))
    y = held.withColumn("low", F.explode(F.expr("sequence(0L, slice)"))).select(*block, "low", F.col("slice").alias("high"), F.col("piece").alias("y"), F.col("ids").alias("ys"))
    met = x.repartition(tasks, *cell).join(y.repartition(tasks, *cell), cell).filter("x <= y")
    scored = met.select("xs", "ys", (F.col("x") == F.col("y")).alias("same"), score(F.col("x.key"), F.col("y.key")).alias(name))
    each = scored.select("ys", "same", name, F.explode("xs").alias("x")).select("same", name, "x", F.explode("ys").alias("y")).filter("if(same, x < y, x <> y)")
    return each.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), name)


def linked_facts(facts: DataFrame, most_in_block: int | None = 400) -> DataFrame:
    """a, b: records that are one tournament.

    facts: idx, event_ref, year, month, key, roster (array). Records of one event reference are linked to the first of them, whatever their year or
    name; one with a reference is never linked to one without or of another. The others are compared within a year and first key word:
    months at most one apart, and a similarity of 0.94, or of 0.62 with half of the smaller roster shared. Blocks of over most_in_block
    records are not compared, as a rule of the operation; None compares them all. Only pairs whose bounds can reach what they need
    are matched letter by letter."""
    ref = F.coalesce(F.col("event_ref"), F.lit(""))
    sure = facts.filter(ref != "")
    stars = sure.join(sure.groupBy("event_ref").agg(F.min("idx").alias("a")), "event_ref").filter("a <> idx").select("a", F.col("idx").alias("b"))
    f = facts.withColumn("block", F.split_part("key", F.lit(" "), F.lit(1)))
    if most_in_block is not None:
        sizes = f.groupBy("year", "block").agg(F.count("*").alias("n")).filter(F.col("n") <= most_in_block).drop("n")
        f = f.join(sizes, ["year", "block"], "left_semi")
    f = f.filter(ref == "")
    x, y = f.alias("x"), f.alias("y")
    j = x.join(y, (F.col("x.year") == F.col("y.year")) & (F.col("x.block") == F.col("y.block")) & (F.col("x.idx") < F.col("y.idx")))
    known = lambda s: F.coalesce(F.col(f"{s}.month"), F.lit(0))
    j = j.filter((known("x") == 0) | (known("y") == 0) | (F.abs(known("x") - known("y")) <= 1))
    shared = F.coalesce(F.size(F.array_intersect("x.roster", "y.roster")) / F.nullif(F.least(F.size("x.roster"), F.size("y.roster")), F.lit(0)), F.lit(0.0))
    j = j.select(F.col("x.idx").alias("a"), F.col("y.idx").alias("b"), F.when(shared >= 0.5, 0.62).otherwise(0.94).alias("needed"), F.col("x.key").alias("k"), F.col("y.key").alias("l"))
    # the matcher's ratio is at most twice the shorter length over both; pairs that cannot reach what they need go first
    bound = 0.65 * 2 * F.least(F.length("k"), F.length("l")) / F.nullif(F.length("k") + F.length("l"), F.lit(0)) + 0.35 * token_jaccard(F.col("k"), F.col("l"))
    j = j.filter(bound >= F.col("needed") - 1e-9)
    return j.withColumn("s", similarity(F.col("k"), F.col("l"))).filter("s >= needed").select("a", "b").unionByName(stars)


def _rare_first(rows: DataFrame, by: list[str], of: list[str], items: str) -> DataFrame:
    """of, by and items sorted by how many rows of the same `by` have each, the rarest first."""
    each = rows.select(*of, *by, F.explode(items).alias("_item"))
    counts = each.groupBy(*by, "_item").agg(F.count("*").alias("_n"))
    listed = F.array_sort(F.collect_list(F.struct("_n", "_item")))
    return each.join(counts, [*by, "_item"]).groupBy(*of, *by).agg(F.transform(listed, lambda x: x["_item"]).alias(items))


def _met_by_words(names: DataFrame, least: float) -> DataFrame:
    """names (year, block, key, words, the rarest first) with n (how many), fewer, more and word: two names of which least of all their words are common have a row of equal fewer, more and word,
    the one of fewer words with n = fewer, the other with n = more.

    The numbers of words of both tell how many must be common. All of both: the words as a whole meet. All of the one of fewer, and the other has one more: these and the other without
    one of its words. Else one of so many rarest words that fewer common ones are left behind them."""
    n, other = F.col("n"), F.col("other")
    f = names.withColumn("n", F.size("words")).withColumn("other", F.explode(F.sequence(F.ceil(n * least - 1e-9).cast("int"), F.floor(n / least + 1e-9).cast("int"))))
    f = f.withColumns({"fewer": F.least(n, other), "more": F.greatest(n, other), "common": F.ceil((n + other) * (least / (1 + least)) - 1e-9).cast("int")}).filter("common <= fewer")
    whole = lambda w: F.array_join(F.array_sort(w), " ")
    without_one = F.transform(F.sequence(F.lit(1), n), lambda i: whole(F.filter("words", lambda w: w != F.element_at("words", i))))
    some = F.when((F.col("common") == F.col("fewer")) & (F.col("more") - F.col("fewer") <= 1), F.when(n == F.col("fewer"), F.array(whole(F.col("words")))).otherwise(without_one))
    return f.select("year", "block", "key", "n", "fewer", "more", F.explode(F.coalesce(some, F.slice("words", F.lit(1), n - F.col("common") + 1))).alias("word"))


def linked_in_large_blocks(facts: DataFrame) -> DataFrame:
    """a, b: links whose components are those of linked_facts(facts, None), for blocks of any size, without a block's pairs.

    Records of one year, month and name are one unit, tied to its first; one of several units of a name is enough to link them to another name. A similarity of 0.94 needs 0.829 of
    the words of both to be shared: up to ten words those of one name are all among the other's, which has one more at most, beyond that both have one of their rarest few words in common (a prefix
    filter: two sets that share a part of their items share one of the first so many of them in any order). A similarity of 0.62 counts with half of the smaller roster shared, so the rosters, by units of equal roster, have one of the smaller one's rarer
    half in common. Only such candidates are matched, each pair of names once. The matcher depends on the order of its arguments, the earlier record's name first: a unit's
    first and last record tell whether a pair in either order is among theirs."""
    ref = F.coalesce(F.col("event_ref"), F.lit(""))
    sure = facts.filter(ref != "")
    referred = sure.join(sure.groupBy("event_ref").agg(F.min("idx").alias("a")), "event_ref").filter("a <> idx").select("a", F.col("idx").alias("b"))
    f = facts.filter((ref == "") & (F.col("key") != "")).select("idx", "year", F.coalesce("month", F.lit(0)).alias("month"), "key", F.array_sort(F.array_distinct(F.coalesce("roster", F.array().cast("array<string>")))).alias("roster"))
    f = f.withColumn("block", F.split_part("key", F.lit(" "), F.lit(1)))
    span = [F.min("idx").alias("low"), F.max("idx").alias("high")]
    units = keep(f.groupBy("year", "block", "month", "key").agg(*span), "units")
    stars = f.join(units, ["year", "block", "month", "key"]).filter("idx <> low").select(F.col("low").alias("a"), F.col("idx").alias("b"))

    def side(df: DataFrame, s: str) -> DataFrame:
        return df.toDF(*[f"{s}_{c}" for c in df.columns])

    near = "(x_month = 0 or y_month = 0 or abs(x_month - y_month) <= 1)"
    link = [F.least("x_low", "y_low").alias("a"), F.greatest("x_low", "y_low").alias("b")]
    same_name = side(units, "x").join(side(units, "y"), F.expr(f"x_year = y_year and x_key = y_key and x_month < y_month and {near}")).select(*link)

    def matched(pairs: DataFrame, least: float) -> DataFrame:
        """x_key, y_key (x_key the lesser), xy and yx: pairs of names one of whose similarities reaches least."""
        p = pairs.select(F.least("x_key", "y_key").alias("x_key"), F.greatest("x_key", "y_key").alias("y_key")).distinct()
        bound = 0.65 * 2 * F.least(F.length("x_key"), F.length("y_key")) / (F.length("x_key") + F.length("y_key")) + 0.35 * token_jaccard(F.col("x_key"), F.col("y_key"))
        p = p.filter(bound >= least - 1e-9)
        return p.withColumns({"xy": similarity(F.col("x_key"), F.col("y_key")), "yx": similarity(F.col("y_key"), F.col("x_key"))}).filter((F.col("xy") >= least) | (F.col("yx") >= least))

    names = units.select("year", "block", "key").distinct().withColumn("words", F.array_distinct(F.split("key", " ")))
    words = _met_by_words(_rare_first(names, ["year", "block"], ["key"], "words"), 0.29 / 0.35)
    met = side(words.filter("n = fewer"), "x").join(side(words.filter("n = more"), "y"), F.expr("x_year = y_year and x_block = y_block and x_fewer = y_fewer and x_more = y_more and x_word = y_word and (x_fewer < x_more or x_key < y_key)"))
    alike = keep(matched(met, 0.94), "alike-names")
    in_order = lambda least: F.expr(f"(x_low < y_high and xy >= {least}) or (y_low < x_high and yx >= {least})")
    names_linked = side(units, "x").join(alike, "x_key").join(side(units, "y"), ["y_key"]).filter(F.expr(f"x_year = y_year and {near}") & in_order(0.94)).select(*link)

    teams = f.filter(F.size("roster") > 0).groupBy("year", "block", "month", "key", "roster").agg(*span)
    rare = _rare_first(teams, ["year", "block"], ["month", "key", "low", "high"], "roster").withColumn("n", F.size("roster"))
    rare = keep(rare, "rosters")
    some = rare.withColumn("player", F.explode(F.slice("roster", 1, (F.floor(F.col("n") / 2) + 1).cast("int"))))
    every = rare.withColumn("player", F.explode("roster"))
    met = side(some, "x").join(side(every, "y"), F.expr(f"x_year = y_year and x_block = y_block and x_player = y_player and x_n <= y_n and x_key <> y_key and {near}"))
    met = met.filter(2 * F.size(F.array_intersect("x_roster", "y_roster")) >= F.col("x_n")).drop("x_roster", "y_roster", "x_player", "y_player")
    met = keep(met.distinct(), "roster-pairs")
    similar = matched(met, 0.62).toDF("k", "l", "kl", "lk")
    flipped = F.col("x_key") > F.col("y_key")
    both = met.join(similar, (F.least("x_key", "y_key") == F.col("k")) & (F.greatest("x_key", "y_key") == F.col("l")))
    both = both.withColumns({"xy": F.when(flipped, F.col("lk")).otherwise(F.col("kl")), "yx": F.when(flipped, F.col("kl")).otherwise(F.col("lk"))})
    teams_linked = both.filter(in_order(0.62)).select(*link)
    return referred.unionByName(stars).unionByName(same_name).unionByName(names_linked).unionByName(teams_linked).distinct()


#: Which source of a tournament is trusted first.
SOURCE_PRIORITY = {"chess-results": 100, "twic": 90, "edo": 80, "nwchess-minev": 70, "olimpbase": 60}


def trust(source: Column) -> Column:
    out = F.lit(0)
    for name, rank in SOURCE_PRIORITY.items():
        out = F.when(source == name, rank).otherwise(out)
    return out


def clusters(facts: DataFrame, links: DataFrame) -> DataFrame:
    """idx, cluster (the least idx of its records), cluster_id (cluster-000001 for the largest, then by year and name) of every record.

    facts: idx, year, name."""
    member = components(links)
    of = facts.select("idx", "year", "name").join(member, facts["idx"] == member["node"], "left").withColumn("cluster", F.coalesce("root", "idx"))
    heads = of.groupBy("cluster").agg(F.count("*").alias("size"), F.min_by("year", "idx").alias("year"), F.min_by("name", "idx").alias("name"))
    heads = heads.withColumn("cluster_id", F.format_string("cluster-%06d", F.row_number().over(Window.orderBy(F.desc("size"), "year", "name", "cluster"))))
    return of.select("idx", "cluster").join(heads.select("cluster", "cluster_id", "size"), "cluster").select("idx", "cluster", "cluster_id", "size")


def best_facts(facts: DataFrame, member: DataFrame) -> DataFrame:
    """cluster and idx of its best record: by source, then participants, those with a federation's id, and those rated; the first of equals."""
    has_id = F.size(F.filter("participants", lambda p: (F.coalesce(p["fide_id"], F.lit("")) != "") | F.coalesce(p["ref"], F.lit("")).startswith("player:fide:")))
    rated = F.size(F.filter("participants", lambda p: p["rating"].isNotNull()))
    rank = F.struct(trust(F.col("source")).alias("t"), F.size("participants").alias("n"), has_id.alias("i"), rated.alias("r"), (-F.col("idx")).alias("o"))
    return facts.join(member.select("idx", "cluster"), "idx").groupBy("cluster").agg(F.max_by("idx", rank).alias("idx"))


def merged_players(facts: DataFrame, member: DataFrame) -> DataFrame:
    """cluster and players of each cluster: one for each reference (or name and federation), every field from the most trusted record that has it,
    by rank (none last), then name."""
    fields = ("ref", "name", "fed", "title", "fide_id", "rating", "score", "rank")
    p = facts.join(member.select("idx", "cluster"), "idx").select("cluster", "idx", trust(F.col("source")).alias("t"), F.posexplode("participants").alias("pos", "p"))
    key = F.coalesce(F.nullif(F.col("p.ref"), F.lit("")), F.concat_ws("|", name_key(F.col("p.name")), F.coalesce("p.fed", F.lit(""))))
    order = F.struct(-F.col("t"), "idx", "pos")
    first = [F.min_by(f"p.{f}", F.when(F.coalesce(F.col(f"p.{f}").cast("string"), F.lit("")) != "", order)).alias(f) for f in fields]
    one = p.withColumn("key", key).groupBy("cluster", "key").agg(*first)
    listed = F.array_sort(F.collect_list(F.struct(F.col("rank").isNull().alias("none"), F.coalesce(F.nullif("rank", F.lit(0)), F.lit(9999)).alias("at"), F.col("name").alias("by"), "key", F.struct(*fields).alias("player"))))
    return one.groupBy("cluster").agg(F.transform(listed, lambda x: x["player"]).alias("players"))
