"""Chat formatting in budgeted windows of whole turns.

A conversation is cut into spans of turns by the prefix sums of their token counts: a span takes turns as long as they fit the budget, less
what its window repeats. Every window after the first repeats the system turn, if the conversation opens with one, and the last turns
before its span up to ``history`` tokens. The loss mask covers the text of each assistant turn in the span and never a repeated turn, so
each assistant text is a target once.

The template marks a turn ``<|im_start|>role<|im_sep|>text<|im_end|>``. Control strings inside roles and texts (these marks, ``<s>``,
``</s>``, ``[INST]``, ``[/INST]`` and any ``<|name|>``) get a backslash behind their first character, one more if there are some
already; taking one away restores the text, whatever it is.

Cases: null roles and texts are empty; turns go by turn number, null first, then by role and text; repeated turns stay; a conversation whose
id is null is one conversation; a turn over the budget has a window without history to itself, marked over_budget; an empty table gives
no rows; further columns are not read. A conversation is the unit here and one row of the job, however long; the work on it grows in proportion to its turns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castellan.llm.common import let

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = r"(/?s>|/?INST\]|\|[a-z_]+\|>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2$3")


def quarter_of_bytes(text: Column) -> Column:
    """The usual estimate of a turn's tokens: four bytes each, and four for its marks."""
    return F.ceil(F.octet_length(text) / 4) + 4


def format_windows(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", budget: int = 2048, history: int = 512, target_role: str = "assistant", turn_tokens: Callable[[Column], Column] = quarter_of_bytes) -> DataFrame:
    """conv, window, formatted, loss (array of start and length in code points), repeated (how many of its turns come first as context),
    tokens, over_budget; one row for each window."""
    if not 0 <= history < budget:
        raise ValueError("history must leave room in the budget")
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    head = F.concat(F.lit(START), escape(r), F.lit(SEP))
    tokens = F.greatest(F.lit(1), turn_tokens(t)).cast("bigint")
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), r.alias("role"), t.alias("text"), head.alias("head"), escape(t).alias("body"), tokens.alias("tokens"))
    own = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.withColumns({"i": F.row_number().over(own) - 1, "pre": F.sum("tokens").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")})
    c = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("i", "pre", "tokens", "role", "head", "body"))).alias("t"))

    def windows(t: Column) -> Column:
        n, first = F.size(t), F.get(t, F.lit(0))
        lead = (first["role"] == "system").cast("int")
        room = budget - history - F.when(lead == 1, first["tokens"]).otherwise(0)  # beside the lead and what is repeated

        def before(i: Column) -> Column:
            return F.when(i < n, F.get(t, i)["pre"]).otherwise(F.element_at(t, -1)["pre"] + F.element_at(t, -1)["tokens"])

        def one(starts: Column) -> Column:
            def window(a: Column, k: Column) -> Column:
                b = F.coalesce(F.get(starts, k + 1), n)
                near = F.array_min(F.filter(F.sequence(F.greatest(lead, a - history), a), lambda i: before(a) - F.get(t, i)["pre"] <= history))  # a turn has a token at least, so no more can be repeated
                h = F.when((k == 0) | (before(b) - before(a) > room), a).otherwise(near)
                led = F.slice(t, 1, F.when((k > 0) & (lead == 1), 1).otherwise(0))
                return let(h, lambda h: F.struct(F.concat(led, F.slice(t, h + 1, b - h)).alias("part"), (F.when((k > 0) & (lead == 1), 1).otherwise(0) + a - h).alias("repeated")))

            return F.transform(starts, window)

        return let(span_starts(t, budget, F.greatest(F.lit(1).cast("bigint"), room.cast("bigint"))), one)

    w = c.select("conv", F.posexplode(let(F.col("t"), windows)).alias("window", "w")).select("conv", "window", "w.part", "w.repeated")
    loss = f"""aggregate(sequence(0, size(part) - 1), named_struct('at', 0, 'loss', cast(array() as array<struct<start:int,length:int>>)), (s, i) -> named_struct(
        'at', s.at + length(part[i].head) + length(part[i].body) + {len(END)},
        'loss', if(i >= repeated and part[i].role = '{target_role}', concat(s.loss, array(named_struct('start', s.at + length(part[i].head), 'length', length(part[i].body)))), s.loss)), s -> s.loss)"""
    formatted = f"array_join(transform(part, x -> concat(x.head, x.body, '{END}')), '')"
    return w.select("conv", "window", F.expr(formatted).alias("formatted"), F.expr(loss).alias("loss"), "repeated", F.expr("aggregate(part, 0L, (s, x) -> s + x.tokens)").alias("tokens")).withColumn("over_budget", F.col("tokens") > budget)


def span_starts(t: Column, budget: int, later: Column, block: int = 256) -> Column:
    """The turns at which spans begin: a turn that would take its span over the budget (later: over what is left in windows after the first) begins the next.

    A fold in blocks: what a fold appends to is copied, so a block appends to an array of its own and those are put one behind the other at the end."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(t) - 1) / block).cast("int"))
    none, zero = F.array().cast("array<int>"), F.lit(0).cast("bigint")

    def state(a, p, k, out) -> Column:
        return F.struct(a.alias("a"), p.alias("p"), k.alias("limit"), out.alias("out"))

    def step(s: Column, x: Column) -> Column:
        cut = (x["i"] > s["a"]) & (x["pre"] + x["tokens"] - s["p"] > s["limit"])
        return F.when(cut, state(x["i"], x["pre"], later, F.concat(s["out"], F.array(x["i"])))).otherwise(s)

    def whole(acc: Column, n: Column) -> Column:
        inner = F.aggregate(F.slice(t, n * block + 1, block), state(acc["a"], acc["p"], acc["limit"], none), step)
        return let(inner, lambda r: state(r["a"], r["p"], r["limit"], F.concat(acc["out"], F.array(r["out"]))))

    start = state(F.lit(0), zero, F.lit(budget).cast("bigint"), F.array(F.array(F.lit(0))))
    return F.flatten(F.aggregate(blocks, start, whole)["out"])


def read_back(windows: DataFrame) -> DataFrame:
    """conv, n_turns, turns (role, newline, text, newline for each), loss (the text under the masks), formatted_chars: all parsed from the
    windows alone, without the turns they repeat."""
    marked = F.expr(f"slice(split(formatted, '{END.replace('|', chr(92) * 2 + '|')}'), repeated + 1, size(split(formatted, '{END.replace('|', chr(92) * 2 + '|')}')) - 1 - repeated)")
    w = windows.withColumn("own", marked)
    role = lambda p: unescape(F.substr(F.substring_index(p, SEP, 1), F.lit(len(START) + 1)))
    text = lambda p: unescape(F.substring_index(p, SEP, -1))
    w = w.select(
        "conv", "window", F.size("own").alias("n"), F.length("formatted").alias("chars"), F.array_join(F.transform("own", lambda p: F.concat(role(p), F.lit("\n"), text(p), F.lit("\n"))), "").alias("turns"),
        let(F.col("formatted"), lambda f: F.array_join(F.transform("loss", lambda s: unescape(F.substr(f, s["start"] + 1, s["length"]))), "")).alias("loss"))
    parts = w.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("window", "n", "chars", "turns", "loss"))).alias("p"))
    return parts.select(
        "conv", F.expr("aggregate(p, 0L, (a, x) -> a + x.n)").alias("n_turns"), F.expr("array_join(transform(p, x -> x.turns), '')").alias("turns"),
        F.expr("array_join(transform(p, x -> x.loss), '')").alias("loss"), F.expr("aggregate(p, 0L, (a, x) -> a + x.chars)").alias("formatted_chars"), F.size("p").cast("long").alias("n_windows"))
