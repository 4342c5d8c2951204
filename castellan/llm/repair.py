"""Conversation structure repair: the cheapest edits that make the roles of a conversation ``(s?(ua)+)?``, by lazy weighted determinisation.

The grammar is a weighted automaton of four states (nothing yet, after the system turn, after a user, after an assistant); an edit of a row is an
arc. A vector of what it costs to be in each state, less its least entry, is one state of a deterministic automaton; its arcs are made when
first met and cached in a transition table, so a scan of the table gives the cost. Entries that can take no part in a cheapest repair (a later state
follows them at no more cost) are dropped, which leaves a few dozen vectors. A trace from the end marks the arcs that are tight, that is, lie on a cheapest
path; the least of them by ASCII at each row, from the front, is the audit.

A row's first fault counts: blank, duplicate (role and text seen earlier in the conversation), truncated (its last non-blank character ends no
sentence). Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (forced for blank and duplicate rows), Insert an empty user or assistant turn 5;
a truncated row that stays adds 5.

At scale: rows are ordered by range, without their texts, and cut in runs of 4,096, so a conversation of any length is dealt over many tasks. A run is scanned
from each of the four states, the runs' costs are joined by conversation (16 numbers a run), and each run then traces its own arcs from each state
that may enter it. Texts are shuffled once, by conversation, and read as a stream, since the repaired text is one sequence.

Cases: null roles and texts are one space, so such a text is blank and such a role is never kept; no role but one starting with s, u or a is kept, an empty one neither; turns go by number,
null first, then by role and by a hash of role and text; repeated rows are duplicates; a conversation whose id is null is one conversation; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castellan.llm.ordered import RUN, in_order
from castellan.workspace import keep

FAR = 1 << 30
START, FINAL = (0, FAR, FAR, FAR), (0, 10, 5, 0)
#: By the class of a row's role (s, u, a, other): the state that a kept row leads to.
KEEP = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
#: The state after the next user or assistant turn.
NEXT = (2, 2, 3, 2)
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: Added at the end of a conversation that stops in a state.
TAIL = ("", "II", "I", "")


class Determinised:
    """States by number: normalised cost vectors. Symbols are letters: 'A' + 3 * class of the role + (0 sound, 1 truncated, 2 to delete)."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.table: list[dict[str, tuple[int, int]]] = []
        self.traced: dict[tuple[int, str, int], tuple[int, tuple]] = {}

    def state(self, costs) -> tuple[int, int]:
        least = min(costs)
        v = tuple(c - least if c < FAR else FAR for c in costs)
        if v not in self.number:
            self.number[v] = len(self.vectors)
            self.vectors.append(v)
            self.table.append({})
        return self.number[v], least

    @staticmethod
    def inserted(v) -> list[int]:
        """Costs once up to two turns were inserted."""
        w = list(v)
        for _ in range(2):
            for p, q in enumerate(NEXT):
                w[q] = min(w[q], w[p] + INSERT)
        return w

    @staticmethod
    def edits(p: int, symbol: str) -> list[tuple[str, int, int]]:
        """(initial, state after, cost) of what may be done with a row in state p."""
        role, fault = divmod(ord(symbol) - 65, 3)
        out = [("D", p, DELETE)]
        if fault < 2:
            if p in KEEP[role]:
                out.append(("K", KEEP[role][p], TRUNCATED * fault))
            out.append(("R", NEXT[p], REROLE + TRUNCATED * fault))
        return out

    def arc(self, s: int, symbol: str) -> tuple[int, int]:
        """The state after a symbol, and what is added to the cost."""
        if symbol not in self.table[s]:
            w, after = self.inserted(self.vectors[s]), [FAR] * 4
            for p in range(4):
                for _, q, cost in self.edits(p, symbol):
                    after[q] = min(after[q], w[p] + cost, FAR)
            # from "after an assistant" all goes on as from the start but for a system turn, whose deletion costs 2
            after[0] = FAR if after[0] > after[3] + DELETE else after[0]
            after[1] = FAR if after[1] > after[3] else after[1]
            self.table[s][symbol] = self.state(after)
        return self.table[s][symbol]

    def scan(self, costs, symbols: str) -> tuple[list[int], int]:
        """The states along the symbols, and the cost taken out of the vectors."""
        s, total = self.state(costs)
        path, table = [s], self.table
        for c in symbols:
            s, more = table[s].get(c) or self.arc(s, c)
            total += more
            path.append(s)
        return path, total

    def costs_from_each(self, symbols: str) -> list[list[int]]:
        """What the symbols cost from each state to each state."""
        out = []
        for p in range(4):
            path, total = self.scan([0 if q == p else FAR for q in range(4)], symbols)
            out.append([min(FAR, c + total) for c in self.vectors[path[-1]]])
        return out

    def tight(self, s: int, symbol: str, live: int) -> tuple[int, tuple]:
        """Of the states before a symbol, those on a cheapest path through the live ones after it (bits), and for each its edits and the state after."""
        if (s, symbol, live) not in self.traced:
            v, w = self.vectors[s], self.inserted(self.vectors[s])
            t, off = self.arc(s, symbol)
            after = self.vectors[t]

            def least(p: int) -> tuple[str, int] | None:
                if w[p] >= FAR:
                    return None
                at = {e: q for e, q, cost in self.edits(p, symbol) if live >> q & 1 and w[p] + cost - off == after[q]}
                if "D" not in at and w[p] + INSERT == w[NEXT[p]] and (more := least(NEXT[p])):
                    return "I" + more[0], more[1]
                return next(((e, at[e]) for e in "DKR" if e in at), None)

            found = tuple(least(p) for p in range(4))
            self.traced[s, symbol, live] = sum(1 << p for p in range(4) if found[p] and v[p] == w[p] < FAR), found
        return self.traced[s, symbol, live]

    def trace(self, costs, rest, symbols: str) -> tuple[int, list[str | None], list[int | None]]:
        """The cost of the whole, given costs before and after the symbols; for each state that enters them on a cheapest path, its edits and the state it leaves in."""
        path, total = self.scan(costs, symbols)
        ends = [min(FAR, a + b) for a, b in zip(self.vectors[path[-1]], rest)]
        best = min(ends)
        live, steps = sum(1 << q for q in range(4) if ends[q] == best), []
        for s, c in zip(path[-2::-1], reversed(symbols)):
            live, found = self.tight(s, c, live)
            steps.append(found)
        pieces, exits = [None] * 4, [None] * 4
        for p in range(4):
            if live >> p & 1:
                q, out = p, []
                for found in reversed(steps):
                    e, q = found[q]
                    out.append(e)
                pieces[p], exits[p] = "".join(out), q
        return total + best, pieces, exits


def _groups(batches: Iterator[pa.RecordBatch], key: str = "conv") -> Iterator[tuple[object, Iterator[dict]]]:
    """Rows of sorted batches by runs of one key, as a stream."""
    rows = (r for b in batches for r in b.to_pylist())
    return itertools.groupby(rows, key=lambda r: r[key])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the runs of each conversation, in order: the costs of its states before the run, and of what follows it."""
    start = next(batches, None)
    if start is None:
        return
    kind, costs = start.schema.field("conv").type, pa.list_(pa.int64())
    for conv, rows in _groups(itertools.chain([start], batches)):
        at, runs = [], []
        for r in rows:
            at.append(r["run"])
            runs.append([r["m"][4 * p : 4 * p + 4] for p in range(4)])
        before, after = [list(START)], [list(FINAL)]
        for m in runs[:-1]:
            before.append([min(FAR, *(before[-1][p] + m[p][q] for p in range(4))) for q in range(4)])
        for m in reversed(runs[1:]):
            after.append([min(FAR, *(m[p][q] + after[-1][q] for q in range(4))) for p in range(4)])
        yield pa.RecordBatch.from_arrays([pa.array([conv] * len(at), kind), pa.array(at, pa.int64()), pa.array(before, costs), pa.array(after[::-1], costs)], ["conv", "run", "before", "after"])


def repair_conversations(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", rows: bool = False) -> DataFrame:
    """One row a conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 (of ``role:text`` joined by newlines).

    With rows, the repaired conversations themselves and what was done: conv, nth (long, from 0, in the order of the audit), edit (its initial), role, text; a deleted row shows what it was."""
    blanks = " \t\n\v\f\r"
    r, t = F.coalesce(F.col(role), F.lit(" ")), F.coalesce(F.col(text), F.lit(" "))
    plain = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), r.alias("role"), t.alias("text"))
    plain = plain.withColumn("h", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    shown = F.rtrim("text", F.lit(blanks))
    kind = F.coalesce(F.array_position(F.lit(["s", "u", "a"]), F.left("role", F.lit(1))).cast("int"), F.lit(0))
    narrow = plain.select(
        "conv", "turn", "role", "h", F.when(kind == 0, 3).otherwise(kind - 1).alias("kind"), (shown == "").alias("blank"), (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("open"))
    placed = in_order(narrow, ["conv", "turn", "role", "h"], "rows-in-order").withColumn("run", F.shiftright("pos", RUN))
    firsts = placed.groupBy("conv", "h").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    told = placed.join(firsts, "pos", "left")
    fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("open"), "t")
    told = told.withColumn("fault", fault).withColumn("symbol", F.char(65 + 3 * F.col("kind") + F.when(F.col("fault").isin("b", "d"), 2).when(F.col("fault") == "t", 1).otherwise(0)))
    count = lambda k: F.count_if(F.col("fault") == k)
    runs = told.groupBy("conv", "run").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "symbol"))), lambda x: x["symbol"]), "").alias("symbols"), count("b").alias("blank"), count("d").alias("duplicate"),
        count("t").alias("truncated"), F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).cast("bigint").alias("turns"))
    runs = keep(runs, "runs")
    kind_of = runs.schema["conv"].dataType.simpleString()

    def costed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = Determinised()
        for b in batches:
            m = [[c for row in auto.costs_from_each(s) for c in row] for s in b.column("symbols").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("run"), pa.array(m, pa.list_(pa.int64()))], ["conv", "run", "m"])

    several = runs.groupBy("conv").count().filter("count > 1").select(F.col("conv").alias("many"))
    cut = runs.join(several, F.col("conv").eqNullSafe(F.col("many")), "left_semi").select("conv", "run", "symbols")
    cut = cut.mapInArrow(costed, f"conv {kind_of}, run bigint, m array<bigint>")
    entries = cut.repartition("conv").sortWithinPartitions("conv", "run").mapInArrow(_entries, f"conv {kind_of}, run bigint, before array<bigint>, after array<bigint>")
    entries = entries.select(F.col("conv").alias("c2"), F.col("run").alias("r2"), "before", "after")
    met = runs.join(entries, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("run") == F.col("r2")), "left").drop("c2", "r2")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = Determinised()
        for b in batches:
            out = [auto.trace(f or START, a or FINAL, s) for s, f, a in zip(*(b.column(n).to_pylist() for n in ("symbols", "before", "after")))]
            columns = [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.list_(pa.string())), pa.array([o[2] for o in out], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in kept), *columns], [*kept, "cost", "pieces", "exits"])

    kept = ["conv", "run", "symbols", "blank", "duplicate", "truncated", "low", "high", "turns"]
    found = met.mapInArrow(traced, f"conv {kind_of}, run bigint, symbols string, blank bigint, duplicate bigint, truncated bigint, low bigint, high bigint, turns bigint, cost bigint, pieces array<string>, exits array<bigint>")
    both = found.unionByName(plain.select("conv", "turn", "role", "h", "text"), allowMissingColumns=True)
    both = both.repartition("conv").sortWithinPartitions("conv", F.col("run").asc_nulls_last(), "turn", "role", "h").drop("h")

    schema = f"conv {kind_of}, nth bigint, edit string, role string, text string" if rows else f"conv {kind_of}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field("conv").type, *(_ROW if rows else _SUMMARY)]
        names, out, size = [c.split()[0] for c in schema.split(", ")], [], 0
        for conv, group in _groups(itertools.chain([first], batches)):
            for x in _repaired(conv, group, rows):
                out.append(x)
                size += sum(len(v) for v in x if isinstance(v, str))
                if len(out) == 1000 or size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return both.mapInArrow(finished, schema)


_ROW, _SUMMARY = [pa.int64(), pa.string(), pa.string(), pa.string()], [pa.int64()] * 6 + [pa.string()] * 2


def _repaired(conv, group: Iterator[dict], wanted: bool) -> Iterator[tuple]:
    """Reads a conversation's runs, which come first, and then its rows; yields the rows as edited if wanted, or else the summary."""
    audit, sums, illegal, turns, low, high, cost = [], [0, 0, 0], 0, 0, None, None, None
    state, last = 0, None
    row = None
    for row in group:
        if row["run"] is None:
            break
        cost = row["cost"] if cost is None else cost
        audit.append(row["pieces"][state])
        state = row["exits"][state]
        sums = [a + row[k] for a, k in zip(sums, ("blank", "duplicate", "truncated"))]
        kinds = [(ord(c) - 65) // 3 for c in row["symbols"]]
        illegal += sum(pair not in ((0, 1), (1, 2), (2, 1)) for pair in itertools.pairwise(kinds if last is None else [last, *kinds]))
        last = kinds[-1]
        if row["low"] is not None:
            turns += row["turns"] - (row["low"] == high)  # a turn number may go on from one run to the next
            low, high = row["low"] if low is None else low, row["high"]
    edits = "".join([*audit, TAIL[state]])
    digest, at, lines, left = hashlib.sha256(), 0, 0, itertools.chain([row], group)
    for nth, e in enumerate(edits):
        role, text = "", ""
        if e != "I":
            r = next(left)
            role, text = r["role"], r["text"]
        if e in "IR":
            role, at = "assistant" if at == 2 else "user", NEXT[at]
        elif e == "K":
            at = KEEP["sua".index(role[0])][at]
        if e != "D":
            digest.update((("\n" if lines else "") + role + ":" + text).encode())
            lines += 1
        if wanted:
            yield conv, nth, e, role, text
    if not wanted:
        yield conv, high - low + 1 - turns if turns else 0, *sums, illegal, cost, edits, digest.hexdigest()


def damage(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The same four columns, damaged by the CRC-32 of ``conv:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes it a
    user's. Null counts as one space, in the key as in role and text; a null turn or conversation stays null."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    d = turns.withColumn("_d", F.crc32(F.encode(F.concat_ws(":", *shown), "UTF-8")) % 20).filter("_d <> 0")
    r, t = F.coalesce(F.col(role), F.lit(" ")), F.coalesce(F.col(text), F.lit(" "))
    return d.select(
        F.col(conv), F.col(turn), F.when(F.col("_d") == 4, "user").otherwise(r).alias(role), F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace(t, "[.!?]", "")).otherwise(t).alias(text),
        F.explode(F.when(F.col("_d") == 3, F.lit([0, 1])).otherwise(F.lit([0]))).alias("_copy")).drop("_copy")
