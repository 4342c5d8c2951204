"""Windows of long conversations: the work grows with the turns, and the spans are those of a plain loop."""

import random
import time

from pyspark.sql import functions as F

from castellan.llm import chat


def by_loop(sizes, lead, budget, history):
    """(first turn shown, first turn of the span, turn after it) of each window."""
    pre = [0]
    for s in sizes:
        pre.append(pre[-1] + s)
    lead_tokens = sizes[0] if lead else 0
    out, a = [], 0
    while a < len(sizes):
        b, most = a + 1, budget if not out else max(1, budget - history - lead_tokens)
        while b < len(sizes) and pre[b + 1] - pre[a] <= most:
            b += 1
        h = a
        if out and pre[b] - pre[a] <= budget - history - lead_tokens:
            while h > lead and pre[a] - pre[h - 1] <= history:
                h -= 1
        out.append((h, a, b))
        a = b
    return out


def test_spans_equal_a_loop(spark):
    rnd = random.Random(2)
    convs = {c: [rnd.choice([1, 3, 10, 40, 200]) for _ in range(rnd.choice([1, 2, 30, 300, 900]))] for c in range(12)}
    rows = [(c, i, "system" if c % 3 == 0 and i == 0 else "user" if i % 2 else "assistant", "x" * n) for c, sizes in convs.items() for i, n in enumerate(sizes)]
    w = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"), budget=120, history=30, turn_tokens=lambda t: F.length(t)).collect()
    for c, sizes in convs.items():
        lead = int(c % 3 == 0)
        got = sorted((r.window, r.formatted.count(chat.START), r.repeated) for r in w if r.conv == c)
        want = [(k, b - h + (lead if k else 0), a - h + (lead if k else 0)) for k, (h, a, b) in enumerate(by_loop(sizes, lead, 120, 30))]
        assert got == want, c


def test_time_grows_with_the_turns(spark):
    def took(n):
        turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("some four words "), F.col("id").cast("string")).alias("text"))
        began = time.time()
        (r,) = chat.read_back(chat.format_windows(turns)).collect()
        assert r.n_turns == n and r.loss == "".join(f"some four words {i}" for i in range(1, n, 2))
        return time.time() - began

    took(200)
    small, large = took(2_000), took(20_000)
    assert large < 20 * small + 2 and large < 60, (small, large)
