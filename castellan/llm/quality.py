"""Quality rules: plain limits first, then robust multivariate outliers by language and source.

Each text gives a vector of transformed statistics. For each language and source, each language, and all documents a
minimum-covariance-determinant estimate is fitted to the vectors that pass the plain limits, in the deterministic form of Hubert, Rousseeuw and
Verdonck (2012): starts from medians with MAD scales and from the covariance of tanh scores, then concentration steps until no determinant
changes; the start of the smaller determinant wins. A group's estimate is then drawn towards its language's, and that towards all documents', by
the weight ``prior`` against its degrees of freedom: it holds at every size, and a handful of rows never defines what is normal. A
document goes if its squared Mahalanobis distance is over ``cutoff``, by default the 0.9999 quantile of the chi-square distribution that
squared distances in a normal cloud follow.

A floor under each statistic's deviation keeps the matrices regular where most of a group is alike. For the fit, statistics are rounded to a quarter of
their floors and equal vectors counted; so the documents are read once, and the steps work on a table whose size the resolution bounds. Sums are exact,
so the estimates do not depend on the order of rows. Half of a group is found by a histogram of distances (steps of 1.6 %).

Cases: a null or blank text has no words and fails the limits; null languages and sources are groups of their own; repeated rows count as
rows; an empty table gives no rows; further columns stay untouched and may have any names.
"""

from __future__ import annotations

from math import exp, lgamma, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castellan.llm.common import let, numbered, words_of
from castellan.workspace import keep

SYMBOLS = "#*$%&|<>"
BLANK_CHARS = " \t\n\x0b\f\r"
#: name, transform of the base statistics, floor of its standard deviation
STATISTICS = (
    ("words", "ln(n_words)", 0.8),
    ("length", "ln(word_chars / n_words)", 0.08),
    ("symbols", "sqrt(n_symbols / word_chars)", 0.06),
    ("lines", "sqrt(n_dup_lines / n_lines)", 0.12),
    ("repeats", "sqrt(n_repeat_words / n_words)", 0.12),
)
P = len(STATISTICS)
#: Statistics are counted in quarters of their floors, so that is the floor in these units.
FLOOR = 4


def base_statistics(docs: DataFrame, text: Column, window: int = 8) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words added.

    Windows are compared by hash; only where two hashes agree are the windows themselves sorted and compared."""
    t = F.coalesce(text, F.lit(""))
    d = docs.withColumn("_words", words_of(t)).withColumn("_lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("_n", F.size("_words"))
    window_hash = "xxhash64(" + ", ".join(f"_words[i + {k}]" for k in range(window)) + ")"
    d = d.withColumn("_hashes", F.expr(f"if(_n < {window}, cast(array() as array<bigint>), transform(sequence(0, greatest(_n - {window}, 0)), i -> {window_hash}))"))
    windows = F.expr(f"array_sort(transform(sequence(0, _n - {window}), i -> named_struct('s', array_join(slice(_words, i + 1, {window}), ' '), 'i', i)))")

    def covered(s: Column) -> Column:
        """Words within windows that a neighbour in sorted order equals."""
        n = F.size(s)
        again = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.when(((k > 0) & (F.get(s, k - 1)["s"] == F.get(s, k)["s"])) | ((k + 1 < n) & (F.get(s, k + 1)["s"] == F.get(s, k)["s"])), F.get(s, k)["i"]))
        at = F.array_sort(F.filter(again, lambda i: i.isNotNull()))

        def total(p: Column) -> Column:
            step = lambda a, k: a + F.coalesce(F.least(F.lit(window), F.get(p, k + 1) - F.get(p, k)), F.lit(window))
            return F.when(F.size(p) > 0, F.aggregate(F.sequence(F.lit(0), F.size(p) - 1), F.lit(0), step)).otherwise(0)

        return let(at, total)

    repeats = F.when(F.size("_hashes") == F.size(F.array_distinct("_hashes")), 0).otherwise(let(windows, covered))
    stats = {
        "n_words": F.col("_n"), "word_chars": F.length(F.translate(t, BLANK_CHARS, "")), "n_symbols": F.length(t) - F.length(F.translate(t, SYMBOLS, "")), "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")), "n_repeat_words": repeats,
    }
    return d.withColumns({k: v.cast("long") for k, v in stats.items()}).drop("_words", "_lines", "_n", "_hashes")


def chi_square_share(x: float, p: int) -> float:
    """The chi-square distribution function, by the series of the incomplete gamma function."""
    a, x = p / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > 1e-15 * total:
        n += 1
        term *= x / (a + n)
        total += term
    return total * exp(-x + a * log(x) - lgamma(a))


def chi_square_quantile(share: float, p: int) -> float:
    low, high = 0.0, 10.0 * p
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_share(mid, p) < share else (low, mid)
    return low


def consistency(p: int) -> float:
    """By how much the covariance of the inner half of a normal cloud is to be enlarged."""
    return 0.5 / chi_square_share(chi_square_quantile(0.5, p), p + 2)


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
COVARIANCE = [f"s{i}_{j}" for i, j in PAIRS]
PLACE = [f"mu{i}" for i in range(P)]
INVERSE = [f"m{i}_{j}" for i, j in PAIRS]
ESTIMATE = ["g", "start", "logdet", *PLACE, *COVARIANCE, *INVERSE]


def x(i: int) -> Column:
    return F.col(f"x{i}")


def one_file(df: DataFrame, name: str) -> DataFrame:
    """A few rows for each group, kept as one file: of a size that Spark knows when it decides about broadcasting it."""
    return keep(df.repartition(1), name)


def inverse_root(est: DataFrame) -> DataFrame:
    """With s{i}_{j} the covariance (j <= i), m{i}_{j}: the inverse of its Cholesky factor, and logdet. Each line of the one projection uses those before."""
    lines = []
    for i, j in PAIRS:
        rest = " - ".join([f"s{i}_{j}", *(f"l{i}_{k} * l{j}_{k}" for k in range(j))])
        lines.append(f"sqrt(greatest({rest}, 1e-9D)) as l{i}_{i}" if i == j else f"({rest}) / l{j}_{j} as l{i}_{j}")
    for i, j in PAIRS:
        known = " - ".join(["0D", *(f"l{i}_{k} * m{k}_{j}" for k in range(j, i))])
        lines.append(f"{'1D' if i == j else f'({known})'} / l{i}_{i} as m{i}_{j}")
    return est.selectExpr("*", *lines, " + ".join(f"ln(l{i}_{i})" for i in range(P)) + " as logdet")


def distance() -> Column:
    """The squared Mahalanobis distance of x0, x1, ... under an estimate in the same row."""
    rows = (" + ".join(f"m{i}_{j} * (x{j} - mu{j})" for j in range(i + 1)) for i in range(P))
    return F.expr(" + ".join(f"pow({r}, 2D)" for r in rows))


def half_within(binned: DataFrame, keys: list[str], more: int = 0) -> DataFrame:
    """keys, edge: the least bin at or below which (n + more) / 2 rows (column w counts them) of the group lie, or all if they are fewer."""
    counts = binned.groupBy(*keys, "bin").agg(F.sum("w").alias("n"))
    ordered = Window.partitionBy(*keys).orderBy("bin")
    counts = counts.withColumn("upto", F.sum("n").over(ordered)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    return counts.filter(F.col("upto") >= F.least(F.col("all"), F.floor((F.col("all") + more + 1) / 2))).groupBy(*keys).agg(F.min("bin").alias("edge"))


def exact_moments(rows: DataFrame, keys: list[str], scale: float, unit: int = 1) -> DataFrame:
    """mu and covariance times scale, floors added, from exact sums of whole numbers that count units."""
    sums = [f"cast(sum(w * x{i}) as double) as t{i}" for i in range(P)]
    products = [f"cast(sum(cast(w * x{i} * x{j} as decimal(19,0))) as double) as q{i}_{j}" for i, j in PAIRS]
    est = rows.groupBy(*keys).agg(*map(F.expr, ["cast(sum(w) as double) as n", *sums, *products]))
    means = [f"t{i} / n / {unit} as mu{i}" for i in range(P)]
    return est.selectExpr(*keys, "n", *means, *(f"(q{i}_{j} / n / {unit} / {unit} - mu{i} * mu{j}) * {scale!r}D + {FLOOR**2 if i == j else 0} as s{i}_{j}" for i, j in PAIRS))


def starting_estimates(vectors: DataFrame) -> DataFrame:
    """Start 0: medians and MAD scales. Start 1: medians, and the covariance of tanh scores scaled back."""
    long = lambda v, rows: rows.select("g", "w", F.posexplode(F.array(*(v(i) for i in range(P)))).alias("i", "bin"))
    side = lambda df, name: one_file(df.groupBy("g").pivot("i", list(range(P))).agg(F.first("edge")).select("g", *(F.col(str(i)).alias(f"{name}{i}") for i in range(P))), name)
    middle = side(half_within(long(x, vectors), ["g", "i"]), "c")
    spread = side(half_within(long(lambda i: F.abs(x(i) - F.col(f"c{i}")), vectors.join(middle, "g")), ["g", "i"]), "d")
    place = {f"mu{i}": F.col(f"c{i}").cast("double") for i in range(P)}
    deviation = lambda i: F.sqrt(F.pow(F.col(f"d{i}") * 1.4826, F.lit(2.0)) + FLOOR**2)
    own = middle.join(spread, "g")
    first = own.withColumns(place | {f"s{i}_{j}": F.pow(deviation(i), F.lit(2.0)) if i == j else F.lit(0.0) for i, j in PAIRS})
    unit = 1 << 10
    scores = {f"x{i}": F.round(F.tanh((x(i) - F.col(f"c{i}")) / deviation(i)) * unit).cast("long") for i in range(P)}
    tanh = exact_moments(vectors.join(own, "g").withColumns(scores), ["g"], 1.0, unit)
    tanh = tanh.select("g", *((F.col(f"s{i}_{j}") - (FLOOR**2 - 0.01 if i == j else 0)).alias(f"s{i}_{j}") for i, j in PAIRS))
    second = own.join(tanh, "g").withColumns(place | {f"s{i}_{j}": F.col(f"s{i}_{j}") * deviation(i) * deviation(j) for i, j in PAIRS})
    both = [inverse_root(e.withColumn("start", F.lit(k))).select(*ESTIMATE) for k, e in enumerate((first, second))]
    return one_file(both[0].unionByName(both[1]), "estimates")


def robust_estimates(vectors: DataFrame, most_steps: int) -> DataFrame:
    """g, PLACE and COVARIANCE after the concentration steps of vectors (g, x0, ..., w: how many rows have this vector)."""
    scale = consistency(P)
    est, before = starting_estimates(vectors), None
    for _ in range(most_steps):
        binned = vectors.join(est, "g").select("g", "start", "w", *(x(i) for i in range(P)), F.floor(64 * F.log1p(distance())).cast("int").alias("bin"))
        inner = binned.join(half_within(binned, ["g", "start"], P), ["g", "start"]).filter("bin <= edge")
        est = one_file(inverse_root(exact_moments(inner, ["g", "start"], scale)).select(*ESTIMATE), "estimates")
        after = est.agg(F.sum(F.round("logdet", 6).cast("decimal(38,6)"))).first()[0]
        if after == before:
            break
        before = after
    best = est.groupBy("g").agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    return est.join(best, ["g", "start"]).select("g", *PLACE, *COVARIANCE)


def drawn_together(own: str, other: str, n: str, prior: int, to: str) -> list[str]:
    """The estimate (columns prefixed own) of n rows with the other, of weight prior, in columns prefixed to. An estimate's weight is its degrees of
    freedom: n less the parameters it fits. The other, of more groups, has the spread between groups in its covariance already."""
    free = f"greatest({n} - {P + len(PAIRS)}, 0)"
    w = f"({free} / ({free} + {prior}D))"
    return [f"{w} * {own}{c} + (1 - {w}) * {other}{c} as {to}{c}" for c in PLACE + COVARIANCE]


def group_estimates(vectors: DataFrame, prior: int, most_steps: int) -> DataFrame:
    """lang, source, PLACE and INVERSE for each group of vectors (lang, source, x0, ..., w)."""
    names = {0: F.to_json(F.struct("lang", "source")), 1: F.concat(F.lit("l"), F.to_json(F.struct("lang"))), 2: F.lit("all")}
    levels = F.explode(F.array(*names.values()))
    by_level = vectors.select(levels.alias("g"), *(x(i) for i in range(P)), "w").groupBy("g", *(f"x{i}" for i in range(P))).agg(F.sum("w").alias("w"))
    est = one_file(robust_estimates(keep(by_level, "vectors"), most_steps), "robust")
    sizes = vectors.groupBy("lang", "source").agg(F.sum("w").alias("n0"))
    sizes = sizes.withColumn("n1", F.sum("n0").over(Window.partitionBy("lang"))).withColumns({f"g{k}": g for k, g in names.items()})
    for k in names:
        sizes = sizes.join(est.select(F.col("g").alias(f"g{k}"), *(F.col(c).alias(f"e{k}_{c}") for c in PLACE + COVARIANCE)), f"g{k}")
    both = sizes.selectExpr("*", *drawn_together("e1_", "e2_", "n1", prior, "l_"))
    both = both.selectExpr("lang", "source", *drawn_together("e0_", "l_", "n0", prior, ""))
    return one_file(inverse_root(both).select("lang", "source", *PLACE, *INVERSE), "estimates")


def row_key(id: Column, text: Column) -> Column:
    """128 bits of a row's id and text."""
    return F.struct(F.xxhash64(id, text).alias("a"), F.xxhash64(F.lit(1), text, id).alias("b"))


def quality_verdicts(docs: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", least_words: int = 20, most_repeated: int = 30, cutoff: float = chi_square_quantile(0.9999, P), prior: int = 200, most_steps: int = 10) -> DataFrame:
    """id, key (of id and text), the base statistics, base_failed, distance (squared; null where base_failed), kept."""
    d = docs.select(F.col(id).alias("id"), F.col(text).alias("t"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    d = base_statistics(d.withColumn("key", row_key(F.col("id"), F.col("t"))), F.col("t")).drop("t")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    d = d.withColumn("base_failed", failed)
    passed = ~F.col("base_failed")
    stats = keep(d.withColumns({f"x{i}": F.when(passed, F.expr(e) * FLOOR / floor) for i, (_, e, floor) in enumerate(STATISTICS)}), "statistics")
    rounded = [F.round(x(i)).cast("long").alias(f"x{i}") for i in range(P)]
    vectors = stats.filter(passed).groupBy("lang", "source", *rounded).agg(F.count("*").alias("w"))
    est = group_estimates(keep(vectors, "vectors"), prior, most_steps)
    est = est.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    out = stats.join(est, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left").withColumn("distance", F.when(passed, distance()))
    return out.select("id", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", (passed & (F.col("distance") <= cutoff)).alias("kept"))


def keep_quality(docs: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that quality_verdicts keeps. The verdict hangs on the text and its group, so repeated rows stay or go together."""
    v = quality_verdicts(docs, id=id, text=text, **options).groupBy("key").agg(F.bool_or("kept").alias("kept")).filter("kept").select("key")
    d, names = numbered(docs)
    d = d.withColumn("key", row_key(F.col(names[id]), F.col(names[text])))
    return d.join(v, "key", "left_semi").select(*[F.col(v).alias(k) for k, v in names.items()])
