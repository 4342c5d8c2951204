"""The covariance estimates of the quality rules against numpy, and verdicts that hold at any size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from castellan.llm import quality
from castellan.llm.quality import FLOOR, P, PAIRS


def lower_median(v):
    return np.sort(v, axis=0)[(len(v) + 1) // 2 - 1]


def fitted(x, steps=10):
    """Both starts, concentration steps on the half of least (binned) distances, the smaller determinant."""
    scale, results = quality.consistency(P), []
    c = lower_median(x)
    dev = np.sqrt((lower_median(np.abs(x - c)) * 1.4826) ** 2 + FLOOR**2)
    z = np.round(np.tanh((x - c) / dev) * 1024)
    t = np.cov(z.T, bias=True) / 1024**2 + np.eye(P) * 0.01
    for s in (np.diag(dev**2), t * np.outer(dev, dev)):
        mu, before = c.astype(float), None
        for _ in range(steps):
            d = np.einsum("ni,ij,nj->n", x - mu, np.linalg.inv(s), x - mu)
            bins = np.floor(64 * np.log1p(d))
            half = x[bins <= np.sort(bins)[min(len(x), (len(x) + P + 1) // 2) - 1]]
            mu, s = half.mean(axis=0), np.cov(half.T, bias=True) * scale + np.eye(P) * FLOOR**2
        results.append((np.linalg.slogdet(s)[1], mu, s))
    return min(results, key=lambda r: r[0])[1:]


def drawn(own, other, n, prior):
    free = max(0, n - P - len(PAIRS))
    w = free / (free + prior)
    return w * own[0] + (1 - w) * other[0], w * own[1] + (1 - w) * other[1]


def test_estimates_match_numpy(spark):
    rng = np.random.default_rng(12)
    groups = {("en", "a"): 300, ("en", None): 40, ("de", "a"): 90, (None, "b"): 25}
    mix = np.tril(rng.normal(size=(P, P))) * 6 + np.eye(P) * 12
    x = {k: np.round(rng.normal(size=(n, P)) @ mix.T + rng.normal(size=P) * 8).astype(int) for k, n in groups.items()}
    x["en", "a"][:60] += 400
    rows = [(*k, *map(int, v)) for k, vs in x.items() for v in vs]
    names = [f"x{i}" for i in range(P)]
    d = spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{n} bigint" for n in names))
    got = {(r.lang, r.source): r for r in quality.group_estimates(d.groupBy("lang", "source", *names).agg(F.count("*").alias("w")), 50, 10).collect()}
    assert set(got) == set(groups)
    all_rows = fitted(np.concatenate(list(x.values())))
    for (lang, source), own in x.items():
        same = np.concatenate([v for (g, _), v in x.items() if g == lang])
        mu, s = drawn(fitted(own), drawn(fitted(same), all_rows, len(same), 50), len(own), 50)
        r = got[lang, source]
        m = np.zeros((P, P))
        for i, j in PAIRS:
            m[i, j] = r[f"m{i}_{j}"]
        assert [r[f"mu{i}"] for i in range(P)] == pytest.approx(mu, rel=1e-6, abs=1e-6)
        assert m.T @ m == pytest.approx(np.linalg.inv(s), rel=1e-5, abs=1e-8)


def test_a_group_of_any_size_has_its_own_weight(spark):
    """A language's usual texts are kept whether their source holds five of them or three hundred, and odd ones go either way."""
    text = lambda i, n: " ".join(f"w{(i * 31 + k * 7) % 900}x{k}" for k in range(60 + i % 40 + n))
    docs = [(i, text(i, 0), "en", "large" if i < 300 else f"small{i % 9}") for i in range(340)]
    docs += [(1000 + i, " ".join(f"a{k}###$$$|" for k in range(90)), "en", "large" if i % 2 else "small1") for i in range(6)]
    v = quality.quality_verdicts(spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")).collect()
    assert len(v) == 346 and {r.id for r in v if not r.kept} == set(range(1000, 1006))
