"""Boosted trees for a bounded table of labelled rows: logistic loss, second-order leaves, splits on histograms of quantile bins, and calibration by isotonic regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH = 3


@dataclass(frozen=True)
class Boosted:
    """Complete trees of DEPTH levels: feature and threshold of each inner node (a row goes right where it is greater), value of each leaf."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - (2**DEPTH - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, *, rounds: int = 80, rate: float = 0.2, bins: int = 32, l2: float = 1.0, least: float = 2.0) -> Boosted:
    """Deterministic: the same rows in the same order give the same trees. least: second-order weight that a child must have."""
    n, features = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[:-1], method="lower")) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)  # edges below the value
    mean = np.clip(y.mean(), 0.01, 0.99)
    margin, base = np.full(n, np.log(mean / (1 - mean))), float(np.log(mean / (1 - mean)))
    inner = 2**DEPTH - 1
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            at = (((node - first)[:, None] * features + np.arange(features)) * bins + binned).ravel()
            sums = [np.bincount(at, np.repeat(w, features), width * features * bins).reshape(width, features, bins).cumsum(axis=2) for w in (g, h)]
            (gl, hl), (gt, ht) = sums, [s[:, :, -1:] for s in sums]
            gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
            gain[(hl < least) | (ht - hl < least)] = 0
            for k in range(width):
                f, b = divmod(int(gain[k].argmax()), bins)
                if gain[k, f, b] > 1e-9:
                    feature[first + k], threshold[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + l2)
        margin += value[leaf]
        trees.append((feature, threshold, value))
    return Boosted(base, *(np.stack(c) for c in zip(*trees)))


def threshold_for(scores: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least score whose calibrated probability (isotonic regression by pooling adjacent violators) reaches precision; infinity if none does."""
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []  # sum, count, least score
    for s, v in zip(scores[order], y[order]):
        if blocks and blocks[-1][3] == s:
            blocks[-1][0] += v
            blocks[-1][1] += 1
        else:
            blocks.append([float(v), 1.0, float(s), float(s)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, count, _, top = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + count, blocks[-1][2], top]
    # one error is added to each block, so that a few lucky rows do not pass
    good = [b[2] for b in blocks if b[0] / (b[1] + 1) >= precision]
    return min(good, default=float("inf"))
