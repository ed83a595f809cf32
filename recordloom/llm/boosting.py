"""Small numpy models: boosted trees on binned features, and monotone calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Additive trees of fixed depth, each a full binary tree of threshold tests."""

    base: float
    features: np.ndarray  # trees x inner nodes
    thresholds: np.ndarray  # trees x inner nodes
    leaves: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaves.shape[1]))
        for f, t, leaf in zip(self.features, self.thresholds, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += leaf[node - len(f)]
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64
) -> Trees:
    """Newton boosting of the logistic loss; splits come from histograms of quantile bins."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    # Rare features are 0 nearly everywhere, so their few other values get edges too.
    for j in range(m):
        some = x[x[:, j] > 0, j]
        if len(some):
            extra = np.quantile(some, np.linspace(0, 1, 9)[:-1])
            edges[j] = np.unique(np.concatenate([edges[j], [0.0], extra]))
    codes = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    width = 1 + max(len(e) for e in edges)
    rate_of_ones = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    margin = np.full(n, base)
    inner = (1 << depth) - 1
    all_f, all_t, all_leaf = [], [], []
    for _ in range(rounds):
        p = sigmoid(margin)
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            at = node - first
            best = np.full(count, 1e-6)
            for j in range(m):
                cell = at * width + codes[:, j]
                g = np.bincount(cell, grad, count * width).reshape(count, width)
                h = np.bincount(cell, hess, count * width).reshape(count, width)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain = gain[:, : len(edges[j])]
                if not gain.shape[1]:
                    continue
                cut = gain.argmax(1)
                value = gain[np.arange(count), cut]
                better = value > best
                best[better] = value[better]
                feature[first : first + count][better] = j
                threshold[first : first + count][better] = edges[j][cut[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        g = np.bincount(leaf, grad, inner + 1)
        h = np.bincount(leaf, hess, inner + 1)
        values = -rate * g / (h + 1)
        margin += values[leaf]
        all_f.append(feature)
        all_t.append(threshold)
        all_leaf.append(values)
    return Trees(base, np.array(all_f), np.array(all_t), np.array(all_leaf))


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the monotone map from score to probability (pool adjacent violators).

    Each pool is weighed with one positive and one negative half-case, so that no
    probability is exactly 0 or 1.
    """
    order = np.argsort(score, kind="stable")
    score, y = score[order], y[order].astype(float)
    pools: list[list[float]] = []
    for s, v in zip(score.tolist(), y.tolist(), strict=True):
        pools.append([v, 1.0, s, s])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            total, weight, _, high = pools.pop()
            pools[-1][0] += total
            pools[-1][1] += weight
            pools[-1][3] = high
    xs = [v for pool in pools for v in (pool[2], pool[3])]
    ps = [(pool[0] + 0.5) / (pool[1] + 1) for pool in pools for _ in range(2)]
    return np.array(xs), np.maximum.accumulate(np.array(ps))


def calibrated(knots: tuple[np.ndarray, np.ndarray], score: np.ndarray) -> np.ndarray:
    xs, ps = knots
    return np.interp(score, xs, ps) if len(xs) else np.full(len(score), 0.5)
