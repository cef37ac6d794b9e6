"""Histogram gradient-boosted trees for two classes, and their flattened form for vectorised traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees as arrays: tree by node, in heap order; a row goes right where its value is above the cut."""

    feature: np.ndarray       # (trees, inner nodes)
    cut: np.ndarray           # (trees, inner nodes)
    leaf: np.ndarray          # (trees, leaves)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for every row; all trees are walked a level at a time."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
        ridge: float = 1.0, least: float = 1.0) -> Trees:
    """Trees grown level by level on histograms of quantile bins, for the logistic loss.

    ``ridge`` shrinks the leaves and ``least`` is the smallest sum of second derivatives in a child.
    """
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)] if n else [np.zeros(0)] * width
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1) if n else np.zeros((0, width), int)
    share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    inner = (1 << depth) - 1
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), base)
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            at = node - first
            gain, best_j, best_b = np.full(count, 1e-6), np.zeros(count, np.int64), np.full(count, -1)
            for j in range(width):
                slot = at * bins + code[:, j]
                gs = np.bincount(slot, g, count * bins).reshape(count, bins).cumsum(1)
                hs = np.bincount(slot, h, count * bins).reshape(count, bins).cumsum(1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                value = gs**2 / (hs + ridge) + (ga - gs)**2 / (ha - hs + ridge) - ga**2 / (ha + ridge)
                value[(hs < least) | (ha - hs < least)] = -1
                b = value.argmax(1)
                top = value[np.arange(count), b]
                better = top > gain
                gain[better], best_j[better], best_b[better] = top[better], j, b[better]
            for k in np.flatnonzero(best_b >= 0):
                j, b = best_j[k], best_b[k]
                if b < len(cuts[j]):
                    out.feature[t, first + k], out.cut[t, first + k] = j, cuts[j][b]
            feature, cut = out.feature[t, node], out.cut[t, node]
            node = 2 * node + 1 + (x[np.arange(n), feature] > cut)
        at = node - inner
        gs, hs = np.bincount(at, g, inner + 1), np.bincount(at, h, inner + 1)
        out.leaf[t] = rate * gs / (hs + ridge)
        margin += out.leaf[t][at]
    return out
