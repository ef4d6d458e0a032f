"""Gradient-boosted regression trees on a log loss, for small tables of numeric features."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BINS = 32


class Trees(NamedTuple):
    """Complete binary trees of equal depth: (tree, node) features and thresholds, (tree, leaf) values."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds for each row."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - len(feature)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 5.0) -> Trees:
    """Trees for labels 0 and 1. Splits are sought among BINS quantiles of each feature."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), start)
    inner = 2**depth - 1
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for n in range(inner):
            own = np.flatnonzero(node == n)
            best = 1e-6
            if len(own) >= 10:
                g, h = grad[own], hess[own]
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    gs = np.cumsum(np.bincount(binned[own, f], g, len(c) + 1))
                    hs = np.cumsum(np.bincount(binned[own, f], h, len(c) + 1))
                    left, right = gs[:-1] ** 2 / (hs[:-1] + ridge), (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + ridge)
                    gain = left + right - gs[-1] ** 2 / (hs[-1] + ridge)
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[n], threshold[n] = gain[k], f, c[k]
            node[own] = 2 * n + 1 + (x[own, feature[n]] > threshold[n])
        at = node - inner
        leaf = rate * np.bincount(at, grad, inner + 1) / (np.bincount(at, hess, inner + 1) + ridge)
        margin += leaf[at]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(np.array(features), np.array(thresholds), np.array(leaves), start)
