"""Gradient-boosted trees for two classes, on binned features, in numpy."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Sum of full trees of fixed depth; each tree holds a feature and a threshold per inner node."""

    def __init__(self, base: float, depth: int):
        self.base, self.depth = base, depth
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - (2 ** self.depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 50, depth: int = 4, rate: float = 0.2, bins: int = 32,
        ridge: float = 5.0) -> Boosted:
    """Newton boosting with quantile bins; deterministic."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), depth)
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    score = np.full(n, model.base)
    inner = 2 ** depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            best = np.full(count, 1e-9)
            split = np.full(count, bins, np.int64)
            local = node - first
            for f in range(width):
                if not len(cuts[f]):
                    continue
                size = len(cuts[f]) + 1
                cell = local * size + binned[:, f]
                g = np.bincount(cell, gradient, count * size).reshape(count, size).cumsum(1)
                h = np.bincount(cell, weight, count * size).reshape(count, size).cumsum(1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = (g ** 2 / (h + ridge) + (total_g - g) ** 2 / (total_h - h + ridge)
                        - total_g ** 2 / (total_h + ridge))[:, :-1]
                at = gain.argmax(1)
                found = gain[np.arange(count), at]
                better = found > best
                best[better], split[better] = found[better], at[better]
                feature[first:first + count][better] = f
                threshold[first:first + count][better] = cuts[f][at[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        leaf = rate * np.bincount(at, gradient, inner + 1) / (np.bincount(at, weight, inner + 1) + ridge)
        model.trees.append((feature, threshold, leaf))
        score += leaf[at]
    return model
