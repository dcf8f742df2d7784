"""Gradient-boosted trees for a yes/no label over small whole-number features."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Logistic boosting of complete trees of a fixed depth; feature values are 0 to BINS - 1."""

    BINS = 32

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.25, ridge: float = 2.0):
        self.trees, self.depth, self.rate, self.ridge = trees, depth, rate, ridge
        self.start = 0.0
        self.forest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        x = x.astype(np.uint8)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        score = np.full(len(y), self.start)
        for _ in range(self.trees):
            q = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(x, q - y, q * (1 - q) + 1e-6)
            self.forest.append(tree)
            score += tree[2][leaf]
        return self

    def _grow(self, x, grad, hess):
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, self.BINS, np.int64)
        at = np.zeros(len(grad), np.int64)
        for level in range(self.depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-9)
            where = (at - first) * self.BINS
            for f in range(x.shape[1]):
                key = where + x[:, f]
                g = np.bincount(key, grad, width * self.BINS).reshape(width, -1)
                h = np.bincount(key, hess, width * self.BINS).reshape(width, -1)
                gl, hl = g.cumsum(1), h.cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better] = top[better]
                feature[first : first + width][better] = f
                cut[first : first + width][better] = k[better]
            at = 2 * at + 1 + (x[np.arange(len(at)), feature[at]] > cut[at])
        leaf = at - inner
        n = 1 << self.depth
        value = -self.rate * np.bincount(leaf, grad, n) / (np.bincount(leaf, hess, n) + self.ridge)
        return (feature, cut, value), leaf

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of yes."""
        x = x.astype(np.uint8)
        score, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = (1 << self.depth) - 1
        for feature, cut, value in self.forest:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            score += value[at - inner]
        return score
