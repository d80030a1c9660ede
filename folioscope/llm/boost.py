"""Gradient-boosted trees for binary targets in NumPy: small, deterministic, trained on bounded samples."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Logistic gradient boosting of shallow trees over quantile bins."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: int = 5, shrink: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.least, self.shrink = trees, depth, rate, bins, least, shrink
        self.edges: list[np.ndarray] = []
        self.nodes: list[list[tuple[int, int, float]]] = []
        self.start = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1) if len(x) else np.zeros((0, len(self.edges)), int)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        x, y = np.asarray(x, float), np.asarray(y, float)
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        b = self._binned(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        f = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            tree: list[tuple[int, int, float]] = []
            f += self.rate * self._grow(tree, b, g, h, np.arange(len(y)), 0, np.zeros(len(y)))
            self.nodes.append(tree)
        return self

    def _grow(self, tree, b, g, h, rows, depth, out) -> np.ndarray:
        """Appends a node for ``rows``: (feature, bin, value), children left then right; -1 is a leaf."""
        at = len(tree)
        value = float(g[rows].sum() / (h[rows].sum() + self.shrink))
        tree.append((-1, 0, value))
        best, where = 1e-6, None
        if depth < self.depth and len(rows) >= 2 * self.least:
            total_g, total_h = g[rows].sum(), h[rows].sum()
            for j in range(b.shape[1]):
                size = len(self.edges[j]) + 1
                if size < 2:
                    continue
                gs, hs, ns = (np.cumsum(np.bincount(b[rows, j], w, size))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
                gain = gs**2 / (hs + self.shrink) + (total_g - gs) ** 2 / (total_h - hs + self.shrink) - total_g**2 / (total_h + self.shrink)
                gain[(ns < self.least) | (len(rows) - ns < self.least)] = 0
                if gain.max() > best:
                    best, where = gain.max(), (j, int(gain.argmax()))
        if where is None:
            out[rows] = value
            return out
        j, cut = where
        tree[at] = (j, cut, value)
        left = b[rows, j] <= cut
        self._grow(tree, b, g, h, rows[left], depth + 1, out)
        tree.append((-2, at, 0.0))  # marks where the right child begins
        self._grow(tree, b, g, h, rows[~left], depth + 1, out)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float).reshape(-1, len(self.edges))
        b = self._binned(x)
        f = np.full(len(x), self.start)
        for tree in self.nodes:
            right = {at: i + 1 for i, (j, at, _) in enumerate(tree) if j == -2}
            stack = [(0, np.arange(len(x)))]
            while stack:
                i, rows = stack.pop()
                j, cut, value = tree[i]
                if not len(rows):
                    continue
                if j == -1:
                    f[rows] += self.rate * value
                else:
                    go = b[rows, j] <= cut
                    stack += [(i + 1, rows[go]), (right[i], rows[~go])]
        return 1 / (1 + np.exp(-f))
