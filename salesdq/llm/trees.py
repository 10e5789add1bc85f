"""Gradient-boosted trees for two classes, on numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class BoostedTrees:
    """Trees of one depth as arrays: in each level's order, the feature and the cut of every node, and the leaves' values."""

    depth: int = 4
    rounds: int = 40
    rate: float = 0.3
    ridge: float = 1.0
    cuts: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    prior: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Second-order boosting of the logistic loss over histograms of at most BINS values a feature."""
        levels = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(column, levels)) for column in x.T]
        binned = self._binned(x)
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.prior = float(np.log(share / (1 - share)))
        margin, self.trees = np.full(len(y), self.prior), []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grown(binned, p - y, p * (1 - p))
            self.trees.append(tree)
            margin += self._leaf(binned, tree)
        return self

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds of the second class."""
        binned, out = self._binned(x), np.full(len(x), self.prior)
        for tree in self.trees:
            out += self._leaf(binned, tree)
        return out

    def _binned(self, x: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(c, column, side="left") for c, column in zip(self.cuts, x.T)]
        return np.stack(columns, 1).astype(np.int16) if columns else np.zeros((len(x), 0), np.int16)

    def _grown(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray):
        n, width = binned.shape
        node = np.zeros(n, np.int64)
        features = np.zeros((1 << self.depth) - 1, np.int64)
        limits = np.full((1 << self.depth) - 1, BINS, np.int64)
        for level in range(self.depth):
            nodes, begin = 1 << level, (1 << level) - 1
            best = np.zeros(nodes)
            for f in range(width):
                cell = node * BINS + binned[:, f]
                gs = np.bincount(cell, g, nodes * BINS).reshape(nodes, BINS).cumsum(1)
                hs = np.bincount(cell, h, nodes * BINS).reshape(nodes, BINS).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge) - gt**2 / (ht + self.ridge)
                at = gain.argmax(1)
                top = gain[np.arange(nodes), at]
                better = top > best + 1e-9
                best[better] = top[better]
                features[begin : begin + nodes][better] = f
                limits[begin : begin + nodes][better] = at[better]
            node = 2 * node + (binned[np.arange(n), features[begin + node]] > limits[begin + node])
        leaves = 1 << self.depth
        values = -self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.ridge)
        return features, limits, values

    def _leaf(self, binned: np.ndarray, tree) -> np.ndarray:
        features, limits, values = tree
        node, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
        for level in range(self.depth):
            at = (1 << level) - 1 + node
            node = 2 * node + (binned[rows, features[at]] > limits[at])
        return values[node]
