"""Histogram gradient-boosted trees for a binary label, in numpy. Trees are complete, of one depth, and flattened
into arrays in heap order, so that a batch of rows goes down one level of a tree in a few vector operations."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    edges: np.ndarray  # (features, bins - 1): upper edges, inclusive
    feature: np.ndarray  # (trees, 2**depth - 1)
    cut: np.ndarray  # (trees, 2**depth - 1): rows with a bin above go right
    leaf: np.ndarray  # (trees, 2**depth)
    start: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for f in range(x.shape[1]):
            out[:, f] = np.searchsorted(self.edges[f], x[:, f], "left")
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.bins(x), np.arange(len(x))
        out = np.full(len(x), self.start)
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.15, bins: int = 64,
    l2: float = 2.0, least: float = 5.0,
) -> Trees:
    """Newton boosting on the logistic loss. With a single class (or no rows) there are no trees."""
    n, k = x.shape
    total = weight.sum()
    base = float(np.clip((weight * y).sum() / total, 1e-3, 1 - 1e-3)) if n else 0.5
    q = np.linspace(0, 1, bins + 1)[1:-1]
    edges = np.array([np.quantile(x[:, f], q) for f in range(k)]) if n else np.zeros((k, bins - 1))
    model = Trees(edges, np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth)), float(np.log(base / (1 - base))))
    if n == 0 or y.min() == y.max():
        return model
    b = model.bins(x).astype(np.int64)
    margin = np.full(n, model.start)
    all_feature, all_cut, all_leaf = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, bins, np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            best = np.zeros(width)
            for f in range(k):
                slot = node * bins + b[:, f]
                gs = np.bincount(slot, g, width * bins).reshape(width, bins).cumsum(1)
                hs = np.bincount(slot, h, width * bins).reshape(width, bins).cumsum(1)
                cs = np.bincount(slot, weight, width * bins).reshape(width, bins).cumsum(1)
                gt, ht, ct = gs[:, -1:], hs[:, -1:], cs[:, -1:]
                gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                gain[(cs < least) | (ct - cs < least)] = 0
                at = gain.argmax(1)
                got = gain[np.arange(width), at]
                better = got > best + 1e-9
                best[better] = got[better]
                feature[first : first + width][better] = f
                cut[first : first + width][better] = at[better]
            node = 2 * node + (b[np.arange(n), feature[first + node]] > cut[first + node])
        gl, hl = np.bincount(node, g, 2**depth), np.bincount(node, h, 2**depth)
        leaf = -rate * gl / (hl + l2)
        margin += leaf[node]
        all_feature.append(feature)
        all_cut.append(cut)
        all_leaf.append(leaf)
    model.feature, model.cut, model.leaf = np.array(all_feature), np.array(all_cut), np.array(all_leaf)
    return model
