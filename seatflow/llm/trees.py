"""Small decision trees and histogram gradient boosting in numpy, with trees flattened into arrays.

A tree is four arrays: feature, threshold, left child (the right one follows it; -1 at a leaf) and
value. All rows walk down together, one level a step. Training takes a bounded sample; scoring
runs in tasks.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Tree(NamedTuple):
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray


def walk(tree: Tree, rows: np.ndarray) -> np.ndarray:
    """Each row's leaf value; a row goes left where its feature is at most the threshold."""
    at, every = np.zeros(len(rows), np.int64), np.arange(len(rows))
    while True:
        left = tree.left[at]
        if (left < 0).all():
            return tree.value[at]
        right = rows[every, tree.feature[at]] > tree.threshold[at]
        at = np.where(left < 0, at, left + right)


def bin_edges(rows: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per feature, at most bins - 1 cut points between its quantiles."""
    out = []
    for j in range(rows.shape[1]):
        values = np.unique(rows[:, j])
        mids = (values[1:] + values[:-1]) / 2
        if len(mids) >= bins:
            mids = np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1]))
        out.append(mids)
    return out


def grown(codes: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, depth: int, least: float, smooth: float, bins: int) -> Tree:
    """One tree on binned rows, level by level; a leaf's value is -sum(gradient) / (sum(hessian) + smooth)."""
    feature, threshold, left, value = [0], [0.0], [-1], [0.0]
    node, level = np.zeros(len(codes), np.int64), [0]
    for d in range(depth + 1):
        place = np.full(len(feature), -1)
        place[level] = np.arange(len(level))
        own = place[node]
        on = np.flatnonzero(own >= 0)
        g = np.bincount(own[on], gradient[on], len(level))
        h = np.bincount(own[on], hessian[on], len(level))
        for i, k in enumerate(level):
            value[k] = float(-g[i] / (h[i] + smooth)) if h[i] + smooth > 0 else 0.0
        if d == depth:
            break
        best = np.full(len(level), 1e-9)
        cut: list[tuple[int, int] | None] = [None] * len(level)
        for j in range(codes.shape[1]):
            if not len(edges[j]):
                continue
            spot = own[on] * bins + codes[on, j]
            gl = np.bincount(spot, gradient[on], len(level) * bins).reshape(-1, bins).cumsum(1)[:, : len(edges[j])]
            hl = np.bincount(spot, hessian[on], len(level) * bins).reshape(-1, bins).cumsum(1)[:, : len(edges[j])]
            gr, hr = g[:, None] - gl, h[:, None] - hl
            gain = gl**2 / (hl + smooth + 1e-12) + gr**2 / (hr + smooth + 1e-12) - (g**2 / (h + smooth + 1e-12))[:, None]
            gain[(hl < least) | (hr < least)] = -1
            top = gain.argmax(1)
            for i in np.flatnonzero(gain[np.arange(len(level)), top] > best):
                best[i], cut[i] = gain[i, top[i]], (j, int(top[i]))
        deeper = []
        for i, k in enumerate(level):
            if cut[i] is None:
                continue
            j, b = cut[i]
            feature[k], threshold[k], left[k] = j, float(edges[j][b]), len(feature)
            deeper += [len(feature), len(feature) + 1]
            feature += [0, 0]
            threshold += [0.0, 0.0]
            left += [-1, -1]
            value += [0.0, 0.0]
            mine = on[own[on] == i]
            node[mine] = left[k] + (codes[mine, j] > b)
        level = deeper
        if not level:
            break
    return Tree(np.array(feature), np.array(threshold), np.array(left), np.array(value))


def binned(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, rows[:, j], side="left") for j, e in enumerate(edges)], axis=1)


class Boosted(NamedTuple):
    base: float
    trees: list[Tree]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of class 1."""
        total = np.full(len(rows), self.base)
        for tree in self.trees:
            total += walk(tree, rows)
        return 1 / (1 + np.exp(-total))


def boosted(rows: np.ndarray, labels: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 4.0, smooth: float = 1.0) -> Boosted:
    """Logistic loss with histogram splits. Without rows the score is 0.5 everywhere."""
    if not len(rows):
        return Boosted(0.0, [])
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    base = float(np.log(share / (1 - share)))
    edges = bin_edges(rows, bins)
    codes, total, trees = binned(rows, edges), np.full(len(rows), base), []
    for _ in range(rounds if 0 < labels.sum() < len(labels) else 0):
        p = 1 / (1 + np.exp(-total))
        tree = grown(codes, edges, p - labels, p * (1 - p), depth, least, smooth, bins)
        tree = tree._replace(value=tree.value * rate)
        trees.append(tree)
        total += walk(tree, rows)
    return Boosted(base, trees)


def classified(rows: np.ndarray, labels: np.ndarray, depth: int = 5, least: float = 1.0, bins: int = 64) -> Tree:
    """A single decision tree for 0/1 labels: squared loss, so a leaf's value is its share of label 1."""
    edges = bin_edges(rows, bins)
    return grown(binned(rows, edges), edges, -labels.astype(float), np.ones(len(rows)), depth, least, 0.0, bins)
