"""Gradient-boosted trees in numpy: histogram training with monotonic constraints, flat scoring.

Training takes a bounded sample on the driver.  All trees are flattened into
one set of node arrays, and a batch of rows walks all trees at once, one
vectorised step a level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class TreeModel:
    """Node arrays of all trees; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray       # goes left if x <= threshold
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.start + self.value[node].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15,
        bins: int = 32, reg: float = 1.0, least_weight: float = 1.0) -> TreeModel:
    """Logistic loss.  ``monotone``: +1 or -1 where the probability may only rise or fall with a feature, else 0.

    A split on a constrained feature must order its sides, and the midpoint of
    its sides bounds all values below it, so the whole model is monotonic.
    Without rows, or with one class only, the model is a constant.
    """
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 1.0
    start = float(np.log(share / (1 - share))) if 0 < share < 1 else 10.0
    if len(np.unique(y)) < 2:
        trees = 0
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T] if trees else []
    binned = [np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)] if trees else []
    nodes: list[list[float]] = []
    roots, margin = [], np.full(len(y), start)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, lo: float, hi: float) -> int:
        me, total, weight = len(nodes), g[rows].sum(), h[rows].sum()
        value = float(np.clip(-total / (weight + reg), lo, hi))
        nodes.append([0, np.inf, me, me, value * rate])
        best = (1e-6, None)
        for f in range(len(edges)) if level < depth else ():
            gl = np.cumsum(np.bincount(binned[f][rows], g[rows], len(edges[f]) + 1))[:-1]
            hl = np.cumsum(np.bincount(binned[f][rows], h[rows], len(edges[f]) + 1))[:-1]
            gr, hr = total - gl, weight - hl
            wl, wr = np.clip(-gl / (hl + reg), lo, hi), np.clip(-gr / (hr + reg), lo, hi)
            gain = -(gl * wl + (hl + reg) * wl**2 / 2) - (gr * wr + (hr + reg) * wr**2 / 2) + (total * value + (weight + reg) * value**2 / 2)
            gain[(hl < least_weight) | (hr < least_weight) | (monotone[f] * (wr - wl) < 0)] = -1
            k = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[k] > best[0]:
                best = (float(gain[k]), (f, k, (wl[k] + wr[k]) / 2))
        if best[1]:
            f, k, mid = best[1]
            goes = binned[f][rows] <= k
            l_lo, l_hi, r_lo, r_hi = {1: (lo, mid, mid, hi), -1: (mid, hi, lo, mid)}.get(int(monotone[f]), (lo, hi, lo, hi))
            left = grow(rows[goes], g, h, level + 1, l_lo, l_hi)
            right = grow(rows[~goes], g, h, level + 1, r_lo, r_hi)
            nodes[me] = [f, float(edges[f][k]), left, right, 0.0]
        else:
            margin[rows] += value * rate
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
    flat = np.array(nodes, float).reshape(-1, 5)
    return TreeModel(np.array(roots, np.int64), flat[:, 0].astype(np.int64), flat[:, 1], flat[:, 2].astype(np.int64),
                     flat[:, 3].astype(np.int64), flat[:, 4], depth, start)
