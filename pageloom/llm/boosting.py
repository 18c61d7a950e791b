"""Gradient-boosted trees in numpy with monotonic constraints, flattened into node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """All trees end to end: a leaf points to itself, ``roots`` has each tree's first node."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row; all rows and trees step down together."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        at = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go_left = x[at, self.feature[node]] <= self.threshold[node]
            node = np.where(go_left, self.left[node], self.right[node])
        return self.start + self.value[node].sum(axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(x), -50, 50)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Thresholds between neighbouring distinct values, at most ``bins`` of them at quantiles."""
    found = []
    for column in x.T:
        values = np.unique(column)
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) > bins:
            middle = np.unique(np.quantile(column, np.linspace(0, 1, bins + 2)[1:-1]))
        found.append(middle)
    return found


def fit(
    x: np.ndarray,
    y: np.ndarray,
    constraints: np.ndarray,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 48,
    ridge: float = 2.0,
    least: float = 4.0,
) -> Trees:
    """Trees for P(y = 1); ``constraints`` has +1, 0 or -1 for each feature.

    A split on a feature with +1 never gives the right side the lower value, and its
    middle bounds all nodes below, so the sum never falls as the feature grows.
    """
    edges = _edges(x, bins)
    width = max([1, *(len(e) + 1 for e in edges)])
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    rate_of_ones = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    margin = np.full(len(y), start)
    features, d = x.shape[1], np.arange(x.shape[1]) * width
    node_lists: tuple[list, list, list, list, list] = ([], [], [], [], [])
    feature, threshold, left, right, value = node_lists
    roots = []

    def new_node() -> int:
        feature.append(0), threshold.append(0.0), value.append(0.0)
        left.append(len(left)), right.append(len(right))
        return len(feature) - 1

    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        roots.append(new_node())
        open_nodes = [(roots[-1], np.arange(len(y)), -np.inf, np.inf, 0)]
        while open_nodes:
            node, rows, low, high, level = open_nodes.pop()
            g, h = gradient[rows], hessian[rows]
            best = _best_split(binned[rows] + d, g, h, features, width, constraints, low, high, ridge, least) if level < depth else None
            if best is None:
                value[node] = rate * float(np.clip(-g.sum() / (h.sum() + ridge), low, high))
                margin[rows] += value[node]
                continue
            k, cut, a, b = best
            feature[node], threshold[node] = k, float(edges[k][cut])
            goes_left = binned[rows, k] <= cut
            left[node], right[node] = new_node(), new_node()
            middle = (a + b) / 2
            low_left, high_left, low_right, high_right = low, high, low, high
            if constraints[k] > 0:
                high_left, low_right = middle, middle
            elif constraints[k] < 0:
                low_left, high_right = middle, middle
            open_nodes.append((left[node], rows[goes_left], low_left, high_left, level + 1))
            open_nodes.append((right[node], rows[~goes_left], low_right, high_right, level + 1))
    return Trees(
        np.array(feature, np.int32),
        np.array(threshold),
        np.array(left, np.int32),
        np.array(right, np.int32),
        np.array(value),
        np.array(roots, np.int32),
        depth,
        start,
    )


def _best_split(cells, g, h, features, width, constraints, low, high, ridge, least):
    """(feature, bin, left value, right value) of the best allowed split, or None."""
    size = features * width
    flat = cells.ravel()
    sums_g = np.bincount(flat, np.repeat(g, features), size).reshape(features, width).cumsum(axis=1)
    sums_h = np.bincount(flat, np.repeat(h, features), size).reshape(features, width).cumsum(axis=1)
    all_g, all_h = sums_g[:, -1:], sums_h[:, -1:]
    gl, hl, gr, hr = sums_g, sums_h, all_g - sums_g, all_h - sums_h
    a = np.clip(-gl / (hl + ridge), low, high)
    b = np.clip(-gr / (hr + ridge), low, high)
    score = lambda w, gs, hs: -(gs * w + 0.5 * (hs + ridge) * w * w)
    gain = score(a, gl, hl) + score(b, gr, hr) - score(np.clip(-all_g / (all_h + ridge), low, high), all_g, all_h)
    gain[(hl < least / 4) | (hr < least / 4)] = -1
    gain[(constraints[:, None] * (b - a)) < 0] = -1
    k, cut = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[k, cut] <= 1e-6:
        return None
    return int(k), int(cut), float(a[k, cut]), float(b[k, cut])
