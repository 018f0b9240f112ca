"""Gradient-boosted trees for a 0/1 label with monotonic constraints, in flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Forest:
    """Node arrays of all trees. A leaf has feature -1; children are node numbers."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    prior: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row, all rows and trees in step."""
        node = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            feature = self.feature[node]
            low = x[row, np.maximum(feature, 0)] <= self.threshold[node]
            node = np.where(feature < 0, node, np.where(low, self.left[node], self.right[node]))
        return 1 / (1 + np.exp(-(self.prior + self.value[node].sum(axis=1))))


def train(
    x: np.ndarray,
    y: np.ndarray,
    falling: list[int],
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    penalty: float = 2.0,
    min_weight: float = 2.0,
) -> Forest:
    """Fit by second-order boosting over binned features.

    For a feature in `falling` no split may give the higher side the higher value, and the
    subtrees below stay on their side of the middle, so the score never rises with it.
    """
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}

    def add() -> int:
        for name, empty in zip(nodes, (-1, 0.0, -1, -1, 0.0), strict=True):
            nodes[name].append(empty)
        return len(nodes["feature"]) - 1

    share = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):  # nothing to tell apart
        trees, x = 0, np.zeros((1, x.shape[1]))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], axis=1)
    total = np.full(len(y), prior)
    roots = []

    def best(at: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
        def weight(sg, sh):
            return np.clip(-sg / (sh + penalty), low, high)

        def loss(sg, sh, w):
            return sg * w + 0.5 * (sh + penalty) * w * w

        sg, sh = g[at].sum(), h[at].sum()
        start = loss(sg, sh, weight(sg, sh))
        found = (1e-6, None)
        for f in range(x.shape[1]):
            if not len(edges[f]):
                continue
            bins = binned[at, f]
            lg = np.cumsum(np.bincount(bins, g[at], len(edges[f]) + 1))[:-1]
            lh = np.cumsum(np.bincount(bins, h[at], len(edges[f]) + 1))[:-1]
            lw, rw = weight(lg, lh), weight(sg - lg, sh - lh)
            gain = start - loss(lg, lh, lw) - loss(sg - lg, sh - lh, rw)
            gain[(lh < min_weight) | (sh - lh < min_weight)] = -1
            if f in falling:
                gain[lw < rw] = -1
            b = int(np.argmax(gain))
            if gain[b] > found[0]:
                found = (gain[b], (f, b, float(lw[b]), float(rw[b])))
        return found[1]

    def grow(node: int, at: np.ndarray, g, h, level: int, low: float, high: float) -> None:
        split = best(at, g, h, low, high) if level < depth else None
        if split is None:
            sg, sh = g[at].sum(), h[at].sum()
            nodes["value"][node] = rate * float(np.clip(-sg / (sh + penalty), low, high))
            total[at] += nodes["value"][node]
            return
        f, b, lw, rw = split
        nodes["feature"][node], nodes["threshold"][node] = f, float(edges[f][b])
        left, right = add(), add()
        nodes["left"][node], nodes["right"][node] = left, right
        side = binned[at, f] <= b
        middle = (lw + rw) / 2
        bounds = ((middle, high), (low, middle)) if f in falling else ((low, high), (low, high))
        grow(left, at[side], g, h, level + 1, *bounds[0])
        grow(right, at[~side], g, h, level + 1, *bounds[1])

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        root = add()
        roots.append(root)
        grow(root, np.arange(len(y)), p - y, p * (1 - p), 0, -4.0, 4.0)
    whole = ("feature", "left", "right")
    return Forest(
        *(np.array(nodes[k], np.int64 if k in whole else np.float64) for k in nodes),
        roots=np.array(roots, np.int64),
        prior=prior,
        depth=depth,
    )
