"""Gradient-boosted trees on numpy arrays, with monotonic constraints.

Trees are grown on binned features with the logistic loss and flattened into
node arrays (feature, threshold, left, right, value), so scoring walks all rows
of a batch down one level at a time.
"""

from __future__ import annotations

import numpy as np


class Forest:
    """Flattened trees: ``feature`` is -1 at leaves; ``roots`` starts each tree."""

    def __init__(self, base: float, feature, threshold, left, right, value, roots):
        self.base = base
        self.feature, self.threshold = np.array(feature, np.int32), np.array(threshold)
        self.left, self.right = np.array(left, np.int32), np.array(right, np.int32)
        self.value, self.roots = np.array(value), np.array(roots, np.int32)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the positive class for each row of ``x``."""
        out, every = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root, np.int32)
            while True:
                f = self.feature[node]
                if (f < 0).all():
                    break
                down = np.where(x[every, np.maximum(f, 0)] <= self.threshold[node],
                                self.left[node], self.right[node])
                node = np.where(f < 0, node, down)
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 4,
        rate: float = 0.15, bins: int = 64, least: float = 1.0, ridge: float = 1.0) -> Forest:
    """``monotone[f]``: 1 (the margin may only rise with feature f), -1 (only fall) or 0.

    A split that breaks its feature's direction is not made, and both children are
    held between bounds that meet at the middle of their values, so the whole tree
    obeys the constraint. ``least`` is the smallest sum of Hessians in a leaf.
    """
    n, n_features = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for column, v in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (value, 0.0)):
            column.append(v)
        return len(feature) - 1

    def leaf_value(g, h, low, high):
        return float(np.clip(-g / (h + ridge), low, high))

    def grow(at, members, g, h, level, low, high):
        own = leaf_value(g[members].sum(), h[members].sum(), low, high)
        value[at] = own * rate
        margin[members] += value[at]
        if level == depth or h[members].sum() < 2 * least:
            return
        best = (1e-6, None)
        total_g, total_h = g[members].sum(), h[members].sum()
        whole = total_g ** 2 / (total_h + ridge)
        for f in range(n_features):
            if not len(cuts[f]):
                continue
            b = binned[members, f]
            gs = np.cumsum(np.bincount(b, g[members], len(cuts[f]) + 1))[:-1]
            hs = np.cumsum(np.bincount(b, h[members], len(cuts[f]) + 1))[:-1]
            gain = gs ** 2 / (hs + ridge) + (total_g - gs) ** 2 / (total_h - hs + ridge) - whole
            ok = (hs >= least) & (total_h - hs >= least)
            if monotone[f]:
                wl = np.clip(-gs / (hs + ridge), low, high)
                wr = np.clip(-(total_g - gs) / (total_h - hs + ridge), low, high)
                ok &= monotone[f] * (wr - wl) >= 0
            gain = np.where(ok, gain, -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), (f, k, gs[k], hs[k]))
        if best[1] is None:
            return
        f, k, gl, hl = best[1]
        goes_left = binned[members, f] <= k
        margin[members] -= value[at]
        feature[at], threshold[at], value[at] = f, float(cuts[f][k]), 0.0
        left[at], right[at] = node(), node()
        bounds_l, bounds_r = (low, high), (low, high)
        if monotone[f]:
            middle = (leaf_value(gl, hl, low, high) + leaf_value(total_g - gl, total_h - hl, low, high)) / 2
            bounds_l, bounds_r = ((low, middle), (middle, high)) if monotone[f] > 0 else ((middle, high), (low, middle))
        grow(left[at], members[goes_left], g, h, level + 1, *bounds_l)
        grow(right[at], members[~goes_left], g, h, level + 1, *bounds_r)

    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        roots.append(node())
        grow(roots[-1], np.arange(n), p - y, np.maximum(p * (1 - p), 1e-12), 0, -np.inf, np.inf)
    return Forest(base, feature, threshold, left, right, value, roots)
