"""Small boosted trees in numpy, fitted on the driver from a bounded sample of numbers.

A tree is complete: node ``i`` has children ``2i + 1`` and ``2i + 2``. All trees of a model
lie in three arrays, so rows are scored for all trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

INNER_NONE = -1


@dataclass
class Trees:
    feature: np.ndarray  # trees x inner nodes; -1: no split, go left
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves
    bias: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        n, t = len(x), len(self.feature)
        at = np.zeros((n, t), np.int64)
        tree, row = np.arange(t)[None, :], np.arange(n)[:, None]
        for _ in range(self.depth):
            f = self.feature[tree, at]
            right = (f >= 0) & (x[row, np.maximum(f, 0)] > self.threshold[tree, at])
            at = 2 * at + 1 + right
        return self.bias + self.value[tree, at - (2**self.depth - 1)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def cuts_of(x: np.ndarray, most: int = 63) -> list[np.ndarray]:
    """Thresholds per feature: middles between neighbouring quantiles."""
    out = []
    for column in x.T:
        v = np.unique(np.quantile(column, np.linspace(0, 1, most + 1)))
        out.append((v[1:] + v[:-1]) / 2)
    return out


def boost(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    ridge: float = 1.0,
    least: float = 5.0,
    monotone: dict[int, int] | None = None,
    draw: float = 1.0,
    seed: int = 7,
) -> Trees:
    """Logistic gradient boosting on histograms.

    ``monotone[f]`` is +1 if the score may only rise with feature ``f``, -1 if it may only
    fall: splits against it are refused, and the middle of a split bounds both sides below.
    Without rows the model is the bias alone. ``draw`` is the share of rows for each tree.
    """
    monotone, rng = monotone or {}, np.random.default_rng(seed)
    n, width = x.shape
    rate_of = (y.sum() + 1) / (n + 2)
    bias = float(np.log(rate_of / (1 - rate_of)))
    inner, leaves = 2**depth - 1, 2**depth
    feature = np.full((trees if n else 0, inner), INNER_NONE)
    threshold, value = np.zeros(feature.shape), np.zeros((len(feature), leaves))
    if not n:
        return Trees(feature, threshold, value, bias, depth)
    cuts = cuts_of(x)
    codes = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    bins = max(len(c) for c in cuts) + 1
    raw = np.full(n, bias)
    for t in range(trees):
        p = sigmoid(raw)
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        if draw < 1:
            used = rng.random(n) < draw
            g, h = g * used, h * used
        node = np.zeros(n, np.int64)
        low, high = np.full(2 * inner + 1, -np.inf), np.full(2 * inner + 1, np.inf)
        for i in range(inner):
            own = np.flatnonzero(node == i)
            best = (1e-6, None)
            if len(own):
                go, ho = g[own], h[own]
                total_g, total_h = go.sum(), ho.sum()
                for f in range(width):
                    gs = np.bincount(codes[own, f], go, bins).cumsum()[:-1]
                    hs = np.bincount(codes[own, f], ho, bins).cumsum()[:-1]
                    gr, hr = total_g - gs, total_h - hs
                    left, right = -gs / (hs + ridge), -gr / (hr + ridge)
                    gain = gs**2 / (hs + ridge) + gr**2 / (hr + ridge) - total_g**2 / (total_h + ridge)
                    count = np.bincount(codes[own, f], minlength=bins).cumsum()[:-1]
                    ok = (count >= least) & (len(own) - count >= least)
                    if monotone.get(f):
                        ok &= (right - left) * monotone[f] >= 0
                    gain = np.where(ok, gain, 0)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        sides = np.clip([left[k], right[k]], low[i], high[i])
                        best = (gain[k], (f, k, sides))
            a, b = 2 * i + 1, 2 * i + 2
            low[a], high[a], low[b], high[b] = low[i], high[i], low[i], high[i]
            if best[1] is None:
                node[own] = a
                continue
            f, k, sides = best[1]
            feature[t, i], threshold[t, i] = f, cuts[f][k]
            middle = float(sides.mean())
            if monotone.get(f) == 1:
                high[a], low[b] = min(high[a], middle), max(low[b], middle)
            elif monotone.get(f) == -1:
                low[a], high[b] = max(low[a], middle), min(high[b], middle)
            node[own] = np.where(codes[own, f] > k, b, a)
        leaf = node - inner
        sums_g, sums_h = np.bincount(leaf, g, leaves), np.bincount(leaf, h, leaves)
        value[t] = rate * np.clip(-sums_g / (sums_h + ridge), low[inner:], high[inner:])
        raw += value[t][leaf]
    return Trees(feature, threshold, value, bias, depth)
