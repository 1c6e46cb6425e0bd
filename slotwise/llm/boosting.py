"""Gradient-boosted trees in numpy: fitted on the driver on bounded input, flattened for vectorised scoring.

The input is a bounded sample, or the different rows of a whole table with the number of their copies.

Trees are complete binary trees of one depth, stored as arrays (tree, node), so that scoring a batch is one gather per
tree and level. A split without gain sends all rows left. Features may be held monotonic: +1 for a score that never
falls as the feature rises, -1 for one that never rises.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    base: float
    feature: np.ndarray  # (trees, inner nodes) int
    threshold: np.ndarray  # (trees, inner nodes) float: at most goes left
    value: np.ndarray  # (trees, leaves) float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1 for each row. Not-a-number goes left."""
        x = np.nan_to_num(np.asarray(x, np.float64), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        out = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while inner and node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.score(x), -40, 40)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: np.ndarray | None = None,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    ridge: float = 1.0,
    least: int = 5,
    copies: np.ndarray | None = None,
    weight: np.ndarray | None = None,
) -> Trees:
    """Boosting of the logistic loss over quantile bins. Repeatable: no randomness. One class alone gives a constant.

    A row stands for `copies` equal ones, each of which has the given `weight`.
    """
    x, y = np.nan_to_num(np.asarray(x, np.float64)), np.asarray(y, np.float64)
    n, width = x.shape
    copies = np.ones(n, np.int64) if copies is None else np.asarray(copies, np.int64)
    heavy = copies * (1.0 if weight is None else np.asarray(weight, np.float64))
    inner, leaves = 2**depth - 1, 2**depth
    share = ((heavy * y).sum() + 0.5) / (heavy.sum() + 1)
    model = Trees(float(np.log(share / (1 - share))), np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    if n == 0 or y.min() == y.max():
        return model
    signs = np.zeros(width, int) if monotone is None else np.asarray(monotone, int)
    places = np.floor(np.linspace(0, 1, bins + 1)[1:-1] * (copies.sum() - 1))
    orders = [np.argsort(x[:, f], kind="stable") for f in range(width)]
    cuts = [np.unique(x[o, f][np.searchsorted(np.cumsum(copies[o]), places, side="right")]) for f, o in enumerate(orders)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], axis=1)
    cell = binned + np.arange(width) * bins
    score = np.full(n, model.base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, curve = heavy * (p - y), heavy * np.maximum(p * (1 - p), 1e-9)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        low, high = np.full(inner + leaves, -np.inf), np.full(inner + leaves, np.inf)
        node = np.zeros(n, int)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            flat = ((node - first)[:, None] * (width * bins) + cell).ravel()
            size = count * width * bins
            shape = (count, width, bins)
            g = np.bincount(flat, np.repeat(gradient, width), size).reshape(shape)
            h = np.bincount(flat, np.repeat(curve, width), size).reshape(shape)
            c = np.bincount(flat, np.repeat(copies, width), size).reshape(shape)
            gl, hl, cl = g.cumsum(2), h.cumsum(2), c.cumsum(2)
            gt, ht, ct = gl[:, :, -1:], hl[:, :, -1:], cl[:, :, -1:]
            left, right = -gl / (hl + ridge), -(gt - gl) / (ht - hl + ridge)
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            legal = (cl >= least) & (ct - cl >= least) & ((right - left) * signs[None, :, None] >= 0)
            for f in range(width):
                legal[:, f, len(cuts[f]) :] = False
            gain = np.where(legal, gain, -1.0).reshape(count, -1)
            for k in range(count):
                at, best = first + k, int(gain[k].argmax())
                low[2 * at + 1 : 2 * at + 3], high[2 * at + 1 : 2 * at + 3] = low[at], high[at]
                if gain[k, best] <= 1e-12:
                    continue
                f, b = divmod(best, bins)
                feature[at], threshold[at] = f, cuts[f][b]
                if signs[f]:
                    middle = np.clip((left[k, f, b] + right[k, f, b]) / 2, low[at], high[at])
                    lower, upper = (1, 2) if signs[f] > 0 else (2, 1)
                    high[2 * at + lower], low[2 * at + upper] = middle, middle
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        gs, hs = np.bincount(leaf, gradient, leaves), np.bincount(leaf, curve, leaves)
        value = rate * np.clip(-gs / (hs + ridge), low[inner:], high[inner:])
        score += value[leaf]
        features.append(feature), thresholds.append(threshold), values.append(value)
    return Trees(model.base, np.array(features), np.array(thresholds), np.array(values))


def precise_threshold(probability: np.ndarray, truth: np.ndarray, precision: float, least: float = 0.5, copies: np.ndarray | None = None) -> float:
    """Lowest probability from which on held-out rows reach the precision; above all of them if none does."""
    order = np.argsort(-probability, kind="stable")
    p, t = probability[order], truth[order].astype(float)
    if not len(p):
        return 1.0
    many = np.ones(len(p), np.int64) if copies is None else np.asarray(copies, np.int64)[order]
    reached = np.cumsum(many * t) / np.cumsum(many) >= precision
    last = np.append(p[1:] != p[:-1], True)  # equal scores stand or fall together
    good = np.flatnonzero(reached & last)
    return max(least, float(p[good[-1]])) if len(good) else 1.0
