"""Gradient-boosted trees over dense features, with isotonic calibration, in numpy: trained on the driver from a bounded sample, applied to batches.

Trees are complete binary trees of a fixed depth, so a batch walks all of them by array indexing, with no Python per row.
"""

from __future__ import annotations

import numpy as np


class Trees:
    """Boosted trees for a yes/no question."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, leaf: float = 2.0, ridge: float = 1.0, prior: bool = False):
        """prior: the first feature is log odds from which boosting starts."""
        self.rounds, self.depth, self.rate, self.bins, self.leaf, self.ridge, self.prior = rounds, depth, rate, bins, leaf, ridge, prior

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> Trees:
        n, f = x.shape
        w = np.ones(n) if w is None else w
        plain = bool((w == 1).all())  # rows of equal weight are counted
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) if n else np.zeros(0) for j in range(f)]
        wide = max((len(c) for c in self.cuts), default=0) + 1
        b = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], 1) if f else np.zeros((n, 0), int)
        place = (b + np.arange(f) * wide).astype(np.int64)  # each row's bin of each feature, features one after the other
        there = np.array([[k < len(c) for k in range(wide)] for c in self.cuts]).reshape(f, wide)  # bins with a cut above them
        p = np.clip(np.average(y, weights=w) if n else 0.5, 0.01, 0.99)
        self.base = float(np.log(p / (1 - p)))
        score, inner = x[:, 0].astype(float) if self.prior else np.full(n, self.base), 2**self.depth - 1
        self.feature, self.cut, self.value = [], [], []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = w * (y - p), w * p * (1 - p)
            feature, cut, at = np.zeros(inner, np.int32), np.full(inner, np.inf), np.zeros(n, np.int64)
            for d in range(self.depth):
                # The sums of a level's nodes, features and bins at once.
                nodes = 2**d
                key = ((at - (nodes - 1))[:, None] * (f * wide) + place).ravel()
                sums = [np.bincount(key, np.repeat(v, f), nodes * f * wide) for v in (g, h)] + [np.bincount(key, None if plain else np.repeat(w, f), nodes * f * wide)]
                gl, hl, wl = (np.cumsum(v.reshape(nodes, f, wide), axis=2) for v in sums)
                gt, ht, wt = gl[:, :, -1:], hl[:, :, -1:], wl[:, :, -1:]
                gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                gain[(wl < self.leaf) | (wt - wl < self.leaf) | ~there] = -1
                best = gain.reshape(nodes, -1).argmax(1)
                split = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-6
                j, k = best // wide, best % wide
                for m in np.flatnonzero(split):
                    feature[nodes - 1 + m], cut[nodes - 1 + m] = j[m], self.cuts[j[m]][k[m]]
                own = at - (nodes - 1)
                at = 2 * at + 1 + (split[own] & (b[np.arange(n), j[own]] > k[own]))
            leaves = at - inner
            gs, hs = np.bincount(leaves, g, inner + 1), np.bincount(leaves, h, inner + 1)
            value = self.rate * gs / (hs + self.ridge)
            score = score + value[leaves]
            self.feature.append(feature)
            self.cut.append(cut)
            self.value.append(value)
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds before calibration."""
        out, rows, inner = x[:, 0].astype(float) if self.prior else np.full(len(x), self.base), np.arange(len(x)), 2**self.depth - 1
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += value[at - inner]
        return out


class Isotonic:
    """A rising step function from scores to probabilities, by pooling adjacent violators; linear between the steps."""

    def fit(self, score: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> Isotonic:
        order = np.argsort(score, kind="stable")
        w = np.ones(len(y)) if w is None else w
        blocks: list[list[float]] = []
        for s, t, v in zip(score[order], y[order], w[order], strict=True):
            blocks.append([t * v, v, s, s])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                a = blocks.pop()
                blocks[-1] = [blocks[-1][0] + a[0], blocks[-1][1] + a[1], blocks[-1][2], a[3]]
        self.at = np.array([p for b in blocks for p in (b[2], b[3])] or [0.0])
        self.to = np.array([b[0] / b[1] for b in blocks for _ in (0, 1)] or [0.5])
        return self

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.at, self.to)


class Calibrated:
    """Trees whose scores are calibrated on rows their trees have not seen (folds by row number)."""

    def __init__(self, folds: int = 3, **trees):
        self.folds, self.options = folds, trees

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> Calibrated:
        w = np.ones(len(y)) if w is None else w
        fold, unseen = np.arange(len(y)) % self.folds, np.zeros(len(y))
        for k in range(self.folds):
            there = fold == k
            unseen[there] = Trees(**self.options).fit(x[~there], y[~there], w[~there]).raw(x[there])
        self.unseen = unseen
        self.trees, self.calibration = Trees(**self.options).fit(x, y, w), Isotonic().fit(unseen, y, w)
        return self

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.calibration(self.trees.raw(x)) if len(x) else np.zeros(0)
