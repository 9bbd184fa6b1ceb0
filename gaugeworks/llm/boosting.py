"""Gradient-boosted trees for several classes, on binned features."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

BINS = 32


@dataclass
class Trees:
    """Complete binary trees of one depth. ``feature``, ``cut``: by tree and inner node; ``leaf``: by
    tree and leaf; tree ``i`` adds to the score of class ``i % classes``."""

    feature: Any
    cut: Any
    leaf: Any
    classes: int

    def log_probabilities(self, x):
        import numpy as np

        scores = np.zeros((len(x), self.classes))
        depth = int(np.log2(self.leaf.shape[1]))
        rows = np.arange(len(x))
        for i, (feature, cut, leaf) in enumerate(zip(self.feature, self.cut, self.leaf, strict=True)):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            scores[:, i % self.classes] += leaf[at - (len(leaf) - 1)]
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def fit(x, y, classes: int, weight=None, rounds: int = 40, depth: int = 4, rate: float = 0.25) -> Trees:
    """Trees fitted to the softmax loss by Newton steps, one tree per class and round."""
    import numpy as np

    n, width = x.shape
    weight = np.ones(n) if weight is None else weight
    cuts = np.stack([np.quantile(x[:, j], np.arange(1, BINS) / BINS) for j in range(width)])
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(width)], axis=1)
    inner, leaves = 2**depth - 1, 2**depth
    columns = np.arange(width) * BINS
    scores = np.zeros((n, classes))
    target = np.eye(classes)[y]
    found = []
    for _ in range(rounds):
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for k in range(classes):
            g, h = (target[:, k] - p[:, k]) * weight, np.maximum(p[:, k] * (1 - p[:, k]), 1e-6) * weight
            feature, cut, bin_ = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, BINS)
            node = np.zeros(n, np.int64)
            for level in range(depth):
                first, count = 2**level - 1, 2**level
                key = ((node - first)[:, None] * (width * BINS) + columns[None, :] + binned).ravel()
                size = count * width * BINS
                sums = [
                    np.bincount(key, np.repeat(v, width), size).reshape(count, width, BINS).cumsum(axis=2)
                    for v in (g, h)
                ]
                (gl, hl), (gt, ht) = sums, (s[:, :, -1:] for s in sums)
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[:, :, -1] = 0
                gain[(hl < 1e-3) | (ht - hl < 1e-3)] = 0
                best = gain.reshape(count, -1).argmax(axis=1)
                for i in range(count):
                    if gain.reshape(count, -1)[i, best[i]] > 1e-6:
                        j, b = divmod(int(best[i]), BINS)
                        feature[first + i], cut[first + i], bin_[first + i] = j, cuts[j][b], b
                node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > bin_[node])
            at = node - inner
            value = rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + 1)
            scores[:, k] += value[at]
            found.append((feature, cut, value))
    feature, cut, leaf = map(np.array, zip(*found, strict=True))
    return Trees(feature, cut, leaf, classes)
