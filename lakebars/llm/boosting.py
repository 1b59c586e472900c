"""Gradient-boosted trees for two classes, and isotonic calibration; fitted on a bounded sample, or on sums over spread rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

ROUNDS = 60
DEPTH = 3
RATE = 0.2
BINS = 64
SMOOTH = 1.0  # added to the second derivative of a leaf


@dataclass(frozen=True)
class Trees:
    base: float
    feature: np.ndarray  # rounds x inner nodes
    above: np.ndarray  # a row goes right if its value is above this
    leaf: np.ndarray  # rounds x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for feature, above, leaf in zip(self.feature, self.above, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > above[node])
            total += leaf[node - inner]
        return total


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Of a cut after each bin, from sums (node, feature, bin) that run along the bins."""
    all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
    return g**2 / (h + SMOOTH) + (all_g - g) ** 2 / (all_h - h + SMOOTH) - all_g**2 / (all_h + SMOOTH)


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Trees of one depth on quantile bins; a node that gains nothing sends all its rows left."""
    rows, features = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(features)]
    code = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(features)], axis=1)
    mean = (y.sum() + 0.5) / (rows + 1)
    base = float(np.log(mean / (1 - mean)))
    inner = 2**depth - 1
    trees = Trees(base, np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, inner + 1)))
    margin = np.full(rows, base)
    cell = np.arange(features) * BINS + code
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(rows, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (features * BINS) + cell).ravel()
            size = width * features * BINS
            shape = (width, features, BINS)
            g = np.bincount(at, np.repeat(slope, features), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(at, np.repeat(bend, features), size).reshape(shape).cumsum(axis=2)
            gain = _gain(g, h)
            for n in range(width):
                f, b = np.unravel_index(int(np.argmax(gain[n])), gain[n].shape)
                if gain[n, f, b] > 1e-6 and b < len(edges[f]):
                    trees.feature[r, first + n], trees.above[r, first + n] = f, edges[f][b]
            chosen = trees.feature[r, node]
            node = 2 * node + 1 + (x[np.arange(rows), chosen] > trees.above[r, node])
        leaf = node - inner
        g, h = (np.bincount(leaf, w, inner + 1) for w in (slope, bend))
        trees.leaf[r] = rate * g / (h + SMOOTH)
        margin += trees.leaf[r][leaf]
    return trees


BUCKET_BITS = 14  # of a 32-bit float that values of one bucket may differ in: 0.2 % of the value
WHOLE = float(1 << 24)  # derivatives are summed as whole multiples of 1 / WHOLE, so no sum depends on an order


def bucket_counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (feature and bucket of the value, in the order of values), and their rows."""
    bits = x.astype(np.float32).view(np.uint32)
    bucket = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.int64) >> BUCKET_BITS
    return np.unique((np.arange(x.shape[1]) << 32) + bucket, return_counts=True)


def add_counts(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, of = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, of, np.concatenate([a[1], b[1]]))
    return keys, counts


def bucket_edges(counts: tuple[np.ndarray, np.ndarray], features: int) -> list[np.ndarray]:
    """Quantiles of each feature, each value taken as the middle of its bucket."""
    found = []
    for f in range(features):
        here = (counts[0] >> 32) == f
        bits = (((counts[0][here] & 0xFFFFFFFF) << BUCKET_BITS) + (1 << (BUCKET_BITS - 1))).astype(np.uint32)
        values = np.where(bits >> 31, bits & np.uint32((1 << 31) - 1), ~bits).view(np.float32).astype(float)
        upto = np.cumsum(counts[1][here])
        place = (upto[-1] - 1) * np.arange(1, BINS) / BINS
        low, high = (values[np.searchsorted(upto, at, side="right")] for at in (np.floor(place), np.ceil(place)))
        found.append(np.unique(low + (high - low) * (place % 1)))
    return found


def codes(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each value."""
    return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)


def level_sums(code: np.ndarray, y: np.ndarray, trees: Trees, r: int, level: int) -> np.ndarray:
    """Sums of both derivatives by node, feature and bin, for `level` of tree `r` of `trees` over codes."""
    features = code.shape[1]
    done = Trees(trees.base, trees.feature[:r], trees.above[:r], trees.leaf[:r])
    p = 1 / (1 + np.exp(-done.margin(code)))
    node, rows = np.zeros(len(code), np.int64), np.arange(len(code))
    for _ in range(level):
        node = 2 * node + 1 + (code[rows, trees.feature[r, node]] > trees.above[r, node])
    width = 2**level
    at = ((node - width + 1)[:, None] * (features * BINS) + np.arange(features) * BINS + code).ravel()
    sums = [np.bincount(at, np.repeat(np.rint(w * WHOLE), features), width * features * BINS) for w in (y - p, p * (1 - p))]
    return np.stack(sums).reshape(2, width, features, BINS)


def grow_trees(
    edges: list[np.ndarray],
    mean: float,
    sums: Callable[[Trees, int, int], np.ndarray],
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    rate: float = RATE,
) -> Trees:
    """Trees from `level_sums` over all rows, wherever these are; `sums` is asked about trees over codes."""
    inner = 2**depth - 1
    base = float(np.log(mean / (1 - mean)))
    coded = Trees(base, np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, inner + 1)))
    above = np.full((rounds, inner), np.inf)
    for r in range(rounds):
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            g, h = (sums(coded, r, level) / WHOLE).cumsum(axis=3)
            gain = _gain(g, h)
            for n in range(width):
                f, b = np.unravel_index(int(np.argmax(gain[n])), gain[n].shape)
                split = gain[n, f, b] > 1e-6 and b < len(edges[f])
                if split:
                    coded.feature[r, first + n], coded.above[r, first + n], above[r, first + n] = f, b, edges[f][b]
                if level == depth - 1:
                    whole = np.array([g[n, 0, -1], h[n, 0, -1]])
                    left = np.array([g[n, f, b], h[n, f, b]]) if split else whole
                    for side, (slope, bend) in enumerate((left, whole - left)):
                        coded.leaf[r, 2 * n + side] = rate * slope / (bend + SMOOTH)
    return Trees(base, coded.feature, above, coded.leaf)


@dataclass(frozen=True)
class Isotonic:
    at: np.ndarray  # margins, ascending
    share: np.ndarray  # of the positive class, never falling

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.at, self.share)


def fit_isotonic(margin: np.ndarray, y: np.ndarray, weight: float = 0.5) -> Isotonic:
    """Pooled adjacent violators; each pool's share counts `weight` rows of either class besides its own."""
    points, of = np.unique(margin, return_inverse=True)  # rows of one margin belong together
    totals, counts = np.bincount(of, y), np.bincount(of)
    pools: list[list[float]] = []  # sum, rows, first margin, last margin
    for pool in zip(totals.tolist(), counts.tolist(), points.tolist(), points.tolist(), strict=True):
        pools.append(list(pool))
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            total, rows, _, last = pools.pop()
            pools[-1][0] += total
            pools[-1][1] += rows
            pools[-1][3] = last
    at = [edge for pool in pools for edge in (pool[2], pool[3])]
    share = [(pool[0] + weight) / (pool[1] + 2 * weight) for pool in pools for _ in range(2)]
    return Isotonic(np.array(at or [0.0]), np.maximum.accumulate(np.array(share or [0.5])))


def out_of_fold(x: np.ndarray, y: np.ndarray, folds: int = 3, **fit: float) -> np.ndarray:
    """Margins of rows by trees that have not seen them."""
    margin = np.zeros(len(x))
    fold = np.arange(len(x)) % folds
    for k in range(folds):
        if (fold == k).any() and (fold != k).any():
            margin[fold == k] = fit_trees(x[fold != k], y[fold != k], **fit).margin(x[fold == k])
    return margin
