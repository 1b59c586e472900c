"""Pairs of similar sets inside one block or between two, by signature trees.

A leaf of a tree is one set, with its size and a bitmap of its members; a node
holds the bits of all its children and the range of their sizes. Two trees are
walked together from the roots: a pair of nodes is followed only if the largest
overlap that their bitmaps and sizes allow could still reach the similarity.
What is left are pairs of leaves, whose overlap is then counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FANOUT = 8
LEAST_BITS, MOST_BITS = 256, 1 << 16
_PAIRS_AT_ONCE = 1 << 13  # of bitmaps of 64 words: 4 MB for each side


def bits_for(size: int) -> int:
    """Bits of the bitmap of a set, a power of two; similar sets have the same or neighbouring numbers."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (2 * max(1, size) - 1).bit_length()))


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """One row of 64-bit words for each set of well-mixed 64-bit members."""
    width = bits // 64
    members = np.concatenate(sets) & np.uint64(bits - 1)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    found = np.zeros(len(sets) * width, np.uint64)
    np.bitwise_or.at(found, row * width + (members >> np.uint64(6)).astype(np.int64), np.uint64(1) << (members & np.uint64(63)))
    return found.reshape(-1, width)


def folded(rows: np.ndarray, width: int) -> np.ndarray:
    """The bitmaps that `width` words would have had."""
    return np.bitwise_or.reduce(rows.reshape(len(rows), -1, width), axis=1)


class SignatureTree:
    """Over bitmaps and sizes of sets; `order` holds the places of the leaves, which stand by size."""

    def __init__(self, rows: np.ndarray, sizes: np.ndarray) -> None:
        self.order = np.argsort(sizes, kind="stable")
        rows, sizes = rows[self.order], sizes[self.order]
        # Members that share a bit with another of their set: an overlap may exceed the common bits by these.
        slack = sizes - np.bitwise_count(rows).sum(axis=1, dtype=np.int64)
        self.levels = [(rows, sizes, sizes, slack)]
        while len(self.levels[-1][0]) > 1:
            rows, low, high, slack = self.levels[-1]
            at = np.arange(0, len(rows), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(rows, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(slack, at),
                )
            )


def _possible(one: tuple, two: tuple, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether pairs of nodes may hold a pair of sets of similarity `num / den`."""
    keep = np.zeros(len(a), bool)
    step = max(1, (_PAIRS_AT_ONCE * 64) // one[0].shape[1])
    for start in range(0, len(a), step):
        x, y = a[start : start + step], b[start : start + step]
        low = one[1][x] + two[1][y]
        most = np.minimum(one[2][x], two[2][y])
        fits = den * most >= num * np.maximum(one[1][x], two[1][y])
        x, y, low, most = x[fits], y[fits], low[fits], most[fits]
        common = np.bitwise_count(one[0][x] & two[0][y]).sum(axis=1, dtype=np.int64)
        most = np.minimum(most, common + np.minimum(one[3][x], two[3][y]))
        keep[start + np.flatnonzero(fits)] = (num + den) * most >= num * low
    return keep


def candidate_leaves(one: SignatureTree, two: SignatureTree, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves that may be similar; within one tree each pair once."""
    alone = one is two
    depth = max(len(one.levels), len(two.levels))
    a = b = np.zeros(1, np.int64)
    for level in range(depth - 1, -1, -1):
        x, y = (tree.levels[min(level, len(tree.levels) - 1)] for tree in (one, two))
        keep = _possible(x, y, a, b, num, den)
        a, b = a[keep], b[keep]
        if level:
            a, b = _children(a, one, level, b, two)
            if alone:
                up = a <= b
                a, b = a[up], b[up]
    if alone:
        a, b = a[a < b], b[a < b]
    return a, b


def _children(a: np.ndarray, one: SignatureTree, level: int, b: np.ndarray, two: SignatureTree) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children; a tree that is not as deep as `level` stays at its root."""

    def fan(nodes: np.ndarray, tree: SignatureTree) -> np.ndarray:
        if level >= len(tree.levels):
            return nodes[:, None]
        return nodes[:, None] * FANOUT + np.arange(FANOUT)

    x, y = fan(a, one), fan(b, two)
    x, y = (v.ravel() for v in np.broadcast_arrays(x[:, :, None], y[:, None, :]))
    there = (x < len(one.levels[min(level, len(one.levels)) - 1][0])) & (y < len(two.levels[min(level, len(two.levels)) - 1][0]))
    return x[there], y[there]


def candidates(rows: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of sets that may be similar, from their bitmaps (`bits_for` bits each) alone.

    `side` parts the sets: with one value all pairs count, with two values
    those between them. Sets of equal width are joined with each other, and with
    those of wider ones, folded, up to the width of sets `den` / `num` times as
    large: of the next width alone from a similarity of one half on. No others can
    be similar to them.
    """
    widths = np.array([len(row) for row in rows])
    values = np.unique(side)
    found_a, found_b = [], []

    def trees(width: int, of: int) -> list[tuple[np.ndarray, SignatureTree]]:
        made = []
        for value in values:
            places = np.flatnonzero((widths == of) & (side == value))
            if len(places):
                words = folded(np.stack([rows[p] for p in places]), width)
                made.append((value, places, SignatureTree(words, sizes[places])))
        return made

    def join(one: tuple, two: tuple) -> None:
        a, b = candidate_leaves(one[2], two[2], num, den)
        found_a.append(one[1][one[2].order[a]])
        found_b.append(two[1][two[2].order[b]])

    for width in np.unique(widths).tolist():
        own, wider, times = trees(width, width), [], 2
        while times * num < 2 * den:
            wider += trees(width, times * width)
            times *= 2
        if len(values) == 1:
            join(own[0], own[0])
        elif len(own) == 2:
            join(own[0], own[1])
        for one in own:
            for two in wider:
                if len(values) == 1 or one[0] != two[0]:
                    join(one, two)
    return np.concatenate(found_a), np.concatenate(found_b)


def links(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, num: int, den: int) -> Iterator[tuple[int, int]]:
    """Enough similar pairs to connect all that are linked: a pair already connected here is left out."""
    sizes = np.array([len(s) for s in sets], np.int64)
    a, b = candidates([bitmaps([s], bits_for(len(s)))[0] for s in sets], sizes, side, num, den)
    if not len(a):
        return
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    members, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    group = np.arange(len(sets))
    marked = np.zeros(len(members), np.int64)
    cuts = np.flatnonzero(np.diff(a)) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(a)], strict=True):
        one = int(a[low])
        others = b[low:high]
        others = others[group[others] != group[one]]
        if not len(others):
            continue
        own = flat[ends[one] - sizes[one] : ends[one]]
        marked[own] = 1
        spread = marked[np.concatenate([flat[ends[o] - sizes[o] : ends[o]] for o in others.tolist()])]
        marked[own] = 0
        starts = np.cumsum(sizes[others]) - sizes[others]
        overlap = np.add.reduceat(spread, starts)
        near = others[(num + den) * overlap >= num * (sizes[one] + sizes[others])]
        for other in near.tolist():
            if group[other] != group[one]:
                group[group == group[other]] = group[one]
                yield int(ids[one]), int(ids[other])
