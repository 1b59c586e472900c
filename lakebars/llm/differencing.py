"""Karmarkar-Karp multiway differencing: items into windows of near-equal sums."""

from __future__ import annotations

import heapq

import numpy as np


def differenced(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """The window of each item, and the sums of the windows.

    Each item starts as a partial partition of its own, with one filled window.
    The two partials of the largest spread are merged again and again, the
    fullest window of one with the emptiest of the other, so that their
    imbalances cancel. A window's items are kept as a binary tree: node `i` of
    the first `len(sizes)` is item `i`, a later one joins two nodes.
    """
    items = len(sizes)
    sums = {i: np.zeros(windows, np.int64) for i in range(items)}
    nodes = {i: np.full(windows, -1, np.int64) for i in range(items)}
    for i, size in enumerate(sizes):
        sums[i][0], nodes[i][0] = size, i
    heap = [(-int(size) if windows > 1 else 0, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    left, right, made = [], [], items
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums.pop(a) + sums.pop(b)[::-1]  # sums descend, so opposite ends meet
        one, two = nodes.pop(a), nodes.pop(b)[::-1]
        both = np.flatnonzero((one >= 0) & (two >= 0))
        merged = np.maximum(one, two)
        left.append(one[both])
        right.append(two[both])
        merged[both] = made + np.arange(len(both))
        made += len(both)
        order = np.argsort(-total, kind="stable")
        sums[a], nodes[a] = total[order], merged[order]
        heapq.heappush(heap, (int(total.min() - total.max()), a))
    place = np.full(made, -1, np.int64)
    if not heap:
        return place, np.zeros(windows, np.int64)
    last = heap[0][1]
    filled = nodes[last] >= 0
    place[nodes[last][filled]] = np.flatnonzero(filled)
    low, high = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    for node in range(made - 1, items - 1, -1):
        place[low[node - items]] = place[high[node - items]] = place[node]
    return place[:items], sums[last]


def near_equal_windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each item; the number of windows rises until none is over `capacity`."""
    if sizes.size and int(sizes.max()) > capacity:
        raise ValueError("an item is larger than a window")
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        place, sums = differenced(sizes, windows)
        over = sums[sums > capacity]
        if not over.size:
            return place
        windows += max(1, int((over - capacity).sum()) // capacity)
