"""Nearest neighbours by collision counting over single projections.

Vectors are dealt into blocks of a bounded size. A block is indexed by random
projections, each kept as one sorted array. A query opens a window around its
own projection in every array; a vector collides once for each window it lies
in, and is verified by its true distance when it collides often enough. Windows
widen round by round (virtual rehashing: the arrays stay, only the new margins
are counted). A window stands for a radius: a vector at that distance reaches
the threshold in all but about one case in fifteen, a nearer one more surely.
The radius grows by a factor, but never past the distance of the k-th nearest
verified so far; once it is that distance, no wider window is opened. So the
vectors verified are those whose collisions place them within the distance of
the k-th nearest, and no share of the block is fixed beforehand. Where few are
verified, the windows widen on. Each block returns its nearest; the nearest of
those are the result.

Queries are dealt into blocks as well: a task holds one block of either, however
many vectors and queries there are. Every block of queries meets every block of
vectors, so with queries in proportion to the rows the work is quadratic.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEAREST = 10
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 1024
PROJECTIONS = 128
WINDOW = 2.7  # width of a window, in radii
MISSED = 1.5  # standard deviations by which a vector at the radius may collide less than expected
GROWTH = 1.3  # of the radius, at most, from round to round
ROUNDS = 64  # then the windows take in the whole block
EXTRA = 100  # vectors verified beyond `k`, at least


class BlockIndex:
    """The sorted projections of one block of vectors; `verified` counts the distances taken."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS, seed: int = 1) -> None:
        self.ids, self.vectors, self.verified = ids, vectors, 0
        size, dims = vectors.shape
        # Lengths are in units of the largest component, so that projections of any vectors are finite.
        self.unit = float(np.abs(vectors).max())
        self.axes = np.random.default_rng(seed + dims).standard_normal((dims, projections))
        hashed = (vectors / self.unit @ self.axes).T
        order = np.argsort(hashed, axis=1, kind="stable")
        # One sorted array behind the other, each moved to a stretch of its own.
        span = float(np.ptp(hashed)) or 1.0
        self.moved = np.arange(projections) * 2 * span - hashed.min()
        self.lowest, self.highest = self.moved + hashed.min() - span / 4, self.moved + hashed.max() + span / 4
        self.sorted = (np.take_along_axis(hashed, order, axis=1) + self.moved[:, None]).ravel()
        self.order = order.ravel()
        expected = projections * math.erf(WINDOW / 2 / math.sqrt(2))
        spread = math.sqrt(expected * (1 - expected / projections))
        self.need = max(1, math.floor(expected - MISSED * spread))
        self.first = self._first_radius(vectors[:: max(1, size // 64)] / self.unit)

    @staticmethod
    def _first_radius(some: np.ndarray) -> float:
        """Small against the distances between a few vectors of the block."""
        far = np.sqrt(((some[:, None] - some[::4]) ** 2).sum(axis=2))
        far = far[far > 0]
        return float(np.quantile(far, 0.02)) / 4 if far.size else 1.0

    def _between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The vectors at all places from a start to before its end."""
        sizes = ends - starts
        before = np.cumsum(sizes) - sizes
        return self.order[np.repeat(starts - before, sizes) + np.arange(sizes.sum())]

    def _search(self, query_id: object, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of the vectors verified for a query."""
        size = len(self.ids)
        others = size - int(np.count_nonzero(self.ids == query_id))
        wanted = min(k, others)
        found, far = np.zeros(0, np.int64), np.zeros(0)
        if wanted == 0:
            return found, far
        center = query / self.unit @ self.axes + self.moved
        hits, seen = np.zeros(size, np.int64), np.zeros(size, bool)
        radius, kth, low, high = self.first, np.inf, None, None
        for left in range(ROUNDS, -1, -1):
            half = WINDOW / 2 * radius if left else np.inf
            # Ends beyond an array's values stay in the gaps on either side of them.
            a = np.searchsorted(self.sorted, np.clip(center - half, self.lowest, self.highest), "left")
            b = np.searchsorted(self.sorted, np.clip(center + half, self.lowest, self.highest), "right")
            margin = [self._between(a, b)] if low is None else [self._between(a, low), self._between(high, b)]
            hits += np.bincount(np.concatenate(margin), minlength=size)
            low, high = a, b
            fresh = np.flatnonzero((hits >= self.need) & ~seen)
            seen[fresh] = True
            fresh = fresh[self.ids[fresh] != query_id]
            found = np.append(found, fresh)
            far = np.append(far, np.sqrt(((self.vectors[fresh] - query) ** 2).sum(axis=1)))
            if len(far) >= wanted:
                kth = float(np.partition(far, wanted - 1)[wanted - 1]) / self.unit
            enough = len(far) >= min(others, wanted + EXTRA)
            if enough and radius >= kth:
                break
            radius = radius * GROWTH if radius >= kth else min(radius * GROWTH, kth)
        return found, far

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[object, np.ndarray, np.ndarray]]:
        """For each query the ids and distances of up to `k` vectors, nearest first; its own id is left out."""
        for query_id, query in zip(query_ids, queries, strict=True):
            found, far = self._search(query_id, query, k)
            self.verified += len(found)
            if len(found):
                best = np.lexsort((self.ids[found], far))[:k]
                yield query_id, self.ids[found[best]], far[best]


def usable(vector: str) -> Column:
    """True for vectors with components, all of them finite, that are not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    asks: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = NEAREST,
    block_vectors: int = BLOCK_VECTORS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the nearest found of each row that `asks` holds for.

    `score` is the Euclidean distance in double precision; ties go to the
    smaller id. Vectors that are null, empty, zero or not finite take no part,
    nor do rows without an id; a query meets only vectors of its own length. Of
    rows that repeat an id each is a candidate, none for its own id, and one of
    them (the smallest vector) asks. Other columns take no part. No usable
    vectors, no rows.
    """
    clean = vectors.filter(F.col(vec_id).isNotNull() & usable(vector)).select(
        F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), asks.alias("asks")
    )
    n = clean.agg(F.count("*").alias("all"), F.count(F.when(F.col("asks"), 1)).alias("asking")).first()
    blocks, query_blocks = -(-n["all"] // block_vectors) or 1, -(-n["asking"] // block_queries) or 1
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    deal = lambda count: F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).cast("int")
    rows = clean.select("vec_id", "v", F.size("v").alias("dims"), deal(blocks).alias("b"), every(query_blocks).alias("q"))
    asking = clean.filter("asks").groupBy("vec_id").agg(F.min("v").alias("v"))
    asking = asking.select("vec_id", "v", F.size("v").alias("dims"), deal(query_blocks).alias("q"))
    asking = asking.select("*", every(blocks).alias("b"))
    kind = clean.schema["vec_id"].dataType.simpleString()

    def search(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if block.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        index = BlockIndex(block["vec_id"].to_numpy(), np.stack(block["v"].to_numpy()))
        found = list(index.nearest(queries["vec_id"].to_numpy(), np.stack(queries["v"].to_numpy()), k))
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.DataFrame(
            {
                "query_id": np.repeat([f[0] for f in found], [len(f[1]) for f in found]),
                "vec_id": np.concatenate([f[1] for f in found]),
                "score": np.concatenate([f[2] for f in found]),
            }
        )

    keys = ["b", "q", "dims"]
    near = rows.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(
        search, f"query_id {kind}, vec_id {kind}, score double"
    )
    # Each block sends at most k rows for a query, and Spark keeps k of those in each task before the shuffle.
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")).alias("rank")
    return near.select("query_id", place, "vec_id", "score").filter(F.col("rank") <= k)
