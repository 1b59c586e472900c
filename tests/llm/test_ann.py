from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakebars.llm.collision_ann import BlockIndex, nearest


def brute(rows, asks, k):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    found = {}
    for query in sorted({i for i, _ in usable if asks(i)}):
        vector = min((v.tolist() for i, v in usable if i == query))
        near = [(float(np.sqrt(((v - vector) ** 2).sum())), i) for i, v in usable if i != query and len(v) == len(vector)]
        found[query] = sorted(near)[:k]
    return found


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_odd_vectors(spark, block):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]  # copies: ties go to the smaller id
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [1.0, None] * 4), (204, [float("nan")] * 8)]
    rows += [(205, [float("inf")] * 8), (None, rows[0][1]), (20, rows[1][1]), (206, [1.0, 2.0]), (210, [1.0, 2.5])]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, v string, asks string")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = {}
    for r in nearest(table, F.col("vec_id") % 10 == 0, block_vectors=block, block_queries=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    want = brute(rows, lambda i: i % 10 == 0, 10)
    want = {q: near for q, near in want.items() if near}
    assert got.keys() == want.keys()
    for query, near in want.items():
        ranks, scores, ids = zip(*sorted(got[query]), strict=True)
        assert ranks == tuple(range(1, len(near) + 1))
        assert np.allclose(scores, [s for s, _ in near], rtol=0, atol=1e-9)
        assert list(ids) == [i for _, i in near]


def test_no_rows(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(table, F.col("vec_id") % 10 == 0).count() == 0


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall_with_at_most_half_verified(sf):
    table = duckdb.sql(f"SELECT vec_id, embedding FROM '/root/testdata/sf{sf}/embeddings.parquet' ORDER BY vec_id")
    ids, vectors = (np.array(c) for c in zip(*table.fetchall(), strict=True))
    asks = ids % 100 == 0
    index = BlockIndex(ids, vectors.astype(float))
    got = {q: set(near.tolist()) for q, near, _ in index.nearest(ids[asks], vectors[asks].astype(float), 10)}
    want = brute(list(zip(ids.tolist(), vectors.tolist(), strict=True)), lambda i: i % 100 == 0, 10)
    assert got.keys() == want.keys()
    hits = sum(len(got[q] & {i for _, i in near}) for q, near in want.items())
    assert hits >= 0.9 * 10 * len(want)
    assert index.verified <= 0.5 * len(ids) * len(want)


def test_queries_and_vectors_of_any_size():
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((400, 8)) * 10.0 ** rng.integers(-9, 9, (400, 1))
    vectors = np.concatenate([vectors, np.repeat(vectors[:1], 300, axis=0), [[1e150] * 8]])
    ids = np.arange(len(vectors))
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)]
    index = BlockIndex(ids, vectors)
    queries = np.arange(0, 400, 50)
    hits = 0
    for query, near, far in index.nearest(queries, vectors[queries], 10):
        want = brute(rows, lambda i, query=query: i == query, 10)[query]
        assert len(near) == 10 and all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(sorted(far), far, strict=True))
        hits += len({i for _, i in want} & set(near.tolist()))
    assert hits >= 0.9 * 10 * len(queries)
    alone = BlockIndex(np.array([3]), np.ones((1, 4)))
    assert list(alone.nearest(np.array([3]), np.ones((1, 4)), 10)) == []
