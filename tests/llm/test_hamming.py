"""Exact search by sign codes against all distances."""

from __future__ import annotations

import numpy as np
import pytest

from turnmill.llm import hamming

SCHEMA = "vec_id long, embedding array<float>, code string, distance int"


def brute(rows, queries, k):
    """rows, queries: (id, vector); the (distance, id) of each query's k nearest."""
    rows = [(i, np.array(v) > 0) for i, v in rows if i is not None and v is not None and None not in v]
    out = []
    for i, v in queries:
        if i is not None and v is not None and None not in v:
            bits = np.array(v) > 0
            best = sorted((int((bits != b).sum()), j) for j, b in rows)[:k]
            out += [(i, r, j, d) for r, (d, j) in enumerate(best, 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.neighbor_id, r.distance) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("dimensions,block", [(64, 8192), (64, 50), (20, 100), (7, 8192), (130, 60)])
def test_blocks(spark, dimensions, block):
    """Clusters, a third of all rows copies of one vector, ties, codes of any width."""
    rng = np.random.default_rng(dimensions)
    centres = rng.standard_normal((8, dimensions))
    rows = [(i, (centres[i % 8] + rng.standard_normal(dimensions) * 0.4).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(9, rows[0][1]), (None, rows[1][1]), (5000, None), (5001, [None] * dimensions)]
    df = frame(spark, rows)
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0]
    got = hamming.top_k(df, df.where("vec_id % 20 = 0"), block_codes=block, block_queries=16)
    assert found(got) == brute(rows, queries, hamming.K)


def test_few_rows(spark):
    rows = [(1, [1.0, -1.0]), (2, [1.0, 1.0])]
    df = frame(spark, rows)
    assert found(hamming.top_k(df, df)) == brute(rows, rows, hamming.K)
    alone = hamming.top_k(df, df, with_itself=False)
    assert found(alone) == [(1, 1, 2, 1), (2, 1, 1, 1)]
    empty = df.where("vec_id < 0")
    assert hamming.top_k(empty, empty).collect() == [] and hamming.top_k(df, empty).collect() == []


def test_refused(spark):
    with pytest.raises(ValueError, match="vectors of 1 to 2"):
        hamming.top_k(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]), frame(spark, []))


def test_search_is_covered():
    """Every code within the k-th distance is met, whatever the radius at which a search ends."""
    rng = np.random.default_rng(0)
    codes = np.unique(np.packbits(rng.random((3000, 64)) < 0.5, axis=1), axis=0)
    near = np.packbits((rng.random((40, 64)) < 0.03) ^ np.unpackbits(codes[:40], axis=1).astype(bool), axis=1)
    counts = rng.integers(1, 4, len(codes))
    for queries in (near, codes[100:120]):
        for q, met, distance in hamming.Tables(codes).search(queries, counts, 5):
            every = np.bitwise_count(codes ^ queries[q]).sum(axis=1, dtype=np.int64)
            order = np.argsort(every, kind="stable")
            kth = every[order[np.searchsorted(np.cumsum(counts[order]), 5)]]
            assert set(met.tolist()) == set(np.flatnonzero(every <= kth).tolist()) and (every[met] == distance).all()
