"""Whitening against a dense retelling of the fit list, its covariance and eigenvectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from turnmill.llm import queries, whitening
from turnmill.plans.inputs import table

from .conftest import FOLDER


def whole(vector):
    return [math.floor(64 * float(c)) + 1_000_000 for c in vector]


def dense(rows):
    """(n, sums, eigenvalues falling, eigenvectors, trace) of the distinct x-vectors."""
    x = np.array(sorted({tuple(whole(v)) for v in rows}), dtype=np.int64)
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    return n, sums, values[::-1], vectors[:, ::-1], np.trace(covariance)


def check(found, rows, components=16):
    """``rows``: (id, vector) of those that count; all eigenvalues differ."""
    n, sums, values, vectors, trace = dense([v for _, v in rows])
    count = min(components, int((values > 1e-12 * trace).sum()))
    out = found.collect()
    assert len(out) == len(rows) * count
    by = {}
    for r in out:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    signs = {}
    for i, v in rows:
        gap = [n * a - int(s) for a, s in zip(whole(v), sums, strict=True)]
        own = by[i, sum(g * g for g in gap)]
        assert sorted(own) == list(range(1, count + 1))
        for c, same in own.items():
            want = float(np.dot(np.array(gap) / n, vectors[:, c - 1]) / math.sqrt(values[c - 1]))
            for r in same:
                sign = signs.setdefault(c, np.sign(r.whitened * want)) if abs(want) > 1e-6 else signs.get(c, 1)
                assert abs(r.whitened * sign - want) < 1e-8
                assert r.n == n and abs(r.explained / (values[c - 1] / trace) - 1) < 1e-9 and r.identity_error < 1e-9


def test_given(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, FOLDER, "embeddings").collect()]
    check(queries.op12_whitening(spark, FOLDER), rows)


def frame(spark, rows):
    more = [(*r, 1, "x", 2.0) for r in rows]
    return spark.createDataFrame(more, "vec_id long, embedding array<float>, component int, code string, whitened double")


def test_odd(spark):
    """Nulls, non-finite entries, null and repeated ids, many copies of one vector, clashing columns."""
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(40)]
    good += [(100 + i, good[0][1]) for i in range(60)] + [(None, good[1][1]), (7, good[2][1]), (8, [300.0, 0.5, -0.5, 0.0, 200.0])]
    bad = [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [float("nan"), *[0.0] * 4]), (53, [float("-inf"), *[0.0] * 4])]
    df = frame(spark, good + bad).repartition(4)
    check(whitening.whiten(df, whitening.fit(df)), good)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]])
def test_nothing_to_whiten(spark, rows):
    df = frame(spark, rows)
    assert whitening.whiten(df, whitening.fit(df)).collect() == []


def test_refused(spark):
    df = frame(spark, [(1, [1.0]), (2, [1.0, 2.0])])
    with pytest.raises(Exception, match="vectors of"):
        whitening.fit(df)


def test_low_rank(spark):
    """Three directions in ten dimensions: three components."""
    rng = np.random.default_rng(4)
    basis = rng.integers(-3, 4, (3, 10))
    rows = [(i, (rng.integers(-50, 50, 3) @ basis / 64).tolist()) for i in range(80)]
    df = frame(spark, rows)
    check(whitening.whiten(df, whitening.fit(df)), rows)


@pytest.mark.parametrize("values", [
    np.linspace(1, 100, 60), 10.0 ** np.linspace(-8, 6, 50), np.ones(30), np.r_[np.full(25, 5.0), np.linspace(0, 1, 20)],
    np.r_[[1e9], np.zeros(19)], [3.0], [2.0, 2.0 + 1e-9], np.r_[100 + 1e-10 * np.arange(12), np.linspace(1, 2, 20)],
])
def test_greatest(values):
    """Clustered, equal and widely spread eigenvalues."""
    values = np.array(values, dtype=np.float64)
    turn, _ = np.linalg.qr(np.random.default_rng(len(values)).standard_normal((len(values),) * 2))
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.greatest(matrix)
    want = np.sort(values)[::-1][: len(found)]
    size = max(values)
    assert len(found) == min(16, len(values)) and np.abs(found - want).max() < 1e-12 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * size


def test_inertia():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    inertia, values = whitening.Inertia(a), np.linalg.eigvalsh(a)
    for shift in np.linspace(values[0] - 1, values[-1] + 1, 50):
        assert inertia.from_on(shift) == (values >= shift).sum()
