"""Collections in buckets and versions, and the index of inverted lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnmill.operators import ivf, vectors
from turnmill.plans import inputs
from turnmill.sources import collections

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "chunk_id string, text string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def held(spark, path):
    return {r.chunk_id: r.text for r in collections.read_collection(spark, path).collect()}


def test_one_id_rewrites_one_bucket(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = [(f"c{i}", "old") for i in range(300)]
    assert collections.upsert_collection(spark, path, frame(spark, rows), buckets=8) == 300
    before = collections.newest(spark, path)
    assert len(before.held) == 8 and collections.count_collection(spark, path) == 300
    assert collections.upsert_collection(spark, path, frame(spark, [("c7", "new")])) == 300
    after = collections.newest(spark, path)
    assert after.number == 2 and sum(before.held[b] != after.held[b] for b in after.held) == 1
    assert held(spark, path) == {**dict(rows), "c7": "new"}


def test_batches(spark, tmp_path, monkeypatch):
    """Large buckets over several files, repeated ids, extra and reordered columns, empty batches."""
    monkeypatch.setattr(collections, "ROWS_PER_FILE", 10)
    path = str(tmp_path / "c")
    rows = [(f"c{i}", str(i)) for i in range(200)]
    collections.upsert_collection(spark, path, frame(spark, rows), buckets=2)
    assert len(list((tmp_path / "c/data").glob("*/bucket=0/part-*"))) > 3
    with pytest.raises(Exception, match="repeated id"):
        collections.upsert_collection(spark, path, frame(spark, [("x", "1"), ("x", "2")]))
    twice = frame(spark, [(1, "x", "1", "c3"), (3, "y", "3", "c4"), (2, "z", "2", "c3")], "n int, other string, text string, chunk_id string")
    assert collections.upsert_collection(spark, path, twice, order="n") == 200
    assert collections.upsert_collection(spark, path, frame(spark, [])) == 200
    assert held(spark, path) == {**dict(rows), "c3": "2", "c4": "3"}
    empty = str(tmp_path / "empty")
    assert collections.upsert_collection(spark, empty, frame(spark, [])) == 0 and held(spark, empty) == {}


@pytest.mark.parametrize("rival,rewrites", [("c5", 2), ("other", 1)])
def test_losing_writer_retries(spark, tmp_path, monkeypatch, rival, rewrites):
    """Another writer commits first: nothing of either is lost; only a bucket of ours that it changed is merged again."""
    path = str(tmp_path / "c")
    collections.upsert_collection(spark, path, frame(spark, [("c5", "old"), ("other", "old")]), buckets=1024)
    commit, rewrite, count = collections.commit, collections._rewrite, []

    def late(*args):
        monkeypatch.setattr(collections, "commit", commit)
        collections.upsert_collection(spark, path, frame(spark, [(rival, "rival"), (rival + "+", "rival")]))
        count.clear()
        count.append(1)
        return commit(*args)

    monkeypatch.setattr(collections, "_rewrite", lambda *a: count.append(1) or rewrite(*a))
    monkeypatch.setattr(collections, "commit", late)
    assert collections.upsert_collection(spark, path, frame(spark, [("c5", "new")])) == 3
    assert len(count) == rewrites
    want = {"c5": "new", "other": "old", rival + "+": "rival"}
    assert held(spark, path) == (want if rival == "c5" else {**want, "other": "rival"})
    assert collections.newest(spark, path).number == 3


def recall(exact, found):
    return exact.join(found, ["query_id", "chunk_id"], "left_semi").count() / exact.count()


def tables(spark, points, queries, n=6):
    members = [(i, p.tolist()) for i, p in enumerate(points)]
    asked = [(i, p.tolist()) for i, p in enumerate(queries)]
    return (
        frame(spark, members, "chunk_id long, embedding array<float>").repartition(n),
        frame(spark, asked, "query_id long, embedding array<float>").repartition(3),
    )


def test_ivf_on_clusters(spark):
    """Clustered vectors: nine of ten neighbours at a tenth of all pairs; small blocks find the same."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((100, 32))
    points = centres[rng.integers(0, 100, 8000)] + 0.25 * rng.standard_normal((8000, 32))
    points[:2500] = points[0]  # a third of all rows is one vector
    queries = points[3000:3200] + 0.05 * rng.standard_normal((200, 32))
    members, asked = tables(spark, points, queries)
    index = ivf.build(members, sample=4000)
    found = ivf.search(index, asked).cache()
    assert recall(vectors.top_k(asked, members), found) >= 0.9
    assert ivf.work(index, asked) <= 0.1
    assert found.count() == 1000
    blocks = ivf.search(index, asked, queries_per_block=16, members_per_block=500)
    assert recall(found, blocks) > 0.99


def test_ivf_on_given_vectors(spark):
    vecs = inputs.table(spark, FOLDER, "embeddings")
    members, asked = (vecs.select(F.col("vec_id").alias(k), "embedding") for k in ("chunk_id", "query_id"))
    found = ivf.search(ivf.build(members), asked)
    assert recall(vectors.top_k(asked, members), found) >= 0.9


def test_ivf_of_few(spark):
    members, asked = tables(spark, np.array([[0.0, 1.0], [1.0, 0.0], [1.0, 0.0]]), np.array([[1.0, 0.1]]))
    found = sorted((r["rank"], r.chunk_id) for r in ivf.search(ivf.build(members), asked).collect())
    assert found == [(1, 1), (2, 2), (3, 0)]
    nothing = members.where("chunk_id < 0")
    assert ivf.search(ivf.build(nothing), asked.where("query_id < 0")).collect() == []


def test_ivf_sends_no_query_to_each_list(spark):
    """Queries are sent to one block each, and candidates are measured where they are found."""
    vecs = inputs.table(spark, FOLDER, "embeddings")
    members, asked = (vecs.select(F.col("vec_id").alias(k), "embedding") for k in ("chunk_id", "query_id"))
    found = ivf.search(ivf.build(members), asked)
    assert "FlatMapCoGroupsInArrow" not in found._jdf.queryExecution().toString()
    found.write.format("noop").mode("overwrite").save()


@pytest.mark.parametrize("held", [1, 2_000_000])
def test_ivf_block_holds_the_best(monkeypatch, held):
    """Like all codes of the visited lists sorted at once; of equal ones the first met."""
    monkeypatch.setattr(ivf, "HELD", held)
    monkeypatch.setattr(ivf, "PAIRS", 700)
    rng = np.random.default_rng(3)
    points = np.round(rng.standard_normal((600, 8)), 1)
    points[100:160] = points[100]
    lists = ivf.train(points, 12)
    own = lists.list_of(points)
    order = np.argsort(own, kind="stable")
    rows = np.bincount(own, minlength=len(lists.centres))
    asked, probes, measured, k = points[90:130], 5, 20, 3
    block = ivf.Block(lists, rows, pa.array(range(len(asked))), asked, probes, measured)
    want = []
    for i, seen in enumerate(ivf._visits(lists, rows, asked, probes, measured)):
        rough = np.full(len(points), np.inf, dtype=np.float32)
        for l in np.flatnonzero(seen):
            mine = np.flatnonzero(own == l)
            rough[mine] = lists.rough(asked[i : i + 1] - lists.centres[l], lists.codes(points[mine] - lists.centres[l]))[0]
        best = order[np.argsort(rough[order], kind="stable")[:measured]]
        exact = ((points[best] - asked[i]) ** 2).sum(axis=1)
        want += [(i, int(c)) for c in best[np.lexsort((best, exact.round(9)))[:k]]]
    for l in range(len(rows)):
        mine = np.flatnonzero(own == l)
        block.meet(l, pa.array(mine), lists.codes(points[mine] - lists.centres[l]), points[mine])
    names, ids = block.nearest(k)
    assert sorted(zip(names.to_pylist(), ids.to_pylist())) == sorted(want)
    assert len(block.ids[0]) <= len(asked) * measured


def test_ivf_of_repeated_rows(spark):
    """Text ids, rows that come twice, blocks of one query."""
    rng = np.random.default_rng(4)
    points = rng.standard_normal((60, 4))
    members = frame(spark, [(f"c{i % 40}", points[i % 40].tolist()) for i in range(60)], "chunk_id string, embedding array<double>")
    asked = frame(spark, [(i % 5, points[i % 5].tolist()) for i in range(7)], "query_id int, embedding array<double>")
    found = ivf.search(ivf.build(members), asked, k=2, queries_per_block=1).collect()
    assert {(r.query_id, r.chunk_id) for r in found} == {(i, f"c{i}") for i in range(5)}
    assert {r["rank"] for r in found} == {1, 2} and len(found) == 10


def block_against_all(points, asked, n_lists, probes, measured, k):
    """What a block finds, and the k nearest of the best codes of the visited lists, sorted at once."""
    lists = ivf.train(points, n_lists)
    own = lists.list_of(points)
    codes = lists.codes(points - lists.centres[own])
    rows = np.bincount(own, minlength=len(lists.centres))
    block = ivf.Block(lists, rows, pa.array(range(len(asked))), asked, probes, measured)
    met = np.argsort(own, kind="stable")
    want = []
    for i, seen in enumerate(ivf._visits(lists, rows, asked, probes, measured)):
        mine = met[seen[own[met]]]
        gap = asked[i] - lists.centres[own[mine]] - lists.coded(codes[mine])
        best = mine[np.argsort(np.cumsum(gap * gap, axis=1)[:, -1].astype(np.float32), kind="stable")[:measured]]
        exact = ((points[best] - asked[i]) ** 2).sum(axis=1)
        want += [(i, int(c)) for c in best[np.lexsort((best, exact))[:k]]]
    for l in range(len(rows)):
        mine = met[own[met] == l]
        for some in (mine[:90], mine[90:]):
            if len(some):
                block.meet(l, pa.array(some), codes[some], points[some])
    names, ids = block.nearest(k)
    return set(zip(names.to_pylist(), ids.to_pylist())), set(want)


@pytest.mark.parametrize("away", [0.0, 1e4])
def test_ivf_measures_few_codes(monkeypatch, away):
    """Codes are ruled out by products of matrices, not measured piece by piece; far from the origin, too."""
    finds, hold = [], ivf.Block._hold

    def counted(self, row, *rest):
        finds.append(len(row))
        hold(self, row, *rest)

    def refused(*_):
        raise AssertionError("every code of a list is measured")

    monkeypatch.setattr(ivf.Lists, "rough", refused)
    monkeypatch.setattr(ivf.Block, "_hold", counted)
    points = away + np.random.default_rng(6).standard_normal((6000, 16))
    got, want = block_against_all(points, points[:200] + 0.01, 40, 40, 20, 5)
    assert len(want) == 1000 and len(got & want) >= 998
    assert sum(finds) < 200 * 6000 * 0.05


def test_ivf_of_one_hot_vector(monkeypatch):
    """Of equal codes a list has, only those met first are measured."""
    finds, hold = [], ivf.Block._hold

    def counted(self, row, *rest):
        finds.append(len(row))
        hold(self, row, *rest)

    monkeypatch.setattr(ivf.Block, "_hold", counted)
    rng = np.random.default_rng(7)
    points = rng.standard_normal((4000, 12))
    points[rng.random(4000) < 0.5] = points[3]
    hot = np.flatnonzero((points == points[3]).all(axis=1))
    asked = np.concatenate([points[hot[:50]], points[-50:]])
    got, want = block_against_all(points, asked, 30, 10, 25, 5)
    assert got == want
    assert {c for q, c in got if q < 50} == set(hot[:5].tolist())
    assert sum(finds) < 100 * 1000


def test_ivf_places():
    rng = np.random.default_rng(8)
    for shape in ((3, 5), (8, 16), (1, 7), (4, 33)):
        mask = rng.random(shape) < 0.2
        assert all((a == b).all() for a, b in zip(ivf._where(mask), np.nonzero(mask), strict=True))
    codes = rng.integers(0, 2, (200, 3)).astype(np.uint8)
    order, begins, counts = ivf._distinct(codes, 4)
    for b, n in zip(begins, counts, strict=True):
        assert order[b : b + n].tolist() == np.flatnonzero((codes == codes[order[b]]).all(axis=1))[:4].tolist()
    assert len(begins) == len(np.unique(codes, axis=0)) and counts.sum() == len(order)
    assert ivf._distinct(np.arange(40, dtype=np.uint8).reshape(20, 2), 4) is None


def test_ivf_block_measures_no_whole_list(monkeypatch):
    """A block meets its lists without the table of every query and code."""

    def refused(*_):
        raise AssertionError("every code of a list is measured")

    points = np.random.default_rng(9).standard_normal((900, 8))
    lists = ivf.train(points, 10)
    own = lists.list_of(points)
    rows = np.bincount(own, minlength=len(lists.centres))
    monkeypatch.setattr(ivf.Lists, "rough", refused)
    block = ivf.Block(lists, rows, pa.array(range(50)), points[:50], len(rows), 30)
    for l in np.flatnonzero(rows):
        mine = np.flatnonzero(own == l)
        block.meet(l, pa.array(mine), lists.codes(points[mine] - lists.centres[l]), points[mine])
    names, ids = block.nearest(1)
    assert names.to_pylist() == ids.to_pylist() == list(range(50))
