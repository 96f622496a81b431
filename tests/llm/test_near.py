"""The chosen-path join against all pairs."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from turnmill.llm import near, queries

from .conftest import ODD


def shingles(text):
    words = [w for w in (text or "").lower().translate({c: " " for c in range(33)}).split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def all_pairs(rows):
    """doc -> (class, links, copies) by comparing every two sets that share a shingle."""
    sets = {i: frozenset(shingles(t)) for i, t in rows}
    by = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by[g].append(i)
    shared = defaultdict(lambda: defaultdict(int))
    for own in by.values():
        for x in own:
            for y in own:
                if x < y:
                    shared[x][y] += 1
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    links = dict.fromkeys(sets, 0)
    for x, others in shared.items():
        for y, n in others.items():
            if n >= 0.8 * (len(sets[x]) + len(sets[y]) - n):
                links[x] += 1
                links[y] += 1
                a, b = sorted((find(x), find(y)))
                top[b] = a
    copies = defaultdict(int)
    for i, s in sets.items():
        copies[s or i] += 1
    return {i: (find(i), links[i], copies[sets[i] or i]) for i in sets}


def compared(df, rows):
    got = {r["__a"]: (r.class_a, r.n_links, r.n_copies) for r in df.collect()}
    want = all_pairs(rows)
    assert got.keys() == want.keys()
    return {i: (got[i], want[i]) for i in want if got[i] != want[i]}


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_op10(spark, scale):
    folder = f"/root/testdata/sf{scale}"
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, folder).collect()]
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in queries.op10_ngram_join(spark, folder).collect()}
    assert got == all_pairs(rows)


def family(n, seed=0, words=120, changed=3):
    """Near copies of one text, a passage that all others share too, and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base, passage = [word() for _ in range(words)], [word() for _ in range(40)]
    out = []
    for i in range(n):
        if i % 3:
            text = [word() for _ in range(60)] + passage + [word() for _ in range(40)]
        else:
            text = list(base)
            for _ in range(rng.randrange(changed + 1)):
                text[rng.randrange(words)] = word()
        out.append((i, " ".join(text)))
    return out


def test_small_buckets(spark):
    """Buckets far over the size: split again, and at the last level compared block by block."""
    rows = family(180)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert compared(near.near_duplicates(docs, bucket=10, depth=2, recall=0.99999), rows) == {}


def test_odd(spark, odd, empty):
    rows = [(i, t) for i, t in enumerate(ODD)]
    found = near.near_duplicates(odd).collect()
    assert len(found) == len(rows)  # the repeated row once
    by = {r["__a"]: r for r in found}
    assert by[near.NO_ID].n_links == 2  # ODD[3], with a null id: "a", as two others
    for i in (0, 1, 2):
        assert (by[i].class_a, by[i].n_links, by[i].n_copies) == (i, 0, 1)
    same = ODD.index("same text")
    assert [(by[i].class_a, by[i].n_links, by[i].n_copies) for i in (same, same + 1)] == [(same, 1, 2)] * 2
    assert near.near_duplicates(empty).collect() == []
    kept = near.first_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    # 4, 5 and the row with the null id are one class, which the null id names.
    assert ids.count(None) == 1 and not {4, 5} & set(ids)
    assert same in ids and same + 1 not in ids


def test_embedding_estimates():
    rng = np.random.default_rng(0)
    for n in (20, 200, 2000):
        base = rng.integers(0, 2**63, 3 * n, dtype=np.uint64)
        a, b = np.unique(base[: 2 * n]), np.unique(base[n // 4 : 2 * n + n // 4])
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        seen = np.mean(near.embedding(a) == near.embedding(b))
        assert abs(seen - truth) < 5 * np.sqrt(truth * (1 - truth) / min(n, 128)) + 0.02


def test_large_group(spark):
    """One group of near copies that fills several blocks: every link is counted, one document stays."""
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(700):
        words = list(base)
        words[int(rng.integers(0, 120))] = f"x{i % 300}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(rng.choice(["a", "b", "c", "d"], 60))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    assert compared(near.near_duplicates(docs, recall=0.99999), rows) == {}


def test_clashing_columns(spark):
    rows = [(i, f"text number {i // 2} of a few", 1, 2, 3, {"k": "v"}) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __a long, set long, row long, path map<string,string>")
    kept = near.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [r for r in rows if r[0] % 2 == 0]


def test_texts_not_asked_for_stay(spark, monkeypatch):
    """Only texts of documents to compare are shuffled while their ids are few; the result is the same."""
    docs = spark.createDataFrame([(i, t) for i, t in family(30) + [(1000 + i, f"single {i}") for i in range(20)]], "doc_id long, text string")
    kind = "path long, i int, j int, set binary, a long, b long, copies long, place int, bits binary"
    asked = spark.createDataFrame([], kind)
    plan = near.verified(asked, docs, "doc_id", "text", 0.8)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    few = sorted(map(tuple, near.near_duplicates(docs).collect()))
    monkeypatch.setattr(near, "KNOWN_IDS", 1)
    assert sorted(map(tuple, near.near_duplicates(docs).collect())) == few
