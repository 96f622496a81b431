"""The filter audit against a plain retelling of its five filters."""

from __future__ import annotations

import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from turnmill.llm import audit

from .conftest import ODD

LABELS = "doc_id long, quality int, toxic int"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    capitals = len(re.findall(r"[A-Z]", text))
    return len(words), len(set(words)), capitals, len(text), len(re.findall(r"[#$%&*|]", text))


def masks(rows):
    """rows: (doc_id, text, part)"""
    out = []
    for doc_id, text, _ in rows:
        words, distinct, capitals, points, symbols = plain(text or "")
        same = [i for i, t, _ in rows if (t or "") == (text or "") and i is not None]
        copy = doc_id is not None and min(same) < doc_id
        fails = (words < 50, 100 * distinct < 65 * words, 100 * capitals > 5 * points, symbols > 0, copy)
        out.append("".join(x for x, f in zip("ABCDE", fails, strict=True) if f))
    return out


def expected(rows, labels):
    fails = masks(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    orders = ["".join(o) for o in permutations("ABCDE")]
    out, removed_by = {}, {}
    for part in {p or "" for _, _, p in rows}:
        own = [(i, f) for (i, _, p), f in zip(rows, fails, strict=True) if (p or "") == part]
        for order in orders:
            left = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                failing = [x for x in own if letter in x[1]]
                out[part, order, step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(x[1] == letter for x in own),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone),
                ]
                removed_by[part, letter] = removed_by.get((part, letter), 0) + len(gone)
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def counted(found):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = found.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def test_odd(spark, odd, empty):
    """Null and repeated ids, null labels, null parts, clashing names."""
    rows = [(r.doc_id, r.text, "p" if i % 3 else None) for i, r in enumerate(odd.collect())]
    labels = [(1, 1, None), (1, 0, 1), (5, 1, 0), (None, 1, 1), (19, None, 1), (900, 1, 1)]
    docs = spark.createDataFrame(
        [(*r, 1, "x", False) for r in rows], "doc_id long, text string, source string, mask int, digest string, good boolean"
    )
    found = audit.audit(docs.repartition(3), spark.createDataFrame(labels, LABELS))
    assert counted(found) == expected(rows, labels)
    assert audit.audit(empty, spark.createDataFrame([], LABELS)).collect() == []


def test_copies(spark):
    """A third of all rows is one text, over many partitions."""
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(i, words if i % 3 == 0 else f"{words} x{i % 7} {'Y' * (i % 40)}", f"s{i % 4}") for i in range(600)]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 600, 7)]
    labels = [(i, q, int(t)) for i, q, t in labels]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(13)
    assert counted(audit.audit(docs, spark.createDataFrame(labels, LABELS))) == expected(rows, labels)


@pytest.mark.parametrize("slice_bytes", [7, 40, 1 << 20])
def test_measures(monkeypatch, slice_bytes):
    """Blocks of any size, words longer than a block, slices of a column."""
    monkeypatch.setattr(audit, "SLICE_BYTES", slice_bytes)
    rng = np.random.default_rng(1)
    letters = list("abAB #\n\t\x0b\x1cé漢😀\xa0")
    texts = [*ODD[:-1], *["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(300)], "word " * 300, "Ab" * 200]
    texts += ["x" * 70 + " " + "x" * 70 + " " + "x" * 69 + "y"]
    column = pa.array(["before", *texts, "after"], pa.string()).slice(1, len(texts))
    found, digests = audit.measure(column)
    for i, text in enumerate(texts):
        assert tuple(int(found[m][i]) for m in audit.MEASURES) == plain(text or ""), repr(text)[:80]
    assert len(set(digests)) == len({t or "" for t in texts})


def test_equal_hashes(monkeypatch):
    """Words whose hashes are all equal are told apart by their bytes."""
    monkeypatch.setattr(audit, "mix", lambda h: h * np.uint64(0))
    found, _ = audit.measure(pa.array(["a b a c b", "a", "a a", "abcdefghi abcdefghj abcdefghi"]))
    assert found["n_distinct"].tolist() == [3, 1, 1, 2]
