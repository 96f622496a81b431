"""Odd rows, empty tables and clashing names through the operators and the stages, against brute force."""

from __future__ import annotations

import hashlib
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnmill.llm import licenses, near, packing, quality, queries, rules, toxicity, warc
from turnmill.plans.inputs import table

from .conftest import FOLDER, ODD

CLASHING = "doc_id long, text string, __words int, __id int, __a int, __kept int, license int, bpe int, row int, __quality_score int"


@pytest.fixture
def clashing(spark):
    rows = [(i, t, *range(8)) for i, t in enumerate(ODD[:-1])]
    good = "the cat sat on the mat and it was a day of rest for all to see in the old town "
    rows += [(100 + i, good + f"number {i} and more of it that is by the sea with some of us", *range(8)) for i in range(6)]
    return spark.createDataFrame(rows, CLASHING)


def same_rows(kept, df):
    assert kept.columns == df.columns
    every = {r.doc_id: r for r in df.collect()}
    assert all(every[r.doc_id] == r for r in kept.collect())


def test_clashing_columns(spark, clashing):
    """Rows come out of every stage as they went in."""
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality classifier", "quality rules", "near duplicates"):
        same_rows(stages[name](spark, clashing, FOLDER), clashing)
    assert {r.doc_id for r in rules.keep(clashing).collect()} >= {100}
    pieces = stages["packing"](spark, clashing, FOLDER).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in clashing.collect()}
    found = licenses.scan_licenses(clashing)
    assert found.columns == clashing.columns and found.schema["license"].dataType.typeName() == "struct"
    assert licenses.scan_licenses(clashing, into="found").drop("found").columns == clashing.columns


def phrase_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = []
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return len(words), sorted(places)


def test_license_places(spark, odd, empty):
    """Base columns against a plain search, over all given documents and odd texts."""
    more = ["cc by cc by cc by 4.0", "General PUBLIC license, all rights; reserved all rights reserved", "ccby xcc by", "all rights " * 40_000]
    rows = [*ODD, *more, *[r.text for r in table(spark, FOLDER, "documents").collect()]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.license for r in licenses.scan_licenses(docs).collect()}
    for i, text in enumerate(rows):
        n, places = phrase_places(text)
        got, at = found[i], [p for p, _ in places]
        assert (got.n_words, got.n_base) == (n, len(places))
        assert (got.first_word, got.last_word) == ((min(at), max(at)) if at else (None, None))
        assert got.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(got.base_labels.split(",")) <= set(got.labels.split(",")) | {""} and 0 <= got.score <= 1
    assert licenses.scan_licenses(odd).count() == len(ODD) + 1 and licenses.scan_licenses(empty).collect() == []


def test_long_regions():
    """Holders of any number of words; many places that wait for the same end take one walk."""
    scan = licenses.scanner(licenses.TEMPLATES, licenses.PHRASES)
    names = "one two three " * 5_000
    got = scan(pa.array([f"Copyright (c) {names} All rights reserved.", "copyright x " * 20_000, "copyright a copyright b all rights reserved end"]))
    assert "copyright-notice" in got[0]["labels"] and got[0]["score"] == 1.0
    assert got[1]["labels"] == ""
    assert [(m["label"], m["first_word"], m["last_word"]) for m in got[2]["matches"] if m["label"] != "reserved"] == [
        ("copyright-notice", 0, 6), ("copyright-notice", 2, 6),
    ]


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    positive = labels == 1
    n = positive.sum()
    return (rank[positive].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


@pytest.mark.parametrize("name,label,floor", [("op3_quality_classifier", "quality", 0.97), ("op5_toxicity_network", "toxic", 0.85)])
def test_held_out(spark, name, label, floor):
    """Scores of the held-out fifth, none of which was learned from."""
    folder = "/root/testdata/sf0.1"
    marks = {r.doc_id: r[label] for r in table(spark, folder, "labels").collect()}
    rows = [r for r in queries.QUERIES[name](spark, folder).collect() if r.held_out and marks.get(r.doc_id) is not None]
    assert len(rows) > 300 and all(0 <= r.score <= 1 for r in rows)
    least = queries.QUALITY_FROM if label == "quality" else queries.TOXIC_FROM
    assert all(r.predicted == int(r.score >= least) for r in rows)
    assert auc(np.array([r.score for r in rows]), np.array([marks[r.doc_id] for r in rows])) >= floor


@pytest.mark.parametrize("of", [quality, toxicity])
def test_scores_one_by_one(spark, odd, empty, of):
    """A text's score is the same alone, in a batch, and in any partition; odd texts have one."""
    docs = table(spark, FOLDER, "documents")
    model = of.train(docs, table(spark, FOLDER, "labels"), label="quality" if of is quality else "toxic")
    wide = odd.drop("score")
    whole = {r.text: r.score for r in of.score(wide.repartition(1), model).collect()}
    parted = of.score(wide.repartition(7), model).collect()
    assert len(parted) == len(ODD) + 1
    assert all(0 <= r.score <= 1 and abs(r.score - whole[r.text]) < 1e-6 for r in parted)
    assert of.score(empty, model).collect() == []


def test_warc_of_odd_pages(spark):
    """Null, empty, short, equal and long payloads, null and repeated rows, clashing names."""
    long = "<p>" + "x" * 300_000
    bodies = [None, "", "short", "short", "a" * 100, "a" * 100, "a" * 99, "a" * 99, long, long, "é" * 60]
    rows = [(10 - i, f"http://h{i}/\r\nx", b, 1, "t") for i, b in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, salt int, type string").repartition(3)
    found = {r.page_id: r for r in warc.page_captures(warc.write_archives(pages)).collect()}
    assert len(found) == len(rows)
    first = {}
    for i, _, body, _, _ in sorted(rows):
        first.setdefault(body or "", i)
    for i, _, body, _, _ in rows:
        raw = (body or "").encode()
        got = found[i].response
        assert (got.payload_bytes, got.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        revisit = len(raw) >= 100 and first[body or ""] != i
        assert (got.type, found[i].refers_to_page) == (("revisit", first[body]) if revisit else ("response", None))
    assert warc.page_captures(warc.write_archives(pages.where("page_id < 0"))).collect() == []


def test_rules_of_odd_texts(spark, odd, empty):
    for r in rules.judge(odd).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 1_000 else set(grams)
        inside = {i + k for i, g in enumerate(grams) if g in twice for k in range(5)}
        lines = [x for x in (r.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", r.text or "")), len(lines) - len(set(lines)), len(inside))
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert tuple(r[f"__{n}"] for n in names) == want
    assert rules.keep(empty).collect() == [] and rules.keep(odd).columns == odd.columns


def test_stages_of_odd_rows(spark, odd, empty):
    """Every stage takes odd rows and tables without rows."""
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, FOLDER)
        assert out.count() >= 0 and (name == "packing" or out.columns == odd.columns)
        assert stage(spark, empty, FOLDER).count() == 0
    pieces = packing.pack(near.first_of_each(odd), queries.word_tokenizer())
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 4096
