"""The queries of this subpackage that have SQL, and the pipeline's stages against brute force."""

from __future__ import annotations

import corpus_pipeline
import pytest
from compare import connect, differences

from turnmill.llm import quality, queries
from turnmill.plans.inputs import table

from .conftest import FOLDER
from .test_near import all_pairs


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_oracle(spark, duck, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), duck, queries.ORACLE[name]) == []


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark, duck):
    """Each of the first three stages keeps the rows that brute force keeps, with their columns."""
    docs = table(spark, FOLDER, "documents")
    stages = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = quality.train(docs, table(spark, FOLDER, "labels"))
    score = {i: quality.scores(model, [(t or "").encode()])[0] for i, t in texts.items()}
    assert all(abs(s - queries.QUALITY_FROM) > 1e-4 for s in score.values())
    good = stages["quality classifier"](spark, docs, FOLDER).localCheckpoint()
    assert ids(good) == sorted(i for i, s in score.items() if s >= queries.QUALITY_FROM)
    sql = f"select doc_id from ({queries.ORACLE['op7_quality_rules']}) where kept"
    kept = {i for (i,) in duck.sql(sql).fetchall()}
    ruled = stages["quality rules"](spark, good, FOLDER).localCheckpoint()
    assert ids(ruled) == [i for i in ids(good) if i in kept]
    first = stages["near duplicates"](spark, ruled, FOLDER)
    pairs = all_pairs([(i, texts[i]) for i in ids(ruled)])
    assert set(ids(first)) == {group for group, _, _ in pairs.values()}
    assert good.columns == ruled.columns == first.columns == docs.columns


def test_stages_without_rows(spark, empty):
    rows = empty
    for _, stage in corpus_pipeline.STAGES[:3]:
        rows = stage(spark, rows, FOLDER)
        assert rows.count() == 0
