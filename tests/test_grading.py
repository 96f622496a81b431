"""The registered grading query against the evaluation of the same model."""

from __future__ import annotations

from turnmill.plans import evaluation

FOLDER = "/root/testdata/sf0.001"


def test_every_prediction_is_graded(spark):
    rows = evaluation.grade_answers(spark, FOLDER).collect()
    details = evaluation.eval_details(spark, FOLDER).collect()
    assert any(r.item_id % 9 == 0 for r in rows)
    assert sorted((r.item_id, r.predicted, r.answer, r.is_correct) for r in rows) == sorted(
        (r.id, r.predicted, r.correct, r.is_correct) for r in details
    )
