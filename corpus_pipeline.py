"""A training corpus from ``documents``: four stages over whole tables.

Every stage works on all rows that the one before has written, and is written itself. The
first three return the columns of ``documents``; the last returns packed pieces.

Null and empty texts are no documents to learn from: the classifier scores them like any
text, the rules reject them. Tables without rows pass through all stages without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.llm import near, packing, quality, rules
from turnmill.llm.common import documents, staged
from turnmill.llm.queries import QUALITY_FROM, word_tokenizer
from turnmill.plans.inputs import table

_SCORE = "__quality_score"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; it is fitted on the labels of the corpus."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    name = _SCORE
    while name in map(str.lower, docs.columns):  # a name that the table doesn't use
        name += "_"
    return quality.score(docs, model, name=name).where(F.col(name) >= QUALITY_FROM).drop(name)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep the quality rules."""
    return rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of exact and near copies."""
    return near.first_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in full sequences, one row per piece."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("quality classifier", good_quality),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("packing", packed),
]

#: A trained model, a similarity join and a tokenizer have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
