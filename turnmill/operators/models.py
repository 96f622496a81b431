"""Calling user-supplied models over tables.

A model is a factory without arguments that loads it and returns a function from numpy
arrays (one per input column, one batch) to an array of results. The factory runs once per
Python worker. Results must depend on the row alone, so lost tasks can be repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill import fixed
from turnmill.functions import chat
from turnmill.functions import text as tx
from turnmill.operators import fewshot, grading
from turnmill.operators.vectors import l2_normalize

Factory = Callable[[], Callable]


@dataclass(frozen=True)
class Generation:
    """Settings handed to a text model's factory maker."""

    max_new_tokens: int = fixed.EXAM_MAX_NEW_TOKENS
    do_sample: bool = False
    temperature: float = 0.0
    top_p: float = fixed.SAMPLING_TOP_P
    top_k: int = fixed.SAMPLING_TOP_K

    @classmethod
    def for_chat(cls) -> Generation:
        return cls(fixed.CHAT_MAX_NEW_TOKENS, True, fixed.SAMPLING_TEMPERATURE)


def variant(factories: Mapping[str, Factory], model_type: str) -> Factory:
    """The factory of a model variant; only known variants are allowed."""
    if model_type not in fixed.MODEL_TYPES:
        raise ValueError(f"unknown model type {model_type!r}; use one of {', '.join(fixed.MODEL_TYPES)}")
    if model_type not in factories:
        raise ValueError(f"no factory given for model type {model_type!r}")
    return factories[model_type]


def generate(
    df: DataFrame,
    factory: Factory,
    *,
    prompt: str = "prompt",
    extra_inputs: Sequence[str] = (),
    batch_size: int = 64,
    name: str = "response",
) -> DataFrame:
    """Render ``prompt`` as a chat, let the model complete it, strip the completion."""
    model = predict_batch_udf(factory, return_type=T.StringType(), batch_size=batch_size)
    inputs = [chat.user_prompt_chat(F.col(prompt)), *map(F.col, extra_inputs)]
    return df.withColumn(name, tx.py_strip(model(*inputs)))


def generate_variants(
    df: DataFrame, factories: Mapping[str, Factory], model_types: Sequence[str], **options
) -> DataFrame:
    """The same prompts through several variants, told apart by ``model_id``."""
    runs = None
    for model_type in model_types:
        run = generate(df, variant(factories, model_type), **options).withColumn(
            "model_id", F.lit(model_type)
        )
        runs = run if runs is None else runs.unionByName(run)
    if runs is None:
        raise ValueError("no model type given")
    return runs


def evaluate(
    test: DataFrame, dev: DataFrame, factory: Factory, *, by: list[str] | None = None, **options
) -> DataFrame:
    """Prompts, answers and grades of an exam as one plan."""
    asked = fewshot.few_shot_prompts(test, dev, by)
    return grading.grade_rows(generate(asked, factory, **options))


def embed(
    df: DataFrame,
    factories: Mapping[str, Factory],
    *,
    kind: str = "document",
    column: str = "text",
    batch_size: int = fixed.EMBED_BATCH,
    name: str = "embedding",
) -> DataFrame:
    """Unit-length embeddings; ``kind`` picks the model for documents or for queries."""
    if kind not in ("document", "query"):
        raise ValueError("kind must be 'document' or 'query'")
    model = predict_batch_udf(
        factories[kind], return_type=T.ArrayType(T.FloatType()), batch_size=batch_size
    )
    return df.withColumn(name, model(F.col(column))).withColumn(name, l2_normalize(F.col(name)))


def score(
    df: DataFrame,
    factory: Factory,
    *,
    prompt: str = "prompt",
    completion: str = "completion",
    batch_size: int = 64,
    name: str = "reward",
) -> DataFrame:
    """Reward of each prompt and completion, scored as a two-message chat."""
    model = predict_batch_udf(factory, return_type=T.DoubleType(), batch_size=batch_size)
    pair = chat.pair_chat(F.col(prompt), F.col(completion))
    return df.withColumn(name, model(pair[0]["content"], pair[1]["content"]))


def token_counter(factory: Factory, batch_size: int = 64) -> Callable[[Column], Column]:
    """A tokenizer as a length counter for ``corpus.with_length``."""
    return predict_batch_udf(factory, return_type=T.IntegerType(), batch_size=batch_size)


def token_offsets(factory: Factory, batch_size: int = 64) -> Callable[[Column], Column]:
    """A tokenizer as the ``offsets`` of ``corpus.apply_budgets``.

    The factory's function returns, for each text, start and end of each token in turn.
    """

    @F.pandas_udf("array<int>")
    def edges(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = factory()
        for texts in batches:
            found = [e for i in range(0, len(texts), batch_size) for e in predict(texts.iloc[i : i + batch_size].to_numpy())]
            yield pd.Series([[int(x) for x in e] for e in found], dtype=object)

    return lambda text: edges(F.coalesce(text, F.lit("")))
