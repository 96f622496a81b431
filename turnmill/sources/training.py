"""A training set from conversation files: read, merged, split, rendered, written.

The set lies under one folder, a table for the conversations and one for the ranges of each
that an assistant-only loss covers, each in parts by split. What the parts are made from is
written first; a part is done when its writing job has ended. A run that finds some parts
done makes only the others, a run over a finished set writes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.functions import text as tx
from turnmill.functions.chat import render_messages
from turnmill.operators import corpus, rendering, split
from turnmill.session import file_system, stored
from turnmill.sources.readers import read_chat_log

SPLITS = ("train", "val")
TABLES = ("conversations", "spans")


def read_corpora(spark: SparkSession, sources: Mapping[str, str | list[str]], **blocks) -> DataFrame:
    """``(source, conv_id, conversations)`` of all corpora; a line in two corpora is two conversations."""
    merged = corpus.merge({name: read_chat_log(spark, path, **blocks) for name, path in sources.items()})
    return merged.withColumn("conv_id", F.concat_ws(":", "source", "conv_id"))


def conversations(rows: DataFrame) -> DataFrame:
    """One row a conversation: prompt (null where it is blank), rendered text, messages."""
    prompt = corpus.first_user_content(F.col("conversations"))
    return rows.select(
        "source",
        "conv_id",
        F.when(~tx.is_blank(prompt), prompt).alias("prompt"),
        render_messages(F.col("conversations"), with_calls=True).alias("text"),
        F.col("conversations").alias("messages"),
    )


def spans(rows: DataFrame) -> DataFrame:
    """The trained ranges of the rendered texts, a row a turn."""
    message = F.posexplode("conversations").alias("turn", "m")
    turns = rows.select("conv_id", message).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.col("m.role").alias("role"),
        F.col("m.content").alias("text"),
        F.col("m.tool_calls").alias("tool_calls"),
    )
    return rendering.loss_spans(turns)


def _claim(spark: SparkSession, path: str, made_from: str) -> None:
    """Writes what the set is made from, or compares with what is there."""
    fs, own = file_system(spark, f"{path}/made-from.json")
    if fs.exists(own):
        there = spark.read.text(f"{path}/made-from.json", wholetext=True).first().value
        if there != made_from:
            raise ValueError(f"{path} holds a training set made from {there}")
        return
    out = fs.create(own, False)
    out.write(made_from.encode())
    out.close()


def write_training_set(
    spark: SparkSession,
    sources: Mapping[str, str | list[str]],
    path: str,
    *,
    share: float = fixed.VALIDATION_SHARE,
    seed: int = fixed.SPLIT_SEED,
    **blocks,
) -> list[str]:
    """Makes the parts of the set at ``path`` that aren't there; returns their names.

    Lines that can't be read are left out. The split is exact over all conversations.
    """
    _claim(spark, path, json.dumps({"sources": dict(sources), "share": share, "seed": seed}, sort_keys=True))
    folders = {(t, s): f"{path}/{t}/split={s}" for t in TABLES for s in SPLITS}

    def done(folder: str) -> bool:
        fs, own = file_system(spark, f"{folder}/_SUCCESS")
        return fs.exists(own)

    missing = [part for part, folder in folders.items() if not done(folder)]
    if not missing:
        return []
    # The files are read, numbered and split once for all parts.
    rows = read_corpora(spark, sources, **blocks).where(F.col("conversations").isNotNull())
    parted = stored(split.train_val_split(stored(rows, "corpora"), share=share, seed=seed), "split")
    for name, half in missing:
        own = parted.where(F.col("split") == half).drop("split")
        out = conversations(own) if name == "conversations" else spans(own)
        out.write.mode("overwrite").parquet(folders[name, half])
    return [f"{name}/{half}" for name, half in missing]


def read_training_set(spark: SparkSession, path: str, name: str = "conversations") -> DataFrame:
    """A table of the set, with ``split``."""
    return spark.read.parquet(f"{path}/{name}")
