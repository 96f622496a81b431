"""Rendering conversations held one message per row: ``(conv_id, turn, role, text)``.

An optional column ``tool_calls`` (array of name and arguments) belongs to assistant rows.
A rendered conversation stays in rows, one segment per message with its place in the whole
text, so no task holds a conversation of any length; segments in order are the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.functions import chat
from turnmill.operators.blocks import BLOCK, Blocked, by_number, neighbours, running

#: Turn numbers of a block of the ordered scans; results don't depend on it.
TURNS_PER_BLOCK = 16_384


def segments(
    messages: DataFrame,
    *,
    tools: Sequence[str] | Column | None = None,
    generation_prompt: bool = False,
    turns_per_block: int = TURNS_PER_BLOCK,
) -> Blocked:
    """Each message with its rendered ``segment`` and the trained range inside it."""
    around = neighbours(by_number(messages, ["conv_id"], "turn", turns_per_block), "role")
    content = F.coalesce(F.col("text"), F.lit(""))
    calls = F.col("tool_calls") if "tool_calls" in messages.columns else None
    # What a message says is written out once, in a column of its own.
    said = F.when(F.col("role") == "assistant", chat.assistant_body(content, calls)).otherwise(content)
    staged = around.rows.withColumn("_said", said)
    lead = chat.segment(
        F.col("role"),
        F.col("_said"),
        None,
        first=F.col("previous").isNull(),
        last=F.col("following").isNull(),
        after_tool=F.col("previous.value").eqNullSafe("tool"),
        before_tool=F.col("following.value").eqNullSafe("tool"),
        tools=chat.tool_list(tools),
        generation_prompt=generation_prompt,
    )
    trained = F.col("role") == "assistant"
    close = F.length(F.lit(fixed.TURN_CLOSE)) + (
        F.when(F.col("following").isNull(), len(fixed.ASSISTANT_OPEN)).otherwise(0)
        if generation_prompt
        else F.lit(0)
    )
    rows = staged.select(
        "conv_id",
        "turn",
        "role",
        BLOCK,
        lead.alias("segment"),
        F.when(trained, F.length("_said")).otherwise(0).cast("long").alias("trained_chars"),
        close.alias("_close"),
    ).select(
        "conv_id",
        "turn",
        "role",
        BLOCK,
        "segment",
        F.length("segment").cast("long").alias("chars"),
        "trained_chars",
        (F.length("segment") - F.col("_close") - F.col("trained_chars")).alias("trained_at"),
    )
    return around.with_rows(rows)


def render(messages: DataFrame, **options) -> DataFrame:
    """``(conv_id, turn, start, segment)``: segments follow each other without gaps; options as for ``segments``."""
    placed = running(segments(messages, **options), {"upto": ("sum", F.col("chars"))})
    return placed.rows.select("conv_id", "turn", (F.col("upto") - F.col("chars")).alias("start"), "segment")


def loss_spans(messages: DataFrame, **options) -> DataFrame:
    """Character ranges ``[start, end)`` of the rendered text that an assistant-only loss covers."""
    placed = running(segments(messages, **options), {"upto": ("sum", F.col("chars"))})
    start = F.col("upto") - F.col("chars") + F.col("trained_at")
    return placed.rows.where(F.col("role") == "assistant").select(
        "conv_id",
        "turn",
        start.alias("start"),
        (start + F.col("trained_chars")).alias("end"),
    )


def loss_share(messages: DataFrame, **options) -> DataFrame:
    """Share of each conversation's rendered characters that are trained on."""
    return (
        segments(messages, **options)
        .rows.groupBy("conv_id")
        .agg(F.sum("trained_chars").alias("trained"), F.sum("chars").alias("total"))
        .select(
            "conv_id",
            "trained",
            "total",
            F.when(F.col("total") > 0, F.col("trained") / F.col("total")).otherwise(0.0).alias("share"),
        )
    )


def with_system_turn(messages: DataFrame, text: str) -> DataFrame:
    """Put the same system message in front of every conversation, as turn -1."""
    system = messages.select("conv_id").distinct().select(
        "conv_id",
        F.lit(-1).cast("long").alias("turn"),
        F.lit("system").alias("role"),
        F.lit(text).alias("text"),
    )
    return messages.unionByName(system, allowMissingColumns=True)
