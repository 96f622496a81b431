"""Preparing conversation corpora: adapters, prompts, merging, budgets, rollouts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.functions import text as tx
from turnmill.operators.joins import join_groups


def nest(messages: DataFrame) -> DataFrame:
    """Long rows to ``(conv_id, conversations)``: one record per conversation, its messages in turn order.

    Messages carry their turn, so gaps between turns survive.
    """
    entry = F.struct("turn", "role", F.col("text").alias("content"))
    return messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("conversations"))


def unnest(nested: DataFrame) -> DataFrame:
    """Back to long rows; messages without a turn are numbered from 0."""
    carried = "turn" in nested.schema["conversations"].dataType.elementType.names
    turn = F.col("_m.turn") if carried else F.col("_pos").cast("long")
    return nested.select("conv_id", F.posexplode("conversations").alias("_pos", "_m")).select(
        "conv_id",
        turn.alias("turn"),
        F.col("_m.role").alias("role"),
        F.col("_m.content").alias("text"),
    )


def to_messages(nested: DataFrame) -> DataFrame:
    """``conversations`` renamed to ``messages``, with role and content; all else goes."""
    plain = F.transform("conversations", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return nested.select(plain.alias("messages"))


def first_user_content(messages: Column) -> Column:
    """Content of the first user message of an array, ``''`` if there is none."""
    users = F.filter(messages, lambda m: m["role"] == "user")
    return F.coalesce(F.get(users, F.lit(0))["content"], F.lit(""))


def prompts_nested(nested: DataFrame) -> DataFrame:
    """One ``prompt`` per conversation row, blank ones dropped."""
    return nested.select(first_user_content(F.col("conversations")).alias("prompt")).where(
        ~tx.is_blank(F.col("prompt"))
    )


def prompts(messages: DataFrame) -> DataFrame:
    """``(conv_id, prompt)`` from long rows; conversations without a usable prompt drop out."""
    return (
        messages.where(F.col("role") == "user")
        .groupBy("conv_id")
        .agg(F.coalesce(F.min_by("text", "turn"), F.lit("")).alias("prompt"))
        .where(~tx.is_blank(F.col("prompt")))
    )


def merge(corpora: Mapping[str, DataFrame]) -> DataFrame:
    """All rows of all corpora with their ``source``; nothing is deduplicated."""
    merged = None
    for name, rows in corpora.items():
        tagged = rows.withColumn("source", F.lit(name))
        merged = tagged if merged is None else merged.unionByName(tagged)
    if merged is None:
        raise ValueError("nothing to merge")
    return merged


def with_length(
    df: DataFrame,
    column: str = "text",
    counter: Callable[[Column], Column] = tx.word_count,
    name: str = "n_tokens",
) -> DataFrame:
    """Add a length. The default counts words; ``models.token_counter`` brings a tokenizer."""
    return df.withColumn(name, counter(F.col(column)))


def apply_budgets(df: DataFrame, column: str = "text", offsets: Callable[[Column], Column] | None = None) -> DataFrame:
    """Texts cut to the token budgets: training rows keep the left end, prompts the right end.

    ``offsets`` gives the characters at which each token starts and ends, in turn
    (``models.token_offsets`` brings a tokenizer); without it tokens are words. A cut text is
    a piece of the original one, a text within its budget the original itself.
    """
    text = F.col(column)
    if offsets is None:
        cut = df.withColumn("n_tokens", tx.word_count(text))
        first, last = (lambda n: tx.first_words(text, n)), (lambda n: tx.last_words(text, n))
    else:
        # The tokenizer is asked once.
        edges = F.col("_edges")
        cut = df.withColumn("_edges", offsets(text)).withColumn("n_tokens", F.floor(F.size("_edges") / 2).cast("int"))
        first, last = (lambda n: tx.first_tokens(text, edges, n)), (lambda n: tx.last_tokens(text, edges, n))
    return cut.select(
        *df.columns,
        "n_tokens",
        (F.col("n_tokens") > fixed.SFT_BUDGET).alias("over_sft"),
        (F.col("n_tokens") > fixed.RL_PROMPT_BUDGET).alias("over_prompt"),
        first(fixed.SFT_BUDGET).alias("sft_text"),
        last(fixed.RL_PROMPT_BUDGET).alias("prompt_text"),
        first(fixed.RL_COMPLETION_BUDGET).alias("completion_text"),
    )


def rollout_plan(prompt_rows: DataFrame, samples: int = fixed.COMPLETIONS_PER_PROMPT) -> DataFrame:
    """One row per prompt and sample number from 1."""
    return prompt_rows.withColumn("sample_id", F.explode(F.sequence(F.lit(1), F.lit(samples))))


def reward_pairs(messages: DataFrame, **limits) -> DataFrame:
    """Every assistant turn with the prompt of its conversation."""
    completions = messages.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.col("text").alias("completion")
    )
    return join_groups(completions, prompts(messages), ["conv_id"], **limits)


def group_advantage(rewards: DataFrame, eps: float = 1e-4, **limits) -> DataFrame:
    """Reward relative to its prompt's group: ``(r - mean) / (std + eps)``.

    Group statistics are a partial aggregate joined back, so the rows of a prompt are
    never gathered in one task as a window would do. ``rewards`` is read twice: store what
    a model scored before coming here.
    """
    stats = rewards.groupBy("prompt_id").agg(
        F.avg("reward").alias("group_mean"),
        F.coalesce(F.stddev_samp("reward"), F.lit(0.0)).alias("group_std"),
    )
    return join_groups(rewards, stats, ["prompt_id"], **limits).withColumn(
        "advantage", (F.col("reward") - F.col("group_mean")) / (F.col("group_std") + F.lit(eps))
    )
