"""Corpus preparation and reward queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.functions import text as tx
from turnmill.operators import corpus, models, split
from turnmill.plans import stubs
from turnmill.plans.evaluation import STRIP
from turnmill.plans.inputs import EXAM_LINE, ITEMS_SQL, MESSAGE_COLUMNS, MESSAGE_SQL, items, q, table
from turnmill.session import run_dir
from turnmill.sources import training


def _conversations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations")


def conv_nest_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.unnest(corpus.nest(_conversations(spark, folder)))


def conv_to_messages(spark: SparkSession, folder: str) -> DataFrame:
    renamed = corpus.to_messages(corpus.nest(_conversations(spark, folder)))
    shown = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return renamed.select(F.array_join(shown, "\n").alias("messages"))


def first_user_prompt(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.prompts(_conversations(spark, folder))


def corpus_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations and, as a second corpus, exam items as question and answer."""
    def message(turn: int, role: str, column: str):
        return F.struct(
            F.lit(turn).cast("long").alias("turn"), F.lit(role).alias("role"), F.col(column).alias("text")
        )

    exam = items(spark, folder).select(
        F.col("item_id").alias("conv_id"),
        F.inline(F.array(message(0, "user", "question"), message(1, "assistant", "answer"))),
    )
    return corpus.merge({"chat": _conversations(spark, folder), "exam": exam})


def train_val_split(spark: SparkSession, folder: str) -> DataFrame:
    return split.train_val_split(_conversations(spark, folder).select("conv_id", "turn"))


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Keys per split of the conversations, and items per part of the exam."""
    chats = split.split_counts(split.train_val_split(_conversations(spark, folder).select("conv_id")))
    exam = items(spark, folder).groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return chats.withColumn("source", F.lit("chat")).unionByName(exam.withColumn("source", F.lit("exam")))


def length_budget(spark: SparkSession, folder: str) -> DataFrame:
    cut = corpus.apply_budgets(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("n_tokens").cast("long").alias("n_tokens"),
        "over_sft",
        "over_prompt",
        *[F.md5(c).alias(c) for c in ("sft_text", "prompt_text", "completion_text")],
    )


def rollout_plan(spark: SparkSession, folder: str) -> DataFrame:
    plan = corpus.rollout_plan(corpus.prompts(_conversations(spark, folder)))
    return plan.select("conv_id", F.col("sample_id").cast("long").alias("sample_id"), "prompt")


def reward_pairs(spark: SparkSession, folder: str) -> DataFrame:
    from turnmill.functions.chat import pair_chat

    pairs = corpus.reward_pairs(_conversations(spark, folder))
    chat = pair_chat(F.col("prompt"), F.col("completion"))
    shown = F.transform(chat, lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return pairs.select("conv_id", "turn", F.array_join(shown, "\n").alias("chat"))


def reward_scores(spark: SparkSession, folder: str) -> DataFrame:
    pairs = corpus.reward_pairs(_conversations(spark, folder))
    scored = models.score(pairs, stubs.length_ratio)
    return scored.select("conv_id", "turn", F.round("reward", 6).alias("reward"))


def group_advantage(spark: SparkSession, folder: str) -> DataFrame:
    rollouts = corpus.rollout_plan(corpus.prompts(_conversations(spark, folder)))
    reward = ((F.length("prompt") * 7 + F.col("sample_id") * F.col("sample_id") * 13) % 100) / 100.0
    rewards = rollouts.select(
        F.col("conv_id").alias("prompt_id"), F.col("sample_id").cast("long").alias("sample_id"), reward.alias("reward")
    )
    ranked = corpus.group_advantage(rewards)
    return ranked.select("prompt_id", "sample_id", "reward", F.round("advantage", 6).alias("advantage"))


def training_set(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations and exam items, written as JSON Lines, made into a training set, read back."""
    path = run_dir(spark, "training-set")
    chats = _conversations(spark, folder).selectExpr(*MESSAGE_COLUMNS)
    whole = chats.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "json"))).alias("m"))
    joined = F.array_join(F.transform("m", lambda m: m["json"]), ", ")
    whole.select(F.concat(F.lit('{"conversations": ['), joined, F.lit("]}"))).write.text(f"{path}/files/chat")
    items(spark, folder).selectExpr(EXAM_LINE).write.text(f"{path}/files/exam")
    sources = {name: f"{path}/files/{name}" for name in ("chat", "exam")}
    training.write_training_set(spark, sources, f"{path}/set")
    rows = training.read_training_set(spark, f"{path}/set")
    spans = training.read_training_set(spark, f"{path}/set", "spans")
    trained = spans.groupBy("conv_id").agg(F.sum(F.col("end") - F.col("start")).alias("trained"))
    return rows.join(trained, "conv_id", "left").select(
        "source", "split", "conv_id", "prompt", F.md5("text").alias("text"),
        F.size("messages").cast("long").alias("n_messages"), F.coalesce("trained", F.lit(0)).alias("trained"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        conv_nest_roundtrip,
        conv_to_messages,
        first_user_prompt,
        corpus_merge,
        train_val_split,
        split_counts,
        length_budget,
        rollout_plan,
        reward_pairs,
        reward_scores,
        group_advantage,
        training_set,
    )
}

# Oracle --------------------------------------------------------------------------------

_PROMPTS = f"""select conv_id, arg_min(text, turn) as prompt from conversations where role = 'user'
    group by conv_id having length({STRIP.format('arg_min(text, turn)')}) > 0"""
_PAIRS = f"""select c.conv_id, c.turn, p.prompt, c.text as completion
    from conversations c join ({_PROMPTS}) p using (conv_id) where c.role = 'assistant'"""
_SPLIT = f"""
    with ids as (select distinct conv_id from conversations),
    ranked as (select conv_id, row_number() over (order by md5('{fixed.SPLIT_SEED}:' || conv_id), conv_id) as r,
                      count(*) over () as n from ids)
    select conv_id, case when r <= ceil({fixed.VALIDATION_SHARE}::double * n) then 'val' else 'train' end as split
    from ranked"""
# Words and the white space between them, in turn.
_PIECES = f"{tx.SPACE_CLASS}+|{tx.SPACE_CLASS.replace('[', '[^', 1)}+"


def _first_sql(n: int) -> str:
    return f"case when n <= {n} then text else array_to_string(p[:2 * {n} - 1 + lead], '') end"


_WORDS = f"[x for x in regexp_split_to_array(text, {q(tx.SPACE_CLASS + '+')}) if x <> '']"

_LINES = f"""
    select 'chat' as source, '{{"conversations": [' || string_agg(json, ', ' order by turn) || ']}}' as line,
           arg_min(content, turn) filter (role = 'user') as prompt, count(*) as n_messages,
           string_agg('<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10), '' order by turn) as text,
           coalesce(sum(length(content)) filter (role = 'assistant'), 0) as trained
    from ({MESSAGE_SQL}) group by conv_id
    union all
    select 'exam', {EXAM_LINE}, question, 2,
           '<|im_start|>user' || chr(10) || question || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)
           || answer || '<|im_end|>' || chr(10), length(answer) from ({ITEMS_SQL})"""
_KEYED = f"""
    select *, source || ':' || sha256(line) || ':' || row_number() over (partition by source, line) as conv_id
    from ({_LINES})"""

ORACLE = {
    "training_set": f"""
        select source, case when row_number() over (order by md5('{fixed.SPLIT_SEED}:' || conv_id), conv_id)
                                 <= ceil({fixed.VALIDATION_SHARE}::double * count(*) over ()) then 'val' else 'train' end as split,
               conv_id, case when length({STRIP.format('prompt')}) > 0 then prompt end as prompt,
               md5(text) as text, n_messages, cast(trained as bigint) as trained
        from ({_KEYED})""",
    "conv_nest_roundtrip": "select conv_id, turn, role, text from conversations",
    "conv_to_messages": """select string_agg(role || ': ' || text, chr(10) order by turn) as messages
        from conversations group by conv_id""",
    "first_user_prompt": _PROMPTS,
    "corpus_merge": f"""
        select conv_id, turn, role, text, 'chat' as source from conversations
        union all select item_id, 0, 'user', question, 'exam' from ({ITEMS_SQL})
        union all select item_id, 1, 'assistant', answer, 'exam' from ({ITEMS_SQL})""",
    "train_val_split": f"select conv_id, turn, split from conversations join ({_SPLIT}) using (conv_id)",
    "split_counts": f"""
        select split, count(*) as n, 'chat' as source from ({_SPLIT}) group by split
        union all select split, count(*), 'exam' from ({ITEMS_SQL}) group by split""",
    "length_budget": f"""
        with w as (select doc_id, text, len({_WORDS}) as n,
                          regexp_extract_all(text, {q(_PIECES)}) as p,
                          regexp_matches(text, {q('^' + tx.SPACE_CLASS)})::int as lead from documents)
        select doc_id, n as n_tokens, n > 1024 as over_sft, n > 768 as over_prompt,
               md5({_first_sql(1024)}) as sft_text,
               md5(case when n <= 768 then text
                        else array_to_string(p[2 * (n - 768) + 1 + lead:], '') end) as prompt_text,
               md5({_first_sql(256)}) as completion_text
        from w""",
    "rollout_plan": f"select conv_id, s as sample_id, prompt from ({_PROMPTS}), range(1, 5) as t(s)",
    "reward_pairs": f"""select conv_id, turn, 'user: ' || prompt || chr(10) || 'assistant: ' || completion as chat
        from ({_PAIRS})""",
    "reward_scores": f"""select conv_id, turn,
        round(length(completion) / (length(prompt) + 1.0::double), 6) as reward from ({_PAIRS})""",
    "group_advantage": f"""
        with r as (select conv_id as prompt_id, s as sample_id,
                          ((length(prompt) * 7 + s * s * 13) % 100) / 100.0::double as reward
                   from ({_PROMPTS}), range(1, 5) as t(s))
        select prompt_id, sample_id, reward,
               round((reward - avg(reward) over g) / (stddev_samp(reward) over g + 1e-4::double), 6) as advantage
        from r window g as (partition by prompt_id)""",
}
