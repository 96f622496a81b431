"""Session history queries, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.operators import history
from turnmill.plans.evaluation import STRIP
from turnmill.plans.inputs import DIALOGUE_SQL, LOG_COLUMNS, LOG_SQL, SCHEMAS, dialogue, log, table
from turnmill.session import run_dir
from turnmill.streaming import sessions

ORDER = ["ts", "seq"]
SHOWN = ["session", "seq", "segment", "position", "start", "end", "message"]


def session_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions cut at every error event."""
    rows = table(spark, folder, "events").select(F.col("user_id").alias("session"), "event_id", "ts", "event_type")
    cut = history.segments(history.blocked_log(rows, ["ts", "event_id"]), F.col("event_type") == "error")
    return cut.rows.select("session", "event_id", "segment")


def running_history(spark: SparkSession, folder: str) -> DataFrame:
    return history.history(log(spark, folder), ORDER).select(*SHOWN)


def session_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    return history.transcripts(history.history(log(spark, folder), ORDER))


def failed_turn_rollback(spark: SparkSession, folder: str) -> DataFrame:
    """Every input with its kind, and whether it stays in the history."""
    return history.classify(log(spark, folder)).select("session", "seq", "kind", "kept")


def session_dialogue(spark: SparkSession, folder: str) -> DataFrame:
    """Inputs and replies that stay in the history, in one transcript."""
    kept = history.dialogue(dialogue(spark, folder), ORDER)
    return kept.select("session", "seq", "role", *SHOWN[2:])


def session_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The history worked out by a stream over the event files, read back from its sink."""
    out, checkpoint = run_dir(spark, "session-stream"), run_dir(spark, "session-stream-checkpoint")
    events = sessions.read_log(spark, folder, SCHEMAS["events"], pattern="events.parquet")
    sessions.write_history(events.selectExpr(*LOG_COLUMNS), out, checkpoint).awaitTermination()
    return sessions.read_history(spark, out).select(*SHOWN)


QUERIES = {
    f.__name__: f
    for f in (session_segments, running_history, session_transcripts, failed_turn_rollback, session_dialogue, session_stream)
}

# Oracle --------------------------------------------------------------------------------

_CLASSIFIED = f"""
    select *, kind = 'message' and ok as kept from (
        select *, case when lower(message) in ('quit', 'exit') then 'end' when lower(message) = 'clear' then 'reset'
                       when message = '' then 'skip' else 'message' end as kind
        from (select *, {STRIP.format('text')} as message from ({LOG_SQL})))"""
_HISTORY = f"""
    select session, seq, segment, position, cast(upto - length(message) - 1 as bigint) as start,
           cast(upto as bigint) as "end", message
    from (select *, row_number() over w as position, sum(length(message) + 1) over w as upto
          from (select *, cast(sum((kind in ('end', 'reset'))::int) over (
                    partition by session order by ts, seq rows unbounded preceding) as bigint) as segment
                from ({_CLASSIFIED}))
          where kept window w as (partition by session, segment order by ts, seq rows unbounded preceding))"""

_SIDES = f"""
    select *, case when role = 'assistant' then 'reply' when lower(message) in ('quit', 'exit') then 'end'
                   when lower(message) = 'clear' then 'reset' when message = '' then 'skip' else 'message' end as kind
    from (select *, {STRIP.format('text')} as message from ({DIALOGUE_SQL}))"""
_DIALOGUE = f"""
    select session, seq, role, segment, position, cast(upto - length(message) - 1 as bigint) as start,
           cast(upto as bigint) as "end", message
    from (select *, row_number() over w as position, sum(length(message) + 1) over w as upto
          from (select *, cast(sum((kind in ('end', 'reset'))::int) over o as bigint) as segment,
                       lag(kind) over o as before, lead(kind) over o as after, lead(ok) over o as after_ok
                from ({_SIDES}) window o as (partition by session order by ts, seq rows unbounded preceding))
          where (kind = 'message' and not coalesce(after = 'reply' and not after_ok, false))
                or (kind = 'reply' and ok and coalesce(before = 'message', false))
          window w as (partition by session, segment order by ts, seq rows unbounded preceding))"""

ORACLE = {
    "session_dialogue": _DIALOGUE,
    "session_segments": """
        select user_id as session, event_id, cast(sum((event_type = 'error')::int) over (
            partition by user_id order by ts, event_id rows unbounded preceding) as bigint) as segment
        from events""",
    "running_history": _HISTORY,
    "session_transcripts": f"""
        select session, segment, position, start, message || chr(10) as line from ({_HISTORY})""",
    "failed_turn_rollback": f"select session, seq, kind, kept from ({_CLASSIFIED})",
    "session_stream": _HISTORY,
}
