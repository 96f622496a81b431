"""Chat-loop rules over a log of console inputs: ``(session, .., text, ok)``.

Inputs are commands or messages. A message whose answer failed (``ok`` false) is taken
back. Clear and quit start the history afresh. What the model sees at a turn is the
segment's kept messages up to that turn, so a history is stored as a place in its segment
and a range of the segment's transcript: its size grows with the log, not with its square.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.functions import text as tx
from turnmill.operators.blocks import Blocked, by_heavy_key, neighbours, running


def blocked_log(log: DataFrame, order: list[str], **limits) -> Blocked:
    """A log cut into blocks of rows for sessions that hold very many."""
    return by_heavy_key(log, ["session"], order, **limits)


def classify(log: DataFrame) -> DataFrame:
    """Add ``kind``, and ``kept``: a message that stays in the history."""
    return log.withColumn("kind", tx.command_kind(F.col("text"))).withColumn(
        "kept", (F.col("kind") == "message") & F.col("ok")
    )


def segments(blocked: Blocked, is_reset) -> Blocked:
    """Add ``segment``: how many resets the session has seen, this row included."""
    return running(blocked, {"segment": ("sum", F.when(is_reset, 1).otherwise(0).cast("long"))})


def rolled_back(log: DataFrame) -> DataFrame:
    """The messages taken back because their answer failed."""
    return classify(log).where((F.col("kind") == "message") & ~F.col("ok"))


def placed(log: DataFrame, order: list[str], **blocks) -> DataFrame:
    """Every input with ``segment``, and what of the segment's history there is behind it.

    ``position`` counts the kept messages so far, this one included; ``[start, end)`` is the
    range of a kept message in the segment's transcript.
    """
    ready = classify(log).withColumn("message", tx.py_strip(F.col("text")))
    return _counted(blocked_log(ready, order, **blocks), log.columns)


def _counted(blocked: Blocked, columns: list[str]) -> DataFrame:
    """Places of rows that have ``kind``, ``kept`` and ``message``."""
    reset = F.col("kind").isin("end", "reset")
    kept = F.col("kept").cast("long")
    chars = F.when(F.col("kept"), F.length("message") + 1).otherwise(0).cast("long")
    counted = running(
        blocked,
        {
            "segment": ("sum", F.when(reset, 1).otherwise(0).cast("long")),
            "_messages": ("sum", kept),
            "_chars": ("sum", chars),
        },
    )
    # Both counts never fall, so their largest value at a reset is the one at the last reset.
    based = running(
        counted,
        {
            "_messages_before": ("max", F.when(reset, F.col("_messages")).otherwise(0)),
            "_chars_before": ("max", F.when(reset, F.col("_chars")).otherwise(0)),
        },
    )
    end = F.col("_chars") - F.col("_chars_before")
    return based.rows.select(
        *columns,
        "kept",
        "segment",
        (F.col("_messages") - F.col("_messages_before")).alias("position"),
        (end - F.length("message") - 1).alias("start"),
        end.alias("end"),
        "message",
    )


def history(log: DataFrame, order: list[str], **blocks) -> DataFrame:
    """Kept messages with ``segment``, ``position`` from 1 and the range ``[start, end)``.

    The history visible at a message is the first ``position`` messages of its segment:
    the first ``end`` characters of the segment's transcript.
    """
    shown = ("segment", "position", "start", "end", "message")
    return placed(log, order, **blocks).where("kept").select("session", *order, *shown)


def dialogue(log: DataFrame, order: list[str], **blocks) -> DataFrame:
    """Both sides of a console: kept inputs and replies with their place, as ``history`` gives.

    ``log`` has a ``role`` as well: ``user`` rows are inputs, ``assistant`` rows answer the
    input before them. A reply that failed takes back itself and its message; a reply is
    never a command, whatever it says, and one that answers no message is left out. A message
    without a reply so far is kept.
    """
    ready = log.withColumn("message", tx.py_strip(F.col("text"))).withColumn(
        "kind", F.when(F.col("role") == "user", tx.command_kind(F.col("text"))).otherwise(F.lit("reply"))
    )
    ready = ready.withColumn("_side", F.struct("kind", F.coalesce("ok", F.lit(False)).alias("ok")))
    around = neighbours(blocked_log(ready, order, **blocks), "_side")
    before, after = F.col("previous.value"), F.col("following.value")
    failed = F.coalesce((after["kind"] == "reply") & ~after["ok"], F.lit(False))
    answers = F.coalesce(before["kind"] == "message", F.lit(False)) & F.col("_side.ok")
    kept = F.when(F.col("kind") == "message", ~failed).when(F.col("kind") == "reply", answers).otherwise(False)
    sided = around.with_rows(around.rows.withColumn("kept", kept).drop("previous", "following", "_side"))
    shown = ("role", "segment", "position", "start", "end", "message")
    return _counted(sided, log.columns).where("kept").select("session", *order, *shown)


def transcripts(history_rows: DataFrame) -> DataFrame:
    """Each segment's kept messages as the lines of its transcript, with their places in it.

    Lines stay rows: a segment may be of any length.
    """
    return history_rows.select("session", "segment", "position", "start", F.concat("message", F.lit("\n")).alias("line"))
