"""The chat-loop rules on a stream of console inputs.

Each micro-batch is worked out by the batch operators, so a session of any size is cut into
blocks as there. Between micro-batches three numbers a session are kept in a table: its
segment, and the messages and characters kept in it so far (and the time of its last input).
A micro-batch writes its history and the new numbers of the sessions it has met under its
batch number, and counts once both are complete: one that is run again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from turnmill.operators.history import placed
from turnmill.operators.joins import join_groups
from turnmill.session import complete_dirs

#: Micro-batches after which the numbers of all sessions are written together.
SNAPSHOT_EVERY = 32


def read_log(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    *,
    bytes_per_trigger: int = 256 << 20,
    files_per_trigger: int | None = None,
    pattern: str = "*.parquet",
) -> DataFrame:
    """A folder of parquet files as a stream; the bytes (or files) per trigger bound a micro-batch."""
    limit = (
        {"maxBytesPerTrigger": str(bytes_per_trigger)}
        if files_per_trigger is None
        else {"maxFilesPerTrigger": str(files_per_trigger)}
    )
    return (
        spark.readStream.schema(schema)
        .options(**limit)
        .option("pathGlobFilter", pattern)
        .parquet(path)
    )


def _state(spark: SparkSession, path: str, before: int) -> DataFrame | None:
    """The newest numbers of each session from micro-batches before this one: a snapshot and what came after."""
    whole = [n for n in complete_dirs(spark, f"{path}/state", "snapshot=") if n < before]
    base = whole[-1] if whole else -1
    later = [n for n in complete_dirs(spark, f"{path}/state", "batch=") if base < n < before]
    folders = [f"{path}/state/snapshot={base}"] * bool(whole) + [f"{path}/state/batch={n}" for n in later]
    if not folders:
        return None
    rows = spark.read.parquet(*folders)
    newest = rows.groupBy("key").agg(F.max_by(F.struct("segment", "messages", "chars", "ts"), "batch").alias("n"))
    return newest.select("key", "n.*")


def _with_state(rows: DataFrame, state: DataFrame | None, idle: str | None) -> DataFrame:
    """Rows with ``_segment``, ``_messages`` and ``_chars`` of their sessions before the micro-batch."""
    names = ("segment", "messages", "chars")
    if state is None:
        return rows.select("*", *[F.lit(0).cast("long").alias(f"_{n}") for n in names])
    if idle is not None:
        first = rows.groupBy("key").agg(F.min("ts").alias("_first"))
        state = state.join(first, "key").where(F.expr(f"_first <= ts + interval {idle}")).drop("_first")
    known = state.select("key", *[F.col(n).alias(f"_{n}") for n in names])
    joined = join_groups(rows, known, ["key"], "left")
    return joined.withColumns({f"_{n}": F.coalesce(f"_{n}", F.lit(0)) for n in names})


def take_batch(log: DataFrame, batch: int, path: str, seq: str = "seq", idle: str | None = None, **blocks) -> None:
    """Adds one micro-batch to the history at ``path``, unless it is there already."""
    spark = log.sparkSession
    if batch in complete_dirs(spark, f"{path}/state", "batch="):
        return
    columns = ["session", seq, "text", "ok"] + ["ts"] * ("ts" in log.columns)
    rows = placed(log.select(*columns), [seq], **blocks)
    if "ts" not in log.columns:
        rows = rows.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    # As a struct, a null session is equal to itself.
    rows = rows.withColumn("key", F.struct("session")).persist()
    try:
        based = _with_state(rows, _state(spark, path, batch), idle)
        goes_on = F.col("segment") == 0  # no reset in this micro-batch yet
        carried = {n: F.when(goes_on, F.col(n)).otherwise(0) for n in ("_messages", "_chars")}
        based = based.select(
            "key", "session", seq, "ts", "kept", "message",
            (F.col("segment") + F.col("_segment")).alias("segment"),
            (F.col("position") + carried["_messages"]).alias("position"),
            (F.col("start") + carried["_chars"]).alias("start"),
            (F.col("end") + carried["_chars"]).alias("end"),
        )
        shown = ("session", seq, "segment", "position", "start", "end", "message")
        based.where("kept").select(*shown).write.mode("overwrite").parquet(f"{path}/history/batch={batch}")
        last = F.max_by(F.struct("segment", F.col("position").alias("messages"), F.col("end").alias("chars")), seq)
        now = based.groupBy("key").agg(last.alias("n"), F.max("ts").alias("ts")).select(
            "key", "n.*", "ts", F.lit(batch).cast("long").alias("batch")
        )
        now.write.mode("overwrite").parquet(f"{path}/state/batch={batch}")
    finally:
        rows.unpersist()
    if batch % SNAPSHOT_EVERY == SNAPSHOT_EVERY - 1:
        whole = _state(spark, path, batch + 1).withColumn("batch", F.lit(batch).cast("long"))
        whole.write.mode("overwrite").parquet(f"{path}/state/snapshot={batch}")


def write_history(
    log: DataFrame, path: str, checkpoint: str, *, seq: str = "seq", idle: str | None = None, **blocks
) -> StreamingQuery:
    """Takes in everything that is there, micro-batch by micro-batch, then stops.

    ``log`` has session, ``seq``, text, ok and (for ``idle``) ts. Rows of one micro-batch are
    taken in ``seq`` order; across micro-batches arrival order counts, as in a console. With
    ``idle`` a session whose next micro-batch begins later than that after its last input is
    forgotten and starts again. ``path`` and ``checkpoint`` belong together.
    """
    def take(rows: DataFrame, batch: int) -> None:
        take_batch(rows, batch, path, seq, idle, **blocks)

    query = log.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Kept messages with their place in the session, as ``operators.history.history`` gives."""
    done = complete_dirs(spark, f"{path}/state", "batch=")
    if not done:
        raise FileNotFoundError(f"no complete micro-batch at {path}")
    return spark.read.parquet(*[f"{path}/history/batch={n}" for n in done])
