"""What the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Iterable

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.session import run_dir

#: Rows of one Arrow batch, and the bytes at which Spark closes it earlier.
BATCH_ROWS = 2_000
BATCH_BYTES = "16m"
#: Pieces that the rows of one key are dealt to.
SALTS = 256


def bounded_batches(df: DataFrame) -> DataFrame:
    """Bounds what one Arrow batch brings into a Python worker, unless the session sets its own."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def worker_store(name: str) -> dict:
    """A dict that the Python worker keeps over all tasks that use it.

    Workers outlive stages: one that asks for another store lets go of what it kept before,
    so an encoder's remembered words don't weigh on the stages behind it.
    """
    module = sys.modules.setdefault("_turnmill_worker", types.ModuleType("_turnmill_worker"))
    stores = module.__dict__.setdefault("stores", {})
    if name not in stores:
        stores.clear()
        stores[name] = {}
        give_back()
    return stores[name]


def give_back() -> None:
    """Hands memory that was freed back to the system; allocators keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Values of a string column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: lost executors don't bring it back to life."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_blocks(column: pa.Array | pa.ChunkedArray) -> tuple[bytes, list[int]]:
    """All UTF-8 bytes of a string column in a row, and where each value starts (and the last ends)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    parts = [x.encode() if x else b"" for x in column.to_pylist()]
    ends, total = [0], 0
    for p in parts:
        total += len(p)
        ends.append(total)
    return b"".join(parts), ends


def attach(
    rows: DataFrame, key: str, over: DataFrame, *aggs: tuple[Column, str], having: Column | None = None
) -> DataFrame:
    """Each row with aggregates over the rows of ``over`` that have its key; a hot key is spread.

    ``aggs`` hold (aggregate over ``over``, how the partial values merge: min, max or sum),
    each aliased. The aggregate travels to as many places as it has rows in: rows of a key
    are dealt to ``SALTS`` pieces by the column ``salt`` (a long, needed in both frames), the
    aggregate is worked out for each piece and then for the key, and goes back to the pieces.
    Rows whose key is null or not in ``over`` get nulls; with ``having``, a condition on the
    aggregates, rows of other keys are left out.
    """
    names = [a._jc.toString().rsplit(" AS ", 1)[1] for a, _ in aggs]
    piece = F.pmod(F.col("salt"), F.lit(SALTS)).cast("int")
    partial = over.where(F.col(key).isNotNull()).groupBy(key, piece.alias("__piece")).agg(*[a for a, _ in aggs])
    whole = partial.groupBy(key).agg(
        *[getattr(F, how)(n).alias(n) for n, (_, how) in zip(names, aggs, strict=True)],
        F.collect_list("__piece").alias("__pieces"),
    )
    if having is not None:
        whole = whole.where(having)
    back = whole.select(key, *names, F.explode("__pieces").alias("__piece"))
    return rows.withColumn("__piece", piece).join(back, [key, "__piece"], "left" if having is None else "inner").drop("__piece")


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a path and the path in it; a path without scheme is local."""
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


def write_file(folder: str, suffix: str, parts: Iterable[bytes]) -> str:
    """Writes a new file under the shared folder; returns its path.

    The name is new for each attempt, so a task that runs again never touches a file that an
    earlier attempt has reported; files that nobody reported are never read.
    """
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"
    fs, inner = filesystem(path)
    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(inner, compression=None) as out:
        for part in parts:
            out.write(part)
    return path


def spread(df: DataFrame, rows_per_task: int = 1) -> DataFrame:
    """A short list of work items (files), dealt one by one to tasks of their own."""
    n = max(1, -(-df.count() // rows_per_task))
    return df.repartition(n)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    from turnmill.plans.inputs import table

    return table(spark, folder, "documents")
