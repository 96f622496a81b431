"""A vector collection kept in hash buckets, with versions.

Rows lie in buckets by a hash of their id. A version is a small file that names, for each
bucket, the folder that holds it and its rows; an upsert rewrites the buckets that its batch
touches and names the others again. A version's file is put in its place under the version's
number, which fails where the number is taken: of two writers one wins, the other merges with
what the winner has written. Readers take the newest version and never meet half a one.

The file system must refuse to rename onto a file that is there (HDFS does so atomically; a
local disk checks first, so writers of one local collection should take turns).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill.operators.vectors import latest
from turnmill.session import file_system, stored

#: Buckets of a new collection. They bound a version's file; choose more for more rows.
BUCKETS = 256
ROWS_PER_FILE = 1_000_000
TRIES = 100


@dataclass(frozen=True)
class Version:
    """``held`` maps a bucket to (folder, rows); buckets without rows are absent."""

    number: int
    key: str
    buckets: int
    schema: T.StructType
    held: dict[int, tuple[str, int]]

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.held.values())

    def text(self) -> str:
        held = {str(b): list(x) for b, x in sorted(self.held.items())}
        return json.dumps({"key": self.key, "buckets": self.buckets, "schema": self.schema.json(), "held": held})


def newest(spark: SparkSession, path: str) -> Version | None:
    """The newest version of a collection; None where there is none."""
    fs, root = file_system(spark, f"{path}/versions")
    if not fs.exists(root):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    numbers = [int(n) for n in names if n.isdigit()]
    if not numbers:
        return None
    number = max(numbers)
    body = json.loads(spark.read.text(f"{path}/versions/{number}", wholetext=True).first().value)
    held = {int(b): (folder, rows) for b, (folder, rows) in body["held"].items()}
    return Version(number, body["key"], body["buckets"], T.StructType.fromJson(json.loads(body["schema"])), held)


def commit(spark: SparkSession, path: str, version: Version) -> bool:
    """Puts a version in its place; False if its number is taken."""
    jvm = spark.sparkContext._jvm
    fs, own = file_system(spark, f"{path}/versions/.{uuid.uuid4().hex}")
    out = fs.create(own, True)
    out.write(version.text().encode())
    out.close()
    hadoop = jvm.org.apache.hadoop.fs
    target = fs.makeQualified(hadoop.Path(f"{path}/versions/{version.number}"))
    context = hadoop.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        context.rename(fs.makeQualified(own), target, options)
    except Exception as error:
        fs.delete(own, False)
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, version: Version, buckets: list[int] | None = None) -> DataFrame:
    chosen = version.held if buckets is None else {b: version.held[b] for b in buckets if b in version.held}
    folders = [f"{path}/data/{folder}/bucket={b}" for b, (folder, _) in chosen.items()]
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*folders)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a collection."""
    version = newest(spark, path)
    if version is None:
        raise FileNotFoundError(f"no collection at {path}")
    return _read(spark, path, version)


def count_collection(spark: SparkSession, path: str) -> int:
    """Rows of the newest version, as its file says."""
    version = newest(spark, path)
    return 0 if version is None else version.rows


def _rewrite(
    spark: SparkSession, path: str, base: Version, new: DataFrame, touched: dict[int, int]
) -> dict[int, tuple[str, int]]:
    """Writes the touched buckets with the new rows in the place of those with their ids."""
    old = _read(spark, path, base, list(touched))
    kept = old.join(new.select(base.key), base.key, "left_anti")
    rows = kept.select(*base.schema.names).unionByName(new.select(*base.schema.names))
    most = max(n + base.held.get(b, ("", 0))[1] for b, n in touched.items())
    files = -(-most // ROWS_PER_FILE)
    # A large bucket is written by several tasks.
    part = F.pmod(F.xxhash64(F.col(base.key).cast("string"), F.lit(1)), F.lit(files))
    rows = rows.withColumn("bucket", bucket_of(base.key, base.buckets)).repartition(len(touched) * files, "bucket", part)
    folder = uuid.uuid4().hex
    rows.write.partitionBy("bucket").parquet(f"{path}/data/{folder}")
    counts = spark.read.parquet(f"{path}/data/{folder}").groupBy("bucket").count().collect()  # a row a bucket
    return {r["bucket"]: (folder, r["count"]) for r in counts}


def upsert_collection(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: str = "chunk_id",
    order: str | None = None,
    buckets: int = BUCKETS,
) -> int:
    """Upserts a batch into the collection at ``path`` (made if missing); returns its row count.

    Without ``order`` an id that is twice in the batch fails the job, with it the last wins.
    ``buckets`` is that of a new collection. A null id is an id like others in its bucket but
    never equals one that is there, so it should not be used.
    """
    base = newest(spark, path)
    names = [c for c in batch.columns if c != order] if base is None else base.schema.names
    if "bucket" in names:
        raise ValueError("a collection can't have a column named 'bucket'")
    new = stored(latest(batch, key, order).select(*names), "batch")
    made: dict[int, tuple[str, int]] = {}
    touched: dict[int, int] = {}
    seen: dict | None = None
    for _ in range(TRIES):
        if base is None:
            base = Version(0, key, buckets, new.schema, {})
        if not touched:
            counts = new.groupBy(bucket_of(key, base.buckets).alias("b")).count().collect()  # a row a bucket
            touched = {r["b"]: r["count"] for r in counts}
        now = {b: base.held.get(b) for b in touched}
        if touched and now != seen:  # a first try, or another writer has changed a bucket of ours
            made, seen = _rewrite(spark, path, base, new, touched), now
        version = Version(base.number + 1, base.key, base.buckets, base.schema, base.held | made)
        if commit(spark, path, version):
            return version.rows
        base = newest(spark, path)
    raise RuntimeError(f"{TRIES} other writers came first")
