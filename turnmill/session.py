"""Session settings shared by jobs and tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="turnmill-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written under the shared folder and read back: worked out once, and safe from lost executors."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as its kind of object."""
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), own


def complete_dirs(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers n, rising, of the folders ``<prefix>n`` under ``path`` whose writing job has ended."""
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return []
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        number = name.removeprefix(prefix)
        if name.startswith(prefix) and number.isdigit() and fs.exists(done(status.getPath(), "_SUCCESS")):
            found.append(int(number))
    return sorted(found)


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, with its file system's scheme; nothing is created yet.

    Without the scheme Spark and other readers might take the path for one of different stores.
    """
    fs, path = file_system(spark, f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return fs.makeQualified(path).toString()
