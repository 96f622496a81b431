"""Writing results; collections are kept by ``sources.collections``."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.functions import text as tx
from turnmill.operators.grading import details, report_foot, report_head, report_lines, summarize
from turnmill.operators.models import Generation
from turnmill.session import file_system
from turnmill.sources.collections import read_collection, upsert_collection

__all__ = ["read_collection", "report", "upsert_collection", "write_results"]

RUN_KEYS = ["model_id", "subject"]


def write_results(
    graded: DataFrame,
    path: str,
    *,
    shots: int,
    base_model: str = "model/qwen",
    adapters: Mapping[str, str] | None = None,
    generation: Generation = Generation(),  # noqa: B008  (frozen)
    completed_at: Column | None = None,
) -> None:
    """Details and summary as tables under ``path``, and each run's report as one text file.

    ``graded`` holds ``model_id``, ``subject`` and the graded items; ``adapters`` names the
    adapter path of each model type but the base one. Reports lie where ``text.report_path``
    says, one file a run, its lines in order.
    """
    spark = graded.sparkSession
    rows = details(graded, RUN_KEYS)
    rows.write.mode("overwrite").partitionBy(*RUN_KEYS).parquet(f"{path}/details")
    # Read back, so the models behind ``graded`` are asked only once.
    stored = spark.read.schema(rows.schema).parquet(f"{path}/details")
    done = F.current_timestamp() if completed_at is None else completed_at
    summary = summarize(stored, RUN_KEYS).withColumn("written_at", done)
    summary.write.mode("overwrite").partitionBy(*RUN_KEYS).parquet(f"{path}/summary")
    summary = spark.read.schema(summary.schema).parquet(f"{path}/summary")
    adapter = F.coalesce(F.try_element_at(_map(adapters or {}), F.col("model_id")), F.lit(""))
    settings = F.struct(
        F.lit(base_model).alias("base_model"),
        adapter.alias("adapter"),
        F.lit(generation.temperature).alias("temperature"),
        F.lit(generation.do_sample).alias("do_sample"),
        F.lit(generation.max_new_tokens).alias("max_new_tokens"),
    )
    summary = summary.withColumn("path", tx.report_path("out", F.col("subject"), tx.run_label(F.col("model_id"), adapter)))
    lines = report(stored, summary, settings, shots)
    lines.write.mode("overwrite").partitionBy("path").text(f"{path}/parts")
    _place(spark, f"{path}/parts", path)


def _map(entries: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for kv in entries.items() for x in kv]
    return F.create_map(*pairs).cast("map<string,string>")


def report(detail_rows: DataFrame, summary: DataFrame, settings: Column, shots: int) -> DataFrame:
    """(path, line) of all runs: a run lies in one partition, its lines in order.

    A report is one text file, so one task writes it, sorted on disk where it is long.
    """
    runs = summary.select(*RUN_KEYS, "path")
    head = summary.select("path", F.lit(0).alias("_section"), F.posexplode(report_head(settings, shots)).alias("_at", "line"))
    body = report_lines(detail_rows, RUN_KEYS).join(runs, RUN_KEYS).select(
        "path", F.lit(1).alias("_section"), F.col("id").alias("_at"), "line"
    )
    foot = summary.select("path", F.lit(2).alias("_section"), F.posexplode(report_foot(F.col("written_at"))).alias("_at", "line"))
    every = head.unionByName(body).unionByName(foot)
    return every.repartition("path").sortWithinPartitions("path", "_section", "_at").select("path", "line")


def _place(spark: SparkSession, parts: str, root: str) -> None:
    """Moves the file of each run, whose folder names its path, to that path."""
    fs, own = file_system(spark, parts)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for run in fs.listStatus(own):  # a folder a run
        name = run.getPath().getName()
        if not name.startswith("path="):
            continue
        files = [f.getPath() for f in fs.listStatus(run.getPath()) if f.getPath().getName().startswith("part-")]
        if len(files) != 1:
            raise RuntimeError(f"{len(files)} files of {name}")
        target = path(f"{root}/{unquote(name.removeprefix('path='))}")
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        fs.rename(files[0], target)
    fs.delete(own, True)
