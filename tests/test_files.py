"""Readers, writers and the stream."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from turnmill.functions.chat import render_messages
from turnmill.operators import corpus, grading, history, vectors
from turnmill.plans import inputs
from turnmill.plans.evaluation import _variants
from turnmill.plans.sessions import ORDER, SHOWN
from turnmill.sources import readers, writers
from turnmill.streaming import sessions

FOLDER = "/root/testdata/sf0.001"


def test_conversations_from_json_lines(spark, tmp_path):
    chats = [
        {"conversations": [{"role": "user", "content": "问"}, {"role": "assistant", "content": "答"}], "extra": 1},
        {"conversations": [{"role": "system", "content": "s"}]},
    ]
    path = tmp_path / "chats.jsonl"
    path.write_text("\n".join(json.dumps(c, ensure_ascii=False) for c in chats), encoding="utf-8")
    read = readers.read_conversations(spark, str(path))
    assert read.columns == ["conversations"]
    assert [r.prompt for r in corpus.prompts_nested(read).collect()] == ["问"]
    assert corpus.to_messages(read).columns == ["messages"]
    texts = [r[0] for r in read.select(render_messages(F.col("conversations"))).collect()]
    assert texts[0] == "<|im_start|>user\n问<|im_end|>\n<|im_start|>assistant\n答<|im_end|>\n"


def test_exam(spark, tmp_path):
    for subject in ("one", "two"):
        for part, n in (("dev", 2), ("test", 3)):
            rows = [(i, f"{subject} q{i}", "a", "b", "c", "d", "A") for i in range(n)]
            spark.createDataFrame(rows, readers.EXAM_ITEMS).coalesce(1).write.parquet(str(tmp_path / "out" / subject / part))
            file = next((tmp_path / "out" / subject / part).glob("part-*.parquet"))
            target = tmp_path / "exam" / subject / f"{part}-00000-of-00001.parquet"
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(file.read_bytes())
    items = readers.read_exam(spark, str(tmp_path / "exam"), ["one", "two"])
    counts = {(r.subject, r.split): r["count"] for r in items.groupBy("subject", "split").count().collect()}
    assert counts == {(s, p): n for s in ("one", "two") for p, n in (("dev", 2), ("test", 3))}


def test_chunks(spark, tmp_path):
    chunks = [
        {"chunk_id": "a", "text": "x", "metadata": {"k": 1, "none": None, "deep": {"z": [1]}}},
        {"chunk_id": "b", "text": "y"},
    ]
    path = tmp_path / "chunks.json"
    path.write_text(json.dumps(chunks, indent=1))
    got = {r.chunk_id: r.metadata for r in readers.read_chunks(spark, str(path)).collect()}
    assert got == {"a": {"k": "1", "deep": '{"z":[1]}'}, "b": {}}


def test_collection_versions(spark, tmp_path):
    path = str(tmp_path / "collection")
    with pytest.raises(FileNotFoundError):
        writers.read_collection(spark, path)
    first = spark.createDataFrame([("a", "1"), ("b", "2")], "chunk_id string, text string")
    second = spark.createDataFrame([("b", "3"), ("c", "4")], "chunk_id string, text string")
    assert writers.upsert_collection(spark, path, first) == 2
    assert writers.upsert_collection(spark, path, second) == 3
    rows = {r.chunk_id: r.text for r in writers.read_collection(spark, path).collect()}
    assert rows == {"a": "1", "b": "3", "c": "4"}


@pytest.mark.parametrize("size,indent", [("400", None), ("700", 2), ("128m", 2)])
def test_array_in_pieces(spark, tmp_path, size, indent):
    """Nested and escaped elements over every edge, as the reader of one task gives them."""
    awkward = ["}", "{", "\\", "\\\"}", "a\"b", '"', "]}[{", "\\\\", "é😀}", "", "\n}\t", 'x\\"', "},{"]
    chunks = [
        {"chunk_id": f"{n}", "text": t, "metadata": {"k": n, "deep": {"z": [{}, {"y": t}], "e": {}}, "none": None}}
        for n, t in enumerate(awkward)
    ]
    chunks.append({"chunk_id": "bare", "text": "y"})
    for n in range(2):
        (tmp_path / f"{n}.json").write_text(json.dumps(chunks[n::2], indent=indent, ensure_ascii=False) + "\n", encoding="utf-8")
    (tmp_path / "none.json").write_text("[]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = readers.read_chunks(spark, str(tmp_path)).collect()
        elements = readers.array_elements(spark, str(tmp_path)).count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = spark.read.schema(readers.CHUNKS).option("multiLine", True).json(str(tmp_path)).where("chunk_id is not null")
    want = whole.withColumn("metadata", vectors.clean_metadata_json(F.col("metadata"))).collect()
    assert elements == len(chunks) and sorted(map(repr, got)) == sorted(map(repr, want))


def test_results(spark, tmp_path):
    path = str(tmp_path / "results")
    graded = _variants(spark, FOLDER)
    adapters = {"lora": "out/my-lora", "grpo": "out/my-grpo"}
    for _ in range(2):  # a second time replaces the first
        writers.write_results(graded, path, shots=5, adapters=adapters)
    assert spark.read.parquet(f"{path}/details").count() == graded.count()
    summary = spark.read.parquet(f"{path}/summary")
    assert summary.count() == 6
    names = {p.name for p in (tmp_path / "results/out/ceval-exma/even").glob("*.txt")}
    assert names == {"base_results.txt", "lora_my-lora_results.txt", "grpo_my-grpo_results.txt"}
    lines = (tmp_path / "results/out/ceval-exma/even/lora_my-lora_results.txt").read_text(encoding="utf-8").splitlines()
    assert lines[:2] == ["=" * 70, "C-Eval Even Evaluation Results"] and "  Adapter Path: out/my-lora" in lines
    assert lines[-2].startswith("Evaluation completed at: ") and lines[-1] == "=" * 70
    ids = [int(x[:6]) for x in lines if re.match(r"\d+ +\| ", x)]  # questions may hold line ends
    assert ids == sorted(ids) and len(ids) == summary.where("model_id = 'lora' and subject = 'even'").first().total


def test_padding_counts_characters(spark):
    row = spark.range(1).select(grading.report_line(F.lit("1"), F.lit("😀 q"), F.lit("A"), F.lit("B"), F.lit(False))).first()
    assert row[0] == f"{'1':<6} | {'😀 q':<40} | {'A':<5} | {'B':<5} | ✗"


def test_stream_over_several_batches_equals_batch(spark, tmp_path):
    events = inputs.table(spark, FOLDER, "events")
    for n in range(4):  # one file and one micro-batch per quarter of the time
        part = events.where(F.col("event_id").between(n * 250, n * 250 + 249)).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "log"))
    stream = sessions.read_log(spark, str(tmp_path / "log"), inputs.SCHEMAS["events"], files_per_trigger=1)
    log = stream.selectExpr(*inputs.LOG_COLUMNS)
    query = sessions.write_history(log, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) >= 2
    got = sessions.read_history(spark, str(tmp_path / "out")).select(*SHOWN)
    want = history.history(inputs.log(spark, FOLDER), ORDER).select(*SHOWN)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_idle_sessions_start_again(spark, tmp_path):
    def add(rows):
        df = spark.createDataFrame(rows, "session long, seq long, ts timestamp_ntz, text string, ok boolean")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))

    def run():
        stream = sessions.read_log(
            spark, str(tmp_path / "log"), "session long, seq long, ts timestamp_ntz, text string, ok boolean"
        )
        query = sessions.write_history(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), idle="10 minutes")
        query.awaitTermination()

    from datetime import datetime

    add([(1, 1, datetime(2024, 1, 1, 0, 0), "a", True)])
    run()
    add([(2, 1, datetime(2024, 1, 1, 5, 0), "x", True)])
    run()
    add([(1, 2, datetime(2024, 1, 1, 5, 1), "b", True), (2, 2, datetime(2024, 1, 1, 5, 1), "y", True)])
    run()
    got = sessions.read_history(spark, str(tmp_path / "out")).select("session", "seq", "position").collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (2, 2, 2)]


@pytest.mark.parametrize("every", [2, 32])
def test_repeated_micro_batches(spark, tmp_path, monkeypatch, every):
    """A micro-batch run again, whole or from its middle, changes nothing; hot and null sessions too."""
    monkeypatch.setattr(sessions, "SNAPSHOT_EVERY", every)
    path = str(tmp_path / "out")
    log = inputs.log(spark, FOLDER).withColumn(
        "session", F.when(F.col("session") % 3 > 0, None).otherwise(F.col("session"))
    )
    limits = {"share": 0.1, "min_rows": 10, "size": 32}
    parts = [log.where(F.col("seq").between(n * 250, n * 250 + 249)) for n in range(4)]
    sessions.take_batch(parts[0], 0, path, **limits)
    sessions.take_batch(parts[0], 0, path, **limits)
    # The second has written its history, but not its numbers: it is taken in anew.
    parts[3].select("session", "seq").write.parquet(f"{path}/history/batch=1")
    for n in (1, 2, 2, 1, 3):
        sessions.take_batch(parts[n], n, path, **limits)
    got = sessions.read_history(spark, path).select(*SHOWN)
    want = history.history(log, ORDER).select(*SHOWN)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
