"""Heavy keys, splits, searches and plans: results must not depend on how work is cut."""

from __future__ import annotations

import math

import __spark_entry__ as contract
import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from turnmill.operators import blocks, corpus, fewshot, grading, history, joins, rendering, split, traces, vectors
from turnmill.plans import inputs, registry
from turnmill.plans.sessions import ORDER

FOLDER = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def skewed_log(spark):
    """One session holding far more rows than the others together."""
    log = inputs.log(spark, FOLDER)
    return log.withColumn("session", F.when(F.col("session") % 3 > 0, 0).otherwise(F.col("session")).cast("long"))


@pytest.mark.parametrize("size", [1, 16, 300, 1 << 20])
@pytest.mark.parametrize("moment", [False, True])
def test_heavy_session_equals_plain(spark, size, moment):
    """A session with most rows, in one moment too, lies in several blocks of at most ``size`` rows."""
    log = skewed_log(spark)
    if moment:
        log = log.withColumn("ts", F.min("ts").over(Window.partitionBy(F.lit(1))))
    log = log.withColumn("session", F.when(F.col("session") == 0, None).otherwise(F.col("session")))
    plain = history.history(log, ORDER)
    limits = {"share": 0.1, "min_rows": 10, "size": size}
    assert len(blocks.heavy_keys(log, ["session"], 0.1, 10)) == 1
    cut = history.blocked_log(log, ORDER, **limits)
    counts = cut.rows.groupBy("session", blocks.BLOCK).count().where("session is null").collect()
    total = log.where("session is null").count()
    assert sum(r["count"] for r in counts) == total and max(r["count"] for r in counts) <= size
    assert len(counts) >= total / size
    assert rows_of(history.history(log, ORDER, **limits)) == rows_of(plain)


def test_heavy_keys_are_bounded(spark):
    log = inputs.log(spark, FOLDER)
    assert blocks.heavy_keys(log, ["session"], 1e-5, 1_000_000) == []
    assert 0 < len(blocks.heavy_keys(log, ["session"], 0.001, 0)) < 1000


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_running_and_neighbours_equal_windows(spark, size):
    events = inputs.table(spark, FOLDER, "events").withColumn("user_id", F.col("user_id") % 3)
    window = Window.partitionBy("user_id").orderBy("event_id")
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    value = F.length("event_type")
    want = events.select(
        "event_id",
        F.sum(value).over(so_far).alias("a"),
        F.max(value).over(so_far).alias("b"),
        F.min("event_id").over(so_far).alias("c"),
        F.lag("event_type").over(window).alias("p"),
        F.lead("event_type").over(window).alias("f"),
    )
    cut = blocks.by_number(events, ["user_id"], "event_id", size)
    cut = blocks.neighbours(cut, "event_type")
    cut = blocks.running(cut, {"a": ("sum", value), "b": ("max", value), "c": ("min", F.col("event_id"))})
    got = cut.rows.select("event_id", "a", "b", "c", F.col("previous.value").alias("p"), F.col("following.value").alias("f"))
    assert rows_of(got) == rows_of(want)


def test_more_long_keys_than_listed(spark, monkeypatch):
    chats = inputs.table(spark, FOLDER, "conversations")
    want = rows_of(rendering.loss_spans(chats))
    assert rows_of(rendering.loss_spans(chats, turns_per_block=2)) == want
    monkeypatch.setattr(blocks, "MOST_KEYS_SENT", 3)
    assert blocks.by_number(chats, ["conv_id"], "turn", 2).several is None
    assert rows_of(rendering.loss_spans(chats, turns_per_block=2)) == want


def test_audit_and_accuracy_do_not_depend_on_blocks(spark):
    trace = inputs.trace(spark, FOLDER)
    assert rows_of(traces.audit(trace, 5)) == rows_of(traces.audit(trace))
    graded = inputs.table(spark, FOLDER, "events").select(
        F.lit("m").alias("model_id"), F.col("event_id").alias("item_id"), (F.col("value") > 9).alias("is_correct")
    )
    assert rows_of(grading.running_accuracy(graded, ["model_id"], items_per_block=13)) == rows_of(
        grading.running_accuracy(graded, ["model_id"])
    )


@pytest.mark.parametrize("n", [1, 9, 10, 11, 70, 1000])
def test_split_is_exact(spark, n):
    rows = spark.range(n).select(F.col("id").alias("conv_id")).withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1))))
    done = split.train_val_split(rows)
    assert done.count() == 2 * n
    counts = {r.split: r.n for r in split.split_counts(done).collect()}
    assert counts.get("val", 0) == math.ceil(0.1 * n)
    assert sum(counts.values()) == n
    assert done.select("conv_id", "split").distinct().count() == n


def brute_force(queries, members, k):
    found = []
    for q, v in queries:
        ranked = sorted((sum((a - b) ** 2 for a, b in zip(v, w, strict=True)), m) for m, w in members)[:k]
        found += [(q, r, m, round(d, 9)) for r, (d, m) in enumerate(ranked, 1)]
    return sorted(found)


def vector_tables(spark, copies):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(120, 6)).astype(np.float32).round(2)
    points[:copies] = points[0]  # a third of all rows may be copies of one
    members = [(f"c{i:03d}", [float(x) for x in p]) for i, p in enumerate(points)]
    queries = [(i, [float(x) for x in p]) for i, p in enumerate(points[::2])]
    return (
        spark.createDataFrame(queries, "query_id long, embedding array<float>").repartition(5),
        spark.createDataFrame(members, "chunk_id string, embedding array<float>").repartition(7),
        brute_force(queries, members, 5),
    )


def found_rows(df):
    return sorted((r.query_id, r["rank"], r.chunk_id, round(r.distance, 9)) for r in df.collect())


@pytest.mark.parametrize("copies", [1, 50])
def test_searches_equal_brute_force(spark, copies):
    queries, members, want = vector_tables(spark, copies)
    assert found_rows(vectors.top_k(queries, members)) == want
    assert found_rows(vectors.top_k(queries, members, broadcast_bytes=64, cells=6)) == want
    assert found_rows(vectors.top_k_cells(queries, members, cells=9, queries_per_block=4, members_per_block=3)) == want
    assert found_rows(vectors.top_k_approx(queries, members, cells=8, probes=8, members_per_block=16)) == want


def test_pivots_of_large_collection(spark):
    _, members, _ = vector_tables(spark, 1)
    assert (vectors.pivots(members, 1) == vectors.pivots(members, 120)[:1]).all()  # filtered, not filtered


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_of_heavy_groups(spark, how):
    rows = spark.range(300).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    groups = spark.range(200).where("id <> 9").select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = joins.join_groups(rows, groups, ["k"], how)
    split_up = joins.join_groups(rows, groups, ["k"], how, share=0.1, min_rows=5)
    assert rows_of(split_up.select("k", "id", "v")) == rows_of(plain.select("k", "id", "v"))


def test_heavy_prompts_and_pairs(spark):
    chats = inputs.table(spark, FOLDER, "conversations")
    limits = {"share": 0.01, "min_rows": 1}
    assert rows_of(corpus.reward_pairs(chats, **limits)) == rows_of(corpus.reward_pairs(chats))
    rewards = spark.range(400).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("prompt_id"), F.col("id").cast("double").alias("reward")
    )
    assert rows_of(corpus.group_advantage(rewards, **limits)) == rows_of(corpus.group_advantage(rewards))


def test_many_shots(spark):
    """Every dev item is in the prompt, however many there are."""
    dev = spark.range(1500).selectExpr(
        "id as item_id", "'q' as question", "'a' as A", "'b' as B", "'c' as C", "'d' as D", "'A' as answer"
    )
    prompt = fewshot.few_shot_prompts(dev.limit(1), dev).first().prompt
    assert prompt.count("q\nA. a") == 1501


def test_sparse_turns(spark):
    """Turn numbers far apart change neither rows nor places."""
    rows = [(1, t, r, x) for t, r, x in ((0, "user", "a"), (100_001, "assistant", "b"), (10**9, "user", "c"))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(rendering.render(df).collect(), key=lambda r: r.turn)
    near = sorted(rendering.render(df.selectExpr("conv_id", "turn % 7 as turn", "role", "text")).collect(), key=lambda r: r.turn)
    assert [(r.start, r.segment) for r in got][0] == (0, "<|im_start|>user\na<|im_end|>\n")
    assert [r.start for r in got] == [0, len(got[0].segment), len(got[0].segment) + len(got[1].segment)]
    assert len(near) == 3
    nested = corpus.nest(df)
    assert nested.count() == 1 and sorted(corpus.unnest(nested).collect()) == sorted(df.collect())


def brute(queries, members, k):
    out = {}
    for q, a in queries:
        gaps = [(float(((np.array(a) - np.array(b)) ** 2).sum()), c) for c, b in members]
        out[q] = [c for _, c in sorted(gaps)[:k]]
    return out


def test_search_with_one_long_vector(spark):
    rng = np.random.default_rng(3)
    unit = rng.standard_normal((300, 8))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    unit[7] *= 1e7
    members = [(f"c{i:03}", v.tolist()) for i, v in enumerate(unit)]
    asked = [(i, (v + 1e-3).tolist()) for i, v in enumerate(unit[:20])]
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    collection = spark.createDataFrame(members, "chunk_id string, embedding array<double>")
    for n in (1, 7):
        found = vectors.top_k(queries, collection.repartition(n), k=5).orderBy("query_id", "rank").collect()
        got = {}
        for r in found:
            got.setdefault(r.query_id, []).append(r.chunk_id)
        assert got == brute(asked, members, 5)


def test_ragged_vectors_are_refused(spark):
    ragged = spark.createDataFrame([("a", [1.0]), ("b", [2.0, 3.0, 4.0])], "chunk_id string, embedding array<double>")
    asked = spark.createDataFrame([(1, [1.0, 2.0])], "query_id long, embedding array<double>")
    with pytest.raises(Exception, match="same number of values"):
        vectors.top_k(asked, ragged.coalesce(1)).collect()


def test_unanswered_items_count(spark):
    gold = spark.createDataFrame([("s", 1, "A"), ("t", 1, "B"), ("t", 2, "C")], "subject string, item_id long, answer string")
    said = spark.createDataFrame([("s", 1, "A"), ("t", 1, "A")], "subject string, item_id long, response string")
    got = sorted((r.subject, r.item_id, r.predicted, r.is_correct) for r in grading.grade(said, gold).collect())
    assert got == [("s", 1, "A", True), ("t", 1, "A", False), ("t", 2, "UNKNOWN", False)]


def test_search_of_few_members(spark):
    queries, members, _ = vector_tables(spark, 1)
    few = members.where(F.col("chunk_id") < "c003")
    for found in (vectors.top_k(queries, few), vectors.top_k_cells(queries, few, cells=4)):
        assert found.count() == 3 * 60
    assert vectors.top_k(queries.where("query_id < 0"), members).count() == 0
    assert vectors.top_k(queries, members.where("chunk_id < ''")).count() == 0


def test_approx_recall(spark):
    vecs = inputs.table(spark, FOLDER, "embeddings")
    queries = vecs.select(F.col("vec_id").alias("query_id"), "embedding")
    members = vecs.select(F.col("vec_id").alias("chunk_id"), "embedding")
    exact = vectors.top_k(queries, members)
    approx = vectors.top_k_approx(queries, members, cells=16, probes=8)
    hits = exact.join(approx, ["query_id", "chunk_id"], "left_semi").count()
    assert hits / exact.count() > 0.7


def test_upsert(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "chunk_id string, text string")
    new = spark.createDataFrame([("b", "3", 0), ("c", "4", 1), ("b", "5", 2)], "chunk_id string, text string, n int")
    want = [("a", "1"), ("b", "5"), ("c", "4")]
    once = vectors.upsert(old, new, order="n")
    assert rows_of(once) == want
    assert rows_of(vectors.upsert(once, new, order="n")) == want
    with pytest.raises(Exception, match="repeated id"):
        vectors.upsert(old, new.drop("n")).collect()


@pytest.mark.parametrize("name", ["render_chat", "loss_spans", "running_accuracy", "train_val_split", "running_history"])
def test_partition_count_does_not_matter(spark, name):
    query = contract.queries()[name]
    results = []
    for n in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(rows_of(query(spark, FOLDER)))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


@pytest.mark.parametrize("name", ["localized_time", "running_history", "session_segments", "series_slot"])
def test_session_zone_does_not_matter(spark, name):
    query = contract.queries()[name]
    want = rows_of(query(spark, FOLDER))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows_of(query(spark, FOLDER)) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON_ALLOWED = {
    "batch_generate", "grade_answers", "eval_details", "eval_summary", "running_accuracy", "model_compare",
    "report_lines", "report_file", "reward_scores", "batch_embed", "topk_exact", "topk_cells", "topk_approx", "topk_ivf", "topk_retrieve",
    "session_stream",
}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - PYTHON_ALLOWED))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    for banned in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text


def test_top_k_limits_before_the_shuffle(spark):
    text = plan(contract.queries()["topk_exact"](spark, FOLDER))
    assert text.index("WindowGroupLimit") >= 0 and text.count("WindowGroupLimit") >= 2
    text = plan(contract.queries()["series_slot"](spark, FOLDER))
    assert text.count("WindowGroupLimit") >= 2


def test_scans_are_pruned(spark):
    text = plan(contract.queries()["first_user_prompt"](spark, FOLDER))
    assert "EqualTo(role,user)" in text
    text = plan(contract.queries()["tool_usage"](spark, FOLDER))
    assert "ts:" not in text


def test_broadcast_queries_are_searched_some_at_a_time(spark, monkeypatch):
    """What a worker holds for the finds of a batch doesn't grow with the queries."""
    nearest = vectors._nearest

    def watched(queries, *rest):
        assert len(queries) <= 7
        return nearest(queries, *rest)

    rng = np.random.default_rng(8)
    points = rng.standard_normal((50, 6)).astype(np.float32)
    members = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "chunk_id long, embedding array<float>")
    queries = members.withColumnRenamed("chunk_id", "query_id")
    want = vectors.top_k(queries, members, k=4).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(vectors, "QUERIES", 7)
    monkeypatch.setattr(vectors, "_nearest", watched)
    got = vectors.top_k(queries, members.repartition(3), k=4).orderBy("query_id", "rank").collect()
    assert got == want
    wide = points.astype(np.float64)
    gaps = ((wide[:, None] - wide[None]) ** 2).sum(axis=2)
    assert [r.chunk_id for r in got] == [int(c) for row in gaps for c in np.lexsort((np.arange(50), row))[:4]]
