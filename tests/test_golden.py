"""Edge cases with results written out."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.functions import chat, tools
from turnmill.functions import text as tx
from turnmill.operators import corpus, grading, history, models, rendering, traces, vectors
from turnmill.plans import stubs

ANSWERS = [
    ("A", "A"), ("b", "B"), ("  c ", "C"), ("答案是A", "A"), ("选择 b", "B"), ("我认为A正确", "A"),
    ("I think C.", "C"), ("这是 Because", "B"), ("banana", "B"), ("", "UNKNOWN"), ("无", "UNKNOWN"),
    ("Definitely B", "D"), ("　D", "D"), ("x:d", "D"), ("应该为C", "C"), ("选项（B）", "B"), ("\nA", "A"),
    ("e\u0301 A\u0301 C", "A"), ("\u00e9 \u00c1 C", "C"), ("_A_ b", "B"), ("\x1cB", "B"), ("（Ａ）", "UNKNOWN"), ("x=B2", "B"), ("zz C‍", "C"),
    ("ẚ", "A"), (None, "UNKNOWN"), ("答　\x1c c", "C"),
]

TURNS = "conv_id long, turn long, role string, text string, tool_calls " + chat.TOOL_CALLS
TRACE = [
    (1, 0, "system", "S", None),
    (1, 1, "user", "U", None),
    (1, 2, "assistant", "hi", [("get_time", '{"zone": "Asia/Shanghai"}'), ("calculator", '{"expression": "1+1"}')]),
    (1, 3, "tool", "t1", None),
    (1, 4, "tool", "t2", None),
    (1, 5, "assistant", "done", None),
    (2, 0, "tool", "x", None),
    (2, 1, "user", "y", None),
    (2, 2, "other", "zz", None),
    (3, 0, "user", None, None),
    (3, 1, "system", "later", None),
    (3, 2, "assistant", None, [("get_time", "{}")]),
]
ONE = (
    "<|im_start|>user\nU<|im_end|>\n<|im_start|>assistant\nhi\n<tool_call>\n"
    '{"name": "get_time", "arguments": {"zone": "Asia/Shanghai"}}\n</tool_call>\n<tool_call>\n'
    '{"name": "calculator", "arguments": {"expression": "1+1"}}\n</tool_call><|im_end|>\n'
    "<|im_start|>user\n<tool_response>\nt1\n</tool_response>\n<tool_response>\nt2\n</tool_response><|im_end|>\n"
    "<|im_start|>assistant\ndone<|im_end|>\n"
)
TWO = "<|im_start|>user\n<tool_response>\nx\n</tool_response><|im_end|>\n<|im_start|>user\ny<|im_end|>\n"
THREE = (
    "<|im_start|>user\n<|im_end|>\n<|im_start|>system\nlater<|im_end|>\n<|im_start|>assistant\n<tool_call>\n"
    '{"name": "get_time", "arguments": {}}\n</tool_call><|im_end|>\n'
)
SYSTEM = "<|im_start|>system\nS<|im_end|>\n"


def test_extract_answer(spark):
    df = spark.createDataFrame(ANSWERS, "response string, want string")
    wrong = df.withColumn("got", tx.extract_answer(F.col("response"))).where("got <> want").collect()
    assert wrong == []


def test_strip_matches_python(spark):
    points = [p for p in range(0x3100) if not 0xD800 <= p < 0xE000]
    df = spark.createDataFrame([(p, chr(p) + "x" + chr(p)) for p in points], "p int, s string")
    for row in df.select("s", tx.py_strip(F.col("s")).alias("t"), tx.word_count(F.col("s")).alias("n")).collect():
        assert row.t == row.s.strip()
        assert row.n == len(row.s.split())


def test_clip_and_report_line(spark):
    rows = [(1, "q" * 50), (2, "q" * 51)]
    df = spark.createDataFrame(rows, "id int, q string").withColumn("c", tx.clip(F.col("q")))
    assert [r.c for r in df.orderBy("id").collect()] == ["q" * 50, "q" * 50 + "..."]
    line = grading.report_line(F.lit("7"), F.lit("w" * 45), F.lit("UNKNOWN"), F.lit("A"), F.lit(False))
    assert spark.range(1).select(line).first()[0] == f"{'7':<6} | {'w' * 45:<40} | {'UNKNOWN':<5} | {'A':<5} | ✗"


@pytest.mark.parametrize("turns_per_block", [1, 2, 16_384])
@pytest.mark.parametrize("with_tools", [False, True])
def test_render_trace(spark, turns_per_block, with_tools):
    df = spark.createDataFrame(TRACE, TURNS)
    offered = ['{"name": "a"}', '{"name": "b"}'] if with_tools else None
    rows = rendering.render(df, turns_per_block=turns_per_block, tools=offered, generation_prompt=with_tools).collect()
    text = {}
    for row in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        assert row.start == len(text.get(row.conv_id, ""))
        text[row.conv_id] = text.get(row.conv_id, "") + row.segment
    if not with_tools:
        assert text == {1: SYSTEM + ONE, 2: TWO, 3: THREE}
        return
    block = fixed.TOOLS_HEAD + '\n{"name": "a"}\n{"name": "b"}' + fixed.TOOLS_TAIL
    end = fixed.ASSISTANT_OPEN
    assert text == {
        1: fixed.SYSTEM_OPEN + "S\n\n" + block + ONE + end,
        2: fixed.SYSTEM_OPEN + block + TWO + end,
        3: fixed.SYSTEM_OPEN + block + THREE + end,
    }


@pytest.mark.parametrize("offered", [None, ["{}"]])
def test_nested_rendering_equals_long(spark, offered):
    df = spark.createDataFrame(TRACE, TURNS)
    entry = F.struct("turn", "role", F.col("text").alias("content"), "tool_calls")
    nested = df.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("m"))
    body = chat.render_messages(F.col("m"), tools=offered, generation_prompt=True, with_calls=True)
    got = {r.conv_id: r.t for r in nested.select("conv_id", body.alias("t")).collect()}
    want = {}
    rows = rendering.render(df, tools=offered, generation_prompt=True).collect()
    for row in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        want[row.conv_id] = want.get(row.conv_id, "") + row.segment
    assert got == want


@pytest.mark.parametrize("turns_per_block", [1, 2, 16_384])
def test_spans_slice_back(spark, turns_per_block):
    df = spark.createDataFrame(TRACE, TURNS)
    options = {"tools": ["{}"], "generation_prompt": True}
    text = {}
    for row in sorted(rendering.render(df, **options).collect(), key=lambda r: (r.conv_id, r.turn)):
        text[row.conv_id] = text.get(row.conv_id, "") + row.segment
    spans = rendering.loss_spans(df, turns_per_block=turns_per_block, **options).collect()
    assert sorted(text[s.conv_id][s.start : s.end] for s in spans) == sorted(
        [
            "done",
            '<tool_call>\n{"name": "get_time", "arguments": {}}\n</tool_call>',
            'hi\n<tool_call>\n{"name": "get_time", "arguments": {"zone": "Asia/Shanghai"}}\n</tool_call>\n'
            '<tool_call>\n{"name": "calculator", "arguments": {"expression": "1+1"}}\n</tool_call>',
        ]
    )


def test_calls_read_back(spark):
    df = spark.createDataFrame(TRACE, TURNS)
    body = chat.assistant_body(F.coalesce("text", F.lit("")), F.col("tool_calls"))
    written = df.select("conv_id", "turn", "role", body.alias("text"))
    got = traces.parsed_calls(written).select("conv_id", "call_no", "tool", "valid").collect()
    assert sorted(map(tuple, got)) == [
        (1, 0, "get_time", True), (1, 1, "calculator", True), (3, 0, "get_time", True)
    ]


def test_first_prompt_and_pairs(spark):
    nested = spark.createDataFrame(
        [([("system", "s"), ("user", "a"), ("user", "b")],), ([("assistant", "x")],), ([("user", "　 ")],), ([],)],
        "conversations array<struct<role:string,content:string>>",
    )
    assert [r.prompt for r in corpus.prompts_nested(nested).collect()] == ["a"]
    lists = spark.createDataFrame([(["p", "q", "r"], ["c", "d"])], "p array<string>, c array<string>")
    pairs = lists.select(chat.pair_list_chats(F.col("p"), F.col("c")).alias("x")).first().x
    assert [[tuple(m) for m in pair] for pair in pairs] == [
        [("user", "p"), ("assistant", "c")], [("user", "q"), ("assistant", "d")]
    ]


def test_run_label(spark):
    kind, path = F.col("t"), F.col("p")
    df = spark.createDataFrame([("base", "out/x"), ("lora", "out/some-adapter")], "t string, p string")
    assert [r[0] for r in df.select(tx.run_label(kind, path)).collect()] == ["base", "lora_some-adapter"]


def test_local_time(spark):
    at = datetime.datetime(2024, 7, 1, 20, 30, 5)
    zones = [("Asia/Shanghai",), ("America/New_York",), ("Mars/Base",)]
    # 02:30 on that day does not exist in New York, whatever zone the session has.
    gap = F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert spark.range(1).select(tools.local_time(gap, F.lit("UTC"))).first()[0] == "2024-03-10 02:30:00 星期日"
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.createDataFrame(zones, "z string").select(tools.local_time(F.lit(at).cast("timestamp_ntz"), F.col("z")))
    assert [r[0] for r in df.collect()] == [
        "2024-07-02 04:30:05 星期二",
        "2024-07-01 16:30:05 星期一",
        "获取时间失败: 'No time zone found with key Mars/Base'",
    ]


def test_weather(spark):
    place = '[{"name": "Beijing", "country": "CN", "local_names": {"zh": "北京"}}]'
    now = '{"main":{"temp":3.5,"feels_like":1.0,"humidity":40},"weather":[{"description":"晴"}]}'
    points = ",".join(
        f'{{"dt_txt":"t{i}","main":{{"temp":{i},"feels_like":1,"humidity":5}},"weather":[{{"description":"云"}}]}}'
        for i in range(40)
    )
    later = f'{{"list":[{points}]}}'
    rows = [
        (0, "b", 0, 200, place, 200, now),
        (1, "b", 2, 200, place, 200, later),
        (2, "b", 5, 200, place, 200, later),
        (3, "b", 6, 200, place, 200, later),
        (4, "b", 0, 200, "[]", 200, now),
        (5, "b", 0, 401, None, None, None),
        (6, "b", 1, 200, place, 503, None),
        (7, "b", 0, 200, place, 429, None),
        (8, "b", 0, 200, place, 200, '{"main"'),
        (9, "b", 1, 200, place, 200, '{"list":[]}'),
        (10, "b", 0, 200, "oops", 200, now),
    ]
    failed = fixed.WEATHER_FAILED + tools.UNREADABLE
    schema = "n int, location string, forecast_days int, geo_status int, geo_body string, status int, body string"
    got = [(r.answer, r.outcome) for r in traces.weather(spark.createDataFrame(rows, schema)).orderBy("n").collect()]
    assert got == [
        ("北京（CN）天气：晴\n温度：3.5°C (体感温度：1.0°C)\n湿度：40%", "ok"),
        ("北京（CN）天气预报（t16）：云\n预计温度：16°C (体感温度：1°C)\n预计湿度：5%", "ok"),
        ("北京（CN）天气预报（t39）：云\n预计温度：39°C (体感温度：1°C)\n预计湿度：5%", "ok"),
        (fixed.BAD_DAYS, "rejected"),
        ("错误: 找不到城市 'b'，请检查城市名称是否正确", "city_unknown"),
        (fixed.BAD_KEY, "bad_key"),
        ("无法获取天气预报，服务返回状态码: 503", "failed"),
        (fixed.RATE_LIMITED, "rate_limited"),
        (failed, "weather_failed"),
        (failed, "weather_failed"),
        (failed, "weather_failed"),
    ]


def test_outcomes(spark):
    rows = [(p + " more", name) for p, name in fixed.OUTCOME_PREFIXES] + [("42", "ok"), (None, "ok")]
    df = spark.createDataFrame(rows, "text string, want string")
    assert df.where(tools.outcome(F.col("text")) != F.col("want")).count() == 0


def test_commands(spark):
    rows = [
        ("s", 1, "hi", True), ("s", 2, "clear", True), ("s", 3, "yo", True), ("s", 4, "  ", True),
        ("t", 1, "a", True), ("t", 2, " QUIT\n", True), ("t", 3, "b", True), ("t", 4, "bad", False), ("t", 5, "c", True),
    ]
    log = spark.createDataFrame(rows, "session string, seq long, text string, ok boolean")
    log = log.withColumn("ts", F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    got = history.history(log, ["ts", "seq"]).select("session", "seq", "segment", "position", "start", "end")
    assert sorted(map(tuple, got.collect())) == [
        ("s", 1, 0, 1, 0, 3), ("s", 3, 1, 1, 0, 3), ("t", 1, 0, 1, 0, 2), ("t", 3, 1, 1, 0, 2), ("t", 5, 1, 2, 2, 4)
    ]
    back = history.rolled_back(log).select("session", "seq").collect()
    assert [tuple(r) for r in back] == [("t", 4)]


def test_metadata(spark):
    raw = '{"a": "x", "b": 3, "c": null, "d": {"e": [1, 2]}, "f": true}'
    df = spark.createDataFrame([(raw,), (None,)], "m string")
    got = [r[0] for r in df.select(vectors.clean_metadata_json(F.col("m"))).collect()]
    assert got == [{"a": "x", "b": "3", "d": '{"e":[1,2]}', "f": "true"}, {}]


def test_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<float>")
    assert [r[0] for r in df.select(vectors.l2_normalize(F.col("v"))).collect()] == [[0.0, 0.0], [0.6, 0.8]]


def test_variants():
    assert models.variant(stubs.VARIANTS, "lora") is stubs.VARIANTS["lora"]
    with pytest.raises(ValueError):
        models.variant(stubs.VARIANTS, "other")
    with pytest.raises(ValueError):
        models.variant({}, "base")


def test_token_counter(spark):
    def factory():
        import numpy as np

        return lambda text: np.array([len(t) // 2 for t in text], dtype=np.int32)

    df = corpus.with_length(spark.createDataFrame([("abcdef",)], "text string"), counter=models.token_counter(factory))
    assert df.first().n_tokens == 3


def test_empty_summary(spark):
    graded = spark.createDataFrame([], "is_correct boolean, predicted string")
    assert tuple(grading.summarize(graded).first()) == (0, 0, 0, 0, 0.0)


def test_series_slot_of_short_series(spark):
    rows = [(1, i, float(i)) for i in range(10)] + [(2, 0, 7.0)]
    got = traces.series_slots(spark.createDataFrame(rows, "k int, at int, v double"), "k", ["at"], "v").collect()
    assert sorted((r.k, r.day, r.at) for r in got) == [
        (1, 1, 8), (1, 2, 9), (1, 3, 9), (1, 4, 9), (1, 5, 9), *[(2, d, 0) for d in range(1, 6)]
    ]
