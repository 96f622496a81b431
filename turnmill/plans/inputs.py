"""The given tables, and tables derived from them row by row.

Derived columns are written once, in SQL that Spark and the oracle engine read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "conversations": "conv_id long, turn long, role string, text string",
    "benchmark": "item_id long, text string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def q(text: str) -> str:
    """A SQL string literal (the oracle engine keeps backslashes and line ends as they are)."""
    return "'" + text.replace("'", "''") + "'"


# Exam items from `benchmark`: the words of the text serve as options.
ITEM_COLUMNS = [
    "item_id",
    "text as question",
    *[f"split_part(text, ' ', {n}) as {letter}" for n, letter in enumerate("ABCD", 1)],
    "substr('ABCD', cast(item_id % 4 as int) + 1, 1) as answer",
    "case when item_id % 2 = 0 then 'even' else 'odd' end as subject",
    "case when item_id < 5 then 'dev' else 'test' end as split",
]
ITEMS_SQL = f"select {', '.join(ITEM_COLUMNS)} from benchmark"

# An agent trace from `events`: users are conversations, event types are roles.
_WHOLE = "cast(floor(value) as bigint)"
TRACE_COLUMNS = [
    "user_id as conv_id",
    "event_id as turn",
    """case when event_type = 'signup' and value < 2 then 'system'
            when event_type = 'signup' then 'user'
            when event_type in ('view', 'click') then 'assistant'
            when event_type = 'purchase' or value < 40 then 'tool'
            else 'other' end as role""",
    f"""case when event_type = 'signup' then 'ask ' || props
            when event_type = 'view' then ''
            when event_type = 'click' then 'thinking ' || props
            when event_type = 'purchase' then 'result ' || props
            when {_WHOLE} % 9 = 0 then '错误: 除数不能为零'
            when {_WHOLE} % 9 = 1 then '计算错误: ' || props
            when {_WHOLE} % 9 = 2 then '获取时间失败: ' || props
            when {_WHOLE} % 9 = 3 then '获取天气失败: ' || props
            when {_WHOLE} % 9 = 4 then '获取天气信息超时'
            when {_WHOLE} % 9 = 5 then '网络连接错误，无法访问天气服务'
            when {_WHOLE} % 9 = 6 then '无法获取天气信息，服务返回状态码: 500'
            when {_WHOLE} % 9 = 7 then '执行错误: ' || props
            else '42' end as text""",
    f"""case when event_type = 'view' then 'get_time'
            when {_WHOLE} % 3 = 0 then 'calculator'
            when {_WHOLE} % 3 = 1 then 'get_weather'
            else 'get_time' end as tool""",
    "case when event_type = 'click' and value >= 30 then '{bad' else props end as arguments",
    """case when event_type = 'view' then 1
            when event_type <> 'click' or value < 5 then 0
            when value < 15 then 1
            else 2 end as n_calls""",
]
TRACE_SQL = f"select {', '.join(TRACE_COLUMNS)} from events"
SECOND_TOOL = "get_time"
SECOND_ARGUMENTS = '{"zone": "UTC"}'

# A console log from `events`.
LOG_COLUMNS = [
    "user_id as session",
    "event_id as seq",
    "ts",
    """case when event_type = 'error' and value < 10 then ' Quit '
            when event_type = 'error' then 'CLEAR'
            when event_type = 'purchase' and value < 5 then '   '
            else '  ' || event_type || ' ' || props || ' ' end as text""",
    "value >= 4 as ok",
]
LOG_SQL = f"select {', '.join(LOG_COLUMNS)} from events"

# Both sides of a console: the inputs, and a reply to most of those that are messages.
DIALOGUE_SQL = """
    select user_id as session, event_id * 2 as seq, ts, 'user' as role,
           case when event_type = 'error' and value < 10 then 'Exit' when event_type = 'error' then ' clear '
                when event_type = 'purchase' and value < 5 then ' ' else event_type || ' ' || props end as text,
           true as ok
    from events
    union all
    select user_id, event_id * 2 + 1, ts, 'assistant',
           case when value > 40 then 'clear' else ' you said ' || event_type end, value >= 4
    from events
    where event_type <> 'error' and not (event_type = 'purchase' and value < 3) and not (value >= 20 and value < 22)"""

# Conversations as JSON Lines. Some contents are numbers, lists, objects or null.
def _json_text(column: str) -> str:
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        inner = f"chr({ord(plain)})"
        outer = " || ".join(f"chr({ord(c)})" for c in escaped)
        column = f"replace({column}, {inner}, {outer})"
    return f"""'"' || {column} || '"'"""


_KIND = "(conv_id + turn) % 13"
MESSAGE_COLUMNS = [
    "conv_id",
    "turn",
    "role",
    f"case when {_KIND} in (5, 6, 7, 8) then '' else text end as content",
    f"""'{{"role": "' || role || '", "content": ' ||
        case {_KIND} when 5 then cast(turn as string) when 6 then '[{{"type": "text", "text": ' || {_json_text('text')} || '}}]'
                     when 7 then '{{"b": 1, "a": [2]}}' when 8 then 'null' else {_json_text('text')} end || '}}' as json""",
]
MESSAGE_SQL = f"select {', '.join(MESSAGE_COLUMNS)} from conversations"
EXAM_LINE = f"""'{{"conversations": [{{"role": "user", "content": ' || {_json_text('question')} ||
    '}}, {{"role": "assistant", "content": "' || answer || '"}}], "split": "' || split || '"}}'"""

# Landed responses of the weather services from `events`.
_K = """cast(replace(replace(props, '{"k": ', ''), '}', '') as bigint)"""
_POINT = (
    """'{"main": {"temp": ' || {k} || '.5, "feels_like": ' || {k} || ', "humidity": 40}, """
    """"weather": [{"description": "晴"}], "dt_txt": "day ' || {k} || '"}'"""
)


POINTS = 12


def _point(k: str) -> str:
    return _POINT.replace("{k}", f"cast({k} as string)")


PAYLOAD_COLUMNS = [
    "event_id",
    "event_type as location",
    f"cast(k % 7 as int) as forecast_days",
    "case when event_type = 'signup' and value < 5 then 429 when event_type = 'signup' and value < 8 then 503 else 200 end as geo_status",
    """case when event_type = 'purchase' and value < 5 then '[]'
            when event_type = 'purchase' and value < 8 then '[{"name": "Beij'
            when event_type = 'purchase' then '[{"name": "Beijing", "country": "CN", "local_names": {"zh": "北京"}}]'
            else '[{"name": "Somewhere"}]' end as geo_body""",
    "case when event_type <> 'error' then 200 when value < 10 then 401 when value < 20 then 429 else 500 end as status",
    # Some bodies break off; a forecast has twelve points, fewer than some days ask for.
    f"""case when event_type = 'view' and value < 3 then '{{"list": [{{"main": '
            when event_type = 'view' and value < 5 then '{{"list": []}}'
            when k % 7 = 0 then {_point("k")}
            else '{{"list": [' || {" || ', ' || ".join(_point(f"k + {i}") for i in range(POINTS))} || ']}}'
            end as body""",
]
# The number in ``props`` is worked out once a row.
PAYLOAD_SQL = f"select {', '.join(PAYLOAD_COLUMNS)} from (select *, {_K} as k from events)"


def items(spark: SparkSession, folder: str, split: str | None = None) -> DataFrame:
    rows = table(spark, folder, "benchmark").selectExpr(*ITEM_COLUMNS)
    return rows if split is None else rows.where(F.col("split") == split)


def trace(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").selectExpr(*TRACE_COLUMNS)
    first = F.struct(F.col("tool").alias("name"), F.col("arguments").alias("arguments"))
    second = F.struct(F.lit(SECOND_TOOL).alias("name"), F.lit(SECOND_ARGUMENTS).alias("arguments"))
    return rows.withColumn("tool_calls", F.slice(F.array(first, second), F.lit(1), F.col("n_calls")))


def log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*LOG_COLUMNS)


def dialogue(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return spark.sql(DIALOGUE_SQL.replace("from events", "from {events}"), events=events)


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr("*", f"{_K} as k").selectExpr(*PAYLOAD_COLUMNS)
