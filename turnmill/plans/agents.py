"""Agent trace and tool payload queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.functions import chat, tools
from turnmill.operators import traces
from turnmill.plans.inputs import PAYLOAD_SQL, POINTS, SECOND_TOOL, TRACE_SQL, payloads, q, table, trace

# Zone by user: three of fixed offset, one that does not exist.
ZONE = """case when user_id % 4 = 0 then 'Asia/Shanghai' when user_id % 4 = 1 then 'Asia/Tokyo'
          when user_id % 4 = 2 then 'UTC' else 'Nowhere/City' end"""


def localized_time(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events")
    return rows.select("event_id", tools.local_time(F.col("ts"), F.expr(ZONE)).alias("local"))


def series_slot(spark: SparkSession, folder: str) -> DataFrame:
    slots = traces.series_slots(table(spark, folder, "events"), "user_id", ["ts", "event_id"], "value")
    return slots.select("user_id", F.col("day").cast("long").alias("day"), "event_id", "value")


def tool_calls_parsed(spark: SparkSession, folder: str) -> DataFrame:
    """Calls read back from the rendered texts of the trace."""
    body = chat.assistant_body(F.col("text"), F.col("tool_calls"))
    written = trace(spark, folder).select("conv_id", "turn", "role", body.alias("text"))
    return traces.parsed_calls(written).withColumn("call_no", F.col("call_no").cast("long"))


def tool_usage(spark: SparkSession, folder: str) -> DataFrame:
    return traces.usage(traces.calls(trace(spark, folder)))


def tool_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return traces.outcomes(trace(spark, folder).where(F.col("role") == "tool"))


def agent_rule_audit(spark: SparkSession, folder: str) -> DataFrame:
    return traces.audit(trace(spark, folder))


def weather_payloads(spark: SparkSession, folder: str) -> DataFrame:
    return traces.weather(payloads(spark, folder)).select("event_id", "answer", "outcome")


QUERIES = {
    f.__name__: f
    for f in (
        localized_time,
        series_slot,
        tool_calls_parsed,
        tool_usage,
        tool_outcomes,
        agent_rule_audit,
        weather_payloads,
    )
}

# Oracle --------------------------------------------------------------------------------

_CALLS = f"""
    select conv_id, turn, 0 as call_no, tool, arguments from ({TRACE_SQL}) where role = 'assistant' and n_calls > 0
    union all
    select conv_id, turn, 1, {q(SECOND_TOOL)}, '{{"zone":"UTC"}}' from ({TRACE_SQL})
    where role = 'assistant' and n_calls > 1"""
_PREFIXES = " ".join(f"when starts_with(text, {q(p)}) then {q(name)}" for p, name in fixed.OUTCOME_PREFIXES)
_WEEKDAYS = "[" + ", ".join(map(q, fixed.WEEKDAYS)) + "]"
_PLACE = """case when geo_body like '%local_names%' then '北京（CN）' else 'Somewhere（）' end"""


def _status(column: str, other: str) -> str:
    return f"""case {column} when 401 then {q(fixed.BAD_KEY)} when 429 then {q(fixed.RATE_LIMITED)}
               else {q(other)} || {column} end"""


def _readings(point: str, prefix: str) -> str:
    return f"""json_extract_string({point}, '$.weather[0].description') || chr(10) || '{prefix}温度：' ||
        json_extract_string({point}, '$.main.temp') || '°C (体感温度：' ||
        json_extract_string({point}, '$.main.feels_like') || '°C)' || chr(10) || '{prefix}湿度：' ||
        json_extract_string({point}, '$.main.humidity') || '%'"""


_POINT = f"json_extract(body, '$.list[' || least(8 * forecast_days, {POINTS - 1}) || ']')"
_BROKEN = "(event_type = 'purchase' and value >= 5 and value < 8)"
_UNREADABLE = "(event_type = 'view' and value < 5)"
_FAILED = q(fixed.WEATHER_FAILED + tools.UNREADABLE)
_LOCATED = "forecast_days between 0 and 5 and geo_status = 200"

ORACLE = {
    "localized_time": f"""
        select event_id, case when zone = 'Nowhere/City' then '获取时间失败: ''No time zone found with key Nowhere/City'''
            else strftime(local, '%Y-%m-%d %H:%M:%S') || ' ' || {_WEEKDAYS}[isodow(local)] end as local
        from (select event_id, zone, ts + case zone when 'Asia/Shanghai' then interval 8 hour
                  when 'Asia/Tokyo' then interval 9 hour else interval 0 hour end as local
              from (select *, {ZONE} as zone from events))""",
    "series_slot": """
        with s as (select user_id, list(struct_pack(e := event_id, v := value) order by ts, event_id) as s
                   from events group by user_id)
        select user_id, day, s[least(8 * day, len(s) - 1) + 1].e as event_id,
               s[least(8 * day, len(s) - 1) + 1].v as value
        from s, range(1, 6) as t(day)""",
    "tool_calls_parsed": f"""
        select conv_id, turn, call_no, case when arguments <> '{{bad' then tool end as tool,
               case when arguments <> '{{bad' then replace(arguments, ': ', ':') end as arguments,
               arguments <> '{{bad' as valid
        from ({_CALLS})""",
    "tool_usage": f"""
        select tool, cast(sum(n) as bigint) as calls, count(*) as conversations, max(n) as most_in_one
        from (select tool, conv_id, count(*) as n from ({_CALLS}) group by all) group by tool""",
    "tool_outcomes": f"""
        select tool, case {_PREFIXES} else 'ok' end as outcome, count(*) as n
        from ({TRACE_SQL}) where role = 'tool' group by all""",
    "agent_rule_audit": f"""
        with n as (select *, sum((role = 'user')::int) over (partition by conv_id order by turn) as user_turn,
                          case when role = 'assistant' and n_calls > 0 then tool end as called
                   from ({TRACE_SQL})),
        g as (select conv_id, cast(user_turn as bigint) as user_turn,
                     arg_min(called, turn) filter (called is not null) as first_tool, count(called) as iterations
              from n where user_turn > 0 group by all)
        select *, coalesce(first_tool = 'get_time', false) as time_first, iterations > 5 as over_limit from g""",
    "weather_payloads": f"""
        select event_id, case
            when forecast_days not between 0 and 5 then {q(fixed.BAD_DAYS)}
            when geo_status <> 200 then {_status('geo_status', fixed.GEO_STATUS)}
            when {_BROKEN} then {_FAILED}
            when geo_body = '[]' then '错误: 找不到城市 ''' || location || '''，请检查城市名称是否正确'
            when status = 200 and {_UNREADABLE} then {_FAILED}
            when forecast_days = 0 and status = 200
                then {_PLACE} || '天气：' || {_readings('body', '')}
            when forecast_days = 0 then {_status('status', fixed.WEATHER_STATUS)}
            when status = 200 then {_PLACE} || '天气预报（' || json_extract_string({_POINT}, '$.dt_txt') || '）：' ||
                {_readings(_POINT, '预计')}
            else {_status('status', fixed.FORECAST_STATUS)} end as answer,
            case when forecast_days not between 0 and 5 then 'rejected'
                when {_LOCATED} and geo_body = '[]' then 'city_unknown'
                when {_LOCATED} and ({_BROKEN} or (status = 200 and {_UNREADABLE})) then 'weather_failed'
                else case case when geo_status <> 200 then geo_status else status end
                    when 200 then 'ok' when 401 then 'bad_key' when 429 then 'rate_limited' else 'failed' end
            end as outcome
        from (select p.*, e.event_type, e.value from ({PAYLOAD_SQL}) p join events e using (event_id))""",
}
