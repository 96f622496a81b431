"""Chat rendering queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.functions import chat
from turnmill.operators import corpus, rendering
from turnmill.plans.inputs import SECOND_ARGUMENTS, SECOND_TOOL, TRACE_SQL, q, table, trace

TOOLS = (
    '{"type": "function", "function": {"name": "calculator"}}',
    '{"type": "function", "function": {"name": "get_time"}}',
    '{"type": "function", "function": {"name": "get_weather"}}',
)


def _conversations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations")


def render_chat(spark: SparkSession, folder: str) -> DataFrame:
    return rendering.render(_conversations(spark, folder))


def render_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The same from nested rows, rendered in place."""
    nested = corpus.nest(_conversations(spark, folder))
    return nested.select("conv_id", chat.render_messages(F.col("conversations")).alias("text"))


def generation_prompt(spark: SparkSession, folder: str) -> DataFrame:
    """Whole conversations, left open for the model to go on."""
    return rendering.render(_conversations(spark, folder), generation_prompt=True)


def loss_spans(spark: SparkSession, folder: str) -> DataFrame:
    return rendering.loss_spans(_conversations(spark, folder))


def loss_spans_tools(spark: SparkSession, folder: str) -> DataFrame:
    return rendering.loss_spans(trace(spark, folder), tools=TOOLS)


def loss_share(spark: SparkSession, folder: str) -> DataFrame:
    return rendering.loss_share(_conversations(spark, folder)).withColumn("share", F.round("share", 6))


def render_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    said = trace(spark, folder).where(F.col("role") == "assistant")
    return said.select("conv_id", "turn", chat.assistant_body(F.col("text"), F.col("tool_calls")).alias("body"))


def render_tool_responses(spark: SparkSession, folder: str) -> DataFrame:
    return rendering.render(trace(spark, folder))


def agent_prompt(spark: SparkSession, folder: str) -> DataFrame:
    """The agent's system text, its tools, the trace so far, and the opening of an answer."""
    asked = rendering.with_system_turn(trace(spark, folder), fixed.AGENT_SYSTEM)
    return rendering.render(asked, tools=TOOLS, generation_prompt=True)


QUERIES = {
    f.__name__: f
    for f in (
        render_chat,
        render_messages,
        generation_prompt,
        loss_spans,
        loss_spans_tools,
        loss_share,
        render_tool_calls,
        render_tool_responses,
        agent_prompt,
    )
}

# Oracle --------------------------------------------------------------------------------

_PLAIN = "select conv_id, turn, role, text, '' as calls from conversations"
_ONE_CALL = """'<tool_call>' || chr(10) || '{"name": "' || %s || '", "arguments": ' || %s || '}' || chr(10) || '</tool_call>'"""
_TRACE = f"""select conv_id, turn, role, text,
    case when n_calls > 0 and text <> '' then chr(10) else '' end ||
    case when n_calls > 0 then {_ONE_CALL % ('tool', 'arguments')} else '' end ||
    case when n_calls > 1 then chr(10) || {_ONE_CALL % (q(SECOND_TOOL), q(SECOND_ARGUMENTS))} else '' end as calls
    from ({TRACE_SQL})"""
_TOOLS_TEXT = q(fixed.TOOLS_HEAD + "".join("\n" + t for t in TOOLS) + fixed.TOOLS_TAIL)


def _segments(source: str, tools: bool = False, opening: bool = False) -> str:
    head = "''"
    system = "'<|im_start|>system' || chr(10) || text || '<|im_end|>' || chr(10)"
    if tools:
        head = f"""case when n > 1 then '' else '<|im_start|>system' || chr(10) ||
            case when role = 'system' then text || chr(10) || chr(10) else '' end || {_TOOLS_TEXT} end"""
        system = f"case when n = 1 then '' else {system} end"
    tail = "case when after is null then '<|im_start|>assistant' || chr(10) else '' end" if opening else "''"
    return f"""
        select conv_id, turn, role, text || calls as body, {head} as head, {tail} as tail,
            case role
            when 'system' then {system}
            when 'user' then '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10)
            when 'assistant' then '<|im_start|>assistant' || chr(10) || text || calls || '<|im_end|>' || chr(10)
            when 'tool' then case when before is distinct from 'tool' then '<|im_start|>user' else '' end ||
                chr(10) || '<tool_response>' || chr(10) || text || chr(10) || '</tool_response>' ||
                case when after is distinct from 'tool' then '<|im_end|>' || chr(10) else '' end
            else '' end as middle
        from (select *, row_number() over w as n, lag(role) over w as before, lead(role) over w as after
              from ({source}) window w as (partition by conv_id order by turn))"""


def _rendered(segments: str) -> str:
    return f"""
        select conv_id, turn, head || middle || tail as segment,
               cast(coalesce(sum(length(head || middle || tail)) over (
                   partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as bigint)
                   as start
        from ({segments})"""


def _whole(segments: str) -> str:
    return f"""select conv_id, string_agg(head || middle || tail, '' order by turn) as text
        from ({segments}) group by conv_id"""


def _spans(segments: str) -> str:
    return f"""
        select conv_id, turn, cast(before + length(head) + {len(fixed.ASSISTANT_OPEN)} as bigint) as start,
               cast(before + length(head) + {len(fixed.ASSISTANT_OPEN)} + length(body) as bigint) as "end"
        from (select *, coalesce(sum(length(head || middle)) over (
                  partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as before
              from ({segments}))
        where role = 'assistant'"""


ORACLE = {
    "render_chat": _rendered(_segments(_PLAIN)),
    "render_messages": _whole(_segments(_PLAIN)),
    "generation_prompt": _rendered(_segments(_PLAIN, opening=True)),
    "loss_spans": _spans(_segments(_PLAIN)),
    "loss_spans_tools": _spans(_segments(_TRACE, tools=True)),
    "loss_share": f"""
        select conv_id, cast(sum(case when role = 'assistant' then length(body) else 0 end) as bigint) as trained,
               cast(sum(length(head || middle)) as bigint) as total,
               round(sum(case when role = 'assistant' then length(body) else 0 end)::double
                     / sum(length(head || middle)), 6) as share
        from ({_segments(_PLAIN)}) group by conv_id""",
    "render_tool_calls": f"select conv_id, turn, text || calls as body from ({_TRACE}) where role = 'assistant'",
    "render_tool_responses": _rendered(_segments(_TRACE)),
    "agent_prompt": _rendered(
        _segments(
            f"{_TRACE} union all select distinct user_id, -1, 'system', {q(fixed.AGENT_SYSTEM)}, '' from events",
            tools=True,
            opening=True,
        )
    ),
}
