"""Chat rendering as Column expressions.

``segment`` renders one message given what stands around it. The long form feeds it
from window functions (``operators.rendering``); a nested row is rendered in place by
``render_messages`` without any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnmill import fixed

TOOL_CALLS = "array<struct<name:string,arguments:string>>"
_CALL_PATTERN = r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>"


def tool_list(tools: Sequence[str] | Column | None) -> Column | None:
    """Tools as an array of JSON strings, taken verbatim."""
    if tools is None or isinstance(tools, Column):
        return tools
    return F.array(*[F.lit(t) for t in tools]) if tools else None


def tools_block(tools: Column) -> Column:
    lines = F.transform(tools, lambda t: F.concat(F.lit("\n"), t))
    return F.concat(F.lit(fixed.TOOLS_HEAD), F.array_join(lines, ""), F.lit(fixed.TOOLS_TAIL))


def unwrapped_call(call: Column) -> Column:
    """Name and arguments of a call, taken from its ``function`` if it has one."""
    inner = call["function"]
    return F.struct(
        F.when(inner.isNotNull(), inner["name"]).otherwise(call["name"]).alias("name"),
        F.when(inner.isNotNull(), inner["arguments"]).otherwise(call["arguments"]).alias("arguments"),
    )


def tool_call_text(call: Column) -> Column:
    return F.concat(
        F.lit(fixed.TOOL_CALL_OPEN + '{"name": "'),
        F.coalesce(call["name"], F.lit("")),
        F.lit('", "arguments": '),
        F.coalesce(call["arguments"], F.lit("")),
        F.lit("}" + fixed.TOOL_CALL_CLOSE),
    )


def assistant_body(content: Column, calls: Column | None) -> Column:
    """Content and tool calls: the part of an assistant turn a loss is computed on."""
    if calls is None:
        return content
    listed = F.coalesce(calls, F.array().cast(TOOL_CALLS))
    gap = F.when((F.size(listed) > 0) & (content != ""), F.lit("\n")).otherwise("")
    return F.concat(content, gap, F.array_join(F.transform(listed, tool_call_text), "\n"))


def segment(
    role: Column,
    content: Column,
    calls: Column | None,
    *,
    first: Column,
    last: Column,
    after_tool: Column,
    before_tool: Column,
    tools: Column | None = None,
    generation_prompt: bool = False,
) -> Column:
    """Rendered text of one message."""
    plain = F.concat(F.lit(fixed.TURN_OPEN), role, F.lit("\n"), content, F.lit(fixed.TURN_CLOSE))
    assistant = F.concat(
        F.lit(fixed.ASSISTANT_OPEN), assistant_body(content, calls), F.lit(fixed.TURN_CLOSE)
    )
    tool = F.concat(
        F.when(after_tool, F.lit("")).otherwise(fixed.TURN_OPEN + "user"),
        F.lit(fixed.TOOL_RESPONSE_OPEN),
        content,
        F.lit(fixed.TOOL_RESPONSE_CLOSE),
        F.when(before_tool, F.lit("")).otherwise(fixed.TURN_CLOSE),
    )
    leading_system = first & (role == "system")
    text = (
        F.when(role == "user", plain)
        .when(role == "system", plain)
        .when(role == "assistant", assistant)
        .when(role == "tool", tool)
        .otherwise("")
    )
    if tools is not None:
        has_tools = F.coalesce(F.size(tools), F.lit(0)) > 0
        opening = F.concat(
            F.lit(fixed.SYSTEM_OPEN),
            F.when(role == "system", F.concat(content, F.lit("\n\n"))).otherwise(""),
            tools_block(tools),
        )
        text = F.concat(
            F.when(has_tools & first, opening).otherwise(""),
            F.when(has_tools & leading_system, F.lit("")).otherwise(text),
        )
    if generation_prompt:
        text = F.concat(text, F.when(last, F.lit(fixed.ASSISTANT_OPEN)).otherwise(""))
    return text


def render_messages(
    messages: Column,
    *,
    tools: Sequence[str] | Column | None = None,
    generation_prompt: bool = False,
    with_calls: bool = False,
) -> Column:
    """Render an array of ``{role, content[, tool_calls]}`` held in one row."""

    def one(message: Column, index: Column) -> Column:
        before = F.get(messages, index - 1)["role"]
        after = F.get(messages, index + 1)["role"]
        return segment(
            message["role"],
            F.coalesce(message["content"], F.lit("")),
            message["tool_calls"] if with_calls else None,
            first=index == 0,
            last=index == F.size(messages) - 1,
            after_tool=before.eqNullSafe("tool"),
            before_tool=after.eqNullSafe("tool"),
            tools=tool_list(tools),
            generation_prompt=generation_prompt,
        )

    return F.array_join(F.transform(messages, one), "")


def user_prompt_chat(prompt: Column) -> Column:
    """A single user message, ready for the model to answer."""
    return F.concat(
        F.lit(fixed.TURN_OPEN + "user\n"),
        prompt,
        F.lit(fixed.TURN_CLOSE + fixed.ASSISTANT_OPEN),
    )


def pair_chat(prompt: Column, completion: Column) -> Column:
    """Prompt and completion as a two-message chat."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("user", prompt), message("assistant", completion))


def pair_list_chats(prompts: Column, completions: Column) -> Column:
    """Element-wise ``pair_chat`` over two lists, as long as the shorter one."""
    shorter = F.least(F.size(prompts), F.size(completions))
    return F.zip_with(
        F.slice(prompts, F.lit(1), shorter), F.slice(completions, F.lit(1), shorter), pair_chat
    )


def tool_call_bodies(text: Column) -> Column:
    """The JSON texts of the tool calls written in an assistant text."""
    return F.regexp_extract_all(text, F.lit(_CALL_PATTERN), F.lit(1))


def read_tool_call(body: Column) -> Column:
    """Name, arguments as JSON text, and the body itself where it is not readable JSON."""
    return F.from_json(body, "name string, arguments string, _corrupt_record string")
