"""Analysing agent traces: ``(conv_id, turn, role, text, tool_calls)`` and tool payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.functions import chat, tools
from turnmill.operators.blocks import by_number, running

TURNS_PER_BLOCK = 1_000_000


def calls(trace: DataFrame) -> DataFrame:
    """One row per tool call: ``(conv_id, turn, call_no, tool, arguments)``."""
    return (
        trace.where(F.col("role") == "assistant")
        .select("conv_id", "turn", F.posexplode("tool_calls").alias("call_no", "_call"))
        .select("conv_id", "turn", "call_no", F.col("_call.name").alias("tool"), F.col("_call.arguments").alias("arguments"))
    )


def parsed_calls(messages: DataFrame) -> DataFrame:
    """Tool calls read back from rendered assistant texts; unreadable ones have ``valid`` false."""
    return (
        messages.where((F.col("role") == "assistant") & F.col("text").contains("<tool_call>"))
        .select("conv_id", "turn", F.posexplode(chat.tool_call_bodies(F.col("text"))).alias("call_no", "_body"))
        .withColumn("_call", chat.read_tool_call(F.col("_body")))
        .select(
            "conv_id",
            "turn",
            "call_no",
            F.col("_call.name").alias("tool"),
            F.col("_call.arguments").alias("arguments"),
            F.col("_call._corrupt_record").isNull().alias("valid"),
        )
    )


def usage(call_rows: DataFrame) -> DataFrame:
    """Calls per tool, and in how many conversations."""
    per_conversation = call_rows.groupBy("tool", "conv_id").agg(F.count(F.lit(1)).alias("_n"))
    return per_conversation.groupBy("tool").agg(
        F.sum("_n").alias("calls"), F.count(F.lit(1)).alias("conversations"), F.max("_n").alias("most_in_one")
    )


def outcomes(tool_rows: DataFrame) -> DataFrame:
    """Results per tool and outcome, from rows ``(tool, text)``."""
    return tool_rows.groupBy("tool", tools.outcome(F.col("text")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n")
    )


def audit(trace: DataFrame, turns_per_block: int = TURNS_PER_BLOCK) -> DataFrame:
    """Per user turn: which tool came first, how many steps called tools, and the two rules.

    A user turn takes in all rows up to the next user row of the conversation.
    """
    first_call = F.get(F.col("tool_calls"), F.lit(0))["name"]
    narrow = trace.select(
        "conv_id",
        "turn",
        (F.col("role") == "user").cast("long").alias("_user"),
        F.when((F.col("role") == "assistant") & (F.size("tool_calls") > 0), first_call).alias("_tool"),
    )
    numbered = running(
        by_number(narrow, ["conv_id"], "turn", turns_per_block), {"user_turn": ("sum", F.col("_user"))}
    ).rows
    return (
        numbered.where(F.col("user_turn") > 0)
        .groupBy("conv_id", "user_turn")
        .agg(
            F.min_by("_tool", F.when(F.col("_tool").isNotNull(), F.col("turn"))).alias("first_tool"),
            F.count("_tool").alias("iterations"),
        )
        .select(
            "conv_id",
            "user_turn",
            "first_tool",
            "iterations",
            F.coalesce(F.col("first_tool") == fixed.FIRST_TOOL, F.lit(False)).alias("time_first"),
            (F.col("iterations") > fixed.MAX_ITERATIONS).alias("over_limit"),
        )
    )


def series_slots(series: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """The entry ``min(8 * day, last)`` of each key's series for days 1 to 5.

    Entries past 8 * 5 are never asked for, so the first 41 of a key settle the answer;
    Spark keeps 41 per key and task before it shuffles.
    """
    last = fixed.POINTS_PER_DAY * fixed.MAX_FORECAST_DAYS
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    head = (
        series.withColumn("_place", place)
        .where(F.col("_place") <= last + 1)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("_place", *order, value))).alias("_s"))
    )
    days = F.sequence(F.lit(1), F.lit(fixed.MAX_FORECAST_DAYS))
    slot = F.least(F.col("day") * fixed.POINTS_PER_DAY, F.size("_s") - 1)
    return (
        head.select(key, "_s", F.explode(days).alias("day"))
        .select(key, "day", F.get("_s", slot).alias("_e"))
        .select(key, "day", *[F.col(f"_e.{c}").alias(c) for c in (*order, value)])
    )


def weather(payloads: DataFrame) -> DataFrame:
    """Landed tool payloads to answers.

    Expects ``location, forecast_days, geo_status, geo_body, status, body``; adds the text
    and its outcome. Each JSON text is parsed once, into declared fields.
    """
    days = F.col("forecast_days")
    found = tools.days_ok(days) & (F.col("geo_status") == 200)
    cities = F.from_json(F.when(found, F.col("geo_body")), tools.CITIES)
    weather_body = F.when(found & (F.col("status") == 200), F.col("body"))
    parsed = payloads.withColumns({"_cities": cities, "_weather": F.from_json(weather_body, tools.WEATHER)})
    placed = parsed.withColumn("_city", F.get("_cities", F.lit(0))).withColumn("_point", tools.forecast_point(F.col("_weather.list"), days))
    text = tools.weather_text(
        F.col("location"), days, F.col("geo_status"), F.col("_cities"), F.col("_city"), F.col("status"),
        F.col("_weather"), F.col("_point"),
    )
    outcome = (
        F.when(~tools.days_ok(days), "rejected")
        .when(F.col("geo_status") != 200, tools.status_outcome(F.col("geo_status")))
        .otherwise(tools.status_outcome(F.col("status")))
    )
    answered = placed.select(*payloads.columns, "_cities", "_city", text.alias("answer"), outcome.alias("_status"))
    # A good status is not yet an answer.
    failed = F.col("answer").startswith(fixed.WEATHER_FAILED)
    named = (
        F.when(F.col("_status").isin("rejected") | (F.col("geo_status") != 200), F.col("_status"))
        .when(F.col("_cities").isNotNull() & F.col("_city").isNull(), "city_unknown")
        .when(failed, "weather_failed")
        .otherwise(F.col("_status"))
    )
    return answered.select(*payloads.columns, "answer", named.alias("outcome"))
