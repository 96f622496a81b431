"""Grading answers and summarising runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.functions import text as tx
from turnmill.operators.blocks import by_number, running
from turnmill.session import stored

ITEMS_PER_BLOCK = 1_000_000


def grade(predictions: DataFrame, gold: DataFrame, on: Sequence[str] = ("subject", "item_id")) -> DataFrame:
    """Gold rows ``(.., answer)`` with their predictions ``(.., response)``, compared.

    Item numbers repeat over subjects. Items without a prediction count as answered by nothing.
    """
    met = gold.join(predictions, list(on), "left")
    return grade_rows(met.withColumn("response", F.coalesce("response", F.lit(""))))


def grade_rows(rows: DataFrame) -> DataFrame:
    """Add ``predicted`` and ``is_correct`` to rows holding ``response`` and ``answer``."""
    return rows.withColumn("predicted", tx.extract_answer(F.col("response"))).withColumn(
        "is_correct", F.col("predicted") == F.col("answer")
    )


def details(graded: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The per-item result rows."""
    return graded.select(
        *extra,
        F.col("item_id").alias("id"),
        tx.clip(F.col("question")).alias("question"),
        "predicted",
        F.col("answer").alias("correct"),
        "is_correct",
        F.col("response").alias("raw_response"),
    )


def _accuracy(correct: Column, total: Column) -> Column:
    return F.when(total > 0, correct / total * 100).otherwise(F.lit(0.0))


def summarize(graded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """total, correct, incorrect, unknown and accuracy in per cent (0 for no rows)."""
    counts = graded.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(F.col("is_correct").cast("long")), F.lit(0)).alias("correct"),
        F.count_if(F.col("predicted") == fixed.UNKNOWN).alias("unknown"),
    )
    return counts.select(
        *by,
        "total",
        "correct",
        (F.col("total") - F.col("correct")).alias("incorrect"),
        "unknown",
        _accuracy(F.col("correct"), F.col("total")).alias("accuracy"),
    )


def compare_models(graded: DataFrame, models: Sequence[str], baseline: str) -> DataFrame:
    """Accuracy per subject (and ``ALL``) side by side, with the gain over the baseline.

    Items are counted once per subject and model; the overall row adds up those counts.
    """
    counts = summarize(graded, ("subject", "model_id"))
    table = (
        counts.rollup("model_id", "subject")
        .agg(
            F.sum("correct").alias("correct"),
            F.sum("total").alias("total"),
            F.grouping("model_id").alias("_grand"),
            F.grouping("subject").alias("_all"),
        )
        .where(F.col("_grand") == 0)
        .withColumn("subject", F.when(F.col("_all") == 1, "ALL").otherwise(F.col("subject")))
    )
    wide = (
        table.withColumn("accuracy", _accuracy(F.col("correct"), F.col("total")))
        .groupBy("subject")
        .pivot("model_id", list(models))
        .agg(F.max("accuracy"))
    )
    others = [m for m in models if m != baseline]
    return wide.select(
        "subject", *models, *[(F.col(m) - F.col(baseline)).alias(f"{m}_gain") for m in others]
    )


def running_accuracy(
    graded: DataFrame,
    by: Sequence[str],
    every: int = fixed.PROGRESS_EVERY,
    items_per_block: int = ITEMS_PER_BLOCK,
) -> DataFrame:
    """Accuracy so far at every ``every``-th item of a run, in item order."""
    narrow = graded.select(*by, "item_id", F.col("is_correct").cast("long").alias("_right"))
    cut = by_number(narrow, list(by), "item_id", items_per_block)
    if not cut.plain:
        # Blocks are summed up and then read again: what made the grades is asked once.
        cut = cut.with_rows(stored(cut.rows, "graded"))
    seen = running(
        cut,
        {"seen": ("sum", F.lit(1).cast("long")), "right": ("sum", F.col("_right"))},
    ).rows
    return seen.where(F.col("seen") % every == 0).select(
        *by, "item_id", "seen", (F.col("right") / F.col("seen") * 100).alias("accuracy")
    )


def padded(value: Column, width: int) -> Column:
    """Blanks behind a value up to a width in characters; a longer one stays whole."""
    return F.concat(value, F.repeat(F.lit(" "), F.greatest(F.lit(width) - F.length(value), F.lit(0))))


def _table_line(*values: Column) -> Column:
    fitted = [padded(v, w) for v, w in zip(values, fixed.REPORT_WIDTHS, strict=False)]
    return F.concat_ws(" | ", *fitted, *values[len(fitted) :])


def report_line(identifier, question, predicted, correct, is_correct) -> Column:
    """A fixed-width line; long values are padded never cut."""
    status = F.when(is_correct, fixed.STATUS_RIGHT).otherwise(fixed.STATUS_WRONG)
    return _table_line(identifier, question, predicted, correct, status)


def report_lines(detail_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return detail_rows.select(
        *by,
        "id",
        report_line(
            F.col("id").cast("string"), F.col("question"), F.col("predicted"), F.col("correct"), F.col("is_correct")
        ).alias("line"),
    )


def report_head(settings: Column, shots: Column | int) -> Column:
    """The lines before the details of a run, from its summary's columns and ``model_id``, ``subject``.

    ``settings`` is a struct of base_model, adapter, temperature, do_sample, max_new_tokens.
    """
    def named(label: str, value: Column) -> Column:
        return F.concat(F.lit(label), value.cast("string"))

    title = F.initcap(F.replace(F.col("subject"), F.lit("_"), F.lit(" ")))
    adapted = F.when(F.col("model_id") != "base", F.array(named(fixed.REPORT_ADAPTER, settings["adapter"])))
    ruler, blank = F.lit(fixed.REPORT_RULER), F.lit("")
    return F.concat(
        F.array(
            ruler,
            F.format_string(fixed.REPORT_TITLE, title),
            ruler,
            blank,
            F.lit(fixed.REPORT_MODEL),
            named(fixed.REPORT_MODEL_TYPE, F.col("model_id")),
            named(fixed.REPORT_BASE_MODEL, settings["base_model"]),
        ),
        F.coalesce(adapted, F.array().cast("array<string>")),
        F.array(
            named(fixed.REPORT_DATASET, F.col("subject")),
            blank,
            F.lit(fixed.REPORT_GENERATION),
            named(fixed.REPORT_TEMPERATURE, settings["temperature"]),
            named(fixed.REPORT_DO_SAMPLE, F.initcap(settings["do_sample"].cast("string"))),
            named(fixed.REPORT_MAX_NEW_TOKENS, settings["max_new_tokens"]),
            blank,
            F.lit(fixed.REPORT_SETUP),
            F.format_string(fixed.REPORT_TEST_SPLIT, F.col("total").cast("string")),
            F.format_string(fixed.REPORT_SHOTS, (shots if isinstance(shots, Column) else F.lit(shots)).cast("string")),
            blank,
            ruler,
            F.lit(fixed.REPORT_SUMMARY),
            ruler,
            named(fixed.REPORT_TOTAL, F.col("total")),
            named(fixed.REPORT_CORRECT, F.col("correct")),
            named(fixed.REPORT_INCORRECT, F.col("incorrect")),
            named(fixed.REPORT_UNKNOWN, F.col("unknown")),
            F.format_string(fixed.REPORT_ACCURACY, F.col("accuracy")),
            blank,
            ruler,
            F.lit(fixed.REPORT_DETAILS),
            ruler,
            _table_line(*map(F.lit, fixed.REPORT_COLUMNS)),
            F.lit(fixed.REPORT_THIN_RULER),
        ),
    )


def report_foot(completed_at: Column) -> Column:
    """The lines behind the details."""
    ruler = F.lit(fixed.REPORT_RULER)
    done = F.concat(F.lit(fixed.REPORT_END), F.date_format(completed_at, "yyyy-MM-dd HH:mm:ss"))
    return F.array(F.lit(""), ruler, done, ruler)
