"""Few-shot prompts for multiple-choice items ``(item_id, question, A, B, C, D, answer)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.operators.joins import join_groups


def _item(number: Column, item) -> Column:
    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(label), value, F.lit("\n"))

    return F.concat(
        F.lit(fixed.QUESTION_WORD),
        number.cast("string"),
        F.lit(": "),
        item["question"],
        F.lit("\n"),
        *[line(f"{letter}. ", item[letter]) for letter in fixed.LETTERS],
        F.lit(f"{fixed.ANSWER_WORD}:"),
    )


def prefixes(dev: DataFrame, by: list[str]) -> DataFrame:
    """The instruction and all dev items, one row per group: ``(prefix, shots)``.

    Every dev item of a group is part of each of its prompts, so a group is one value by
    definition, as large as the prompts it goes into.
    """
    items = F.sort_array(F.collect_list(F.struct("item_id", "question", *fixed.LETTERS, "answer")))
    shown = F.transform(
        items,
        lambda item, i: F.concat(_item(i + 1, item), F.lit(" "), item["answer"], F.lit("\n\n")),
    )
    whole = F.concat(F.lit(fixed.EXAM_INSTRUCTION), F.array_join(shown, ""))
    return dev.groupBy(*by).agg(whole.alias("prefix"), F.count(F.lit(1)).alias("shots"))


def few_shot_prompts(test: DataFrame, dev: DataFrame, by: list[str] | None = None, **limits) -> DataFrame:
    """Add ``prompt`` to the test items.

    With ``by`` (such as the subject) items meet the prefix of their own group by an
    equi-join; items of a group without dev examples get the bare instruction. Without
    it the single prefix is computed once and used as a constant.
    """
    if by:
        joined = join_groups(test, prefixes(dev, by), by, "left", **limits)
        prefix = F.coalesce(F.col("prefix"), F.lit(fixed.EXAM_INSTRUCTION))
        shots = F.coalesce(F.col("shots"), F.lit(0))
    else:
        joined = test
        one = prefixes(dev, []).select(F.struct("prefix", "shots")).scalar()
        prefix, shots = one["prefix"], one["shots"]
    question = _item(shots + 1, {c: F.col(c) for c in ("question", *fixed.LETTERS)})
    return joined.select(*test.columns, F.concat(prefix, question).alias("prompt"))
