"""Text expressions. Everything here is a native Column, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnmill import fixed

# The characters Python's str.strip() and str.split() treat as white space.
_SPACE_POINTS = (
    *range(0x09, 0x0E),
    *range(0x1C, 0x21),
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
)
SPACES = "".join(map(chr, _SPACE_POINTS))
# The same set as a regular-expression class that Java and RE2 read alike.
SPACE_CLASS = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\p{Z}]"

_MARK = ":"
AFTER_MARK = rf"{_MARK}{SPACE_CLASS}*([A-Da-d])"
STANDALONE = r"(?<![\p{L}\p{N}_])([A-Da-d])(?![\p{L}\p{N}_])"


def py_strip(text: Column) -> Column:
    """Strip Unicode white space at both ends; ``trim`` alone knows only the ASCII space."""
    return F.btrim(text, F.lit(SPACES))


def is_blank(text: Column) -> Column:
    return F.length(py_strip(text)) == 0


def clip(text: Column, limit: int = fixed.QUESTION_CLIP) -> Column:
    """At most ``limit`` characters, marked with ``...`` when something was cut."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))
    ).otherwise(text)


def preview(text: Column, limit: int = fixed.PREVIEW_CHARS) -> Column:
    return F.substring(text, 1, limit)


def words(text: Column) -> Column:
    """White-space separated words; a blank text has none."""
    return F.array_remove(F.split(py_strip(text), f"{SPACE_CLASS}+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def first_words(text: Column, budget: int) -> Column:
    """The text up to the end of its ``budget``-th word; a text within the budget as it is.

    Split once more than the budget, the last part is what follows those words.
    """
    lead = F.ltrim(text, F.lit(SPACES))
    rest = F.get(F.split(lead, f"{SPACE_CLASS}+", budget + 1), F.lit(budget))
    upto = F.substring(text, F.lit(1), F.length(text) - F.length(rest))
    return F.when(F.coalesce(rest, F.lit("")) == "", text).otherwise(F.rtrim(upto, F.lit(SPACES)))


def last_words(text: Column, budget: int) -> Column:
    """The text from the beginning of the last ``budget`` words on; a text within the budget as it is."""
    before = word_count(text) - budget
    rest = F.get(F.split(F.ltrim(text, F.lit(SPACES)), F.lit(f"{SPACE_CLASS}+"), F.greatest(before, F.lit(0)) + 1), before)
    return F.when(before <= 0, text).otherwise(rest)


def first_tokens(text: Column, edges: Column, budget: int) -> Column:
    """The text up to the end of its ``budget``-th token; ``edges`` has start and end of each token in turn."""
    end = F.get(edges, F.lit(2 * budget - 1))
    return F.when(F.size(edges) <= 2 * budget, text).otherwise(F.substring(text, F.lit(1), end))


def last_tokens(text: Column, edges: Column, budget: int) -> Column:
    """The text from the start of its last ``budget`` tokens on."""
    start = F.get(edges, F.size(edges) - 2 * budget)
    return F.when(F.size(edges) <= 2 * budget, text).otherwise(F.substring(text, start + 1, F.length(text)))


def extract_answer(response: Column) -> Column:
    """The option letter a free-text response stands for, or ``UNKNOWN``.

    The rules are tried in order: the first character, a letter after one of the
    answer marks, a letter standing alone, and any of the letters in letter order.
    """
    text = py_strip(F.coalesce(response, F.lit("")))
    head = F.upper(F.substring(text, 1, 1))
    upper = F.upper(text)
    # One mark stands for all, which makes for a pattern that is searched much faster.
    marked = text
    for mark in fixed.ANSWER_MARKS:
        if mark != _MARK:
            marked = F.replace(marked, F.lit(mark), F.lit(_MARK))
    # Each rule gives a letter or nothing, so the first letter of them all in a row is the
    # answer. Every rule is evaluated once, where ``coalesce`` would search texts twice.
    rules = F.concat(
        F.when(head.isin(*fixed.LETTERS), head).otherwise(""),
        F.upper(F.regexp_extract(marked, AFTER_MARK, 1)),
        F.upper(F.regexp_extract(text, STANDALONE, 1)),
        *[F.when(upper.contains(letter), letter).otherwise("") for letter in fixed.LETTERS],
        F.lit(fixed.UNKNOWN),
    )
    return F.replace(F.substring(rules, 1, 1), F.lit(fixed.UNKNOWN[0]), F.lit(fixed.UNKNOWN))


def run_label(model_type: Column, adapter_path: Column) -> Column:
    """``base``, or the type and the last part of the adapter path."""
    folder = F.element_at(F.split(adapter_path, "/"), -1)
    return F.when(model_type == "base", F.lit("base")).otherwise(
        F.concat(model_type, F.lit("_"), folder)
    )


def report_path(root: str, subject: Column, label: Column) -> Column:
    folder = F.lit(f"{root.rstrip('/')}/{fixed.RESULTS_FOLDER}/")
    return F.concat(folder, subject, F.lit("/"), label, F.lit(fixed.RESULTS_SUFFIX))


def command_kind(text: Column) -> Column:
    """What a console input asks for, checked in this order: end, reset, skip, message."""
    word = F.lower(py_strip(text))
    return (
        F.when(word.isin(*fixed.QUIT_COMMANDS), "end")
        .when(word == fixed.CLEAR_COMMAND, "reset")
        .when(word == "", "skip")
        .otherwise("message")
    )
