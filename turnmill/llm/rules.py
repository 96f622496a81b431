"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

A measure is a Column over a text; a rule bounds one measure, or the ratio of two. The
table of rules becomes one boolean per rule and a verdict, all in one Spark projection
without user functions.

Empty, blank and null texts have no words: every count is 0, ratios over them are 0, and
``base_failed`` holds. Nothing depends on other rows, so ties and repeated rows are judged
alike; ``keep`` passes other columns unread, whatever their names, ``judge`` and
``with_measures`` need them not to begin with two underscores.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
_BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent short words of four languages.
STOP_WORDS = (
    "the of and to in is was for with by be this that as it "
    "der die das und ist von mit zu den dem "
    "le la les de et en un une des que "
    "el los las del y por con se"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; without a denominator the measure itself.

    The rule is asked only of texts of at least ``from_words`` words.
    """

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: Ratios that prose keeps in any of the four languages.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbol_ratio", "n_symbols", "n_words", high=0.3),
    Rule("exclamation_ratio", "n_exclamations", "n_words", high=0.3),
    Rule("capital_ratio", "n_capitals", "word_chars", high=0.4),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.2),
    Rule("stop_words", "n_stop_words", low=2, from_words=50),  # different ones
)


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def with_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the columns ``__<measure>`` (longs).

    Each step is a projection of its own whose columns later steps read more than once, so
    Spark keeps it apart and nothing is worked out twice. (A struct of all measures would be
    taken apart and its fields worked out for every rule.)
    """
    body = F.coalesce(F.col(text), F.lit(""))
    one = df.select("*", body.alias("__text"), _words(body).alias("__words"))
    last = F.size("__words") - WINDOW
    hashes = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("__text", "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    two = one.select("*", hashes.alias("__hashes"), lines.alias("__lines"))
    # Only texts that repeat a window at all have their windows sorted: by hash, so that equal
    # windows are neighbours. The places of those, in order, each cover the words up to the
    # next one, at most a window's length.
    repeats = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    sorted_places = F.when(
        repeats,
        F.sort_array(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    three = two.select("*", sorted_places.alias("__sorted"))
    near = lambda x, i, d: F.coalesce(F.get("__sorted", i + d)["h"] == x["h"], F.lit(False))
    kept = F.filter("__sorted", lambda x, i: near(x, i, -1) | near(x, i, 1))
    four = three.select("*", F.sort_array(F.transform(kept, lambda x: x["i"])).alias("__places"))
    covered = F.aggregate(
        F.transform(
            "__places",
            lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__places", i + 1) - p, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    without = lambda pattern: F.length(F.regexp_replace("__text", pattern, ""))
    measures = {
        "n_words": F.size("__words"),
        "word_chars": without(SPACE + "+"),
        "n_symbols": without(f"[^{SYMBOLS}]+"),
        "n_exclamations": without("[^!]+"),
        "n_capitals": without(r"[^\p{Lu}]+"),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_stop_words": F.size(F.array_intersect("__words", F.array(*[F.lit(w) for w in STOP_WORDS]))),
    }
    return four.select(
        *[F.col(f"`{c}`") for c in df.columns], *[c.cast("long").alias(f"__{n}") for n, c in measures.items()]
    )


def compiled(rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """One boolean Column per rule: whether the text keeps it."""
    out = {}
    for rule in rules:
        value = F.col(f"__{rule.numerator}").cast("double")
        if rule.denominator:
            below = F.col(f"__{rule.denominator}")
            value = F.when(below == 0, F.lit(0.0)).otherwise(value / below)
        held = F.lit(True)
        if rule.low is not None:
            held = held & (value >= rule.low)
        if rule.high is not None:
            held = held & (value <= rule.high)
        out[rule.name] = held | (F.col("__n_words") < rule.from_words)
    return out


def base_failed() -> Column:
    words = F.col("__n_words")
    return (words < 10) | (F.col("__n_repeat_words") * 100 > words * 20)


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with its measures and a struct ``__verdict``: base_failed, each rule, kept."""
    measured = with_measures(df, text)
    held = compiled(rules)
    kept = ~base_failed()
    for column in held.values():
        kept = kept & column
    verdict = F.struct(
        base_failed().alias("base_failed"), *[c.alias(n) for n, c in held.items()], kept.alias("kept")
    )
    return measured.select("*", verdict.alias("__verdict"))


def keep(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose texts keep all rules, with the columns they came with.

    A filter moves below the projections it reads from, where each mention of a measure
    would work it out anew. A row number (true of every row) holds it back.
    """
    kept = F.when(F.monotonically_increasing_id() >= 0, F.col("__verdict")["kept"])
    # The caller's columns travel in one, whatever their names.
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    judged = judge(own, "text", rules).withColumn("__kept", kept)
    return judged.where("__kept").select("row.*")
