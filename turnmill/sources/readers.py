"""Reading the input formats. Every schema is declared, nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.functions.chat import unwrapped_call
from turnmill.functions.text import is_blank
from turnmill.operators.blocks import BLOCK, Blocked, by_heavy_key, running
from turnmill.operators.vectors import clean_metadata_json
from turnmill.session import stored

CONVERSATIONS = "conversations array<struct<role:string,content:string>>"
RICH_CONVERSATIONS = (
    "conversations array<struct<role:string,content:string,"
    "tool_calls:array<struct<name:string,arguments:string,function:struct<name:string,arguments:string>>>>>"
)
#: Content keeps the kind it has in the file.
CHAT_LOG = (
    "conversations array<struct<role:string,content:variant,"
    "tool_calls:array<struct<name:string,arguments:string,function:struct<name:string,arguments:string>>>>>"
)
EXAM_ITEMS = "id long, question string, A string, B string, C string, D string, answer string"
CHUNKS = "chunk_id string, text string, metadata string"


def read_conversations(spark: SparkSession, path: str | list[str], *, with_tool_calls: bool = False) -> DataFrame:
    """JSON Lines, one conversation per line, so files split freely.

    Tool calls may hold name and arguments themselves or in a ``function`` of their own.
    """
    if not with_tool_calls:
        return spark.read.schema(CONVERSATIONS).json(path)

    def message(m: Column) -> Column:
        return m.withField("tool_calls", F.transform(m["tool_calls"], unwrapped_call))

    rows = spark.read.schema(RICH_CONVERSATIONS).json(path)
    return rows.withColumn("conversations", F.transform("conversations", message))


def text_content(content: Column) -> Column:
    """A message's content if it is a string, else ``''``: numbers, lists and objects are no text."""
    is_text = F.coalesce(F.schema_of_variant(content) == "STRING", F.lit(False))
    return F.when(is_text, F.try_variant_get(content, "$", "string")).otherwise("")


def numbered(rows: DataFrame, key: str, name: str = "occurrence", **blocks) -> DataFrame:
    """Add a number from 1 among the rows of a key; a key of its own is neither shuffled nor sorted.

    Only keys that come twice are numbered by a window, in blocks where they are heavy.
    """
    twice = rows.groupBy(key).count().where("count > 1").select(key)
    once = rows.join(twice, key, "left_anti").withColumn(name, F.lit(1).cast("long"))
    cut = by_heavy_key(rows.join(twice, key, "left_semi"), [key], [key], **blocks)
    several = running(cut, {name: ("sum", F.lit(1).cast("long"))}).rows
    return once.select(*rows.columns, name).unionByName(several.select(*rows.columns, name))


def read_chat_log(spark: SparkSession, path: str | list[str], **blocks) -> DataFrame:
    """JSON Lines as they come: ``(conv_id, conversations)`` with role, content and tool calls.

    ``conv_id`` is the SHA-256 of the line and, after a colon, the number of the line among
    equal ones, so it stays the same however often and in whatever pieces the files are read.
    Content that is no string is ``''``; a line that can't be read has no conversations (null).
    """
    lines = spark.read.text(path).where(~F.coalesce(is_blank(F.col("value")), F.lit(True)))
    keyed = numbered(lines.withColumn("key", F.sha2("value", 256)), "key", **blocks)

    def message(m: Column) -> Column:
        calls = F.transform(m["tool_calls"], unwrapped_call)
        return F.struct(m["role"].alias("role"), text_content(m["content"]).alias("content"), calls.alias("tool_calls"))

    parsed = keyed.select(
        F.concat_ws(":", "key", F.col("occurrence").cast("string")).alias("conv_id"), F.from_json("value", CHAT_LOG).alias("r")
    )
    return parsed.select("conv_id", F.transform("r.conversations", message).alias("conversations"))


def read_exam(
    spark: SparkSession, root: str, subjects: Sequence[str], splits: Sequence[str] = ("dev", "test")
) -> DataFrame:
    """Exam items of some subjects in one scan, files named ``<root>/<subject>/<split>*.parquet``."""
    paths = [f"{root.rstrip('/')}/{s}/{split}*.parquet" for s in subjects for split in splits]
    path = F.col("_metadata.file_path")
    return (
        spark.read.schema(EXAM_ITEMS)
        .parquet(*paths)
        .select(
            F.col("id").alias("item_id"),
            "question", "A", "B", "C", "D", "answer",
            F.url_decode(F.replace(F.regexp_extract(path, "([^/]+)/[^/]+$", 1), F.lit("+"), F.lit("%2B"))).alias("subject"),
            F.regexp_extract(path, f"/({'|'.join(splits)})[^/]*$", 1).alias("split"),
        )
    )


# Strings of JSON text; the second pattern is one that is still open at the end of a piece.
_STRING = r'"(?:[^"\\]|\\.)*+"'
_OPEN_STRING = r'(?s)"(?:[^"\\]|\\.)*+$'


def array_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, element, value): the objects of files that hold one JSON array, read in pieces by many tasks.

    Files are cut behind every closing brace, wherever their splits lie. The quotes before a
    piece tell whether it begins inside a string, the braces and brackets outside of strings
    how deep it stands; an element ends with the brace that brings the depth back to one. The
    counts run over blocks, one for each split, so a file of any size is read by all tasks.
    """
    raw = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    # A quote behind an odd number of backslashes is part of a string; no piece ends in backslashes.
    plain = F.regexp_replace("value", r"\\.", "")
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))
    # Written once: the numbers of pieces hold for this reading alone.
    pieces = stored(raw.withColumn("quotes", quotes.cast("long")), "array-pieces")
    keys, order = ("file",), ("at",)
    several = None if pieces.select(*keys, BLOCK).distinct().groupBy(*keys).count().where("count > 1").limit(1).collect() else []
    cut = Blocked(pieces, keys, order, several)
    cut = running(cut, {"upto": ("sum", F.col("quotes"))})
    opens_inside = (F.col("upto") - F.col("quotes")) % 2 == 1
    inside = F.col("upto") % 2 == 1
    # Within a string up to its first quote, which the added one closes.
    text = F.when(opens_inside, F.concat(F.lit('"'), F.col("value"))).otherwise(F.col("value"))
    bare = F.regexp_replace(F.regexp_replace(text, _STRING, ""), _OPEN_STRING, "")
    count = lambda c: F.length(bare) - F.length(F.replace(bare, F.lit(c), F.lit("")))
    deeper = count("{") + count("[") - count("]") - F.when(inside, 0).otherwise(1)
    rows = cut.rows.select(*keys, BLOCK, "at", "value", inside.alias("inside"), deeper.cast("long").alias("deeper"))
    cut = running(cut.with_rows(rows), {"depth": ("sum", F.col("deeper"))})
    ends = (~F.col("inside") & (F.col("depth") == 1)).cast("long")
    cut = running(cut.with_rows(cut.rows.withColumn("ends", ends)), {"ended": ("sum", F.col("ends"))})
    element = (F.col("ended") - F.col("ends")).alias("element")
    whole = (
        cut.rows.select("file", element, "at", "value", "ends")
        .groupBy("file", "element")
        .agg(F.max("ends").alias("ends"), F.sort_array(F.collect_list(F.struct("at", "value"))).alias("p"))
        .where("ends = 1")  # what follows the last element is none
    )
    joined = F.concat(F.array_join(F.transform("p", lambda x: x["value"]), "}"), F.lit("}"))
    return whole.select("file", "element", F.regexp_replace(joined, r"^[\s,\[\x{FEFF}]+", "").alias("value"))


def read_chunks(spark: SparkSession, path: str | list[str], *, json_lines: bool = False) -> DataFrame:
    """Chunks with cleaned metadata, from files with one JSON array each or from JSON Lines."""
    if json_lines:
        rows = spark.read.schema(CHUNKS).json(path)
    else:
        rows = array_elements(spark, path).select(F.from_json("value", CHUNKS).alias("c")).select("c.*")
    return rows.withColumn("metadata", clean_metadata_json(F.col("metadata")))
