"""Filter interaction audit: what each filter removes in every order of the filters.

A table-driven byte transducer reads each text's UTF-8 once: the class of a byte and the
state (inside a word or not) look up what is emitted there: a word opens or closes, a
capital, a symbol, a code point. The state after a byte follows from its class alone, so a
block of bytes is run by table look-ups at once. Word spans go into an open-addressing hash
table; equal hashes are verified byte by byte, so distinct words are counted exactly.

A document becomes a mask of the filters it fails. Counts per part and mask are all that
the orders need: each mask has fixed consequences for each step of each order.

Null and empty texts have no words (they fail the filter of length). Null parts count as
the empty part. A copy is a text equal to that of a smaller id; null ids are neither copies
nor originals, rows of the same id are no copies of each other. Repeated rows each count. A
document without labels, or with null ones, is neither good nor toxic; one with several rows
of labels is what any of them says. An empty table has no parts and so no rows. Other columns
are not read, so their names don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import attach, bounded_batches, staged
from turnmill.llm.features import SLICE_BYTES, _powers, kinds, mix

# The filters; each condition speaks of a document that fails.
FILTERS = {
    "A": "n_words < 50",
    "B": "100 * n_distinct < 65 * n_words",
    "C": "100 * n_capitals > 5 * n_points",
    "D": "n_symbols > 0",
    "E": "earlier_copy",
}

# Classes of bytes, states, and what is emitted.
_SPACE, _CAPITAL, _SYMBOL, _CONTINUES, _OTHER = range(5)
_OUT, _IN = range(2)
OPENS, CLOSES, CAPITAL, SYMBOL, POINT = (1 << i for i in range(5))


def _classes() -> np.ndarray:
    out = np.full(256, _OTHER, dtype=np.uint8)
    out[kinds((0x20, 0x20), (0x09, 0x0D))] = _SPACE
    out[kinds((0x41, 0x5A))] = _CAPITAL
    out[kinds((0x80, 0xBF))] = _CONTINUES
    out[list(b"#$%&*|")] = _SYMBOL
    return out


def _emissions() -> np.ndarray:
    out = np.zeros((2, 5), dtype=np.uint8)
    out[_IN, _SPACE] |= CLOSES
    out[_OUT, [c for c in range(5) if c != _SPACE]] |= OPENS
    out[:, _CAPITAL] |= CAPITAL
    out[:, _SYMBOL] |= SYMBOL
    out[:, [c for c in range(5) if c != _CONTINUES]] |= POINT
    return out.ravel()


CLASS = _classes()
#: The next state by class: the same from both states.
NEXT = np.array([_OUT if c == _SPACE else _IN for c in range(5)], dtype=np.uint8)
EMIT = _emissions()


def transduce(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """What is emitted at each byte; the state is reset at ``starts``."""
    seen = CLASS[data]
    state = np.empty(len(data), dtype=np.uint8)
    state[1:] = NEXT[seen[:-1]]
    state[starts] = _OUT
    return EMIT[state * np.uint8(5) + seen]


def _same_bytes(wide: np.ndarray, data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at ``a`` and at ``b`` are equal; ``wide`` reads eight at a place."""
    out = np.ones(len(a), dtype=bool)
    short = np.flatnonzero(size <= 64)
    done = 0
    while len(short):
        left = size[short] - done
        keep = np.where(left >= 8, ~np.uint64(0), (np.uint64(1) << (np.minimum(left, 7) * 8).astype(np.uint64)) - np.uint64(1))
        out[short] = (wide[a[short] + done] ^ wide[b[short] + done]) & keep == 0
        done += 8
        short = short[out[short] & (size[short] > done)]
    for i in np.flatnonzero(size > 64):
        out[i] = data[a[i] : a[i] + size[i]].tobytes() == data[b[i] : b[i] + size[i]].tobytes()
    return out


def first_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether each span is the one kept of the equal spans of its owner.

    All spans are put into one open-addressing table, a step of probing at a time. Equal
    spans walk the same places in step, so one of them settles and the others meet it.
    """
    kept = np.zeros(len(starts), dtype=bool)
    if not len(starts):
        return kept
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    wide = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = ends - starts
    mask = (1 << (2 * len(starts) - 1).bit_length()) - 1
    place = (hashes & np.uint64(mask)).astype(np.int64)
    table = np.full(mask + 1, -1, dtype=np.int64)
    active = np.arange(len(starts))
    while len(active):
        at = place[active]
        free = table[at] < 0
        table[at[free]] = active[free]
        there = table[at]
        settled = there == active
        kept[active[settled]] = True
        a, b = active[~settled], there[~settled]
        equal = (hashes[a] == hashes[b]) & (owner[a] == owner[b]) & (size[a] == size[b])
        asked = np.flatnonzero(equal)
        equal[asked] = _same_bytes(wide, data, starts[a[asked]], starts[b[asked]], size[a[asked]])
        active = a[~equal]
        place[active] = (place[active] + 1) & mask
    return kept


def _block(data: np.ndarray, edges: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Measures of the texts between ``edges``, and the spans of their distinct words."""
    n = len(data)
    starts, stops = edges[:-1][edges[1:] > edges[:-1]], edges[1:][edges[1:] > edges[:-1]]
    emitted = transduce(data, starts)

    def count(flag: int) -> np.ndarray:
        sums = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(emitted & flag != 0, out=sums[1:])
        return sums[edges[1:]] - sums[edges[:-1]]

    closes = np.zeros(n + 1, dtype=bool)
    closes[:n] = emitted & CLOSES != 0
    closes[stops[NEXT[CLASS[data[stops - 1]]] == _IN]] = True  # the end of a text ends its word
    opened, closed = np.flatnonzero(emitted & OPENS), np.flatnonzero(closes)
    owner = np.searchsorted(edges, opened, side="right") - 1
    kept = first_spans(data, opened, closed, owner)
    measures = {
        "n_words": np.bincount(owner, minlength=len(edges) - 1),
        "n_distinct": np.bincount(owner[kept], minlength=len(edges) - 1),
        "n_capitals": count(CAPITAL),
        "n_points": count(POINT),
        "n_symbols": count(SYMBOL),
    }
    return measures, opened[kept], closed[kept]


def _long(data: np.ndarray) -> dict[str, int]:
    """Measures of one text, block by block; blocks end behind a space, a longer word is a block."""
    total = dict.fromkeys(MEASURES, 0)
    words: set[bytes] = set()
    at = 0
    while at < len(data):
        end = min(at + SLICE_BYTES, len(data))
        if end < len(data):
            spaces = np.flatnonzero(CLASS[data[at:end]] == _SPACE)
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:
                while end < len(data):
                    later = np.flatnonzero(CLASS[data[end : end + SLICE_BYTES]] == _SPACE)
                    end = end + int(later[0]) if len(later) else min(end + SLICE_BYTES, len(data))
                    if len(later):
                        break
        if end - at > SLICE_BYTES:
            words.add(data[at:end].tobytes())
            total["n_words"] += 1
            for i in range(at, end, SLICE_BYTES):
                seen = CLASS[data[i : min(i + SLICE_BYTES, end)]]
                total["n_capitals"] += int(np.count_nonzero(seen == _CAPITAL))
                total["n_symbols"] += int(np.count_nonzero(seen == _SYMBOL))
                total["n_points"] += int(np.count_nonzero(seen != _CONTINUES))
        else:
            part = data[at:end]
            found, starts, ends = _block(part, np.array([0, len(part)]))
            for name in MEASURES:
                total[name] += int(found[name][0])
            words.update(part[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
        at = end
    return total | {"n_distinct": len(words)}


MEASURES = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def measure(column: pa.Array) -> tuple[dict[str, np.ndarray], list[bytes]]:
    """The measures of each text of a string column, and each text's SHA-256."""
    column = column.fill_null("")
    buffers = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(buffers[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2] or b"", dtype=np.uint8)
    out = {name: np.zeros(len(column), dtype=np.int64) for name in MEASURES}
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        if end <= at:
            for name, value in _long(data[offsets[at] : offsets[at + 1]]).items():
                out[name][at] = value
            end = at + 1
        else:
            found, _, _ = _block(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
            for name, values in found.items():
                out[name][at:end] = values
        at = end
    view = memoryview(data)
    cuts = offsets.tolist()
    return out, [hashlib.sha256(view[a:b]).digest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(id, part, digest, salt, measures) of every document; ``salt`` numbers the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            values, digests = measure(batch.column("text"))
            columns = {"id": batch.column("id"), "part": batch.column("part"), "digest": pa.array(digests, pa.binary())}
            columns["salt"] = pa.array(np.arange(at, at + batch.num_rows))
            at += batch.num_rows
            yield pa.RecordBatch.from_pydict(columns | {n: pa.array(v) for n, v in values.items()})

    rows = docs.select(
        F.col(doc_id).cast("long").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).alias("text"),
    )
    fields = ", ".join(f"{m} long" for m in MEASURES)
    return bounded_batches(rows).mapInArrow(run, f"id long, part string, digest binary, salt long, {fields}")


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(id, part, salt, mask) of every document: bit i of the mask is set where it fails filter i."""
    rows = staged(measured(docs, doc_id, text, part), "measures")
    rows = attach(rows, "digest", rows, (F.min("id").alias("least_id"), "min"))
    rows = rows.withColumn("earlier_copy", F.coalesce(F.col("id") > F.col("least_id"), F.lit(False)))
    mask = F.lit(0)
    for i, condition in enumerate(FILTERS.values()):
        mask = mask + F.when(F.expr(condition), 1 << i).otherwise(0)
    return rows.select("id", "part", "salt", mask.alias("mask"))


def consequences() -> pd.DataFrame:
    """What becomes of a document with each mask at each step of each order.

    A filter fails first in as many orders as its share among the filters the mask fails.
    """
    letters = list(FILTERS)
    orders = list(permutations(range(len(letters))))
    out = []
    for order in orders:
        for step, own in enumerate(order):
            before = sum(1 << f for f in order[:step])
            for mask in range(1 << len(letters)):
                fails, gone = bool(mask >> own & 1), bool(mask & before)
                first = len(orders) // mask.bit_count() if fails else 0
                flags = (not gone and not fails, fails and not gone, fails and gone, mask == 1 << own, first)
                out.append(("".join(letters[f] for f in order), step + 1, mask, *map(int, flags)))
    names = ["filter_order", "step", "mask", "kept", "removed", "redundant", "unique_fails", "shapley"]
    return pd.DataFrame(out, columns=names).astype({"step": "int32", "mask": "int32"})


def audit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of documents there."""
    rows = failures(docs, doc_id, text, part)
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    named = rows.where(F.col("id").isNotNull()).join(marks, "id", "left").select("part", "mask", "good", "toxic")
    no = F.lit(False)
    nameless = rows.where(F.col("id").isNull()).select("part", "mask", no.alias("good"), no.alias("toxic"))
    counts = named.unionByName(nameless).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic")
    )
    plan = F.broadcast(docs.sparkSession.createDataFrame(consequences()))  # 600 rows a mask, whatever the data
    each = counts.join(plan, "mask")
    total = lambda flag, n="n": F.sum(F.col(flag) * F.col(n)).cast("long")
    return each.groupBy("part", "filter_order", "step").agg(
        *[total(c).alias(c) for c in ("kept", "removed", "redundant", "unique_fails")],
        total("removed", "n_good").alias("good_lost"),
        total("removed", "n_toxic").alias("toxic_lost"),
        total("shapley").alias("shapley"),
    )
