"""Quality classifier: n-gram indicators scaled by class log-count ratios, with a linear hinge-loss model.

Indicators are hashed: words (one and two in a row) and shapes of words (one to three in a
row). A shape is a word's case, the signs it ends with, and whether it repeats the word
before. The ratio of an n-gram is the log of its smoothed share in texts of label 1 over
that in texts of label 0. The linear model is fitted by dual coordinate descent on a
bounded sample of labelled rows that have a document (``SAMPLE_ROWS``, those of least hash;
of texts over ``SAMPLE_CHARS`` up to ``LONG_BYTES`` together), and a sigmoid turns its
margins into scores: it is fitted on the part of the sample kept aside for it.

Null and empty texts have no n-grams and get the score of the bias alone. Labels that are
null or belong to no document are left out; without rows of both labels every score is the
share of label 1 (0.5 without labels). Rows are scored one by one: ties, repeated rows and
other columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from turnmill.llm.common import bounded_batches, texts
from turnmill.llm.features import VISIBLE, Spans, mix, slices

#: Labelled rows the model is fitted on, at most.
SAMPLE_ROWS = 8_000
#: Texts over so many characters are long; the long ones of the sample have so many bytes together, at most.
SAMPLE_CHARS = 20_000
LONG_BYTES = 32_000_000
WORD_BITS = 16
SHAPE_BITS = 14
BUCKETS = (1 << WORD_BITS) + (1 << SHAPE_BITS)
#: Texts of the sample an n-gram must be in to count.
LEAST_TEXTS = 5
SMOOTHING = 1.0
COST = 0.1
EPOCHS = 20

_ALPHA = np.zeros(256, dtype=bool)
_ALPHA[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_PLAIN = _ALPHA.copy()
_PLAIN[0x30:0x3A] = True


def indicators(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Which n-grams (buckets) each text has, once each: places of the texts, buckets."""
    docs, buckets = [], []
    for first, some in slices(bodies):
        spans = Spans(some, VISIBLE)
        starts, ends, doc = spans.starts, spans.ends, spans.doc
        if not len(starts):
            continue
        blob = spans.blob
        upper = np.concatenate([[0], np.cumsum(_UPPER[blob], dtype=np.int32)])
        alpha = np.concatenate([[0], np.cumsum(_ALPHA[blob], dtype=np.int32)])
        n_upper, n_alpha = upper[ends] - upper[starts], alpha[ends] - alpha[starts]
        case = np.select(
            [n_alpha == 0, (n_upper == n_alpha) & (n_alpha > 1), _UPPER[blob[starts]]], [0, 1, 2], 3
        ).astype(np.uint64)
        tail, closing = np.zeros(len(starts), dtype=np.uint64), np.ones(len(starts), dtype=bool)
        for k in range(1, 4):
            at = np.maximum(ends - k, starts)
            closing &= (ends - k >= starts) & ~_PLAIN[blob[at]]
            tail = (tail << np.uint64(8)) | np.where(closing, blob[at], 0).astype(np.uint64)
        words = spans.hashes(starts, ends)
        same = np.zeros(len(words), dtype=np.uint64)
        same[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
        shapes = mix(case | same << np.uint64(2) | tail << np.uint64(3))
        found = []
        for grams, bits, base, most in ((words, WORD_BITS, 0, 2), (shapes, SHAPE_BITS, 1 << WORD_BITS, 3)):
            run = grams
            for n in range(1, most + 1):
                if n > 1:
                    run = mix(run[:-1] * np.uint64(31) + grams[n - 1 :] + np.uint64(n))
                inside = doc[: len(run)] == doc[n - 1 :]
                bucket = (run >> np.uint64(64 - bits)).astype(np.int64) + base
                found.append((doc[: len(run)].astype(np.int64) * BUCKETS + bucket)[inside])
        keys = np.unique(np.concatenate(found))
        docs.append(keys // BUCKETS + first)
        buckets.append(keys % BUCKETS)
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(docs), np.concatenate(buckets)


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.zeros((2, BUCKETS))
    for row, label in zip(rows, labels, strict=True):
        counts[label, row] += 1
    share = counts + SMOOTHING
    share /= share.sum(axis=1, keepdims=True)
    return np.where(counts.sum(axis=0) >= LEAST_TEXTS, np.log(share[1] / share[0]), 0.0)


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, n: int, cost: float, epochs: int
) -> np.ndarray:
    """Weights that minimise |w|²/2 + cost * sum of hinge losses; classes weigh alike."""
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.array([np.mean(labels == 0), np.mean(labels == 1)])
    most = cost * 0.5 / np.maximum(share[labels], 1e-9)
    squares = np.array([v @ v for v in values])
    weights, duals, order = np.zeros(n), np.zeros(len(rows)), np.random.default_rng(0)
    for _ in range(epochs):
        change = 0.0
        for i in order.permutation(len(rows)):
            row, value = rows[i], values[i]
            slope = signs[i] * (weights[row] @ value) - 1.0
            new = min(max(duals[i] - slope / squares[i], 0.0), most[i]) if squares[i] else 0.0
            step = new - duals[i]
            if step:
                weights[row] += step * signs[i] * value
                duals[i] = new
                change = max(change, abs(step))
        if change < 1e-4:
            break
    return weights


def sigmoid_of(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid that fits the labels best (Newton's method, smoothed targets)."""
    ones, zeros = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - target) + 1e-3 * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


BIAS = BUCKETS


def fit(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """All that scoring needs: a weight for each bucket, the bias, slope and shift of the sigmoid."""
    if len(labels) == 0 or labels.min() == labels.max():
        share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
        return np.concatenate([np.zeros(BUCKETS + 1), [0.0, np.log(share / (1 - share))]])
    aside = np.arange(len(rows)) % 4 == 3
    if labels[~aside].min() == labels[~aside].max():
        aside[:] = False
    used = np.flatnonzero(~aside)
    ratios = log_count_ratios([rows[i] for i in used], labels[used])
    scaled = np.append(ratios, 1.0)
    kept = [np.append(r[ratios[r] != 0], BIAS) for r in rows]
    weights = dual_coordinate_descent(
        [kept[i] for i in used], [scaled[kept[i]] for i in used], labels[used], BUCKETS + 1, COST, EPOCHS
    )
    weights = weights * scaled
    checked = np.flatnonzero(aside) if aside.any() else used
    margins = np.array([weights[kept[i]].sum() for i in checked])
    slope, shift = sigmoid_of(margins, labels[checked])
    return np.concatenate([weights, [slope, shift]])


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, limit: int
) -> DataFrame:
    """Up to ``limit`` labelled rows outside the held-out fifth, those of least hash, with their documents.

    Only labels with a document count. What one task gets is bounded by ``limit``,
    ``SAMPLE_CHARS`` and ``LONG_BYTES``; see ``within_budget``.
    """
    docs = docs.select(doc_id, text)  # other columns may have any names
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label"))
    known = known.where(F.col("__id").isNotNull() & F.col("__label").isin(0, 1) & ~held_out(F.col("__id"))).distinct()
    body = F.coalesce(F.col(text), F.lit(""))
    sizes = docs.select(
        F.col(doc_id).alias("__id"), F.length(body).alias("__chars"), F.octet_length(body).alias("__bytes")
    )
    usable = sizes.join(known, "__id").groupBy("__id", "__label").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__bytes").alias("__bytes"), F.max("__chars").alias("__chars")
    )
    usable = usable.withColumn("__hash", F.xxhash64("__id"))
    short, long = [
        usable.where(kind).orderBy("__hash", "__id", "__label").limit(limit)
        for kind in (F.col("__chars") <= SAMPLE_CHARS, F.col("__chars") > SAMPLE_CHARS)
    ]
    # The driver gets twice ``limit`` rows of numbers at most.
    taken = within_budget(short.union(long).collect(), limit)
    sample = docs.sparkSession.createDataFrame(taken, known.schema)
    return docs.join(F.broadcast(sample), docs[doc_id] == sample["__id"])


def within_budget(rows: list[Row], limit: int) -> list[tuple]:
    """(id, label) in the order of the hash, as far as rows and, for long texts, bytes are left.

    What doesn't fit is passed over for the next that does. A label of which nothing fits is
    still learned from: from its shortest text.
    """
    taken, over, room = [], [], LONG_BYTES
    for r in sorted(rows, key=lambda r: (r["__hash"], r["__id"], r["__label"])):
        if limit <= 0:
            break
        size = r["__bytes"] if r["__chars"] > SAMPLE_CHARS else 0
        if r["__n"] > limit or size > room:
            over.append(r)
            continue
        taken.append((r["__id"], r["__label"]))
        limit, room = limit - r["__n"], room - size
    for label in {r["__label"] for r in over} - {label for _, label in taken}:
        least = min((r for r in over if r["__label"] == label), key=lambda r: r["__bytes"])
        taken.append((least["__id"], label))
    return taken


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> np.ndarray:
    """The model of ``label``, fitted in one task on what the tasks before have hashed."""
    sample = training_rows(docs, labels, label, doc_id, text, sample_rows)
    sample = sample.select("__id", F.col("__label").alias("label"), F.col(text).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [t.encode() for t in texts(batch.column("text"))]
            doc, bucket = indicators(bodies)
            cuts = np.searchsorted(doc, np.arange(len(bodies) + 1))
            rows = [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("__id").cast(pa.int64()), "label": batch.column("label"), "row": rows}
            )

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["id", "label"], kind="stable")
        rows = [np.frombuffer(r, dtype=np.int32) for r in frame["row"]]
        model = fit(rows, frame["label"].to_numpy(dtype=np.int64))
        return pd.DataFrame({"model": [model.astype(np.float64).tobytes()]})

    rows = bounded_batches(sample).mapInArrow(hashed, "id long, label int, row binary")
    made = rows.groupBy().applyInPandas(fitted, "model binary").collect()
    return np.frombuffer(made[0][0]) if made else fit([], np.empty(0))


def scores(model: np.ndarray, bodies: list[bytes]) -> np.ndarray:
    doc, bucket = indicators(bodies)
    margins = np.bincount(doc, model[bucket], len(bodies)) + model[BIAS]
    return 1 / (1 + np.exp(-np.clip(model[-2] * margins + model[-1], -30, 30)))


def score(df: DataFrame, model: np.ndarray, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the score of each whole text, from 0 to 1."""
    shared = df.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    @F.arrow_udf("double")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(scores(shared.value, [t.encode() for t in texts(column)]), pa.float64())

    return bounded_batches(df).withColumn(name, run(F.col(text)))
