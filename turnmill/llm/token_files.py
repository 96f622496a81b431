"""Token ids in binary files: blocks of patched frames of reference with an index.

A block holds 256 ids. The block's minimum is subtracted; the rest is packed at the width
that a given share of the ids fits (90 % unless told otherwise), and the ids that need
more stand in an exception list with their places and high bits. A file is::

    "PFOR" | blocks | ids: document ids, lengths, starts of blocks | footer | "PFOR"

Documents follow each other without gaps, in ascending order of id (null ids first; rows
of one id by the hash of their text), each closed by the end id. Files are written by one
task each and numbered in order; a task that runs again writes a new file, and only files
in the manifest are read. An empty table has an empty manifest. Null texts are empty.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import bounded_batches, filesystem, spread, staged, texts, write_file
from turnmill.llm.tokens import ENCODE_ROWS, WordEncoder
from turnmill.session import run_dir

BLOCK = 256
SHARE = 0.9
END_ID = 2
MAGIC = b"PFOR"
#: Ids that are packed at a time, and after which a task opens its next file.
SEGMENT_IDS = 1 << 20
FILE_IDS = 1 << 26
#: Pieces that a worker remembers, of two generations each (about 200 bytes a piece).
REMEMBERED = 600_000
#: Documents of a file: their ids and lengths are held until it is closed.
FILE_DOCS = 1 << 20

_HEAD = 8  # minimum u32, width u8, unused u8, exceptions u16
_FOOT = "<QQQ"  # ids, documents, place of the lists
_FOOT_BYTES = struct.calcsize(_FOOT)


def encode_blocks(ids: np.ndarray, share: float = SHARE) -> tuple[bytes, np.ndarray]:
    """The bytes of the blocks and where each starts. The last block is filled up with its last id."""
    n = -(-len(ids) // BLOCK)
    values = np.concatenate([ids, np.repeat(ids[-1:], n * BLOCK - len(ids))]).astype(np.uint32).reshape(n, BLOCK)
    low = values.min(axis=1)
    rest = values - low[:, None]
    need = np.frexp(rest.astype(np.float64))[1].astype(np.uint8)  # bits
    at = min(BLOCK - 1, int(np.ceil(share * BLOCK)) - 1)
    width = np.partition(need, at, axis=1)[:, at]
    over = need > width[:, None]
    exceptions = over.sum(axis=1)
    sizes = _HEAD + 32 * width.astype(np.int64) + 5 * exceptions
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1], dtype=np.uint8)
    head = np.zeros((n, _HEAD), dtype=np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(n, 4)
    head[:, 4] = width
    head[:, 6:] = exceptions.astype("<u2").view(np.uint8).reshape(n, 2)
    out[starts[:-1, None] + np.arange(_HEAD)] = head
    for w in np.unique(width):
        if not w:
            continue
        own = np.flatnonzero(width == w)
        w = int(w)
        kept = (rest[own] & np.uint32((1 << w) - 1)).astype(np.uint64).reshape(len(own), 4, 64)
        packed = np.zeros((len(own), 4, w), dtype="<u8")
        for i in range(64):
            word, bit = divmod(i * w, 64)
            packed[:, :, word] |= kept[:, :, i] << np.uint64(bit)
            if bit + w > 64:
                packed[:, :, word + 1] |= kept[:, :, i] >> np.uint64(64 - bit)
        out[starts[own, None] + _HEAD + np.arange(32 * w)] = packed.reshape(len(own), -1).view(np.uint8)
    block, place = np.nonzero(over)
    if len(block):
        first = np.cumsum(exceptions) - exceptions
        nth = np.arange(len(block)) - first[block]
        base = starts[block] + _HEAD + 32 * width[block].astype(np.int64)
        out[base + nth] = place
        high = (rest[block, place] >> width[block].astype(np.uint32)).astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(base + exceptions[block] + 4 * nth)[:, None] + np.arange(4)] = high
    return out.tobytes(), starts[:-1]


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at ``starts`` in ``data``."""
    raw, n = np.frombuffer(data, dtype=np.uint8), len(starts)
    head = raw[starts[:, None] + np.arange(_HEAD)]
    low = head[:, :4].copy().view("<u4")[:, 0]
    width = head[:, 4]
    exceptions = head[:, 6:].copy().view("<u2")[:, 0].astype(np.int64)
    rest = np.zeros((n, BLOCK), dtype=np.uint32)
    for w in np.unique(width):
        if not w:
            continue
        own = np.flatnonzero(width == w)
        w = int(w)
        packed = raw[starts[own, None] + _HEAD + np.arange(32 * w)].view("<u8").reshape(len(own), 4, w)
        mask, kept = np.uint64((1 << w) - 1), np.empty((len(own), 4, 64), dtype=np.uint32)
        for i in range(64):
            word, bit = divmod(i * w, 64)
            value = packed[:, :, word] >> np.uint64(bit)
            if bit + w > 64:
                value |= packed[:, :, word + 1] << np.uint64(64 - bit)
            kept[:, :, i] = value & mask
        rest[own] = kept.reshape(len(own), BLOCK)
    block = np.repeat(np.arange(n), exceptions)
    if len(block):
        nth = np.arange(len(block)) - (np.cumsum(exceptions) - exceptions)[block]
        base = starts[block] + _HEAD + 32 * width[block].astype(np.int64)
        place = raw[base + nth]
        high = raw[(base + exceptions[block] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
        rest[block, place] |= high << width[block].astype(np.uint32)
    return (rest + low[:, None]).reshape(-1)


def write_token_files(
    df: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    share: float = SHARE,
) -> DataFrame:
    """Encodes and writes all texts; returns the manifest: path, order, n_docs, n_tokens, first_token."""
    spark = df.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    folder = run_dir(spark, "tokens")
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer, REMEMBERED)
        some = (b.slice(i, ENCODE_ROWS) for b in batches for i in range(0, b.num_rows, ENCODE_ROWS))
        source = ((x.column(0).to_pylist(), [e + end for e in encoder.encode(texts(x.column(1)))]) for x in some)
        number = TaskContext.get().partitionId() << 33
        for first in source:
            docs: list[int | None] = []
            lengths: list[int] = []

            def parts(chunk=first, docs=docs, lengths=lengths) -> Iterator[bytes]:
                place, starts, waiting, n, total = len(MAGIC), [], [], 0, 0
                yield MAGIC
                while chunk is not None:
                    sizes = [len(x) // 4 for x in chunk[1]]
                    docs += chunk[0]
                    lengths += sizes
                    waiting += chunk[1]
                    n += sum(sizes)
                    room = total + n < FILE_IDS and len(docs) < FILE_DOCS
                    chunk = next(source, None) if room else None
                    if n >= SEGMENT_IDS or chunk is None:
                        ids = np.frombuffer(b"".join(waiting), dtype="<u4")
                        whole = len(ids) if chunk is None else len(ids) - len(ids) % BLOCK
                        data, at = encode_blocks(ids[:whole], share)
                        starts.append(at + place)
                        waiting = [ids[whole:].tobytes()]
                        place, total, n = place + len(data), total + whole, len(ids) - whole
                        yield data
                known = np.array([d is not None for d in docs], dtype=np.uint8)
                ids = np.array([d or 0 for d in docs], dtype="<i8")
                yield known.tobytes() + ids.tobytes() + np.array(lengths, dtype="<u8").tobytes()
                yield np.concatenate(starts).astype("<u8").tobytes()
                yield struct.pack(_FOOT, total, len(docs), place) + MAGIC

            path = write_file(folder, ".pfor", parts())
            row = {"path": path, "order": number, "n_docs": len(docs), "n_tokens": sum(lengths)}
            number += 1
            yield pa.RecordBatch.from_pylist([row])

    written = bounded_batches(rows).mapInArrow(write, "path string, order long, n_docs long, n_tokens long")
    manifest = staged(written, "tokens-manifest")
    # One row per file: the sum over all files before is a window over a short list.
    before = Window.orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_file(path: str) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Documents of a file in order, some at a time: their ids, their lengths, their tokens in a row."""
    fs, inner = filesystem(path)
    with fs.open_input_file(inner) as file:
        size = file.size()
        tail = file.read_at(_FOOT_BYTES + len(MAGIC), size - _FOOT_BYTES - len(MAGIC))
        if tail[-len(MAGIC) :] != MAGIC or file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no token file")
        total, n_docs, place = struct.unpack(_FOOT, tail[:_FOOT_BYTES])
        lists = file.read_at(size - place - _FOOT_BYTES - len(MAGIC), place)
        known = np.frombuffer(lists, np.uint8, n_docs)
        ids = np.frombuffer(lists, "<i8", n_docs, n_docs)
        lengths = np.frombuffer(lists, "<u8", n_docs, 9 * n_docs).astype(np.int64)
        starts = np.frombuffer(lists, "<u8", -1, 17 * n_docs).astype(np.int64)
        docs = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        bounds = np.append(starts, place)
        tokens, left, doc = np.empty(0, np.uint32), total, 0
        step = SEGMENT_IDS // BLOCK
        for b in range(0, len(starts), step):
            last = min(b + step, len(starts))
            new = decode_blocks(file.read_at(bounds[last] - bounds[b], bounds[b]), starts[b:last] - bounds[b])[:left]
            left -= len(new)
            tokens = np.concatenate([tokens, new])
            ends = np.cumsum(lengths[doc : doc + len(tokens)])
            whole = int(np.searchsorted(ends, len(tokens), side="right"))
            if whole:
                yield docs[doc : doc + whole], lengths[doc : doc + whole], tokens[: ends[whole - 1]]
                tokens = tokens[ends[whole - 1] :]
                doc += whole


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document: doc_id, start (tokens of all documents before), n_tokens, ids (little-endian u32)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start = row["first_token"]
                for docs, lengths, tokens in read_file(row["path"]):
                    raw = tokens.astype("<u4").tobytes()
                    ends = np.cumsum(lengths)
                    cuts = zip(ends - lengths, ends, strict=True)
                    columns = {
                        "doc_id": pa.array(docs, pa.int64()),
                        "start": pa.array(start + ends - lengths, pa.int64()),
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids": pa.array([raw[4 * a : 4 * b] for a, b in cuts], pa.binary()),
                    }
                    start += int(ends[-1])
                    yield pa.RecordBatch.from_pydict(columns)

    return spread(manifest.select("path", "first_token")).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids binary"
    )
