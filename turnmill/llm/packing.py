"""Hierarchical packing: documents routed to context sizes, each size packed, gaps filled from shorter ones.

A document's ids are cut into full windows of the longest context; what remains is routed
to the smallest context (tier) that holds it. From the longest tier down, each document
opens a window, and the gap is filled by the longest waiting documents that fit. A gap
that no whole document fits is closed by the head of a waiting one, whose tail waits on.
So all windows are full but the last of a chunk, which is cut into powers of two.

Work is done chunk by chunk within a partition: nothing is shuffled, and a task holds the
ids of one chunk. Sequences of a chunk are dealt to step groups of about equal tokens and
attention work.

Null and empty texts are documents of the end id alone. Repeated rows are packed each for
itself; equal lengths go in order of arrival. Columns other than id and text aren't read.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import bounded_batches, texts
from turnmill.llm.tokens import ENCODE_ROWS, WordEncoder

TIERS = (512, 1024, 2048, 4096)
#: Ids after which a chunk is packed.
CHUNK_IDS = 4_000_000
#: Ids of one training step.
STEP_IDS = 64 * 4096
END_ID = 2

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "context int, step_group long, ids binary"
)


class Waiting:
    """Pieces (document, start, length) by length: the longest that fits, the shortest that is longer."""

    def __init__(self):
        self.lengths: list[int] = []
        self.by: dict[int, list[tuple[int, int]]] = {}

    def __bool__(self) -> bool:
        return bool(self.lengths)

    def add(self, doc: int, start: int, length: int) -> None:
        if length not in self.by:
            bisect.insort(self.lengths, length)
            self.by[length] = []
        self.by[length].append((doc, start))

    def _take(self, at: int) -> tuple[int, int, int]:
        length = self.lengths[at]
        doc, start = self.by[length].pop()
        if not self.by[length]:
            del self.by[length], self.lengths[at]
        return doc, start, length

    def fitting(self, room: int) -> tuple[int, int, int] | None:
        at = bisect.bisect_right(self.lengths, room) - 1
        return None if at < 0 else self._take(at)

    def longer(self, room: int) -> tuple[int, int, int] | None:
        at = bisect.bisect_right(self.lengths, room)
        return None if at == len(self.lengths) else self._take(at)


def plan(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences (context, pieces in order) for documents of these lengths; every id in one piece."""
    tiers = tuple(sorted(tiers))
    if any(t & (t - 1) for t in tiers):
        raise ValueError("context sizes are powers of two")
    longest, out = tiers[-1], []
    waiting = {t: Waiting() for t in tiers}

    def route(doc: int, start: int, length: int) -> None:
        waiting[tiers[bisect.bisect_left(tiers, length)]].add(doc, start, length)

    for doc, n in enumerate(lengths):
        cut = n - n % longest
        out += [(longest, [(doc, s, longest)]) for s in range(0, cut, longest)]
        if n > cut:
            route(doc, cut, n - cut)
    for at in range(len(tiers) - 1, -1, -1):
        tier = tiers[at]
        while waiting[tier]:
            window = [waiting[tier].fitting(tier)]
            room = tier - window[0][2]
            while room:
                # Shorter tiers fill the gap first, from the longest that can fit.
                found = next((x for t in tiers[at::-1] if (x := waiting[t].fitting(room))), None)
                if found is None:
                    found = next((x for t in tiers[: at + 1] if (x := waiting[t].longer(room))), None)
                    if found is None:
                        break
                    doc, start, length = found
                    route(doc, start + room, length - room)
                    found = (doc, start, room)
                window.append(found)
                room -= found[2]
            out += [(tier, window)] if not room else _powers(window)
    return out


def _powers(window: list[tuple[int, int, int]]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """A window that couldn't be filled, as sequences whose lengths are powers of two."""
    total, out, todo = sum(x[2] for x in window), [], list(reversed(window))
    while total:
        size = room = 1 << (total.bit_length() - 1)
        pieces = []
        while room:
            doc, start, length = todo.pop()
            if length > room:
                todo.append((doc, start + room, length - room))
                length = room
            pieces.append((doc, start, length))
            room -= length
        out.append((size, pieces))
        total -= size
    return out


def step_groups(sequences: list[tuple[int, list[tuple[int, int, int]]]], step_ids: int = STEP_IDS) -> list[int]:
    """A group for each sequence: heaviest first, each to the group with the least ids, then least work."""
    groups = max(1, round(sum(c for c, _ in sequences) / step_ids))
    work = [sum(x[2] ** 2 for x in pieces) for _, pieces in sequences]
    heap, out = [(0, 0, g) for g in range(groups)], [0] * len(sequences)
    for i in sorted(range(len(sequences)), key=lambda i: (-sequences[i][0], -work[i])):
        ids, done, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (ids + sequences[i][0], done + work[i], g))
    return out


def pack(
    df: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: its document and place there, its sequence and place there, the ids themselves.

    ``sequence_id`` and ``step_group`` are numbered within partitions; ``context`` is the
    sequence's length. ``ids`` are little-endian unsigned 32-bit integers.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer)
        counter = groups = TaskContext.get().partitionId() << 33
        docs: list[int | None] = []
        bodies: list[bytes] = []
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal counter, groups, docs, bodies, size
            lengths = [len(b) // 4 for b in bodies]
            sequences = plan(lengths, tiers)
            dealt = step_groups(sequences)
            columns = [[] for _ in range(9)]
            for (context, pieces), group in zip(sequences, dealt, strict=True):
                offset = 0
                for doc, start, length in pieces:
                    row = (
                        docs[doc], start, length, lengths[doc], counter, offset, context, groups + group,
                        bodies[doc][4 * start : 4 * (start + length)],
                    )
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += length
                counter += 1
            groups += max(dealt, default=-1) + 1
            docs, bodies, size = [], [], 0
            whole = pa.int64()
            kinds = [whole] * 6 + [pa.int32(), whole, pa.binary()]
            names = [x.split()[0] for x in PIECES.split(", ")]
            for i in range(0, len(columns[0]), 2000):
                arrays = [pa.array(c[i : i + 2000], k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for i in range(0, batch.num_rows, ENCODE_ROWS):
                some = batch.slice(i, ENCODE_ROWS)
                docs += some.column(0).to_pylist()
                new = [ids + end for ids in encoder.encode(texts(some.column(1)))]
                bodies += new
                size += sum(map(len, new)) // 4
                if size >= CHUNK_IDS:
                    yield from packed()
        if docs:
            yield from packed()

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return bounded_batches(rows).mapInArrow(run, PIECES)
