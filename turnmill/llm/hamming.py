"""Exact top-k search over binary codes by multi-index hashing.

Vectors become codes of their signs. Equal codes are one code with their k least ids, so
copies are searched once. Codes are dealt to blocks, queries too, and each block of queries
meets each block of codes once. There a code is cut into segments, each with a table of its
own; tables are searched at growing radii, one segment at a time, until the distance of the
k-th best found is covered: after radius r in the first j segments and r - 1 in the others,
every code closer than (segments * r + j) has been met. When the probes would outnumber
the codes (weighed by what each costs), the rest of the block is compared directly.

Ties go to the least id. A row is its own nearest neighbour unless told otherwise. Vectors
that are null or hold a null are left out; vectors of different lengths are refused. Fewer
than k rows give fewer results, an empty table none. Repeated ids each count; other columns
aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.llm.common import attach, bounded_batches, staged
from turnmill.llm.near import _grouped

K = 10
BLOCK_CODES = 8_192
BLOCK_QUERIES = 1_024
#: Queries of a block that are searched side by side.
TOGETHER = 64
#: Codes that are measured in the time of one probe of a table.
PROBE_COST = 4


def codes(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, code): a bit for each value, set where it is over 0."""

    @F.arrow_udf("binary")
    def pack(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            flat = np.asarray(column.flatten())
            rows = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)
            yield pa.array([x.tobytes() for x in np.packbits(rows > 0, axis=1)], pa.binary())

    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    sizes = rows.agg(F.min(F.size("vector")).alias("a"), F.max(F.size("vector")).alias("b")).first()
    if sizes.a != sizes.b:
        raise ValueError(f"vectors of {sizes.a} to {sizes.b} values")
    return bounded_batches(rows).select("id", pack("vector").alias("code"))


class Tables:
    """The codes of a block under one table per segment."""

    def __init__(self, rows: np.ndarray):
        self.bytes = rows
        bits = np.unpackbits(rows, axis=1)
        n, width = bits.shape
        size = int(np.clip(np.log2(max(n, 2)), 1, 16))
        self.edges = np.linspace(0, width, max(1, round(width / size)) + 1).astype(int)
        self.order, self.offsets = [], []
        for value, a, b in self.segments(bits):
            self.order.append(np.argsort(value, kind="stable"))
            self.offsets.append(np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << (b - a)))]))

    def segments(self, bits: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
        for a, b in zip(self.edges[:-1], self.edges[1:], strict=True):
            yield bits[:, a:b].astype(np.int64) @ (1 << np.arange(b - a)[::-1]), a, b

    @staticmethod
    def masks(size: int, radius: int) -> np.ndarray:
        return np.array([sum(1 << i for i in c) for c in combinations(range(size), radius)], dtype=np.int64)

    def probe(self, j: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, code) of all codes that table ``j`` has under the keys (queries, probes)."""
        low, high = self.offsets[j][keys], self.offsets[j][keys + 1]
        found = (high - low).ravel()
        ends = np.cumsum(found)
        query = np.repeat(np.arange(len(keys)), found.reshape(keys.shape).sum(axis=1))
        place = np.repeat(low.ravel() - ends + found, found) + np.arange(len(query))
        return query, self.order[j][place]

    def search(self, queries: np.ndarray, counts: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query the codes that can be among its k best rows, and their distances.

        ``counts`` has the rows of each code (k at most). All waiting queries go through a
        table together; only codes that a query has not met before are measured, and how many
        rows it has met at each distance tells when its k-th is covered.
        """
        width = self.bytes.shape[1]
        words = [x.view(np.uint64) for x in (_padded(self.bytes), _padded(queries))]
        bits = np.unpackbits(queries, axis=1)
        values = np.stack([v for v, _, _ in self.segments(bits)])
        sizes = np.diff(self.edges)
        m, n = len(sizes), len(self.bytes)
        most = 8 * width

        def measure(query: np.ndarray, code: np.ndarray) -> np.ndarray:
            total = np.zeros(len(query), dtype=np.int64)
            for w in range(words[0].shape[1]):
                total += np.bitwise_count(words[0][code, w] ^ words[1][query, w])
            return total

        waiting = np.arange(len(queries))
        seen = np.zeros((len(queries), n), dtype=bool)
        met = np.zeros((len(queries), most + 1), dtype=np.int64)  # rows by distance
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for radius in range(int(max(sizes)) + 1):
            for j in range(m):
                if radius > sizes[j]:
                    continue
                masks = self.masks(int(sizes[j]), radius)
                # A probe costs about as much as measuring a few codes: beyond that, all are measured.
                if PROBE_COST * len(masks) > n or radius == max(sizes):
                    yield from self._direct(words, counts, waiting, k)
                    return
                query, code = self.probe(j, values[j][waiting][:, None] ^ masks)
                query = waiting[query]
                new = ~seen[query, code]
                query, code = query[new], code[new]
                seen[query, code] = True
                distance = measure(query, code)
                np.add.at(met, (query, distance), counts[code])
                found.append((query, code, distance))
                rows = np.cumsum(met[waiting], axis=1)
                kth = np.where(rows[:, -1] >= k, (rows < k).sum(axis=1), most)
                done = (rows[:, -1] >= k) & (kth <= m * radius + j)
                if done.any():
                    yield from self._nearest(found, waiting[done], kth[done])
                    waiting = waiting[~done]
                    if not len(waiting):
                        return

    @staticmethod
    def _direct(words: list, counts: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The same for queries that are compared with every code."""
        total = np.zeros((len(queries), len(words[0])), dtype=np.uint16)
        for w in range(words[0].shape[1]):
            total += np.bitwise_count(words[1][queries, w][:, None] ^ words[0][None, :, w])
        for q, distance in zip(queries.tolist(), total.astype(np.int64), strict=True):
            near = np.arange(len(distance))
            if len(distance) > k:  # each code has a row at least
                near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
            order = np.argsort(distance[near], kind="stable")
            at = np.searchsorted(np.cumsum(counts[near][order]), k)
            if at < len(order):
                near = near[distance[near] <= distance[near[order[at]]]]
            yield q, near, distance[near]

    @staticmethod
    def _nearest(found: list, queries: np.ndarray, kth: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """What the queries have met up to their k-th distance."""
        query, code, distance = (np.concatenate(x) for x in zip(*found, strict=True))
        limit = np.full(int(max(query.max(initial=0), queries.max())) + 1, -1, dtype=np.int64)
        limit[queries] = kth
        near = np.flatnonzero(distance <= limit[query])
        near = near[np.argsort(query[near], kind="stable")]
        query = query[near]
        for q, a, b in zip(queries, np.searchsorted(query, queries), np.searchsorted(query, queries, side="right"), strict=True):
            yield int(q), code[near[a:b]], distance[near[a:b]]


def _padded(rows: np.ndarray) -> np.ndarray:
    """Codes with zero bytes behind, so that they are whole words."""
    out = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), dtype=np.uint8)
    out[:, : rows.shape[1]] = rows
    return out


CELL = ["i", "j"]


def top_k(
    df: DataFrame,
    queries: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    with_itself: bool = True,
    block_codes: int = BLOCK_CODES,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k rows of ``df`` with the closest codes for each query."""
    wanted = k if with_itself else k + 1
    by_id = Window.partitionBy("code").orderBy("id")
    rows = codes(df, vec_id, vector)
    # The k least ids of a code; each task sends no more than that for a code.
    least = rows.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= wanted)
    data = staged(least.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    asked = staged(codes(queries, vec_id, vector), "queries")
    ask = staged(asked.select("code").distinct(), "query-codes")
    n_data, n_ask = max(1, -(-data.count() // block_codes)), max(1, -(-ask.count() // block_queries))

    def dealt(frame: DataFrame, n: int) -> DataFrame:
        return frame.withColumn("own", F.pmod(F.xxhash64("code"), F.lit(n)).cast("int"))

    def each(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = dealt(ask, n_ask).select(
        F.col("own").alias("i"), each(n_data).alias("j"), "code", F.lit(None).cast("array<bigint>").alias("ids")
    )
    right = dealt(data, n_data).select(each(n_ask).alias("i"), F.col("own").alias("j"), "code", "ids")
    cells = left.unionByName(right).repartition(n_data * n_ask, *CELL).sortWithinPartitions(*CELL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _grouped(batches, CELL):
            code, ids = cell["code"].to_pylist(), cell["ids"].to_pylist()
            mine = [x for x, i in enumerate(ids) if i is None]
            theirs = [x for x, i in enumerate(ids) if i is not None]
            if not mine or not theirs:
                continue
            matrix = np.frombuffer(b"".join(code), dtype=np.uint8).reshape(len(code), -1)
            tables = Tables(matrix[theirs])
            counts = np.array([len(ids[x]) for x in theirs])
            for start in range(0, len(mine), TOGETHER):
                some = mine[start : start + TOGETHER]
                out = []
                for q, found, distance in tables.search(matrix[some], counts, wanted):
                    pairs = [(int(d), i) for f, d in zip(found, distance, strict=True) for i in ids[theirs[f]]]
                    out += [(code[some[q]], d, i) for d, i in sorted(pairs)[:wanted]]
                kinds = (pa.binary(), pa.int32(), pa.int64())
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["code", "distance", "neighbor_id"])

    found = bounded_batches(cells).mapInArrow(run, "code binary, distance int, neighbor_id long")
    best = Window.partitionBy("code").orderBy("distance", "neighbor_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= wanted)
    lists = staged(
        found.groupBy("code").agg(F.sort_array(F.collect_list(F.struct("distance", "neighbor_id"))).alias("found")),
        "found",
    )
    # Back to the queries; any number of them may share a code.
    salted = asked.withColumn("salt", F.xxhash64("id"))
    none = F.lit(None).cast(lists.schema["found"].dataType).alias("found")
    over = lists.select("code", F.xxhash64("code").alias("salt"), "found").unionByName(salted.select("code", "salt", none))
    out = attach(salted, "code", over, (F.max("found").alias("found"), "max"))
    if not with_itself:
        out = out.withColumn("found", F.filter("found", lambda x: x["neighbor_id"] != F.col("id")))
    out = out.select("id", F.posexplode(F.slice("found", 1, k)).alias("place", "x"))
    return out.select(
        F.col("id").alias("query_id"),
        (F.col("place") + 1).cast("long").alias("rank"),
        F.col("x")["neighbor_id"].alias("neighbor_id"),
        F.col("x")["distance"].cast("long").alias("distance"),
    )
