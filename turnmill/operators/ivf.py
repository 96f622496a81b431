"""Approximate nearest neighbours by inverted lists and product-quantised residuals.

Lists are trained in two levels: coarse centres first, then the lists of each. There are
about as many lists as the square root of the collection. A vector lies in the list of its
nearest centre and is kept as a code: what is left of it after the centre is cut into pieces
of a few dimensions, each named by the nearest of up to 256 trained pieces. A query measures
the codes of its nearest lists by adding up table entries, and the best of those exactly.

How many lists a query has to visit is found out on the training sample, so that the asked
recall is reached there: few where vectors are clustered, most where they aren't.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill import fixed
from turnmill.operators.vectors import _best, _ids, _matrix, _top_per_query, _vectors, pivots
from turnmill.session import stored

#: Vectors to train on, those of least id hash; with their dimensions, all that the driver sees.
SAMPLE = 16_384
#: Dimensions of a piece.
PIECE = 4
TURNS = 8
MOST_LISTS = 65_536
#: Sampled vectors that ask for their neighbours in the sample.
ASKED = 256
RECALL = 0.97
#: Pairs of queries and codes measured at a time, and ids met after which a block keeps only those of its finds.
PAIRS = 500_000
HELD = 500_000
#: Finds measured exactly at a time.
FINDS = 512
#: Queries times lists of one block.
MARKS = 32_000_000


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * a @ b.T, 0.0)


def _nearest_row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    tile = max(1, 8_000_000 // max(1, len(b)))
    parts = [_squares(a[i : i + tile], b).argmin(axis=1) for i in range(0, len(a), tile)]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def k_means(points: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Up to ``k`` centres of some points; a centre that loses its points takes the farthest one."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    if len(distinct) <= k:
        return distinct
    centres = distinct[rng.choice(len(distinct), k, replace=False)]
    for _ in range(TURNS):
        own = _nearest_row(points, centres)
        counts = np.bincount(own, minlength=k)
        order = np.argsort(own, kind="stable")
        full = np.flatnonzero(counts)
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        moved = centres.copy()
        moved[full] = np.add.reduceat(points[order], starts, axis=0) / counts[full][:, None]
        empty = np.flatnonzero(counts == 0)
        if len(empty):
            far = ((points - centres[own]) ** 2).sum(axis=1)
            moved[empty] = points[np.argsort(-far, kind="stable")[: len(empty)]]
        centres = moved
    return centres


@dataclass(frozen=True)
class Lists:
    """Trained centres: ``coarse`` ones, those of the lists and the coarse one each belongs to, and the pieces."""

    coarse: np.ndarray
    centres: np.ndarray
    above: np.ndarray
    pieces: list[np.ndarray]
    edges: np.ndarray

    def list_of(self, vectors: np.ndarray, near: int = 3) -> np.ndarray:
        """The nearest list among those of the few nearest coarse centres."""
        order = np.argsort(_squares(vectors, self.coarse), axis=1, kind="stable")[:, :near]
        best = np.full(len(vectors), np.inf)
        out = np.zeros(len(vectors), dtype=np.int64)
        for c in np.unique(order):
            rows, own = np.flatnonzero((order == c).any(axis=1)), np.flatnonzero(self.above == c)
            if not len(own):
                continue
            gap = _squares(vectors[rows], self.centres[own])
            at = gap.argmin(axis=1)
            gap = gap[np.arange(len(rows)), at]
            closer = gap < best[rows]
            best[rows[closer]], out[rows[closer]] = gap[closer], own[at[closer]]
        return out

    def codes(self, residuals: np.ndarray) -> np.ndarray:
        out = np.empty((len(residuals), len(self.pieces)), dtype=np.uint8)
        for p, book in enumerate(self.pieces):
            out[:, p] = _nearest_row(residuals[:, self.edges[p] : self.edges[p + 1]], book)
        return out

    def coded(self, codes: np.ndarray) -> np.ndarray:
        """The residuals that codes stand for."""
        return np.concatenate([book[codes[:, p]] for p, book in enumerate(self.pieces)], axis=1)

    def rough(self, residuals: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distances of query residuals to coded ones (queries, codes)."""
        total = np.zeros((len(residuals), len(codes)), dtype=np.float32)
        for p, book in enumerate(self.pieces):
            table = _squares(residuals[:, self.edges[p] : self.edges[p + 1]], book).astype(np.float32)
            total += table[:, codes[:, p]]
        return total


@dataclass(frozen=True)
class Index:
    """``members`` (list, chunk_id, code, embedding) and ``vectors`` (chunk_id, embedding) are written tables.

    ``sizes`` is the manifest: the rows of each list. ``probes`` lists are visited by a query.
    """

    lists: Lists
    probes: int
    members: DataFrame
    vectors: DataFrame
    sizes: DataFrame


def train(sample: np.ndarray, lists: int, seed: int = 0) -> Lists:
    coarse = k_means(sample, max(1, round(lists**0.5)), seed)
    own = _nearest_row(sample, coarse)
    centres, above = [], []
    for c in range(len(coarse)):
        points = sample[own == c]
        found = k_means(points, max(1, round(lists * len(points) / len(sample))), seed) if len(points) else coarse[c : c + 1]
        centres.append(found)
        above.append(np.full(len(found), c))
    bare = Lists(coarse, np.concatenate(centres), np.concatenate(above), [], np.zeros(1, dtype=np.int64))
    residuals = sample - bare.centres[bare.list_of(sample)]
    edges = np.unique(np.linspace(0, sample.shape[1], max(1, -(-sample.shape[1] // PIECE)) + 1).astype(int))
    pieces = [k_means(residuals[:, a:b], 256, seed) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return Lists(bare.coarse, bare.centres, bare.above, pieces, edges)


def probes_for(sample: np.ndarray, lists: Lists, k: int, recall: float) -> int:
    """The lists that sampled vectors have to visit to meet this share of their neighbours in the sample."""
    asked = sample[np.linspace(0, len(sample) - 1, min(ASKED, len(sample))).astype(int)]
    own = lists.list_of(sample)
    near = np.argsort(_squares(asked, sample), axis=1, kind="stable")[:, : k + 1]
    gaps = _squares(asked, lists.centres)
    place = np.argsort(np.argsort(gaps, axis=1, kind="stable"), axis=1, kind="stable")
    visited = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
    return int(visited[min(len(visited) - 1, int(np.ceil(recall * len(visited))))]) + 1


def build(collection: DataFrame, *, k: int = fixed.NEIGHBOURS, recall: float = RECALL, lists: int | None = None, sample: int = SAMPLE) -> Index:
    """Trains on a bounded sample and writes every vector's list and code.

    ``recall`` is aimed at for the visited lists; what the codes lose is made up for by the
    exact measuring of more than k. Vectors that are null have no neighbours and are none.
    """
    vectors = stored(_vectors(collection, "chunk_id"), "ivf-vectors")
    rows = vectors.count()
    points = pivots(vectors, sample) if rows else np.zeros((0, 1))
    if not rows:
        points = np.zeros((1, 1))
    wanted = min(lists or max(1, round(rows**0.5)), MOST_LISTS, max(1, len(points) // 8))
    trained = train(points, wanted)
    probes = probes_for(points, trained, k, recall)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch.column(1))
                own = trained.list_of(matrix)
                code = trained.codes(matrix - trained.centres[own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), batch.column(0), pa.array([c.tobytes() for c in code], pa.binary()), batch.column(1)],
                    names=["list", "chunk_id", "code", "embedding"],
                )

    schema = T.StructType(
        [
            T.StructField("list", T.IntegerType()), vectors.schema["chunk_id"],
            T.StructField("code", T.BinaryType()), vectors.schema["embedding"],
        ]
    )
    members = stored(vectors.mapInArrow(assign, schema), "ivf-members")
    sizes = stored(members.groupBy("list").agg(F.count(F.lit(1)).alias("rows")), "ivf-sizes")
    return Index(trained, probes, members, vectors, sizes)


def _rows_of(index: Index) -> np.ndarray:
    rows = np.zeros(len(index.lists.centres), dtype=np.int64)
    for r in index.sizes.collect():  # a row a list
        rows[r["list"]] = r["rows"]
    return rows


def _visits(lists: Lists, rows: np.ndarray, vectors: np.ndarray, count: int, least: int) -> np.ndarray:
    """Whether each query visits each list."""
    out = np.zeros((len(vectors), len(rows)), dtype=bool)
    tile = max(1, PAIRS // len(rows))
    for start in range(0, len(vectors), tile):
        order = np.argsort(_squares(vectors[start : start + tile], lists.centres), axis=1, kind="stable")
        before = np.cumsum(rows[order], axis=1) - rows[order]
        query, place = np.nonzero((np.arange(order.shape[1]) < count) | (before < least))
        out[start + query, order[query, place]] = True
    return out


def visited(index: Index, queries: DataFrame, probes: int | None = None, least: int = 1) -> DataFrame:
    """(query_id, embedding, list) for the lists each query visits: the nearest ``probes``, and more
    until they hold ``least`` vectors together."""
    trained, count, rows = index.lists, probes or index.probes, _rows_of(index)
    asked = _vectors(queries, "query_id")
    schema = T.StructType([*asked.schema.fields, T.StructField("list", T.IntegerType())])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = max(1, PAIRS // len(rows))
        for whole in batches:
            for start in range(0, whole.num_rows, tile):
                batch = whole.slice(start, tile)
                query, own = np.nonzero(_visits(trained, rows, _matrix(batch.column(1)), count, least))
                chosen = pa.array(own.astype(np.int32))
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(query)).columns, chosen], names=schema.names)

    return asked.mapInArrow(choose, schema)


def _distinct(codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Where equal codes stand: an order that lists those of a kind in a row, at most the ``most``
    first ones, the place of each kind in it, and how many it has; None if all codes differ."""
    words = np.zeros((len(codes), -(-codes.shape[1] // 8) * 8), dtype=np.uint8)
    words[:, : codes.shape[1]] = codes
    words = words.view(np.uint64)
    order = np.lexsort(words.T)
    first = np.append(True, (words[order[1:]] != words[order[:-1]]).any(axis=1))
    if first.all():
        return None
    starts = np.flatnonzero(first)
    few = np.arange(len(order)) - starts[np.cumsum(first) - 1] < most
    counts = np.add.reduceat(few, starts, dtype=np.int64)
    return order[few], np.cumsum(counts) - counts, counts


def _where(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.nonzero`` of a matrix with few hits, eight places at a time."""
    flat = mask.reshape(-1)
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    word, place = np.nonzero(flat[:whole].reshape(-1, 8)[words])
    at = np.concatenate([words[word] * 8 + place, whole + np.flatnonzero(flat[whole:])])
    return np.divmod(at, mask.shape[1])


class Block:
    """Queries that meet the lists they visit one after the other.

    For each query the ``measured`` best codes so far are held (of equal ones those met first),
    with their exact distances, so neither the codes nor the vectors met have to be. Products of
    matrices in single precision tell which codes may be among them; only those are measured.
    """

    def __init__(self, lists: Lists, rows: np.ndarray, names: pa.Array, vectors: np.ndarray, probes: int, measured: int):
        self.lists, self.names, self.vectors, self.measured = lists, names, vectors, measured
        self.seen = _visits(lists, rows, vectors, probes, measured)
        # Of each query the best in order, then finds since; what is over ``limit`` is none.
        places = (len(vectors), measured + max(1, measured // 2))
        self.limit = np.full(len(vectors), np.inf, dtype=np.float32)
        self.filled = np.zeros(len(vectors), dtype=np.int64)
        self.rough = np.full(places, np.inf, dtype=np.float32)
        self.at, self.exact = np.zeros(places, dtype=np.int64), np.zeros(places)
        self.ids: list[pa.Array] = []
        self.met = self.kept = 0

    def meet(self, own: int, ids: pa.Array, codes: np.ndarray, vectors: np.ndarray) -> None:
        rows = np.flatnonzero(self.seen[:, own])
        if not len(rows):
            return
        same = _distinct(codes, self.measured)
        book = self.lists.coded(codes if same is None else codes[same[0][same[1]]])
        tile = max(1, PAIRS // max(len(book), 256))
        for start in range(0, len(rows), tile):
            some = rows[start : start + tile]
            left = self.vectors[some] - self.lists.centres[own]
            row, col, rough = self._below(left, book, self.limit[some])
            if same is not None:  # all of a code, in the order they were met in
                order, begins, counts = same
                many = counts[col]
                place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - begins[col], many)
                row, rough, col = np.repeat(row, many), np.repeat(rough, many), order[place]
                by_row = np.argsort(row * len(codes) + col, kind="stable")
                row, rough, col = row[by_row], rough[by_row], col[by_row]
            exact = np.empty(len(row))
            for i in range(0, len(row), FINDS):
                gap = self.vectors[some[row[i : i + FINDS]]] - vectors[col[i : i + FINDS]]
                gap *= gap
                # Dimension by dimension, as Spark adds them up.
                exact[i : i + FINDS] = np.add.reduce(np.ascontiguousarray(gap.T), axis=0)
            self._hold(some[row], rough, self.met + col, exact)
        self.ids.append(ids)
        self.met += len(ids)
        if self.met - self.kept >= max(HELD, len(self.names) * self.measured // 2):
            self._forget()

    def _below(self, left: np.ndarray, book: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, code, squared distance) by row and code where it is below the row's limit.

        Only the ``measured`` nearest of a row have to be found, and those of equal distance.
        """
        squares = (book * book).sum(axis=1)
        own = (left * left).sum(axis=1)
        left = np.append(left, np.ones((len(left), 1)), axis=1).astype(np.float32)
        book = np.append(book, -0.5 * squares[:, None], axis=1).astype(np.float32)
        close = left @ book.T  # half of what is near: greater is nearer
        # Twice what rounding may do to a product or to a distance measured in single precision.
        slack = (book.shape[1] + 16) * float(np.finfo(np.float32).eps) * (np.sqrt(own) + np.sqrt(squares.max())) ** 2
        least = 0.5 * (own - limit) - slack
        if close.shape[1] > self.measured and np.isinf(limit).any():
            open_ = np.flatnonzero(np.isinf(limit))
            last = close.shape[1] - self.measured
            least[open_] = np.partition(close[open_], last, axis=1)[:, last] - 2 * slack[open_]
        row, col = _where(~(close <= np.nextafter(least.astype(np.float32), np.float32(-np.inf))[:, None]))
        rough = np.empty(len(row), dtype=np.float32)
        for i in range(0, len(row), FINDS):
            gap = left[row[i : i + FINDS], :-1] - book[col[i : i + FINDS], :-1]
            rough[i : i + FINDS] = np.einsum("ij,ij->i", gap, gap)
        near = rough < limit[row]
        return row[near], col[near], rough[near]

    def _hold(self, row: np.ndarray, rough: np.ndarray, at: np.ndarray, exact: np.ndarray) -> None:
        """Finds, by row, go behind what the rows hold; full rows keep only their best first."""
        while len(row):
            place = self.filled[row] + np.arange(len(row)) - np.searchsorted(row, row)
            fits = place < self.rough.shape[1]
            own, place = row[fits], place[fits]
            self.rough[own, place], self.at[own, place], self.exact[own, place] = rough[fits], at[fits], exact[fits]
            np.maximum.at(self.filled, own, place + 1)
            if len(own) == len(row):
                return
            row, rough, at, exact = row[~fits], rough[~fits], at[~fits], exact[~fits]
            self._trim(np.unique(row))
            near = rough < self.limit[row]
            row, rough, at, exact = row[near], rough[near], at[near], exact[near]

    def _trim(self, rows: np.ndarray) -> None:
        best = np.argsort(self.rough[rows], axis=1, kind="stable")[:, : self.measured]
        for held in (self.rough, self.at, self.exact):
            held[rows, : self.measured] = np.take_along_axis(held[rows], best, axis=1)
        self.rough[rows, self.measured :] = np.inf
        self.filled[rows] = np.minimum(self.filled[rows], self.measured)
        self.limit[rows] = self.rough[rows, self.measured - 1]

    def _forget(self) -> None:
        """Of the ids met only those of finds are held on."""
        taken = np.arange(self.at.shape[1]) < self.filled[:, None]
        used, self.at[taken] = np.unique(self.at[taken], return_inverse=True)
        self.ids = [pa.concat_arrays(self.ids).take(pa.array(used))] if self.ids else []
        self.met = self.kept = len(used)

    def nearest(self, k: int) -> tuple[pa.Array, pa.Array] | None:
        """The names of queries and the ids of the k nearest by exact distance."""
        tile = 4_096
        for start in range(0, len(self.vectors), tile):
            self._trim(np.arange(start, min(start + tile, len(self.vectors))))
        self._forget()
        row, place = np.nonzero(np.arange(self.at.shape[1]) < self.filled[:, None])
        if not len(row):
            return None
        at, exact = self.at[row, place], self.exact[row, place]
        order = np.lexsort((exact, row))
        row, at, exact = row[order], at[order], exact[order]
        first = np.searchsorted(row, row)
        kth = exact[np.minimum(first + k, np.searchsorted(row, row, side="right")) - 1]
        near = exact <= kth  # of equal distances the least ids
        row, at, exact = row[near], at[near], exact[near]
        pool = self.ids[0].take(pa.array(at))
        row, _, place = _best(row, exact, np.unique(_ids(pool), return_inverse=True)[1] * len(pool) + np.arange(len(pool)), k)
        return self.names.take(pa.array(row)), pool.take(pa.array(place % len(pool)))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(block, list, rows) of the runs of a sorted batch."""
    block, own = batch.column("block").to_numpy(), batch.column("list").to_numpy()
    cuts = np.flatnonzero((block[1:] != block[:-1]) | (own[1:] != own[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)], strict=True):
        if b > a:
            yield int(block[a]), int(own[a]), batch.slice(a, b - a)


def search(
    index: Index,
    queries: DataFrame,
    k: int = fixed.NEIGHBOURS,
    *,
    probes: int | None = None,
    measured: int | None = None,
    queries_per_block: int = 16_384,
    members_per_block: int = 65_536,
) -> DataFrame:
    """(query_id, rank, chunk_id, distance): the k nearest of the ``measured`` best codes of the visited lists.

    Queries are dealt to blocks of like size along the lists they lie in, two for each core and
    more if they would hold over ``queries_per_block``. A list travels once to each block with
    a query that visits it, and its members stream by, up to ``members_per_block`` at a time:
    what a task holds is bounded by its queries, and what is shuffled doesn't depend on how
    many lists a query visits.
    """
    measured = measured or 20 * k
    trained, count, rows = index.lists, probes or index.probes, _rows_of(index)
    spark = queries.sparkSession
    asked = _vectors(queries, "query_id")

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = trained.list_of(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32())], names=["query_id", "embedding", "home"])

    placed = stored(
        asked.mapInArrow(home, T.StructType([*asked.schema.fields, T.StructField("home", T.IntegerType())])), "ivf-asked"
    )
    homes = np.zeros(len(rows), dtype=np.int64)
    for r in placed.groupBy("home").count().collect():  # a row a list
        homes[r["home"]] = r["count"]
    total = int(homes.sum())
    most = max(1, min(queries_per_block, MARKS // len(rows)))
    blocks = max(1, min(2 * spark.sparkContext.defaultParallelism, total), -(-total // most))
    # A query stands somewhere in the stretch of its list; equal stretches are blocks.
    starts = (np.cumsum(homes) - homes).tolist()
    stretch = spark.createDataFrame(
        [(i, a, int(n)) for i, (a, n) in enumerate(zip(starts, homes, strict=True)) if n], "home int, first long, of long"
    )
    place = F.col("first") + F.pmod(F.xxhash64("query_id"), F.col("of"))
    dealt = placed.join(F.broadcast(stretch), "home").withColumn(
        "block", F.floor(place * blocks / F.lit(max(1, total))).cast("int")
    )

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(0).to_numpy()
            seen = _visits(trained, rows, _matrix(batch.column(1)), count, measured) if len(block) else None
            for b in np.unique(block):
                own = np.flatnonzero(seen[block == b].any(axis=0)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), b, dtype=np.int32)), pa.array(own)], names=["block", "list"]
                )

    wanted = dealt.select("block", "embedding").mapInArrow(needed, "block int, list int")
    # A row a list, with the blocks it goes to.
    wanted = wanted.groupBy("list").agg(F.collect_set("block").alias("blocks"))
    members = index.members.join(F.broadcast(wanted), "list").select(
        F.explode("blocks").alias("block"), "list", F.lit(None).cast(asked.schema["query_id"].dataType).alias("query_id"),
        "chunk_id", "code", "embedding",
    )
    chunk = index.members.schema["chunk_id"].dataType
    both = dealt.select(
        "block", F.lit(-1).alias("list"), "query_id", F.lit(None).cast(chunk).alias("chunk_id"),
        F.lit(None).cast("binary").alias("code"), "embedding",
    ).unionByName(members)
    # The queries of a block come first.
    stream = both.repartitionById(blocks, "block").sortWithinPartitions("block", "list", "chunk_id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, matrices, block = None, [], [], None

        def found() -> Iterator[pa.RecordBatch]:
            pair = block.nearest(k) if block else None
            if pair:
                yield pa.RecordBatch.from_arrays(list(pair), names=["query_id", "chunk_id"])

        for batch in batches:
            for number, own, run in _runs(batch):
                if number != now:
                    yield from found()
                    now, names, matrices, block = number, [], [], None
                if own < 0:
                    names.append(run.column("query_id"))
                    matrices.append(_matrix(run.column("embedding")))
                    continue
                if block is None:
                    block = Block(trained, rows, pa.concat_arrays(names), np.concatenate(matrices), count, measured)
                    names, matrices = [], []
                for i in range(0, run.num_rows, members_per_block):
                    some = run.slice(i, members_per_block)
                    codes = np.frombuffer(b"".join(some.column("code").to_pylist()), dtype=np.uint8)
                    codes = codes.reshape(some.num_rows, -1)
                    block.meet(own, some.column("chunk_id"), codes, _matrix(some.column("embedding")))
        yield from found()

    schema = T.StructType([asked.schema["query_id"], index.members.schema["chunk_id"]])
    best = stream.mapInArrow(compare, schema)
    pairs = best.join(asked, "query_id").join(index.vectors.withColumnRenamed("embedding", "_theirs"), "chunk_id")
    gaps = F.zip_with("embedding", "_theirs", lambda a, b: a.cast("double") - b.cast("double"))
    distance = F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x * x)
    return _top_per_query(pairs.select("query_id", "chunk_id", distance.alias("distance")), k)


def work(index: Index, queries: DataFrame, probes: int | None = None, measured: int = 20 * fixed.NEIGHBOURS) -> float:
    """The share of all pairs of queries and vectors whose codes a search compares."""
    asked = _vectors(queries, "query_id").count()
    total = index.sizes.agg(F.sum("rows").alias("n")).first().n
    pairs = visited(index, queries, probes, measured).groupBy("list").count().join(index.sizes, "list")
    return pairs.agg(F.sum(F.col("count") * F.col("rows")).alias("n")).first().n / (asked * total)
