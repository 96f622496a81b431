"""Chunks, embeddings and nearest neighbours.

Collections are tables ``(chunk_id, text, metadata, embedding)``; query tables are
``(query_id, embedding)``. The distance is the squared Euclidean one, ties go to the
smaller chunk id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill import fixed
from turnmill.functions import text as tx
from turnmill.session import shared_dir

METADATA = "map<string,string>"
#: Pairs whose distances a task holds at a time.
PAIRS = 1_000_000
#: Broadcast queries whose finds are merged at a time.
QUERIES = 4_096


# Metadata, normalisation, upsert ---------------------------------------------------------


def clean_metadata(metadata: Column) -> Column:
    """Drop entries without a value; no metadata at all is an empty map."""
    kept = F.map_filter(metadata, lambda _, v: v.isNotNull())
    return F.coalesce(kept, F.create_map().cast(METADATA))


def clean_metadata_json(metadata: Column) -> Column:
    """The same from JSON text; nested values stay as their JSON text."""
    return clean_metadata(F.from_json(metadata, METADATA))


def l2_normalize(vector: Column) -> Column:
    """Scale to unit length in double precision; a zero vector stays as it is."""
    wide = vector.cast("array<double>")
    return F.aggregate(
        wide,
        F.lit(0.0),
        lambda total, x: total + x * x,
        # The sum is worked out once and then used for every element.
        lambda total: F.when(total > 0, F.transform(wide, lambda x: x / F.sqrt(total))).otherwise(wide),
    )


def latest(batch: DataFrame, key: str, order: str | None) -> DataFrame:
    """One row per key. Without ``order`` a repeated key fails the job, with it the last wins."""
    others = [c for c in batch.columns if c != key]
    row = F.struct(*others)
    if order is None:
        once = F.when(F.count(F.lit(1)) == 1, F.any_value(row)).otherwise(
            F.raise_error(F.concat(F.lit("repeated id in batch: "), F.col(key).cast("string")))
        )
    else:
        once = F.max_by(row, order)
    return batch.groupBy(key).agg(once.alias("_row")).select(key, "_row.*")


def upsert(collection: DataFrame, batch: DataFrame, key: str = "chunk_id", order: str | None = None) -> DataFrame:
    """The collection with the rows of ``batch`` put in the place of those with the same key."""
    new = latest(batch, key, order).select(*collection.columns)
    kept = collection.join(batch.select(key), key, "left_anti")  # only the ids of the batch travel
    return kept.select(*collection.columns).unionByName(new)


# Nearest neighbours ----------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column as a (rows, dimensions) matrix in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    if len(column) and (flat.null_count or len(set(column.value_lengths().to_pylist())) > 1):
        raise ValueError("vectors must have the same number of values, none of them null")
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Ids as an array numpy can sort: whole numbers or fixed-width text."""
    return np.asarray(column.to_pylist())


def _best(query: np.ndarray, distance: np.ndarray, ids: np.ndarray, k: int):
    """The k nearest entries of every query number among flat candidate arrays."""
    order = np.lexsort((ids, distance, query))
    query, distance, ids = query[order], distance[order], ids[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query, side="left")
    keep = rank < k
    return query[keep], distance[keep], ids[keep]


def _nearest(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """Flat ``(query number, squared distance, id)`` of the k nearest vectors of each query."""
    tile = max(1, PAIRS // max(1, len(vectors)))
    squares = (vectors * vectors).sum(axis=1)
    by_place = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), dtype=np.int64)  # where each vector stands in id order
    place[by_place] = np.arange(len(ids))
    found = []
    for at in range(0, len(queries), tile):
        part = queries[at : at + tile]
        norms = (part * part).sum(axis=1)[:, None] + squares[None, :]
        rough = norms - 2.0 * part @ vectors.T
        # The rough distance is off by no more than the rounding of its terms, which grows
        # with the two norms. All that may be among the k nearest is measured again.
        slack = norms * (8.0 * (part.shape[1] + 8) * np.finfo(np.float64).eps)
        if rough.shape[1] > k:
            limit = np.partition(rough + slack, k - 1, axis=1)[:, k - 1]
            row, col = np.nonzero(rough - slack <= limit[:, None])
        else:
            row, col = (a.ravel() for a in np.indices(rough.shape))
        gap = part[row] - vectors[col]
        row, distance, by_id = _best(row, (gap * gap).sum(axis=1), place[col], k)
        found.append((row + at, distance, ids[by_place[by_id]]))
    return tuple(np.concatenate(a) for a in zip(*found, strict=True))


def _top_per_query(candidates: DataFrame, k: int) -> DataFrame:
    """The final k of each query; Spark keeps k per task before it shuffles."""
    nearest = Window.partitionBy("query_id").orderBy("distance", "chunk_id")
    return (
        candidates.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "chunk_id", "distance")
    )


def _result_schema(queries: DataFrame, collection: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("chunk_id", collection.schema["chunk_id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _search_with_broadcast(queries: DataFrame, collection: DataFrame, k: int) -> DataFrame:
    """One pass over the collection; each task keeps k candidates per query.

    Queries are sent in the precision they have and searched a few thousand at a time: of what
    a worker holds only they and their candidates grow with their number.
    """
    schema = _result_schema(queries, collection)
    table = queries.select("query_id", "embedding").toArrow()  # no more than the checked size
    names, column = table.column("query_id").combine_chunks(), table.column("embedding")
    exact = column.type.value_type.to_pandas_dtype()
    shared = collection.sparkSession.sparkContext.broadcast((names, _matrix(column).astype(exact)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_names, matrix = shared.value
        starts = range(0, len(matrix), QUERIES)
        best, id_type = [None] * len(starts), None
        for batch in batches:
            if not batch.num_rows:
                continue
            id_type = batch.column(0).type
            vectors, ids = _matrix(batch.column(1)), _ids(batch.column(0))
            for i, start in enumerate(starts):
                new = _nearest(matrix[start : start + QUERIES].astype(np.float64), vectors, ids, k)
                if best[i] is not None:
                    new = _best(*map(np.concatenate, zip(best[i], new, strict=True)), k)
                best[i] = new
        for start, found in zip(starts, best, strict=True):
            if found is not None:
                query, distance, ids = found
                yield pa.RecordBatch.from_arrays(
                    [query_names.take(pa.array(start + query)), pa.array(ids.tolist(), type=id_type), pa.array(distance)],
                    names=["query_id", "chunk_id", "distance"],
                )

    members = collection.where(F.col("embedding").isNotNull()).select("chunk_id", "embedding")
    return _top_per_query(members.mapInArrow(scan, schema), k)


def top_k(
    queries: DataFrame,
    collection: DataFrame,
    k: int = fixed.NEIGHBOURS,
    *,
    broadcast_bytes: int = 64 << 20,
    cells: int = 256,
) -> DataFrame:
    """Exact k nearest chunks of every query: ``(query_id, rank, chunk_id, distance)``.

    Query sets up to ``broadcast_bytes`` (counted first) are sent to every task and the
    collection is read once, without a shuffle of vectors. Larger sets go through
    ``top_k_cells``, which is exact as well.
    """
    queries = queries.where(F.col("embedding").isNotNull())
    width = queries.select(F.size("embedding").alias("n")).first()
    if width is not None:
        limit = broadcast_bytes // (8 * max(1, width["n"]))
        if queries.select("query_id").limit(limit + 1).count() > limit:
            return top_k_cells(queries, collection, k, cells=cells)
    return _search_with_broadcast(queries, collection, k)


# Cells: both sides too large to broadcast, and approximate search -------------------------


def pivots(collection: DataFrame, cells: int) -> np.ndarray:
    """``cells`` vectors of the collection: those whose ids have the smallest hashes.

    This small matrix, bounded by ``cells``, is the only thing brought to the driver. In a
    large collection rows with a large hash are filtered out before anything is sorted.
    """
    hashed = _vectors(collection, "chunk_id").withColumn("_hash", F.md5(F.col("chunk_id").cast("string")))
    total = hashed.count()
    wanted = min(cells, total)
    smallest = hashed.orderBy("_hash", "chunk_id").limit(cells).select("embedding")
    if total > 64 * cells:
        place = F.conv(F.substring("_hash", 1, 12), 16, 10).cast("double") / float(16**12)
        low = hashed.where(place < 4.0 * cells / total)
        picked = low.orderBy("_hash", "chunk_id").limit(cells).select("embedding").toArrow()
        if picked.num_rows == wanted:
            return _matrix(picked.column("embedding"))
    return _matrix(smallest.toArrow().column("embedding"))


def _pivot_distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squared = (
        (vectors * vectors).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2.0 * vectors @ centres.T
    )
    return np.sqrt(np.maximum(squared, 0.0))


def _to_cells(df: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """Add the ``probes`` nearest cells of each vector, one row per cell, with the distance."""
    schema = T.StructType(
        [*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("radius", T.DoubleType())]
    )
    at = df.columns.index("embedding")
    count = min(probes, len(centres))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            far = _pivot_distances(_matrix(batch.column(at)), centres)
            near = np.argsort(far, axis=1, kind="stable")[:, :count]
            rows = np.repeat(np.arange(batch.num_rows), count)
            cell = near.ravel()
            repeated = batch.take(pa.array(rows)) if count > 1 else batch
            yield pa.RecordBatch.from_arrays(
                [*repeated.columns, pa.array(cell.astype(np.int32)), pa.array(far[rows, cell])],
                schema=pa.schema(
                    [*repeated.schema, pa.field("cell", pa.int32()), pa.field("radius", pa.float64())]
                ),
            )

    return df.mapInArrow(assign, schema)


def _scan_cells(
    probes: DataFrame, members: DataFrame, k: int, queries_per_block: int, members_per_block: int
) -> DataFrame:
    """k nearest members of every probed cell, for each probe.

    A cell of any size, a third of all vectors included, is cut into blocks on both sides
    by hash, so each task compares two bounded blocks and returns k rows per query.
    """
    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    # One row per cell, so no more rows than there are pivots.
    sizes = F.broadcast(
        blocks(probes, queries_per_block, "query_blocks").join(
            blocks(members, members_per_block, "member_blocks"), "cell"
        )
    )

    def place(df: DataFrame, key: str, own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        return df.join(sizes, "cell").select(
            key,
            "embedding",
            "cell",
            F.pmod(F.xxhash64(key), F.col(own_count)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)).alias(other),
        )

    left = place(probes, "query_id", "qb", "query_blocks", "mb", "member_blocks")
    right = place(members, "chunk_id", "mb", "member_blocks", "qb", "query_blocks")
    schema = _result_schema(probes, members)

    def compare(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        names = queries.column("query_id").combine_chunks()
        id_type = vectors.schema.field("chunk_id").type
        if not queries.num_rows or not vectors.num_rows:
            return pa.table(
                {"query_id": names.slice(0, 0), "chunk_id": pa.array([], id_type), "distance": pa.array([], pa.float64())}
            )
        row, distance, ids = _nearest(
            _matrix(queries.column("embedding")),
            _matrix(vectors.column("embedding")),
            _ids(vectors.column("chunk_id")),
            k,
        )
        return pa.table(
            {"query_id": names.take(pa.array(row)), "chunk_id": pa.array(ids.tolist(), id_type), "distance": distance}
        )

    keys = ("cell", "qb", "mb")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, schema)


def top_k_approx(
    queries: DataFrame,
    collection: DataFrame,
    k: int = fixed.NEIGHBOURS,
    *,
    cells: int = 256,
    probes: int = 16,
    queries_per_block: int = 8192,
    members_per_block: int = 131_072,
) -> DataFrame:
    """k nearest among the ``probes`` cells closest to each query.

    About ``probes / cells`` of all comparisons are made; with ``probes = cells`` the
    answer is exact.
    """
    centres = pivots(collection, cells)
    shared_dir(queries.sparkSession)
    asked = _to_cells(_vectors(queries, "query_id"), centres, probes)
    # Counted and searched: written once, so cells are not worked out twice.
    members = _to_cells(_vectors(collection, "chunk_id"), centres, 1).checkpoint()
    return _top_per_query(_scan_cells(asked, members, k, queries_per_block, members_per_block), k)


def _vectors(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col("embedding").isNotNull()).select(key, "embedding")


def top_k_cells(
    queries: DataFrame,
    collection: DataFrame,
    k: int = fixed.NEIGHBOURS,
    *,
    cells: int = 256,
    queries_per_block: int = 8192,
    members_per_block: int = 131_072,
) -> DataFrame:
    """Exact k nearest chunks when both sides are large.

    Every query first searches its own cell. The distance of its k-th find bounds what any
    other cell must be able to offer; by the triangle inequality only the remaining cells
    are searched as well. Of equal members only the k smallest ids can ever be an answer,
    so however many copies a vector has, no more than k of them are searched.
    """
    shared_dir(queries.sparkSession)
    same = Window.partitionBy("embedding").orderBy("chunk_id")
    members = (
        _vectors(collection, "chunk_id")
        .withColumn("_copy", F.row_number().over(same))
        .where(F.col("_copy") <= k)
        .drop("_copy")
    )
    # What is used more than once is written once, so it is not worked out again.
    centres = pivots(collection, cells)
    placed = _to_cells(members, centres, 1).checkpoint()
    own = _to_cells(_vectors(queries, "query_id"), centres, 1).checkpoint()
    reach = {
        r["cell"]: (r["least"], r["most"])
        for r in placed.groupBy("cell").agg(F.min("radius").alias("least"), F.max("radius").alias("most")).collect()
    }  # one entry per cell

    blocks = (queries_per_block, members_per_block)
    first = _top_per_query(_scan_cells(own, placed, k, *blocks), k).checkpoint()
    bound = first.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.sqrt(F.max("distance"))).alias("_bound")
    )
    rest = _other_cells(own.join(bound, "query_id", "left"), centres, reach)
    second = _scan_cells(rest, placed, k, *blocks)
    return _top_per_query(first.select("query_id", "chunk_id", "distance").unionByName(second), k)


def _other_cells(own: DataFrame, centres: np.ndarray, reach: dict[int, tuple[float, float]]) -> DataFrame:
    """The cells, other than its own, that may hold something within a query's bound."""
    schema = T.StructType(
        [own.schema["query_id"], own.schema["embedding"], T.StructField("cell", T.IntegerType())]
    )
    used = np.array(sorted(reach), dtype=np.int32)
    least = np.array([reach[c][0] for c in used])
    most = np.array([reach[c][1] for c in used])
    apart = _pivot_distances(centres, centres)[:, used] if len(used) else np.zeros((len(centres), 0))
    at = {name: own.columns.index(name) for name in ("query_id", "embedding", "cell", "_bound")}

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            home = batch.column(at["cell"]).to_numpy()
            bound = batch.column(at["_bound"]).to_numpy(zero_copy_only=False).astype(np.float64)
            bound = np.where(np.isnan(bound), np.inf, bound)
            far = _pivot_distances(_matrix(batch.column(at["embedding"])), centres)
            here = far[np.arange(len(home)), home]
            there = far[:, used]
            # Three lower bounds on the distance to a member of the cell.
            low = np.maximum(there - most, least - there)
            with np.errstate(divide="ignore", invalid="ignore"):
                half = (there**2 - here[:, None] ** 2) / (2.0 * apart[home])
            low = np.maximum(low, np.where(np.isfinite(half), half, 0.0))
            row, col = np.nonzero((low <= bound[:, None] + 1e-6 * (1.0 + there)) & (used[None, :] != home[:, None]))
            if len(row):
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(at["query_id"]).take(take),
                        batch.column(at["embedding"]).take(take),
                        pa.array(used[col]),
                    ],
                    names=["query_id", "embedding", "cell"],
                )

    return own.mapInArrow(choose, schema)


# Answers ---------------------------------------------------------------------------------


def retrieve(found: DataFrame, chunks: DataFrame, limit: int = fixed.PREVIEW_CHARS) -> DataFrame:
    """Join found ids to their chunk: preview and metadata. Texts stay out of the search."""
    shown = chunks.select("chunk_id", tx.preview(F.col("text"), limit).alias("preview"), "metadata")
    return found.join(shown, "chunk_id").select(
        "query_id", "rank", "chunk_id", "distance", "preview", "metadata"
    )
