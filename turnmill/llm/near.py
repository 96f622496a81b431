"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles (a shorter text is one shingle). Sets are
embedded in ``COORDINATES`` values, of which two sets share each with the probability of
their Jaccard similarity. A run splits the sets recursively: a node samples a few
coordinates by the hash of its path, and sets that share a sampled value go down together.
Buckets of up to ``BUCKET`` sets are compared by brute force; larger ones are split again,
and those left at ``DEPTH`` are compared block by block, so none is cut. Runs are repeated
until pairs at the threshold are found with the target recall.

Equal sets are one set from the start, so copies are never paired. A bucket is dealt to
blocks, and each two blocks meet in a cell, so that no task gets more than a cell at once.
There the embeddings rule out most pairs (by five standard deviations); the others are
compared shingle by shingle, each pair in only one of the buckets it shares. A cell sends
on its members with a bit for each other member (at most ``2 * BLOCK``), and in the end a
count of links and one name for each member, however many pairs there are.

Documents are told apart by id and text together: repeated rows are one document, null ids
are allowed. Null, empty and blank texts have no shingles: each is a class of its own
without links. Ties don't occur, as classes are named by their least id. Other columns are
not read by the join.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import attach, bounded_batches, staged, texts
from turnmill.llm.features import VISIBLE, Spans, mix, slices

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
COORDINATES = 128
#: Coordinates a node samples on average, times the similarity.
BRANCHING = 2.0
BUCKET = 2_048
DEPTH = 3
#: Sets of one block of a bucket, so that a bucket of ordinary texts is one cell; a set of more
#: shingles than ``HEAVY`` counts as several.
BLOCK = BUCKET
HEAVY = 4_096
#: Edges up to which one task joins them: steps over one partition need no exchange.
EDGES_PER_TASK = 1_000_000
#: Documents to compare up to which their ids (16 bytes each) are sent to the tasks that read the texts.
KNOWN_IDS = 500_000
#: Standard deviations by which an embedding must fall short to rule a pair out.
DEVIATIONS = 5.0
NO_ID = -(2**63)

_SEED = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(bodies: list[bytes]) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each text."""
    out: list[np.ndarray] = []
    for _, some in slices(bodies):
        spans = Spans(some, VISIBLE)
        words = spans.hashes(spans.starts, spans.ends)
        cuts = np.searchsorted(spans.doc, np.arange(len(some) + 1))
        grams = words.copy()
        for k in range(1, SHINGLE if len(words) >= SHINGLE else 1):
            grams[: len(words) - k] = mix(grams[: len(words) - k] * np.uint64(31) + words[k:] + np.uint64(k))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a >= SHINGLE:
                out.append(np.unique(grams[a : b - SHINGLE + 1]))
            elif b > a:
                one = int.from_bytes(hashlib.blake2b(words[a:b].tobytes(), digest_size=8).digest(), "little")
                out.append(np.array([one], dtype=np.uint64))
            else:
                out.append(np.empty(0, dtype=np.uint64))
    return out


def embedding(shingles: np.ndarray) -> np.ndarray:
    """The least hash in each part of the hash space; an empty part takes the next one's, marked by the distance."""
    hashes = np.sort(mix(shingles ^ _SEED))
    step = np.uint64(64 - COORDINATES.bit_length() + 1)
    edges = np.arange(COORDINATES, dtype=np.uint64) << step
    at = np.searchsorted(hashes, edges)
    part = np.append(hashes, hashes[:1])[at] >> step  # the part whose value is taken
    distance = (part.astype(np.int64) - np.arange(COORDINATES)) % COORDINATES
    value = np.append(hashes, hashes[:1])[at]
    return (mix(value + distance.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def runs_for(similarity: float, recall: float) -> int:
    """Runs after which a pair at the threshold, split twice, is found with this probability."""
    level = 1 - math.exp(-BRANCHING)  # a sampled coordinate is shared: BRANCHING of them on average
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - level**2)))


def sampled(path: int, similarity: float) -> np.ndarray:
    """The coordinates a node samples; at least one."""
    luck = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(path))
    chosen = np.flatnonzero(luck < np.uint64(BRANCHING / similarity / COORDINATES * 2.0**64))
    return chosen if len(chosen) else luck.argmin()[None]


def children(paths: np.ndarray, values: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and paths of the next nodes for embeddings that stand at ``paths``."""
    rows, out = [], []
    for path in np.unique(paths):
        own = np.flatnonzero(paths == path)
        for c in sampled(int(path), similarity):
            rows.append(own)
            out.append(mix(values[own, c].astype(np.uint64) + np.uint64(int(c) << 32) ^ path))
    return np.concatenate(rows), np.concatenate(out)


def root(run: int) -> int:
    return int(mix(np.array([run + 1], dtype=np.uint64))[0])


def identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with ``__a`` and ``__b``, which tell documents apart."""
    return docs.withColumns(
        {"__a": F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)), "__b": F.xxhash64(F.coalesce(F.col(text), F.lit("")))}
    )


def profiles(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per document row: a, b, size of its set, the set's 128-bit name (null if empty), its embedding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets([t.lower().encode() for t in texts(batch.column("text"))])
            names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            columns = {
                "a": batch.column("a"), "b": batch.column("b"),
                "size": pa.array([len(s) for s in sets], pa.int64()), "set": pa.array(names, pa.binary()),
                "values": pa.array([embedding(s).tobytes() if len(s) else None for s in sets], pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    rows = identified(docs, doc_id, text).select(
        F.col("__a").alias("a"), F.col("__b").alias("b"), F.col(text).alias("text")
    )
    return bounded_batches(rows).mapInArrow(run, "a long, b long, size long, set binary, values binary")


def _values(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)


def _split(rows: DataFrame, similarity: float, runs: int = 0) -> DataFrame:
    """(path, set, weight) of the next level; ``runs``: of the first level, which starts at the roots of all runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _values(batch.column("values"))
            starts = [np.full(len(values), root(r), dtype=np.uint64) for r in range(runs)]
            starts = starts or [np.array(batch.column("path").to_pylist(), dtype=np.int64).view(np.uint64)]
            for paths in starts:
                row, out = children(paths, values, similarity)
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": pa.array(out.view(np.int64)),
                        "set": batch.column("set").take(pa.array(row)),
                        "weight": batch.column("weight").take(pa.array(row)),
                    }
                )

    return bounded_batches(rows).mapInArrow(run, "path long, set binary, weight long")


def _shared(paths: DataFrame) -> DataFrame:
    """The rows of paths that two sets share at least, with the number and the weight of the sets."""
    rows = paths.withColumn("salt", F.xxhash64("set"))
    aggs = ((F.count(F.lit(1)).alias("members"), "sum"), (F.sum("weight").alias("total"), "sum"))
    return attach(rows, "path", rows, *aggs, having=F.col("members") > 1).drop("salt", "weight")


def buckets(sets: DataFrame, similarity: float, recall: float, bucket: int, depth: int) -> DataFrame:
    """(path, set, members, total): the buckets to compare, over all runs; ``sets`` has set, values and size."""
    sets = sets.select("set", "values", (1 + F.expr(f"size div {HEAVY}")).alias("weight"))
    found = staged(_shared(_split(sets, similarity, runs_for(similarity, recall))), "paths")
    ready = [found.where(F.col("members") <= bucket)]
    for level in range(2, depth + 1):
        large = found.where(F.col("members") > bucket)
        if large.isEmpty():
            break
        rows = large.select("path", "set").join(sets, "set")
        found = staged(_shared(_split(rows, similarity)), f"paths-{level}")
        ready.append(found if level == depth else found.where(F.col("members") <= bucket))
    out = ready[0]
    for more in ready[1:]:
        out = out.unionByName(more)
    return out


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal keys together, from batches in which they stand one after the other."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        changed = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(a, b - a)
            if waiting and any(waiting[0].column(k)[0] != part.column(k)[0] for k in keys):
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(part)
    if waiting:
        yield pa.Table.from_batches(waiting)


def _gather(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a cell together and in order, for ``_grouped``."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, "set")


CELL = ["path", "i", "j"]


def _owned(paths: list[np.ndarray], path: int) -> np.ndarray:
    """Whether two members meet in no bucket of a lesser path (rows by rows)."""
    lesser = [p[p < path] for p in paths]
    row = np.repeat(np.arange(len(paths)), [len(p) for p in lesser])
    _, column, count = np.unique(np.concatenate(lesser), return_inverse=True, return_counts=True)
    several = count[column] > 1
    row, column = row[several], np.unique(column[several], return_inverse=True)[1]
    met = np.zeros((len(paths),) * 2, dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 1024):
        a, b = np.searchsorted(column, [start, start + 1024])
        part = np.zeros((len(paths), 1024), dtype=np.float32)
        part[row[a:b], column[a:b] - start] = 1
        met += part @ part.T
    return met == 0


def _asked(size: np.ndarray, values: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sizes and embeddings leave it open that two members are similar (rows by rows)."""
    out = np.zeros((len(size),) * 2, dtype=bool)
    for x in range(len(size) - 1):
        low, high = np.minimum(size[x], size[x + 1 :]), np.maximum(size[x], size[x + 1 :])
        y = x + 1 + np.flatnonzero(low >= similarity * high)
        if len(y):
            alike = (values[y] == values[x]).mean(axis=1)
            slack = DEVIATIONS * np.sqrt(similarity * (1 - similarity) / np.minimum(COORDINATES, low[y - x - 1]))
            out[x, y[alike >= similarity - slack]] = True
    return out | out.T


def candidates(found: DataFrame, sets: DataFrame, similarity: float, block: int) -> DataFrame:
    """Members of each cell that have to be compared shingle by shingle, with a bit for each other one."""
    n = F.ceil(F.col("total") / block).cast("int")
    own = F.pmod(F.xxhash64("set"), n).cast("int")
    others = F.sequence(F.lit(0), n - 1)
    cells = found.select("path", "set", own.alias("block"), F.explode(others).alias("other")).select(
        "path", "set", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    paths = found.groupBy("set").agg(F.collect_set("path").alias("paths"))
    known = sets.select("set", "size", "values", "copies", "first.a", "first.b").join(paths, "set")
    rows = _gather(cells.join(known, "set"), *CELL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _grouped(batches, CELL):
            block = np.array(cell["block"].to_pylist())
            crossing = cell["i"][0].as_py() != cell["j"][0].as_py()
            if cell.num_rows < 2 or (crossing and block.min() == block.max()):
                continue
            asked = _asked(np.array(cell["size"].to_pylist()), _values(cell["values"]), similarity)
            if crossing:
                asked &= block[:, None] != block[None, :]
            hit = np.flatnonzero(asked.any(axis=1))
            if not len(hit):
                continue
            asked = asked[np.ix_(hit, hit)]
            path = cell["path"][0].as_py()
            asked &= _owned([np.array(cell["paths"][i].as_py(), dtype=np.int64) for i in hit.tolist()], path)
            left = np.flatnonzero(asked.any(axis=1))
            if len(left):
                take = pa.array(hit[left])
                bits = np.packbits(asked[np.ix_(left, left)], axis=1)
                yield pa.RecordBatch.from_pydict(
                    {k: cell[k].take(take).combine_chunks() for k in (*CELL, "set", "a", "b", "copies")}
                    | {"place": pa.array(range(len(left)), pa.int32())}
                    | {"bits": pa.array([x.tobytes() for x in bits], pa.binary())}
                )

    return bounded_batches(rows).mapInArrow(
        run, "path long, i int, j int, set binary, a long, b long, copies long, place int, bits binary"
    )


def _shared_counts(sets_of: list[np.ndarray], asked: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each member the later members it is compared with, and how many shingles they share."""
    sizes = np.array([len(x) for x in sets_of])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    distinct, flat = np.unique(np.concatenate(sets_of), return_inverse=True)
    mark = np.zeros(len(distinct), dtype=bool)
    for x in range(len(sets_of) - 1):
        others = x + 1 + np.flatnonzero(asked[x, x + 1 :])
        if not len(others):
            continue
        own = flat[starts[x] : starts[x + 1]]
        mark[own] = True
        first, last = others[0], others[-1] + 1
        if 2 * sizes[others].sum() > starts[last] - starts[first]:
            # Most of what stands between the first and the last is asked for.
            both = np.add.reduceat(mark[flat[starts[first] : starts[last]]], starts[first:last] - starts[first], dtype=np.int64)
            both = both[others - first]
        else:
            some = np.concatenate([flat[starts[y] : starts[y + 1]] for y in others.tolist()])
            both = np.add.reduceat(mark[some], np.concatenate([[0], np.cumsum(sizes[others])[:-1]]), dtype=np.int64)
        mark[own] = False
        yield x, others, both


def verified(asked: DataFrame, docs: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    """(set, links, root) for each cell: documents linked to the set's members there, and a set of its component."""
    named = asked.withColumnsRenamed({"a": "__a", "b": "__b"})
    rows = identified(docs, doc_id, text).select("__a", "__b", F.col(text).alias("text"))
    known = named.select("__a", "__b").distinct()
    if known.limit(KNOWN_IDS + 1).count() <= KNOWN_IDS:
        rows = rows.join(F.broadcast(known), ["__a", "__b"], "left_semi")  # no other texts are shuffled
    rows = rows.join(named, ["__a", "__b"])
    # A document that comes twice must not stand in a cell twice.
    rows = rows.dropDuplicates([*CELL, "set"]).drop("__a", "__b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _grouped(batches, CELL):
            cell = cell.take(pa.array(np.argsort(cell["place"].to_numpy())))
            n = cell.num_rows
            sets_of = shingle_sets([t.lower().encode() for t in cell["text"].to_pylist()])
            bits = np.frombuffer(b"".join(cell["bits"].to_pylist()), dtype=np.uint8).reshape(n, -1)
            pairs = np.unpackbits(bits, axis=1, count=n).astype(bool)
            size = np.array([len(x) for x in sets_of])
            copies = cell["copies"].to_numpy()
            links, top = np.zeros(n, dtype=np.int64), list(range(n))

            def find(x: int, top=top) -> int:
                while top[x] != x:
                    top[x] = x = top[top[x]]
                return x

            for x, others, both in _shared_counts(sets_of, pairs):
                others = others[both >= similarity * (size[x] + size[others] - both)]
                links[x] += copies[others].sum()
                links[others] += copies[x]
                for y in others.tolist():
                    a, b = sorted((find(x), find(y)))
                    top[b] = a
            names = cell["set"].to_pylist()
            out = [(names[x], int(links[x]), names[find(x)]) for x in range(n) if links[x]]
            if out:
                kinds = (pa.binary(), pa.int64(), pa.binary())
                arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["set", "links", "root"])

    return bounded_batches(_gather(rows, *CELL)).mapInArrow(run, "set binary, links long, root binary")


def _edges(df: DataFrame) -> tuple[DataFrame, tuple]:
    """Edges written and read back, with what tells them from others: their number and a sum of hashes."""
    out = staged(df.where("u <> v").distinct(), "edges")
    mark = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return out.coalesce(max(1, -(-mark[0] // EDGES_PER_TASK))), tuple(mark)


def components(edges: DataFrame) -> DataFrame:
    """(set, component) of the sets that edges (u, v) link; a component is named by its least set.

    Large-star and small-star steps take turns: each set's neighbours are joined to the
    least one around, first the greater and then the smaller ones, until nothing moves.
    Every step is written to the shared folder.
    """
    now, mark = _edges(edges)
    while True:
        turned = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
        both = now.select(F.explode(F.array(F.struct("u", "v"), turned)).alias("e")).select("e.u", "e.v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down, _ = _edges(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
        before = mark
        now, mark = _edges(small)
        if mark == before:
            return now.select(F.col("u").alias("set"), F.col("v").alias("component"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    bucket: int = BUCKET,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per document: ``__a``, ``__b`` (see ``identified``), class_a, class_b, n_links, n_copies.

    A class holds all documents that links connect, equal sets included, and is named by its
    least document. ``n_links`` counts the other documents of at least this similarity.
    """
    rows = staged(profiles(docs, doc_id, text).dropDuplicates(["a", "b"]), "profiles")
    sets = rows.where(F.col("set").isNotNull()).groupBy("set").agg(
        F.min(F.struct("a", "b")).alias("first"), F.count(F.lit(1)).alias("copies"),
        F.max("size").alias("size"), F.max("values").alias("values"),
    )
    sets = staged(sets, "sets")
    found = staged(buckets(sets, similarity, recall, bucket, depth), "buckets")
    asked = staged(candidates(found, sets, similarity, min(BLOCK, bucket)), "candidates")
    links = staged(verified(asked, docs, doc_id, text, similarity), "links")
    linked = components(links.select(F.col("set").alias("u"), F.col("root").alias("v")))
    # A class takes its name from its least document.
    counts = links.groupBy("set").agg(F.sum("links").alias("links"))
    named = sets.select("set", "first", "copies").join(counts, "set", "left").join(linked, "set", "left")
    part = staged(named.withColumn("component", F.coalesce("component", "set")), "named").withColumn(
        "salt", F.xxhash64("set")
    )
    classes = attach(part, "component", part, (F.min("first").alias("class"), "min"))
    known = classes.select(
        "set", "salt", "class", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    # Back to the documents; a set may have any number of them.
    salted = rows.select("a", "b", "set", F.xxhash64("a", "b").alias("salt"))
    empty = known.select("class", "copies", "links").schema
    over = known.unionByName(salted.select("set", "salt", *[F.lit(None).cast(f.dataType).alias(f.name) for f in empty]))
    aggs = [(F.min(c).alias(c), "min") for c in ("class", "copies", "links")]
    out = attach(salted, "set", over, *aggs)
    own = F.struct("a", "b")
    return out.select(
        F.col("a").alias("__a"),
        F.col("b").alias("__b"),
        F.coalesce("class", own)["a"].alias("class_a"),
        F.coalesce("class", own)["b"].alias("class_b"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def id_of(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One document of each class, with the columns it came with; of repeated rows one."""
    classes = near_duplicates(docs, doc_id, text, **settings)
    firsts = classes.where("__a = class_a and __b = class_b").select("__a", "__b")
    # The caller's columns travel in one, whatever their names.
    own = identified(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), f"row.{doc_id}", f"row.{text}")
    return own.join(firsts, ["__a", "__b"], "left_semi").dropDuplicates(["__a", "__b"]).select("row.*")
