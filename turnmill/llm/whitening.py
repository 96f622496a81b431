"""Embedding whitening by contour integration (FEAST).

An entry c becomes the whole number x = floor(64 c) + 1,000,000. The fit list holds each
distinct x-vector once; it is read by tasks that send one sum, and one centred product, of
each dimension. The covariance, a square of the dimensions and no more, is taken apart on the
driver: inertia counts of shifted matrices bound intervals that hold the greatest eigenvalues,
a quadrature of complex shifted solves around each interval projects random vectors onto its
eigenvectors, Rayleigh-Ritz extracts them, and an interval is done when it has as many pairs
as its inertia says. All rows are then projected by tasks.

Vectors that are null or hold a null or non-finite entry are dropped; others must be of one
length (else ValueError). Repeated rows and ids count once in the fit list and are all
returned, null ids too. Equal eigenvalues may come in any order, and their components are any
orthonormal basis. Components without variance (rank) are not returned, so one distinct
vector or an empty table gives no rows. Entries beyond 2**56, and deviations beyond a long,
raise OverflowError. Other columns are not read, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import bounded_batches, staged

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Eigenvalues of an interval, where gaps allow it.
PER_INTERVAL = 8
#: Nodes of the quadrature on half a contour; the other half is their conjugates.
NODES = 12
#: Residuals, and gaps between eigenvalues, relative to the matrix.
TOLERANCE = 1e-13
#: Variances up to this share of the trace are rounding.
NO_VARIANCE = 1e-12
ROUNDS = 30

_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


# Whole vectors --------------------------------------------------------------------------


def whole(column: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Which rows of a list column count, and floor(64 c) of each of those as bytes.

    All bytes of a row have the least width that holds its entries, which is named by the first
    byte: equal vectors are equal bytes, and entries of ordinary embeddings take a byte each.
    """
    offsets = np.asarray(column.offsets).astype(np.int64)
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    sums = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    rows = np.flatnonzero((sums[offsets[1:]] == sums[offsets[:-1]]) & np.asarray(column.is_valid()))
    with np.errstate(invalid="ignore"):
        scaled = np.floor(SCALE * values)
    out = []
    for a, b in zip(offsets[rows].tolist(), offsets[rows + 1].tolist(), strict=True):
        row = scaled[a:b]
        most = max(row.max(), -row.min()) if b > a else 0
        if most >= 2.0**62:
            raise OverflowError(f"an entry of {most / SCALE:g} is too large")
        width = next(i for i, w in enumerate(_WIDTHS) if most <= np.iinfo(w).max)
        out.append(bytes([width]) + row.astype(_WIDTHS[width]).tobytes())
    return rows, out


def vectors(codes: list[bytes]) -> np.ndarray:
    """The x-vectors (rows, dimensions) of some codes."""
    sizes = {(len(c) - 1) >> c[0] for c in codes}
    if len(sizes) > 1:
        raise ValueError(f"vectors of {min(sizes)} to {max(sizes)} values")
    if not codes:
        return np.zeros((0, 0), dtype=np.int64)
    return np.stack([np.frombuffer(c, dtype=_WIDTHS[c[0]], offset=1).astype(np.int64) for c in codes]) + OFFSET


def coded(df: DataFrame, vector: str, vec_id: str | None = None) -> DataFrame:
    """(id, code) of the rows that count; without ``vec_id`` the ids are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, codes = whole(batch.column("vector"))
            ids = batch.column("id").take(pa.array(rows))
            yield pa.RecordBatch.from_pydict({"id": ids, "code": pa.array(codes, pa.binary())})

    own = F.col(vec_id) if vec_id else F.lit(None)
    rows = df.select(own.cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return bounded_batches(rows.where(F.col("vector").isNotNull())).mapInArrow(run, "id long, code binary")


def _summed(fit: DataFrame, per_batch) -> np.ndarray | None:
    """The sum over all batches of a matrix that ``per_batch`` makes of x-vectors.

    Each task adds up its own batches and sends the matrix by rows; equal rows of all tasks
    meet in one place and are added in the order of the tasks' numbers.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                part = per_batch(vectors(batch.column("code").to_pylist()))
                if total is not None and total.shape != part.shape:
                    raise ValueError("vectors of different lengths")
                total = part if total is None else total + part
        if total is not None:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array(np.arange(len(total)), pa.int32()),
                    "task": pa.array(np.full(len(total), task), pa.int32()),
                    "body": pa.array([r.tobytes() for r in total], pa.binary()),
                    "kind": pa.array([total.dtype.str] * len(total)),
                }
            )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        kind = None
        for batch in batches:
            for row in batch.to_pylist():
                kind, at = row["kind"], row["row"]
                own = np.frombuffer(row["body"], dtype=kind)
                if at in sums and len(sums[at]) != len(own):
                    raise ValueError("vectors of different lengths")
                sums[at] = sums[at] + own if at in sums else own
        if sums:
            bodies = pa.array([r.tobytes() for r in sums.values()], pa.binary())
            yield pa.RecordBatch.from_pydict(
                {"row": pa.array(list(sums), pa.int32()), "body": bodies, "kind": pa.array([kind] * len(sums))}
            )

    parts = bounded_batches(fit).mapInArrow(partial, "row int, task int, body binary, kind string")
    by_row = parts.repartition("row").sortWithinPartitions("row", "task")
    rows = by_row.mapInArrow(added, "row int, body binary, kind string").collect()  # as many as dimensions
    if not rows:
        return None
    rows.sort(key=lambda r: r.row)
    if len({len(r.body) for r in rows}) > 1:
        raise ValueError("vectors of different lengths")
    return np.stack([np.frombuffer(r.body, dtype=r.kind) for r in rows])


# Eigenvalues of a bounded symmetric matrix -----------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and side of the tridiagonal matrix that reflections turn a symmetric one into."""
    a = matrix.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if size == 0.0:
            continue
        x[0] += size if x[0] >= 0 else -size
        v = x / np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = a[k, k + 1 :] = 0.0
        a[k + 1, k] = a[k, k + 1] = -size if x[0] > 0 else size
    return np.diag(a).copy(), np.diag(a, 1).copy()


class Inertia:
    """Counts of eigenvalues from a shift on, by the signs of the pivots of the shifted matrix."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, self.side = tridiagonal(matrix)
        self.size = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is beyond it

    def from_on(self, shift: float) -> int:
        tiny = np.finfo(np.float64).tiny ** 0.5
        count, pivot = 0, 1.0
        for d, e in zip(self.diagonal, np.concatenate([[0.0], self.side]), strict=True):
            pivot = d - shift - e * e / pivot
            if pivot == 0.0:
                pivot = tiny
            count += pivot > 0
        return count

    def clear(self, shift: float) -> bool:
        """No eigenvalue is so near to the shift that rounding might put it on either side."""
        gap = 64 * TOLERANCE * self.size
        return self.from_on(shift - gap) == self.from_on(shift + gap)


def intervals(inertia: Inertia, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) of intervals, from the top, that hold the ``wanted`` greatest at least."""
    n = len(inertia.diagonal)
    wanted = min(wanted, n)
    bottom, top, out = -1.01 * inertia.size, 1.01 * inertia.size, []
    narrow = 256 * TOLERANCE * inertia.size
    low = bottom
    while top - low > 0.01 * inertia.size:  # down to just above the greatest
        middle = (low + top) / 2
        low, top = (middle, top) if inertia.from_on(middle) else (low, middle)

    def cut(low: float, high: float, below: int, above: int) -> float | None:
        """A shift free of eigenvalues, with more than ``above`` and up to ``below`` from it on."""
        while high - low > narrow:
            middle = (low + high) / 2
            count = inertia.from_on(middle)
            if count <= above:
                high = middle
            elif count > below:
                low = middle
            else:
                # Anywhere else between the two that has no eigenvalue near.
                for share in (0.5, 0.37, 0.63, 0.23, 0.81):
                    shift = low + share * (high - low)
                    if above < inertia.from_on(shift) <= below and inertia.clear(shift):
                        return shift
                low = middle
        return None

    have, high = 0, top
    while have < wanted:
        shift = cut(bottom, high, have + PER_INTERVAL, have)
        if shift is None:  # more equal eigenvalues than that, or none parted from the next
            shift = cut(bottom, high, n, have)
        if shift is None:
            shift = bottom
        count = inertia.from_on(shift)
        out.append((shift, high, count - have))
        have, high = count, shift
    return out


def project(matrix: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """The block's part in the eigenvectors of an interval: a quadrature around it."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for x, w in zip(nodes, weights, strict=True):
        turn = np.exp(0.5j * np.pi * (1 - x))  # the upper half; the lower half adds its conjugate
        shifted = (centre + radius * turn) * np.eye(len(matrix)) - matrix
        out += 0.5 * w * (radius * turn * np.linalg.solve(shifted, block.astype(np.complex128))).real
    return out


def interval_pairs(matrix: np.ndarray, low: float, high: float, count: int, size: float) -> tuple[np.ndarray, np.ndarray]:
    """All ``count`` eigenpairs of an interval; fails if the inertia is not met."""
    n = len(matrix)
    width = min(n, max(count + 4, -(-3 * count // 2)))
    rng = np.random.default_rng(17)
    block = rng.standard_normal((n, width))
    goal, before = 8 * np.finfo(np.float64).eps * size * n**0.5, np.inf
    for _ in range(ROUNDS):
        basis, _ = np.linalg.qr(project(matrix, low, high, block))
        values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turn
        inside = (values >= low) & (values < high)
        worst = np.linalg.norm(matrix @ block - block * values, axis=0)[inside].max(initial=0.0)
        # Done at the rounding of doubles, or near it when another round doesn't help.
        if inside.sum() == count and (worst <= goal or before / 2 < worst <= TOLERANCE * size * n**0.5):
            return values[inside], block[:, inside]
        if inside.sum() > count or worst > before / 2:
            # Vectors that are no eigenvectors yet, or too near to others: more room parts them.
            width = min(n, width + count)
            block = np.concatenate([block, rng.standard_normal((n, width - block.shape[1]))], axis=1)
        before = worst
    raise ArithmeticError(f"{int(inside.sum())} of {count} eigenvalues between {low:g} and {high:g} were found")


def greatest(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues, falling, and their orthonormal eigenvectors as columns."""
    n = len(matrix)
    if not n or not np.abs(matrix).max():
        return np.zeros(0), np.zeros((n, 0))
    inertia = Inertia(matrix)
    found = [interval_pairs(matrix, low, high, count, inertia.size) for low, high, count in intervals(inertia, wanted)]
    # Pairs of different intervals are orthogonal but for rounding; one last extraction settles it.
    basis, _ = np.linalg.qr(np.concatenate([v for _, v in found], axis=1))
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], (basis @ turn)[:, order]


# Fitting and applying --------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """Sums of the ``n`` vectors of the fit list, its greatest components, and how well they whiten it."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.distance(x) / self.n

    def distance(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        if float(np.abs(x).max(initial=0)) * self.n >= 2.0**62:
            raise OverflowError("n times an entry is beyond a long")
        return self.n * x - self.sums

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        gap = self.distance(x)
        if x.size and float(np.abs(gap).max()) ** 2 * x.shape[1] < 2.0**62:
            return (gap * gap).sum(axis=1)
        exact = [sum(int(g) * int(g) for g in row) for row in gap]
        if exact and max(exact) >= 2**63:
            raise OverflowError("a deviation is beyond a long")
        return np.array(exact, dtype=np.int64)


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fits on each distinct vector of ``df`` once."""
    distinct = staged(coded(df, vector).select("code").distinct(), "fit-list")

    def sums(x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.full((1, x.shape[1]), len(x)), x.sum(axis=0)[None]]).T  # a row for each dimension

    total = _summed(distinct, sums)
    if total is None:
        return Whitening(0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    bare = Whitening(int(total[0, 0]), total[:, 1].copy(), np.zeros(0), np.zeros((len(total), 0)), 0.0, 0.0)

    def squares(x: np.ndarray) -> np.ndarray:
        centred = bare.centred(x)
        return centred.T @ centred

    products = _summed(distinct, squares)
    covariance = (products + products.T) / (2.0 * bare.n)
    trace = float(np.trace(covariance))
    values, vectors_ = greatest(covariance, components)
    real = values > NO_VARIANCE * trace
    model = Whitening(bare.n, bare.sums, values[real], vectors_[:, real], trace, 0.0)
    if not real.any():
        return model

    def moments(x: np.ndarray) -> np.ndarray:
        z = model.apply(x)
        return np.concatenate([z.T @ z, z.sum(axis=0)[None]])

    found = _summed(distinct, moments)
    mean = found[-1] / model.n
    error = np.abs(found[:-1] / model.n - np.outer(mean, mean) - np.eye(len(mean))).max()
    return Whitening(model.n, model.sums, model.values, model.components, trace, float(error))


def whiten(df: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not len(model.values):
                continue
            x = vectors(batch.column("code").to_pylist())
            z = model.apply(x)
            lists = pa.ListArray.from_arrays(np.arange(0, z.size + 1, z.shape[1], dtype=np.int32), z.ravel())
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "deviation": pa.array(model.deviation(x), pa.int64()), "z": lists}
            )

    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    rows = bounded_batches(coded(df, vector, vec_id)).mapInArrow(run, "id long, deviation long, z array<double>")
    return rows.select("id", "deviation", F.posexplode("z").alias("place", "whitened")).select(
        F.col("id").alias("vec_id"),
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
