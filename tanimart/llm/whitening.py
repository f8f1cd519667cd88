"""Whitening of embeddings by shifted CholeskyQR.

An entry c becomes the integer x = floor(64 * c) + 1000000.  The fit list holds
each distinct x vector once; it is a written table (one to a few bytes an
entry), so a vector that half of all rows share counts, and moves, once.

The centred fit list A (rows x - mean) is orthogonalised by passes over that
table.  A pass adds up the Gram matrix of the rows as they are now; the driver
(a matrix of dimension x dimension, whatever the number of rows) takes its
Cholesky factor R and the next pass solves every row against R's triangle.
The first Gram matrix is scaled to a unit diagonal and shifted, so that its
factor exists however badly conditioned A is; the following ones need a shift
only where A lacks rank.  When the rows are orthonormal, A = Q R with R the
product of the factors, and the singular values and right vectors of R are
those of A: the components are found without squaring A's condition number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import save

#: x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Entries whose grid value is this far from OFFSET count as not finite.
LARGEST = float(1 << 50)
#: Entries of a slice (rows times dimension).
SLICE = 1 << 20
#: Partial Gram rows of one dimension that meet in a task at first.
SALTS = 64
#: Passes that orthogonalise at most, and the distance from the identity at
#: which the rows count as orthonormal.
PASSES, CLOSE = 5, 1e-11
_WIDTHS = (1, 2, 4, 8)


def grid(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x - OFFSET as a matrix) for each length of vector in a column;
    nulls and vectors with a null, non-finite or too large entry are left out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    start = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
    for dims in np.unique(size[size > 0]).tolist():
        own = np.flatnonzero(size == dims)
        step = max(1, SLICE // dims)
        for at in range(0, len(own), step):
            rows = own[at:at + step]
            x = np.floor(flat[start[rows][:, None] + np.arange(dims)] * SCALE)
            good = (np.abs(x) < LARGEST).all(axis=1)  # false for NaN too
            yield rows[good], x[good].astype(np.int64)


def packed(x: np.ndarray) -> list[bytes]:
    """Each row as bytes: its width (least that holds it), then its integers."""
    out: list[bytes] = [b""] * len(x)
    most = np.abs(x).max(axis=1) if len(x) else np.zeros(0, np.int64)
    width = np.select([most < 1 << 7, most < 1 << 15, most < 1 << 31], _WIDTHS[:3], 8)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        data, n, head = x[rows].astype(f"<i{w}").tobytes(), w * x.shape[1], bytes([w])
        for k, r in enumerate(rows.tolist()):
            out[r] = head + data[k * n:(k + 1) * n]
    return out


def unpacked(column: pa.BinaryArray, dims: int) -> Iterator[np.ndarray]:
    """The rows of packed() again, in slices (their order does not matter)."""
    data = [b for b in column.to_pylist() if b is not None]
    for w in _WIDTHS:
        own = [b for b in data if b[0] == w]
        step = max(1, SLICE // max(1, dims))
        for at in range(0, len(own), step):
            part = own[at:at + step]
            yield np.frombuffer(b"".join(b[1:] for b in part), dtype=f"<i{w}").reshape(len(part), dims).astype(np.int64)


@dataclass
class Whitening:
    """A fitted whitening: ``components`` has one unit eigenvector a column,
    by falling eigenvalue; directions without variance are left out.

    ``base`` + ``rest`` / n is the mean of x - OFFSET, entry by entry, with
    integers ``base`` and 0 <= ``rest`` < n, so that rows are centred exactly."""

    dims: int
    n: int
    base: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.rest / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S)**2, exact."""
        y = x - self.base
        if self.dims * (self.n * (int(np.abs(y).max(initial=0)) + 1)) ** 2 < 1 << 63:
            y = self.n * y - self.rest
            return pa.array(np.einsum("ij,ij->i", y, y)).cast(pa.decimal128(38, 0))
        y = self.n * y.astype(object) - self.rest.astype(object)
        return pa.array([Decimal(int(v)) for v in (y * y).sum(axis=1)], pa.decimal128(38, 0))


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverses of upper triangular factors, one after another."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(rows.shape[1]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def fit_list(vectors: DataFrame, vec_col: str) -> DataFrame:
    """(dims, x): every distinct x vector once, packed."""
    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in grid(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(packed(x), pa.binary())], names=["dims", "x"])

    return vectors.select(F.col(vec_col)).mapInArrow(cells, "dims int, x binary").distinct()


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows of the fit list and the exact sums of x - OFFSET."""
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            for x in unpacked(batch.column(0), dims):
                n, high, low = n + len(x), high + (x >> 20).sum(axis=0), low + (x & 0xFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n] * dims, pa.int64()), pa.array(np.arange(dims, dtype=np.int32)), pa.array(high), pa.array(low)], names=["n", "j", "high", "low"])

    parts = fit.select("x").mapInArrow(add, "n long, j int, high long, low long")
    rows = parts.groupBy("j").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect()  # one row a dimension
    return rows[0].n, [(r.high << 20) + r.low for r in sorted(rows, key=lambda r: r.j)]


def _gram(fit: DataFrame, dims: int, width: int, turn: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Gram matrix (width x width) of the fit list's rows after ``turn``."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((width, width))
        for batch in batches:
            for x in unpacked(batch.column(0), dims):
                rows = turn(x)
                total += rows.T @ rows
        salt = TaskContext.get().partitionId() % SALTS
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array([salt] * width, pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "salt", "g"])

    def merge(group: pa.Table) -> pa.Table:
        rows = [np.frombuffer(b) for b in group.column("g").to_pylist()]
        out = {"i": [group.column("i")[0].as_py()], "salt": [-1], "g": [np.sum(rows, axis=0).tobytes()]}
        return pa.table(out, schema=pa.schema([("i", pa.int32()), ("salt", pa.int32()), ("g", pa.binary())]))

    kind = "i int, salt int, g binary"
    parts = fit.select("x").mapInArrow(add, kind)
    rows = parts.groupBy("i", "salt").applyInArrow(merge, kind).groupBy("i").applyInArrow(merge, kind).collect()  # width rows of width doubles
    return np.array([np.frombuffer(r.g) for r in sorted(rows, key=lambda r: r.i)])


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular R with R'R = gram (+ shift); the shift grows until it exists."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(4 * shift, 1e-14)


def fit(vectors: DataFrame, vec_col: str = "embedding", components: int = 16) -> Whitening | None:
    """Fit over every distinct x vector; None where no vector takes part.

    Vectors of the commonest length (among distinct ones; the shorter on a
    tie) take part, others do not."""
    table = save(fit_list(vectors, vec_col), "whiten-fit")
    kinds = table.groupBy("dims").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "dims").limit(1).collect()
    if not kinds:
        return None
    dims = kinds[0].dims
    table = table.where(F.col("dims") == dims)
    n, sums = _sums(table, dims)
    base = [s // n for s in sums]
    model = Whitening(dims, n, np.array(base, np.int64), np.array([s - n * b for s, b in zip(sums, base, strict=True)], np.int64), np.zeros((dims, 0)), np.zeros(0), 0.0)
    gram = _gram(table, dims, dims, model.centred)
    scale = np.sqrt(np.diag(gram))
    scale[scale == 0] = 1.0
    # what rounding may add to the Gram matrix of rows with unit columns
    factors = [_factor(gram / np.outer(scale, scale), 1.2e-15 * dims * (dims + 1 + np.log2(n + 1))) * scale]
    for _ in range(PASSES - 1):
        gram = _gram(table, dims, dims, lambda x, done=tuple(factors): solved(model.centred(x), list(done)))
        if np.abs(gram - np.eye(dims)).max() <= CLOSE:
            break
        factors.append(_factor(gram, 0.0))
    else:
        gram = _gram(table, dims, dims, lambda x, done=tuple(factors): solved(model.centred(x), list(done)))
    # what is left of the last Gram matrix (rank it lacks included) enters by its root
    value, vector = np.linalg.eigh(gram)
    r = (vector * np.sqrt(np.maximum(value, 0.0))) @ vector.T
    for f in reversed(factors):
        r = r @ f
    _, s, vt = np.linalg.svd(r)
    model.trace = float((s ** 2).sum() / n)
    rank = int((s > s[0] * dims * 1e-14).sum()) if s[0] > 0 else 0
    k = min(components, rank)
    sign = np.where(vt[np.arange(k), np.abs(vt[:k]).argmax(axis=1)] < 0, -1.0, 1.0) if k else np.ones(0)
    model.components, model.eigenvalues = (vt[:k] * sign[:, None]).T, s[:k] ** 2 / n
    if k:
        both = _gram(table, dims, k + 1, lambda x: np.column_stack([model.project(x), np.ones(len(x))])) / n
        model.identity_error = float(np.abs(both[:k, :k] - np.outer(both[:k, k], both[:k, k]) - np.eye(k)).max())
    return model


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vec_col: str = "embedding", model: Whitening | None = None) -> DataFrame:
    """Return (vec_id, component, n, deviation, whitened, explained,
    identity_error) for every row that takes part and every component.

    ``deviation`` is a decimal(38, 0).  Rows whose vector is null, empty, of
    another length than most, or holds a null, non-finite or too large entry
    (64 * |c| >= 2**50) give no rows.  Repeated rows and null ids give rows of
    their own.  Components without variance are left out: a table of equal
    vectors, or an empty one, gives none.  Other columns are not read.
    ``model``: a fit made before (default: fitted on ``vectors``).
    """
    model = fit(vectors, vec_col, components) if model is None else model
    kind = T.StructType([T.StructField("vec_id", vectors.schema[id_col].dataType)] + [T.StructField(c, t) for c, t in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.DecimalType(38, 0)), ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType()))])
    if model is None:
        return vectors.sparkSession.createDataFrame([], kind)
    k = min(components, len(model.eigenvalues))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, x in grid(batch.column(1)):
                if x.shape[1] != model.dims or not k or not len(own):
                    continue
                out = model.project(x)[:, :k]
                each = pa.array(np.repeat(np.arange(len(own)), k))
                m = len(own) * k
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(own)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(own))),
                    pa.array(np.full(m, model.n, np.int64)), model.deviation(x).take(each), pa.array(out.ravel()),
                    pa.array(np.tile(model.eigenvalues[:k] / model.trace, len(own))), pa.array(np.full(m, model.identity_error))], names=kind.names)

    return vectors.select(F.col(id_col), F.col(vec_col)).mapInArrow(rows, kind)
