"""Whitening of embeddings: eigenvectors of an exact covariance, first in single precision, then refined by matrix products.

Entries become whole numbers, so every sum over rows is exact.  Rows are centred by the whole number next to the mean before they are multiplied; what
is left of the mean is taken off afterwards, exactly.  Tasks send sums of a few numbers a dimension or a pair of dimensions, which Spark adds up by
key: the driver gets a matrix of the dimension, whatever the number of rows.

The refinement is that of Ogita and Aishima: with eigenvectors X of A so far, R = I - X'X and S = X'AX give the correction E, and X becomes
X + XE; each step about doubles the correct digits.  It runs in extended precision.  For eigenvalues too close for a step to part them, the
columns are first made orthonormal, then a small eigenproblem within their span, shifted by their middle, turns them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.llm.arrays import releasing

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Entries may be so large in whole numbers; products of their halves are exact in double precision.
MOST = 1 << 31
_HALF = 1 << 16
_ROWS = 1 << 12
High = np.longdouble


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has no null, NaN or infinite entry."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return rows.where(F.col(vector).isNotNull() & fine)


def _blocks(column: pa.Array, dim: int | None, scale: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, x - OFFSET as int64) of blocks of rows; shorter vectors are filled up with entries of 0."""
    column = column.cast(pa.large_list(pa.float64()))
    for a in range(0, len(column), _ROWS):
        part = column.slice(a, _ROWS)
        lengths = part.value_lengths().to_numpy(zero_copy_only=False)
        out = np.zeros((len(part), int(lengths.max(initial=0)) if dim is None else dim))
        row = np.repeat(np.arange(len(part)), lengths)
        out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = part.flatten().to_numpy()
        x = np.floor(out * scale)
        if np.abs(x).max(initial=0.0) >= MOST:
            raise ValueError(f"an entry of a vector is beyond {MOST // scale}")
        yield a, x.astype(np.int64)


def _sums(scale: int):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(0, np.int64)
        for batch in batches:
            for _, x in _blocks(batch.column(0), None, scale):
                wide = np.zeros(max(len(total), x.shape[1]), np.int64)
                wide[: len(total)] += total
                wide[: x.shape[1]] += x.sum(axis=0)
                n, total = n + len(x), wide
        if n:  # the row -1 counts
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total), dtype=np.int32)), pa.array(np.r_[n, total])], ["i", "s"])

    return run


def _products(dim: int, centre: np.ndarray, scale: int):
    """Sums of products of centred rows, as products of high and low halves: every partial sum is exact."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = np.triu_indices(dim)
        total = np.zeros((3, len(i)), np.int64)
        n = 0
        for batch in batches:
            for _, x in _blocks(batch.column(0), dim, scale):
                x = x - centre
                high, low = (x // _HALF).astype(float), (x % _HALF).astype(float)
                cross = high.T @ low
                for k, part in enumerate((high.T @ high, cross + cross.T, low.T @ low)):
                    total[k] += part[i, j].astype(np.int64)
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *(pa.array(t) for t in total)], ["i", "j", "hh", "hl", "ll"])

    return run


class Fit:
    """n, the whole sums S of x - OFFSET per dimension, and n^2 times the covariance as Python numbers of any size."""

    def __init__(self, n: int, sums: list[int], scaled: np.ndarray):
        self.n, self.sums, self.scaled = n, sums, scaled

    @property
    def dim(self) -> int:
        return len(self.sums)

    def covariance(self) -> np.ndarray:
        """The covariance in extended precision: the nearest double and what it lacks."""
        square = self.n * self.n or 1
        out = np.zeros((self.dim, self.dim), High)
        for a in range(self.dim):
            for b in range(a, self.dim):
                near = self.scaled[a, b] / square  # of whole numbers: correctly rounded
                top, bottom = near.as_integer_ratio()
                out[a, b] = out[b, a] = High(near) + High((self.scaled[a, b] * bottom - top * square) / (square * bottom))
        return out


def fit(rows: DataFrame, vector: str, scale: int = SCALE) -> Fit:
    """Sums and centred products of all `rows` (see `usable`); the dimension is that of the longest vector."""
    vectors = rows.select(vector)
    sums = {r["i"]: int(r["s"]) for r in vectors.mapInArrow(_sums(scale), "i int, s bigint").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    n = sums.pop(-1, 0)
    s = [sums[k] for k in range(len(sums))]
    centre = [(2 * v + n) // (2 * n) for v in s] if n else []
    exact = np.zeros((len(s), len(s)), object)
    if s:
        whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
        found = vectors.mapInArrow(_products(len(s), np.array(centre, np.int64), scale), "i int, j int, hh bigint, hl bigint, ll bigint").groupBy("i", "j").agg(whole("hh"), whole("hl"), whole("ll"))
        rest = [v - n * c for v, c in zip(s, centre, strict=True)]
        for r in found.collect():  # a row per pair of dimensions
            i, j = r["i"], r["j"]
            gram = int(r["hh"]) * _HALF * _HALF + int(r["hl"]) * _HALF + int(r["ll"])
            exact[i, j] = exact[j, i] = n * gram - rest[i] * rest[j]
    return Fit(n, s, exact)


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of neighbouring values (falling) that lie within `gap` of the next one."""
    cut = np.flatnonzero(np.abs(np.diff(values)) > gap) + 1
    return np.split(np.arange(len(values)), cut)


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Newton steps to the nearest orthonormal columns."""
    for _ in range(6):
        r = np.eye(x.shape[1], dtype=High) - x.T @ x
        x = x + x @ r / 2
        if np.abs(r).max(initial=0) < 1e-19 * x.shape[0]:
            break
    return x


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One refinement: new eigenvectors, the eigenvalues of the old ones, and the distance below which eigenvalues weren't parted."""
    r = np.eye(len(a), dtype=High) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    norm = lambda m: np.linalg.norm(m.astype(float), 2)
    close = 2 * (norm(s - np.diag(values)) + norm(np.diag(values)) * norm(r))
    apart = values[None, :] - values[:, None]
    wide = np.abs(apart) > close
    e = np.where(wide, (s + values[None, :] * r) / np.where(wide, apart, 1), r / 2)
    return x + x @ e, values, float(close)


def _turn(a: np.ndarray, x: np.ndarray, gap: float) -> np.ndarray:
    """Columns of close eigenvalues turned within their span by a small eigenproblem, shifted by their middle so that its digits go to their differences."""
    x = _orthonormal(x)
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values)
    x, values = x[:, order], values[order]
    for own in _clusters(values, gap):
        if len(own) > 1:
            middle = values[own].mean()
            inner = x[:, own].T @ (a @ x[:, own] - middle * x[:, own])
            inner = (inner + inner.T) / 2
            size = np.abs(inner).max()
            if size > 0:
                _, w = np.linalg.eigh((inner / size).astype(float))
                x[:, own] = _orthonormal(x[:, own] @ w.astype(High))
    return x


def eigen(a: np.ndarray, most_steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns), falling, of a symmetric matrix in extended precision; both come in extended precision.

    The start is single-precision.  Steps go on until the largest off-diagonal entry of X'AX no longer falls; whenever a step leaves close
    eigenvalues unparted, those columns are turned by a sub-problem before the next.
    """
    d = len(a)
    if not d:
        return np.zeros(0, High), np.zeros((0, 0), High)
    size = np.abs(a).max()
    if size == 0:
        return np.zeros(d, High), np.eye(d, dtype=High)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(High)[:, ::-1]
    best, kept = np.inf, x
    for _ in range(most_steps):
        x, values, close = _step(a, x)
        if any(len(c) > 1 for c in _clusters(-np.sort(-values), close)):
            x = _turn(a, x, close)
        x = _orthonormal(x)
        s = x.T @ (a @ x)
        off = float(np.abs(s - np.diag(np.diag(s))).max())
        if off >= best / 2:
            break
        best, kept = off, x
    values = np.einsum("ij,ij->j", kept, a @ kept)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, kept[:, order] / np.sqrt((kept * kept).sum(axis=0))[order]


def _projector(found: Fit, vectors: np.ndarray, values: np.ndarray):
    """Function of a block of x - OFFSET: (whitened in double precision, n x - S)."""
    n = found.n
    centre, remainder = (np.array(v, np.int64) for v in zip(*(divmod(s, n) for s in found.sums), strict=True))
    rest = remainder / n
    weights = np.where(values > 0, vectors / np.sqrt(np.where(values > 0, values, 1)), np.nan).astype(float)

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = x - centre
        return (x - rest) @ weights, n * x - remainder

    return project


def _moments(dim: int, project, scale: int):
    """Sums and sums of products of whitened rows, a row per pair of components and task."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = 0.0, 0.0
        for batch in batches:
            for _, x in _blocks(batch.column(0), dim, scale):
                w, _ = project(x)
                total, square = total + w.sum(axis=0), square + w.T @ w
        if np.ndim(total):
            i, j = np.indices(square.shape).reshape(2, -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i]), pa.array(square.ravel())], ["i", "j", "s", "p"])

    return run


def _deviation(centred: np.ndarray) -> np.ndarray:
    """Row sums of squares, exact; a sum beyond 64 bits raises."""
    if np.square(centred.astype(float)).sum(axis=1).max(initial=0.0) > 9.2e18:
        raise OverflowError("a deviation is beyond 64 bits")
    return np.square(centred).sum(axis=1)


def whiten(rows: DataFrame, key: str, vector: str, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of each usable row and each of the first `components` components.

    Rows with a null vector or a null or non-finite entry are left out; n counts the others, repeated rows each.  Shorter vectors count as filled up with
    zeros to the longest one's dimension; there are as many components as dimensions at most.  Entries beyond MOST / scale raise, as does a deviation beyond 64
    bits.  Components without variance (eigenvalue 0 to 16 digits of the largest) have a null `whitened`, count as explaining 0, and aren't part of
    `identity_error`.  Without usable rows there are no rows.  Other columns play no part.
    """
    good = usable(rows, vector)
    found = fit(good, vector, scale)
    field = rows.schema[key]
    schema = T.StructType([T.StructField(key, field.dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    if not found.n or not found.dim:
        return rows.sparkSession.createDataFrame([], schema)
    covariance = found.covariance()
    values, vectors = eigen(covariance)
    k = min(components, found.dim)
    trace = np.trace(covariance)
    values = np.where(values[:k] > values[0] * 1e-16, values[:k], 0)
    project = _projector(found, vectors[:, :k], values)
    moments = good.select(vector).mapInArrow(_moments(found.dim, project, scale), "i int, j int, s double, p double").groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("p").alias("p")).collect()
    mean, square = np.zeros(k), np.zeros((k, k))
    for r in moments:  # components squared
        mean[r["i"]], square[r["i"], r["j"]] = r["s"] / found.n, r["p"] / found.n
    live = np.flatnonzero(values > 0)
    error = float(np.abs((square - np.outer(mean, mean) - np.eye(k))[np.ix_(live, live)]).max(initial=0.0))
    explained = (values / trace).astype(float) if trace > 0 else np.zeros(k)
    n, dim = found.n, found.dim

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, x in _blocks(batch.column(1), dim, scale):
                w, centred = project(x)
                rows_at = np.repeat(np.arange(a, a + len(x)), k)
                flat = w.ravel()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows_at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(rows_at), n)), pa.array(np.repeat(_deviation(centred), k)),
                    pa.array(flat, mask=np.isnan(flat)), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(rows_at), error)),
                ], names=schema.names)

    return good.select(key, vector).mapInArrow(run, schema)
