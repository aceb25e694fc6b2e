"""Whitening of embeddings from polarised variances.

Entries become integers (``floor(scale * c) + offset``), so every statistic is
exact.  For each dimension, and for the sum of each pair of dimensions, the
squared centred values are added up: that is one variance each, and

    2 cov(i, j) = var(x_i + x_j) - var(x_i) - var(x_j)

gives every cross-covariance from variances alone.  Values are centred before
they are squared, at the integer m nearest to the mean; the rest r = S - n*m
of each sum is settled exactly afterwards (n * sum(z**2) - r**2 over n**2), so
no digits cancel however far the values lie from zero and whatever n is.  The
matrix is assembled in Python integers, divided once, and given to ``eigh``.

Scale: three narrow passes (sums, squares, a check) and the projecting pass;
each task hands on d * (d + 1) / 2 partial sums, which Spark adds by (i, j).
The driver receives that many numbers, whatever the number of rows, and at
most ``MAX_DIMENSIONS`` dimensions are taken.  No vector is shuffled or
collected.

Defined results: rows with a null or empty vector or with a null or
non-finite entry drop, and so do vectors of another length than the commonest
(the longer of two as common); a null vec_id stays null; repeated rows count
each; columns other than those named are not read.  Entries of 2**53/scale and
more in size count as that bound.  Only components with an eigenvalue above
rounding error are returned (fewer than asked for where vectors are few or
constant in some direction, none for a single row or an empty table); of equal
eigenvalues any order; the largest entry of a component is positive.
``deviation`` is null where it does not fit a long.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetwright.llm.common import each
from sheetwright.llm.vectors import blocks, commonest_length, matrix, usable

MAX_DIMENSIONS = 4096
SUMS = "i int, j int, total decimal(38,0)"
_LIMIT = 2.0**53
_WIDE = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``vectors`` has a unit component in each column, numbered by falling ``values``."""

    n: int
    scale: float
    offset: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    @property
    def nearest(self) -> list[int]:
        """The integer nearest to the mean of each dimension."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    def shifted(self, entries: np.ndarray) -> np.ndarray:
        """x - m of raw entries, exactly."""
        return integers(entries, self.scale, self.offset) - np.array(self.nearest, np.int64)

    def whitened(self, shifted: np.ndarray) -> np.ndarray:
        """Rows of components, from x - m."""
        rest = np.array([(s - self.n * m) / self.n for s, m in zip(self.sums, self.nearest)])
        return (shifted - rest) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, shifted: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)**2, exactly."""
        rest = [s - self.n * m for s, m in zip(self.sums, self.nearest)]
        most = self.n * int(np.abs(shifted).max(initial=0)) + self.n
        kind = np.int64 if most * most * self.dimensions < 1 << 63 else object
        centred = shifted.astype(kind) * self.n - np.array(rest, kind)
        found = (centred * centred).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in found]


def integers(entries: np.ndarray, scale: float, offset: int) -> np.ndarray:
    """``floor(scale * entry) + offset`` as 64-bit integers."""
    return np.clip(np.floor(entries * scale), -_LIMIT, _LIMIT).astype(np.int64) + offset


def vectors_of(df: DataFrame, column: str, *keep) -> DataFrame:
    """The rows that count: columns ``keep`` and ``_v``, the vector as doubles."""
    vector = F.col(f"`{column}`").cast("array<double>")
    return df.select(*keep, vector.alias("_v")).where(usable(F.col("_v")))


class Sums:
    """Exact running sums of one task: 64-bit while they surely fit, handed on and begun again otherwise."""

    def __init__(self, index: list[tuple[int, int]]):
        self.i, self.j = (pa.array([k[x] for k in index], pa.int32()) for x in (0, 1))
        self.total, self.bound = np.zeros(len(index), np.int64), 0

    def add(self, values: np.ndarray, bound: int):
        """Add ``values`` (none above ``bound`` in size); yields a batch of earlier sums if these may overflow."""
        if bound >= 1 << 62:
            yield self.batch(pa.array([Decimal(int(v)) for v in values], _WIDE))
            return
        if self.bound + bound >= 1 << 62:
            yield from self.rest()
        self.total += values.astype(np.int64)
        self.bound += bound

    def rest(self):
        if self.bound:
            yield self.batch(pa.array(self.total, pa.int64()).cast(_WIDE))
        self.total, self.bound = np.zeros_like(self.total), 0

    def batch(self, totals: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([self.i, self.j, totals], names=["i", "j", "total"])


def added(partial: DataFrame) -> dict[tuple[int, int], int]:
    """Sums over all tasks, by index pair."""
    found = partial.groupBy("i", "j").agg(F.sum("total").alias("total")).toArrow()
    return {(i, j): int(t) for i, j, t in zip(*(found.column(c).to_pylist() for c in ("i", "j", "total")))}


def dimension_sums(rows: DataFrame, width: int, scale: float, offset: int) -> DataFrame:
    """Partial sums of x by dimension (i, -1), and the number of rows (-1, -1)."""

    def run(batches):
        sums = Sums([(-1, -1), *((i, -1) for i in range(width))])
        for batch in each(batches):
            entries = matrix(batch.column("_v"), width)
            for a, b in blocks(len(entries), width):
                x = integers(entries[a:b], scale, offset)
                most = (b - a) * max(1, int(np.abs(x).max()))
                kind = np.int64 if most < 1 << 62 else object
                yield from sums.add(np.concatenate(([b - a], x.astype(kind).sum(axis=0))), most)
        yield from sums.rest()

    return rows.mapInArrow(run, SUMS)


def square_sums(rows: DataFrame, width: int, scale: float, offset: int, nearest: list[int]) -> DataFrame:
    """Partial sums of z_i**2 as (i, i), and of (z_i + z_j)**2 as (i, j) for i < j, where z = x - nearest."""

    def run(batches):
        sums = Sums([(i, j) for i in range(width) for j in range(i, width)])
        centre = np.array(nearest, np.int64)
        for batch in each(batches):
            entries = matrix(batch.column("_v"), width)
            for a, b in blocks(len(entries), width):
                z = integers(entries[a:b], scale, offset) - centre
                most = (b - a) * (2 * max(1, int(np.abs(z).max()))) ** 2
                z = z.astype(np.int64 if most < 1 << 62 else object)
                squares = []
                for i in range(width):
                    pair = z[:, i:] + z[:, i : i + 1]
                    pair[:, 0] = z[:, i]  # the dimension itself
                    squares.append((pair * pair).sum(axis=0))
                yield from sums.add(np.concatenate(squares), most)
        yield from sums.rest()

    return rows.mapInArrow(run, SUMS)


def covariance(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix from sums of squares of z and the sums ``rest`` of z, by differences of variances."""
    d = len(rest)
    own = [n * squares[i, i] - rest[i] ** 2 for i in range(d)]  # n**2 times the variance
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = own[i] / n**2
        for j in range(i + 1, d):
            of_sum = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (of_sum - own[i] - own[j]) / (2 * n**2)
    return out


def fit(rows: DataFrame, components: int = 32, scale: float = 64.0, offset: int = 1_000_000) -> Whitening | None:
    """The whitening of ``rows`` (as ``vectors_of`` gives them); None without rows."""
    width = commonest_length(rows, "_v")
    if width > MAX_DIMENSIONS:
        raise ValueError(f"{width} dimensions; at most {MAX_DIMENSIONS} are taken")
    if not width:
        return None
    rows = rows.where(F.size("_v") == width)
    sums = added(dimension_sums(rows, width, scale, offset))
    n, totals = sums[-1, -1], [sums[i, -1] for i in range(width)]
    nearest = [(2 * s + n) // (2 * n) for s in totals]
    squares = added(square_sums(rows, width, scale, offset, nearest))
    matrix_ = covariance(n, [s - n * m for s, m in zip(totals, nearest)], squares)
    values, vectors = np.linalg.eigh(matrix_)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > max(values[0], 0) * width * np.finfo(float).eps * 4
    keep = int(min(components, real.sum()))
    values, vectors = values[:keep], vectors[:, :keep]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)]
    return Whitening(n, scale, offset, tuple(totals), values, vectors * np.sign(largest), float(np.trace(matrix_)))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened rows - identity), measured over all rows."""
    k, width = len(model.values), model.dimensions
    upper = [(i, j) for i in range(-1, k) for j in range(max(i, 0), k)]

    def run(batches):
        whole = np.zeros((k + 1, k + 1))  # the first row has the sums
        for batch in each(batches):
            entries = matrix(batch.column("_v"), width)
            for a, b in blocks(len(entries), width):
                w = model.whitened(model.shifted(entries[a:b]))
                w = np.concatenate((np.ones((b - a, 1)), w), axis=1)
                whole += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array([u[0] for u in upper], pa.int32()), pa.array([u[1] for u in upper], pa.int32()),
             pa.array([whole[i + 1, j + 1] for i, j in upper], pa.float64())], names=["i", "j", "total"])

    found = rows.where(F.size("_v") == width).mapInArrow(run, "i int, j int, total double")
    total = {(r["i"], r["j"]): r["total"] / model.n for r in found.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    return max((abs(total[i, j] - total[-1, i] * total[-1, j] - (i == j)) for i, j in upper if i >= 0), default=0.0)


def whitened(df: DataFrame, model: Whitening, column: str = "embedding", name: str = "whitened") -> DataFrame:
    """The rows of ``df`` that count, with ``name``: their components (array of double); a column of that name is replaced."""
    width = model.dimensions
    kept = [c for c in df.columns if c.lower() != name.lower()]
    rows = vectors_of(df, column, *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(kept)]).where(F.size("_v") == width)
    own = [f"_{i}" for i in range(len(kept))]
    schema = rows.select(*own, F.col("_v").alias("_w")).schema

    def run(batches):
        for batch in each(batches):
            entries = matrix(batch.column("_v"), width)
            for a, b in blocks(len(entries), width):
                w = model.whitened(model.shifted(entries[a:b]))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in own), lists], names=[*own, "_w"])

    return rows.mapInArrow(run, schema).select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], F.col("_w").alias(name))


def report(embeddings: DataFrame, components: int = 32) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error): one per row that counts and component."""
    rows = vectors_of(embeddings, "embedding", F.col("vec_id").cast("bigint").alias("vec_id"))
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    model = fit(rows, components)
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame([], schema)
    error, width, k = identity_error(rows, model), model.dimensions, len(model.values)
    explained = model.values / model.trace

    def run(batches):
        for batch in each(batches):
            entries = matrix(batch.column("_v"), width)
            for a, b in blocks(len(entries), width + k):
                shifted = model.shifted(entries[a:b])
                n = (b - a) * k
                place = pa.array(np.repeat(np.arange(b - a), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(a, b - a).take(place), pa.array(np.tile(np.arange(1, k + 1), b - a), pa.int32()),
                     pa.array(np.full(n, model.n), pa.int64()), pa.array(model.deviation(shifted), pa.int64()).take(place),
                     pa.array(model.whitened(shifted).ravel()), pa.array(np.tile(explained, b - a)), pa.array(np.full(n, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.size("_v") == width).mapInArrow(run, schema)
