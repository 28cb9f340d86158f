"""Whitened embeddings: principal components to double precision from a covariance summed over all rows.

The covariance is a sum of small products over the partitions; only its dims x dims entries reach the
driver. Its eigenvectors are first taken in float32. Each iteration then multiplies the covariance by the
vectors in extended precision and corrects all of them at once (Ogita and Aishima), which squares the
error. Vectors whose eigenvalues lie so close together that the correction cannot tell them apart are
turned by the eigenvectors of their own small problem, shifted by the cluster's mean and so solved on the
scale of its differences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A component with a smaller share of the largest eigenvalue counts as one without variance: whitened, its
#: rounding errors would be as large as its values.
FLAT = 1e-11


@dataclass(frozen=True)
class Grid:
    """Entries c become whole numbers: floor(scale * c) + shift."""

    scale: int = 64
    shift: int = 1_000_000

    def of(self, entries: np.ndarray) -> np.ndarray:
        return np.floor(self.scale * entries.astype(np.float64)).astype(np.int64) + self.shift


@dataclass(frozen=True)
class Fit:
    """n rows, sums per dimension, the mean as a whole part and a rest, the covariance, and its components.

    `vectors` has a unit eigenvector in each column, by falling eigenvalue; `values` and `explained` go with
    them. `error` is the largest entry of the covariance of the whitened rows minus the identity.
    """

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part of the mean is taken off exactly."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> pa.Array:
        """The sum of (n x - S)^2, exact; null where a long cannot hold it."""
        # Sums of longs are right modulo 2 ** 64, and so right where the true sum is below 2 ** 63.
        sums = np.array([(s + 2**63) % 2**64 - 2**63 for s in self.sums], np.int64)
        apart = np.int64(self.n) * x - sums
        about = ((self.n * self.centred(x)) ** 2).sum(axis=1)
        return pa.array((apart * apart).sum(axis=1), pa.int64(), mask=about >= 2.0**63 * (1 - 1e-9))


def eigenvectors(matrix: np.ndarray, iterations: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors of a symmetric matrix, to double precision.

    Within a cluster that stays equal to the last digits any orthonormal basis is right.
    """
    size = len(matrix)
    scale = np.abs(matrix).max(initial=0.0)
    if not scale:
        return np.zeros(size), np.eye(size)
    wide = (matrix / scale).astype(np.longdouble)
    wide = (wide + wide.T) / 2
    vectors = np.linalg.eigh(wide.astype(np.float32))[1].astype(np.longdouble)
    unit = np.eye(size, dtype=np.longdouble)
    last = np.inf
    for _ in range(iterations):
        rest = unit - vectors.T @ vectors
        seen = vectors.T @ (wide @ vectors)
        values = np.diag(seen) / (1 - np.diag(rest))
        off = seen - np.diag(values)
        # Closer than this, the correction would not be small.
        close = 2 * (np.sqrt((off * off).sum()) + np.sqrt((rest * rest).sum()))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= close
        with np.errstate(divide="ignore", invalid="ignore"):
            # Half of rest mends the lengths and angles; the other part only turns, so its rounding, which a
            # small gap amplifies, leaves them alone.
            turn = np.where(near, 0, (seen + (values[None, :] + values[:, None]) / 2 * rest) / gap)
        moved = float(np.abs(turn).max())
        vectors = vectors + vectors @ (rest / 2 + (turn - turn.T) / 2)
        clusters = _clusters(values, close)
        for some in clusters:
            vectors[:, some] = vectors[:, some] @ _inside(wide, vectors[:, some])
        if not clusters and np.abs(rest).max() < 1e-16 and moved >= last / 4:  # rounding is all that is left
            break
        last = moved
    vectors = vectors @ (3 * unit - vectors.T @ vectors) / 2
    values = (vectors * (wide @ vectors)).sum(axis=0) * scale
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, np.arange(size)] < 0, -1, 1)
    return values[order].astype(np.float64), vectors.astype(np.float64)


def _clusters(values: np.ndarray, close: float) -> list[np.ndarray]:
    """Places of eigenvalues that lie within `close` of the next one, two or more together."""
    order = np.argsort(values, kind="stable")
    edges = np.flatnonzero(np.diff(values[order]) > close) + 1
    return [some for some in np.split(order, edges) if len(some) > 1]


def _inside(wide: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A rotation of these vectors to the eigenvectors of the matrix inside their span."""
    # Orthonormal to extended precision: one Newton step, as they are nearly so.
    vectors = vectors @ (3 * np.eye(vectors.shape[1], dtype=np.longdouble) - vectors.T @ vectors) / 2
    small = vectors.T @ (wide @ vectors)
    small = small - np.eye(len(small), dtype=np.longdouble) * (np.trace(small) / len(small))
    scale = np.abs(small).max()
    if scale < 1e-18:
        return np.eye(len(small), dtype=np.longdouble)
    return np.linalg.eigh(((small + small.T) / (2 * scale)).astype(np.float64))[1].astype(np.longdouble)


def usable(rows: DataFrame, column: str) -> DataFrame:
    """The rows whose vector holds finite numbers only."""
    bad = "x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity')"
    return rows.where(F.expr(f"`{column}` IS NOT NULL AND NOT exists(`{column}`, {bad})"))


def _entries(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _products(rows: DataFrame, column: str, dims: int, project: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of p p^T over all rows, p being the projected vector of a row."""

    def partial(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in parts:
            if part.num_rows:
                p = project(_entries(part.column(0), dims))
                held = p.T @ p if held is None else held + p.T @ p
        if held is not None:
            yield pa.record_batch([pa.array(range(len(held)), pa.int32()), pa.array(held.tolist())], ["place", "sums"])

    def total(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for part in parts:
            for place, sums in zip(part.column(0).to_pylist(), part.column(1)):
                held[place] = held.get(place, 0) + sums.values.to_numpy()
        if held:
            yield pa.record_batch([pa.array(list(held), pa.int32()), pa.array([x.tolist() for x in held.values()])], ["place", "sums"])

    shape = "place int, sums array<double>"
    made = rows.select(column).mapInArrow(partial, shape).repartition("place").mapInArrow(total, shape)
    # dims rows of dims numbers, whatever the number of embeddings.
    return np.array([r["sums"] for r in sorted(made.collect(), key=lambda r: r["place"])])


def _sums(rows: DataFrame, column: str, dims: int, grid: Grid) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of every dimension on the grid."""

    def partial(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held = 0, [0] * dims
        for part in parts:
            if part.num_rows:
                x = grid.of(_entries(part.column(0), dims))
                n += part.num_rows
                high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
                held = [s + (h << 32) + w for s, h, w in zip(held, high, low)]
        if n:
            yield pa.record_batch([pa.array(range(-1, dims), pa.int32()), pa.array([str(s) for s in (n, *held)])], ["place", "total"])

    found = rows.select(column).mapInArrow(partial, "place int, total string")
    found = found.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total"))
    totals = {r["place"]: int(r["total"]) for r in found.collect()}  # a number for each dimension
    return totals.get(-1, 0), [totals[i] for i in range(dims)] if totals else []


def fit(rows: DataFrame, column: str = "embedding", most: int = 32, grid: Grid = Grid()) -> Fit | None:
    """The components of all usable vectors, `most` at most; None without a usable row.

    Vectors must have one length; others raise. Components without variance are left out: of equal vectors
    none remains.
    """
    good = usable(rows, column)
    ends = good.agg(F.min(F.size(column)).alias("low"), F.max(F.size(column)).alias("high")).first()
    if ends["low"] is None:
        return None
    if ends["low"] != ends["high"]:
        raise ValueError(f"vectors have {ends['low']} to {ends['high']} entries")
    dims = ends["high"]
    n, sums = _sums(good, column, dims, grid)
    mean = Fit(n, sums, np.zeros((dims, 0)), np.zeros(0), np.zeros(0))
    if not dims:
        return mean
    covariance = _products(good, column, dims, lambda v: mean.centred(grid.of(v))) / n
    values, vectors = eigenvectors(covariance)
    count = int((values[:most] > FLAT * values[0]).sum()) if values[0] > 0 else 0
    found = Fit(n, sums, vectors[:, :count], values[:count], values[:count] / max(np.trace(covariance), 1e-300))
    if not count:
        return found
    unity = _products(good, column, dims, lambda v: found.whitened(grid.of(v))) / n
    error = float(np.abs(unity - np.eye(count)).max())
    return Fit(n, sums, found.vectors, found.values, found.explained, error)


def whiten(rows: DataFrame, found: Fit, column: str = "embedding", grid: Grid = Grid()) -> DataFrame:
    """The usable rows with deviation and whitened (one number for each component).

    Columns of these names are replaced, all others stay; repeated rows stay.
    """
    dims = len(found.sums)

    @F.arrow_udf("struct<deviation long, whitened array<double>>")
    def project(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in parts:
            x = grid.of(_entries(vectors, dims))
            flat = pa.array(found.whitened(x).ravel())
            ends = pa.array(np.arange(len(x) + 1) * len(found.values), pa.int32())
            yield pa.StructArray.from_arrays([found.deviation(x), pa.ListArray.from_arrays(ends, flat)], ["deviation", "whitened"])

    own = [F.col(f"`{name}`") for name in rows.columns if name not in ("deviation", "whitened")]
    return usable(rows, column).select(*own, project(column).alias("_put")).select(*own, "_put.deviation", "_put.whitened")
