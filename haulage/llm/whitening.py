"""Whitening of vectors by principal components from contour integration.

The covariance is added up over all vectors, centred before it is multiplied. Its largest eigenvalues are found interval by
interval: a quadrature of complex shifted solves along a circle around the interval projects random vectors onto the eigenvectors
inside, Rayleigh-Ritz takes the components out of that space, and both are repeated until the residuals vanish. Inertia counts, the
signs of the pivots of the shifted covariance after its reduction to three diagonals, say how many eigenvalues lie in an interval, so
none is missed. Vectors of each length are whitened among themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.llm.base import query, table
from haulage.session import stored

COMPONENTS = 32
#: What a component of a vector becomes: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Eigenvalues of an interval at most, points of the quadrature on the half circle, and rounds of an interval at most.
TOGETHER, POINTS, ROUNDS = 12, 8, 40
#: Eigenvalues below this share of the largest one are zero, and residuals below this share of it have vanished.
ZERO, VANISHED = 1e-11, 1e-13
#: Bytes of covariances and components that are handled at once; lengths beyond it come in turns.
AT_ONCE = 256 << 20


# --- eigenvalues

def three_diagonals(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared side diagonal of a matrix with the same inertia at every shift, by reflections."""
    a = matrix.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k]
        length = np.linalg.norm(x)
        if length == 0 or np.linalg.norm(x[1:]) == 0:
            continue
        v = x.copy()
        v[0] += np.copysign(length, x[0])
        v /= np.linalg.norm(v)
        p = a[k + 1:, k + 1:] @ v
        w = 2 * (p - (v @ p) * v)
        a[k + 1:, k + 1:] -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = a[k, k + 1] = -np.copysign(length, x[0])
    return a.diagonal().copy(), a.diagonal(-1) ** 2


class Inertia:
    """How many eigenvalues of a symmetric matrix lie above a shift."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, self.sides = three_diagonals(matrix)
        reach = np.sqrt(np.concatenate([[0], self.sides])) + np.sqrt(np.concatenate([self.sides, [0]]))
        self.low, self.high = float((self.diagonal - reach).min()), float((self.diagonal + reach).max())
        self.tiny = max(np.finfo(float).tiny, np.finfo(float).eps * 1e-3 * max(abs(self.low), abs(self.high)))

    def above(self, shifts) -> np.ndarray:
        shifts = np.asarray(shifts, float)
        count = np.zeros(shifts.shape, np.int64)
        pivot = np.ones(shifts.shape)
        for d, side in zip(self.diagonal, np.concatenate([[0], self.sides])):
            pivot = d - shifts - side / pivot
            pivot = np.where(np.abs(pivot) < self.tiny, -self.tiny, pivot)
            count += pivot > 0
        return count

    def about(self, numbers: np.ndarray, steps: int = 60) -> np.ndarray:
        """The eigenvalues of these numbers, 1 being the largest, by halving."""
        low, high = np.full(len(numbers), self.low - self.tiny), np.full(len(numbers), self.high + self.tiny)
        for _ in range(steps):
            middle = (low + high) / 2
            more = self.above(middle) >= numbers
            low, high = np.where(more, middle, low), np.where(more, high, middle)
        return (low + high) / 2


def intervals(values: np.ndarray, below: float, together: int = TOGETHER) -> list[tuple[float, float, int]]:
    """Intervals (low, high, how many) over falling eigenvalues, cut in the middle of wide gaps; ``below`` is the next
    eigenvalue."""
    spread = max(float(values[0]) - below, np.finfo(float).tiny)
    edges = np.concatenate([[values[0] + max(spread / 8, abs(values[0]) * 1e-3)], (values[:-1] + values[1:]) / 2, [(values[-1] + below) / 2]])
    gaps = np.concatenate([[np.inf], values[:-1] - values[1:], [np.inf]])
    out, stack = [], [(0, len(values))]
    while stack:
        a, b = stack.pop()
        inner = np.arange(a + 1, b)
        # among eigenvalues that are as good as equal there is no place for an edge
        wide = inner[gaps[inner] > 1e-6 * max(abs(values[0]), np.finfo(float).tiny)]
        if b - a > together and len(wide):
            quarter = wide[(wide - a >= (b - a) / 4) & (b - wide >= (b - a) / 4)]
            places = quarter if len(quarter) else wide
            cut = int(places[np.argmax(gaps[places])])
            stack += [(a, cut), (cut, b)]
        else:
            out.append((float(edges[b]), float(edges[a]), b - a))
    return sorted(out, reverse=True)


def inside(matrix: np.ndarray, low: float, high: float, count: int, scale: float) -> np.ndarray:
    """Unit eigenvectors, as columns, of the ``count`` eigenvalues between ``low`` and ``high``."""
    n = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(POINTS)
    angles = np.pi / 2 * (1 - points)
    solves = [np.linalg.inv((centre + radius * np.exp(1j * t)) * np.eye(n) - matrix) * (w / 2 * radius * np.exp(1j * t)) for t, w in zip(angles, weights)]
    width = min(n, max(count + 6, count * 3 // 2))
    space = np.random.default_rng(n).standard_normal((n, width))
    for turn in range(1, ROUNDS + 1):
        projected = sum((s @ space).real for s in solves)
        basis, _ = np.linalg.qr(projected)
        values, small = np.linalg.eigh(basis.T @ matrix @ basis)
        space = basis @ small
        residual = np.linalg.norm(matrix @ space - space * values, axis=0)
        good = (values > low) & (values < high) & (residual <= VANISHED * scale * np.sqrt(n))
        if good.sum() == count:
            return space[:, good]
        if turn % 10 == 0 and width < n:  # crowded around the interval: a wider space
            width = min(n, 2 * width)
            space = np.concatenate([space, np.random.default_rng(turn).standard_normal((n, width - space.shape[1]))], axis=1)
    raise ArithmeticError(f"{int(good.sum())} of {count} eigenvalues found between {low} and {high}")


def principal(covariance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns; those that are zero are left out.

    The largest entry of an eigenvector is positive.
    """
    n = len(covariance)
    scale = float(np.abs(covariance).sum(axis=1).max(initial=0))
    if not scale:
        return np.empty(0), np.empty((n, 0))
    matrix = covariance / scale
    inertia = Inertia(matrix)
    rank = int(inertia.above(ZERO))
    wanted = min(components, rank)
    if not wanted:
        return np.empty(0), np.empty((n, 0))
    values = inertia.about(np.arange(1, n + 1)[:min(n, rank + 1)])
    last = wanted
    while last < rank and values[last - 1] - values[last] < 1e-6:  # the last one has equals: take all of them
        last += 1
    below = values[last] if last < len(values) else (0.0 if last >= n else values[-1] * 0.5)
    found = []
    for low, high, _ in intervals(values[:last], float(below)):
        count = int(inertia.above(low) - inertia.above(high))
        found.append(inside(matrix, low, high, count, 1.0))
    basis, _ = np.linalg.qr(np.concatenate(found, axis=1))
    own, small = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-own, kind="stable")[:wanted]
    vectors = basis @ small[:, order]
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)] < 0, -1.0, 1.0)
    return own[order] * scale, vectors


# --- sums over all vectors

def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(length, ids, vectors as rows) of stored batches."""
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        for size in np.unique(sizes):
            own = batch.filter(pa.array(sizes == size))
            yield int(size), own.column("vec_id"), _matrix(own.column("x"), int(size))


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, size, x) of the vectors without null and non-finite entries, as whole numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = column.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(SCALE * flat) + OFFSET
                bad = ~np.isfinite(flat) | (np.abs(x) >= 2.0 ** 62)
            ends = np.cumsum(sizes)
            wrong = np.concatenate([[0], np.cumsum(bad)])
            good = (sizes > 0) & (wrong[ends] == wrong[ends - sizes])
            kept = np.where(bad | ~np.repeat(good, sizes), 0, x).astype(np.int64)[np.repeat(good, sizes)]
            offsets = np.concatenate([[0], np.cumsum(sizes[good])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").filter(pa.array(good)), pa.array(sizes[good]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(kept))], ["vec_id", "size", "x"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, size long, x array<long>")


def sums(x: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Number of vectors and exact sums per dimension, of each length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for size, _, rows in _by_length(batches):
            if np.abs(rows).max() * float(len(rows)) >= 2.0 ** 62:
                raise OverflowError("the sum of a dimension does not fit a long")
            n, s = total.get(size, (0, 0))
            total[size] = [n + len(rows), s + rows.sum(axis=0)]
        for size, (n, s) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, size)), pa.array(np.arange(size)), pa.array(np.full(size, n)), pa.array(s)], ["size", "j", "n", "s"])

    added = x.mapInArrow(run, "size long, j long, n long, s long").groupBy("size", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    whole = added.groupBy("size").agg(F.max("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("j", "s"))), lambda e: e["s"]).alias("s"))
    return {r["size"]: (r["n"], np.array(r["s"], np.int64)) for r in whole.collect()}


def centred(rows: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """Rows less the mean s / n: its whole part is subtracted exactly."""
    whole = s // n
    return (rows - whole).astype(np.float64) - (s - whole * n) / n


def moments(x: DataFrame, of: Callable[[int, np.ndarray], np.ndarray]) -> DataFrame:
    """(size, i, j, v): sums of products of the columns i <= j of ``of(size, rows)`` over all rows. A task adds up its rows first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for size, _, rows in _by_length(batches):
            y = of(size, rows)
            total[size] = total.get(size, 0) + y.T @ y
        for size, v in total.items():
            for i in range(len(v)):
                j = np.arange(i, len(v))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), size)), pa.array(np.full(len(j), i)), pa.array(j), pa.array(v[i, i:])], ["size", "i", "j", "v"])

    return x.mapInArrow(run, "size long, i long, j long, v double").groupBy("size", "i", "j").agg(F.sum("v").alias("v"))


def components_of(cells: DataFrame, counts: dict[int, int], components: int) -> DataFrame:
    """(size, component, value, share, axis) from the sums of products of each length."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        size = int(group["size"].iloc[0])
        v = np.zeros((size, size))
        i, j = group["i"].to_numpy(), group["j"].to_numpy()
        v[i, j] = v[j, i] = group["v"].to_numpy() / counts[size]
        values, axes = principal(v, components)
        return pd.DataFrame({"size": size, "component": np.arange(1, len(values) + 1, dtype=np.int32), "value": values, "share": values / max(np.trace(v), np.finfo(float).tiny), "axis": pd.Series(list(axes.T), dtype=object)})

    return cells.groupBy("size").applyInPandas(run, "size long, component int, value double, share double, axis array<double>")


def _lots(lengths: list[int]) -> list[list[int]]:
    """Lengths in lots whose covariances fit ``AT_ONCE`` together."""
    lots, room = [], 0
    for size in sorted(lengths):
        if not lots or room < 8 * size * size:
            lots.append([])
            room = AT_ONCE
        lots[-1].append(size)
        room -= 8 * size * size
    return lots


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every usable row of ``(vec_id, embedding)`` and
    every component, at most ``components``.

    Vectors that are null, empty, or hold null or non-finite entries (or entries too large for a long) are left out; rows without
    an id and repeated rows count like others. Vectors of each length are whitened among themselves, over all of them. Components
    whose eigenvalue is zero (equal vectors, fewer vectors than dimensions) have no scale and are left out, so one vector alone
    gives no rows, and no vectors give none. ``deviation`` is exact, and null where it does not fit a long. Other columns are
    not looked at. What passes the driver is sums and components, of a size that the lengths of the vectors set.
    """
    spark = vectors.sparkSession
    x = stored(scaled(vectors), "whitening")
    out = spark.createDataFrame([], OUT)
    every = sums(x)
    for lot in _lots(list(every)):
        own = x.where(F.col("size").isin(lot))
        out = out.unionByName(_whitened(own, {size: every[size] for size in lot}, components))
    return out


def _whitened(x: DataFrame, fit: dict[int, tuple[int, np.ndarray]], components: int) -> DataFrame:
    spark = x.sparkSession
    shared = spark.sparkContext.broadcast(fit)
    found = components_of(moments(x, lambda size, rows: centred(rows, *shared.value[size])), {size: n for size, (n, _) in fit.items()}, components)
    axes: dict[int, tuple] = {}
    rows = stored(found, "whitening-axes").collect()
    for size in fit:
        own = sorted((r for r in rows if r["size"] == size), key=lambda r: r["component"])
        if own:
            axes[size] = (np.array([r["axis"] for r in own]).T / np.sqrt([r["value"] for r in own]), np.array([r["share"] for r in own]))
    models = spark.sparkContext.broadcast(axes)
    x = x.where(F.col("size").isin(list(axes)))

    def project(size: int, rows: np.ndarray) -> np.ndarray:
        return centred(rows, *shared.value[size]) @ models.value[size][0]

    off = F.max(F.abs(F.col("v") / F.col("n") - (F.col("i") == F.col("j")).cast("double"))).alias("off")
    counts = spark.createDataFrame([(size, n) for size, (n, _) in fit.items()], "size long, n long")
    errors = {r["size"]: r["off"] for r in moments(x, project).join(counts, "size").groupBy("size").agg(off).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, ids, rows in _by_length(batches):
            n, s = shared.value[size]
            share = models.value[size][1]
            k = len(share)
            for start in range(0, len(rows), 4096):
                part = rows[start:start + 4096]
                w = project(size, part)
                m = len(part)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(start, m).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                    deviations(part, n, s).take(pa.array(np.repeat(np.arange(m), k))), pa.array(w.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, errors[size]))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, OUT)


def deviations(rows: np.ndarray, n: int, s: np.ndarray) -> pa.Array:
    """The sum of (n * x - s)^2 of every row, exact; null where it does not fit a long."""
    whole = s // n
    near = rows - whole
    if float(np.abs(near).max() + 1) ** 2 * float(n) ** 2 * rows.shape[1] < 2.0 ** 62:
        return pa.array((((n * near) - (s - whole * n)) ** 2).sum(axis=1))
    exact = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s)) for row in rows]
    return pa.array([e if e < 2 ** 63 else None for e in exact], pa.int64())


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
