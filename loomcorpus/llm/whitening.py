"""Embedding whitening on the leading eigenvectors of the covariance, found by slicing its spectrum.

Entries become integers on a grid, so counts, sums and products of the centred entries are exact whatever the
order of the tasks; each task sends one row for each cell of its d x d sums, and Spark adds them up. Only the
covariance itself, whose size is the dimension's and not the data's, is worked on by the driver.

There an LDLt factorisation of ``V - s I`` with symmetric pivoting counts the eigenvalues above ``s`` by the signs of
its pivots (Sylvester's law of inertia). Bisection on these counts cuts out an interval that holds eigenvalue
number ``j`` alone; Rayleigh quotient iteration inside it converges cubically, and the counts at the ends
of the interval certify the number. Eigenvalues that no shift can tell apart are taken together.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcorpus.llm.common import scratch, small_batches, stored

COMPONENTS = 16
#: Steps of the grid in a unit, and what is added so that the grid's numbers are positive.
SCALE, SHIFT = 64, 1_000_000
#: Eigenvalues up to this share of the trace count as zero: no component, as whitening would divide by them.
ZERO = 1e-12
_EPS = float(np.finfo(np.float64).eps)
_SAFE = float(1 << 53)


def positive_pivots(a: np.ndarray) -> int:
    """The number of positive eigenvalues of a symmetric matrix: positive pivots of its LDLt factorisation, in
    blocks of one or two by Bunch and Kaufman's pivoting."""
    a, n, k, positive = a.copy(), len(a), 0, 0
    alpha = (1 + 17**0.5) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        width, own = 1, abs(a[k, k])
        if k + 1 < n:
            r = k + 1 + int(np.argmax(np.abs(a[k + 1 :, k])))
            most = abs(a[r, k])
            if own < alpha * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0.0
                if own * row.max() < alpha * most * most:
                    if abs(a[r, r]) >= alpha * row.max():
                        swap(k, r)
                    else:
                        swap(k + 1, r)
                        width = 2
        if width == 1:
            pivot, below = a[k, k], a[k + 1 :, k].copy()
            positive += bool(pivot > 0)
            if pivot != 0:
                a[k + 1 :, k + 1 :] -= np.outer(below, below / pivot)
        else:
            block, below = a[k : k + 2, k : k + 2].copy(), a[k + 2 :, k : k + 2].copy()
            product = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            positive += 1 if product < 0 else 2 * bool(block[0, 0] > 0)
            a[k + 2 :, k + 2 :] -= below @ np.linalg.solve(block, below.T)
        k += width
    return positive


class Spectrum:
    """The leading eigenpairs of a positive semidefinite matrix, numbered from 1 by falling eigenvalue."""

    def __init__(self, v: np.ndarray) -> None:
        self.v, self.size = v, float(np.trace(v))
        self.tolerance = 32 * _EPS * self.size
        #: Shifts with the number of eigenvalues above each; the ends are known.
        self.counts = {-self.size * 1e-6: len(v), self.size * (1 + 1e-6): 0}
        self.values: list[float] = []
        self.vectors = np.empty((len(v), 0))

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = positive_pivots(self.v - shift * np.eye(len(self.v)))
        return self.counts[shift]

    def _ends(self, j: int) -> tuple[float, float]:
        return max(s for s, n in self.counts.items() if n >= j), min(s for s, n in self.counts.items() if n < j)

    def _apart(self, x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - self.vectors @ (self.vectors.T @ x)
        return x / np.linalg.norm(x)

    def _solved(self, shift: float, x: np.ndarray) -> np.ndarray:
        for nudge in (0.0, self.tolerance, 7 * self.tolerance):
            try:
                y = np.linalg.solve(self.v - (shift + nudge) * np.eye(len(x)), x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all():
                return self._apart(y / np.abs(y).max())
        return x

    def _residual(self, x: np.ndarray) -> tuple[float, float]:
        value = float(x @ self.v @ x)
        return value, float(np.linalg.norm(self.v @ x - value * x))

    def _polished(self, low: float, high: float, start: np.ndarray) -> tuple[float, np.ndarray, float]:
        """Rayleigh quotient iteration from one step of inverse iteration in the middle of the interval."""
        x = self._solved((low + high) / 2, self._apart(start))
        value, best = self._residual(x)
        for _ in range(12):
            y = self._solved(value, x)
            new, rest = self._residual(y)
            if not rest < best:
                break
            x, value, best = y, new, rest
        return value, x, best

    def take(self, j: int) -> None:
        """Add eigenpair ``j``; those before it are there already."""
        draw = np.random.default_rng(j)
        while True:
            low, high = self._ends(j)
            alone = self.counts[low] == j and self.counts[high] == j - 1
            if alone or high - low <= self.tolerance:
                value, x, rest = self._polished(low, high, draw.standard_normal(len(self.v)))
                # Within the residual of the quotient lies an eigenvalue, and in the interval only number j.
                if high - low <= 2 * self.tolerance or (rest <= self.tolerance and low < value - rest and value + rest < high):
                    break
            middle = (low + high) / 2
            if not low < middle < high:
                value, x, rest = self._polished(low, high, draw.standard_normal(len(self.v)))
                break
            self.above(middle)
        self.values.append(value)
        self.vectors = np.column_stack([self.vectors, x])


def leading(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``v`` above zero, falling, and unit eigenvectors as columns."""
    spectrum = Spectrum(v)
    if not spectrum.size > 0:
        return np.empty(0), spectrum.vectors
    for j in range(1, min(k, spectrum.above(ZERO * spectrum.size)) + 1):
        spectrum.take(j)
    order = np.argsort(-np.array(spectrum.values), kind="stable")
    return np.array(spectrum.values)[order], spectrum.vectors[:, order]


@dataclasses.dataclass(frozen=True)
class Whitening:
    """What was learned: the fit list's size and sums, and its components as columns."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0


def grid(vector: Column) -> Column:
    """Entries as integers of the grid; null unless every entry is a finite number."""
    fit = vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return F.when(fit, F.transform(vector, lambda c: (F.floor(c.cast("double") * SCALE) + SHIFT).cast("long")))


def _rows(batch: pa.RecordBatch, column: str, d: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n x - S``, exactly: as longs where they hold it, else as Python's integers."""
    largest = max(abs(int(x.max())), abs(int(x.min())), 1) if x.size else 1
    if n * largest < 1 << 62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums.astype(object)


def _summed(fit: DataFrame, d: int, add: Callable[[np.ndarray], dict[tuple[int, int], object]], kind: str) -> dict[tuple[int, int], object]:
    """The sums over all tasks of the cells that ``add`` gives for a block of rows."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            if len(batch):
                for cell, value in add(_rows(batch, "x", d)).items():
                    total[cell] = total.get(cell, 0) + value
        yield pa.record_batch([pa.array([c[i] for c in total], pa.int32()) for i in (0, 1)] + [pa.array([str(v) if kind != "double" else float(v) for v in total.values()], pa.float64() if kind == "double" else pa.string())], names=["i", "j", "value"])

    parts = fit.mapInArrow(cells, f"i int, j int, value {'double' if kind == 'double' else 'string'}")
    with small_batches(fit.sparkSession):
        return {(r.i, r.j): r.value for r in parts.groupBy("i", "j").agg(F.sum(F.col("value").cast(kind)).alias("value")).collect()}


def _upper(m: np.ndarray) -> dict[tuple[int, int], object]:
    return {(i, j): m[i, j] for i in range(len(m)) for j in range(i, len(m))}


def _square(cells: dict[tuple[int, int], object], d: int, dtype: type) -> np.ndarray:
    m = np.zeros((d, d), dtype)
    for (i, j), value in cells.items():
        m[i, j] = m[j, i] = value
    return m


def fit(vectors: DataFrame, vector_col: str = "embedding", k: int = COMPONENTS) -> Whitening | None:
    """The whitening learned from every distinct vector; None if there is no usable one.

    Null vectors and those with a null or non-finite entry are passed over, and so are those that have not
    the commonest number of entries (of equally common ones the largest; none is no number).
    """
    spark = vectors.sparkSession
    with scratch(spark):
        usable = vectors.select(grid(F.col(f"`{vector_col}`")).alias("x")).where("size(x) > 0")
        distinct = stored(usable.distinct(), "fit_list")
        sizes = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        if sizes is None:
            return None
        d = sizes.d
        rows = distinct.where(F.size("x") == d)

        def total(x: np.ndarray) -> dict[tuple[int, int], object]:
            wide = x.astype(object) if np.abs(x.astype(np.float64)).max() * len(x) >= _SAFE else x
            return {(i, -1): int(s) for i, s in enumerate(wide.sum(axis=0))} | {(-1, -1): len(x)}

        found = _summed(rows, d, total, "decimal(38,0)")
        n, sums = int(found[-1, -1]), [int(found[i, -1]) for i in range(d)]
        # Entries are centred by the rounded mean, which keeps them integers; the rest of the mean is exact below.
        middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)

        def products(x: np.ndarray) -> dict[tuple[int, int], object]:
            y = x - middle
            largest = float(np.abs(y.astype(np.float64)).max())
            if largest * largest * len(y) < _SAFE:  # sums of products are integers that doubles hold
                m = (y.astype(np.float64).T @ y.astype(np.float64)).astype(np.int64)
            else:
                m = y.astype(object).T @ y.astype(object)
            return {cell: int(v) for cell, v in _upper(m).items()}

        around = _square({c: int(v) for c, v in _summed(rows, d, products, "decimal(38,0)").items()}, d, object)
        off = [s - n * int(m) for s, m in zip(sums, middle, strict=True)]
        v = np.array([[(n * around[i, j] - off[i] * off[j]) / (n * n) for j in range(d)] for i in range(d)], np.float64)
        values, axes = leading(v, k)
        model = Whitening(n, tuple(sums), values, axes, float(np.trace(v)))
        c = len(values)

        def moments(x: np.ndarray) -> dict[tuple[int, int], object]:
            w = _whitened(_centred(x, n, np.array(sums, object)), model)
            return _upper(w.T @ w) | {(i, -1): s for i, s in enumerate(w.sum(axis=0))}

        found = _summed(rows, d, moments, "double") if c else {}
        mean = np.array([found[i, -1] for i in range(c)]) / n
        second = _square({cell: s for cell, s in found.items() if cell[1] >= 0}, c, float) / n
        error = float(np.abs(second - np.outer(mean, mean) - np.eye(c)).max()) if c else 0.0
        return dataclasses.replace(model, identity_error=error)


def _whitened(centred: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened rows from ``n x - S``."""
    x = (centred / model.n).astype(np.float64)
    return x @ model.vectors / np.sqrt(model.values)


def _deviations(centred: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exactly; None where a long can't hold it."""
    if centred.dtype != object and float(np.abs(centred).max(initial=0)) ** 2 * centred.shape[1] < 1 << 62:
        return (centred * centred).sum(axis=1).tolist()
    exact = (sum(int(e) ** 2 for e in row) for row in centred)
    return [v if v < 1 << 63 else None for v in exact]


_MADE = {"deviation": "bigint", "whitened": "array<double>"}


def transform(vectors: DataFrame, model: Whitening, vector_col: str = "embedding") -> DataFrame:
    """The rows of ``vectors`` that have a usable vector of the model's dimension, all columns, with ``deviation``
    (the squared distance to the mean of the fit list, times n squared, exact; null beyond a long)
    and ``whitened`` (in place of columns of these names).
    Repeated rows and ids each get their result."""
    d = len(model.sums)
    names = {c: f"c{i}" for i, c in enumerate(vectors.columns)}

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(model.sums, object)
        for batch in batches:
            centred = _centred(_rows(batch, "x", d), model.n, sums)
            w = _whitened(centred, model)
            offsets = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            made = [pa.array(_deviations(centred), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel()))]
            yield pa.record_batch([*[batch.column(c) for c in names.values()], *made], names=[*names.values(), *_MADE])

    rows = vectors.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], grid(F.col(f"`{vector_col}`")).alias("x")).where(F.size("x") == d)
    kinds = ", ".join([*[f"{n} {vectors.schema[c].dataType.simpleString()}" for c, n in names.items()], *[f"{c} {kind}" for c, kind in _MADE.items()]])
    out = rows.mapInArrow(mapped, kinds)
    return out.select(*[F.col(n).alias(c) for c, n in names.items() if c not in _MADE], *_MADE)


def whitened_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)`` of every usable row and component.

    There are ``k`` components, or as many as the fit list has directions in which it varies: equal vectors
    alone give no rows, as does an empty table.
    """
    model = fit(vectors, vector_col, k)
    kind = vectors.schema[id_col].dataType.simpleString()
    if model is None:
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    rows = transform(vectors.select(id_col, vector_col), model, vector_col)
    rows = rows.select(id_col, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(id_col, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
