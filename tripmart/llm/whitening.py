"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Entries are put on a grid of whole numbers (``floor(step * c) + shift``), so
sums, the scatter and deviations are exact whatever the partitioning: tasks
subtract the rounded mean, multiply blocks of rows in limbs small enough for
doubles to be exact, and give rows of 64-bit sums; what is left of the
centring (less than one grid unit) is done on the summed whole numbers. Only
the scatter, one row per dimension, reaches the driver. There
``P' V P = L L'`` (Cholesky with pivoting, stopped at the numerical rank),
and rotations of L's columns make them orthogonal: their squared norms are
the eigenvalues, the normalised columns the components.

Defined cases: a vector that is null, or holds a null or non-finite entry, is
dropped, and so is one whose length is not the commonest (of equally common
lengths the longest stays) and an empty one; repeated ids and rows all count;
null ids are kept. Grid values are held within 2**40 of the shift, a
deviation that no long holds is null. Components whose variance is within
rounding of zero are not given, so fewer than asked may come, and a table
without any variance, or empty, gives no row. Columns other than id and
vector are not read. A component's sign makes its largest entry positive.

Scale: a pass each for the grid table, the sums, the scatter, and the check
of the result. A task's part of the scatter is one row per dimension (dims *
24 bytes each); these rows shuffle by dimension and are added in a stream.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

STEP, SHIFT = 64, 1_000_000
COMPONENTS = 32
LIMIT = 1 << 40           # grid values beyond shift +- LIMIT are held there
BLOCK = 2048              # rows multiplied at once
_SAFE = 1 << 62           # whole numbers below this are added as longs
_LIMB = 21                # bits: products of limbs times BLOCK rows stay below 2**53


# --- the grid -----------------------------------------------------------------------

def grid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", step: int = STEP,
         shift: int = SHIFT) -> DataFrame:
    """(id, x): the grid values of every sound vector of the commonest length."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    limit = float(LIMIT)
    x = F.transform(v, lambda c: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), c * step))).cast("long") + shift)
    sound = vectors.filter(v.isNotNull() & (F.size(v) > 0) & ~bad)
    rows = staged(sound.select(F.col(f"`{id_col}`").alias("id"), x.alias("x")), "whiten-grid")
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == (length.d if length else 0))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy().reshape(-1, dims)


@dataclass
class Fit:
    """The fit list's number of vectors, sums, and scatter times n (exact)."""
    n: int
    sums: np.ndarray         # Python integers
    scatter: np.ndarray      # n * sum of products of deviations from the mean, Python integers

    @property
    def dims(self) -> int:
        return len(self.sums)

    def covariance(self) -> np.ndarray:
        return np.array([[v / (self.n * self.n) for v in row] for row in self.scatter.tolist()], float)


def _sums(rows: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for b in batches:
            x = _matrix(b, dims)
            n += len(x)
            low += (x & 0xFFFFF).sum(axis=0)           # two halves: no sum overflows
            high += (x >> 20).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int64()), pa.array(np.full(dims, n)),
                                              pa.array(low), pa.array(high)], ["i", "n", "low", "high"])

    parts = rows.select("x").mapInArrow(run, "i long, n long, low long, high long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "low", "high")]
    got = parts.groupBy("i").agg(*exact).orderBy("i").collect()      # a row for each dimension
    return int(got[0].n), np.array([int(r.low) + (int(r.high) << 20) for r in got], object)


def _products(y: np.ndarray) -> list[np.ndarray]:
    """The exact sums of products of a block's columns, as three limbs."""
    if len(y) and np.abs(y).max() < 1 << _LIMB:
        f = y.astype(float)
        low = (f.T @ f).astype(np.int64)
        return [low, np.zeros_like(low), np.zeros_like(low)]
    h, l = (y >> _LIMB).astype(float), (y & ((1 << _LIMB) - 1)).astype(float)
    mixed = (h.T @ l).astype(np.int64)
    return [(l.T @ l).astype(np.int64), mixed + mixed.T, (h.T @ h).astype(np.int64)]


def _carry(limbs: list[np.ndarray]) -> None:
    for k in (0, 1):
        limbs[k + 1] += limbs[k] >> _LIMB
        limbs[k] &= (1 << _LIMB) - 1


def fit(rows: DataFrame) -> Fit | None:
    """Exact sums and centred scatter of a grid table (None: no vector)."""
    head = rows.select(F.size("x").alias("d")).first()
    if head is None:
        return None
    dims = head.d
    n, sums = _sums(rows, dims)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums.tolist()], np.int64)      # the rounded mean

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            y = _matrix(b, dims) - centre
            for s in range(0, len(y), BLOCK):
                part = _products(y[s:s + BLOCK])
                total = part if total is None else [t + p for t, p in zip(total, part)]
                _carry(total)
        if total is not None:
            yield _rows(np.arange(dims), total)

    def _rows(i: np.ndarray, limbs: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int64()), *(pa.array(list(k), pa.list_(pa.int64())) for k in limbs)], ["i", "a", "b", "c"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, []
        for b in batches:
            for i, *row in zip(*(b.column(k).to_pylist() for k in range(4))):
                row = [np.array(k, np.int64) for k in row]
                if i != at:
                    if at is not None:
                        yield _rows(np.array([at]), [t[None, :] for t in total])
                    at, total = i, row
                else:
                    total = [t + r for t, r in zip(total, row)]
                    _carry(total)
        if at is not None:
            yield _rows(np.array([at]), [t[None, :] for t in total])

    schema = "i long, a array<long>, b array<long>, c array<long>"
    tasks = min(dims, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = rows.select("x").mapInArrow(partial, schema).repartition(tasks, "i").sortWithinPartitions("i")
    got = parts.mapInArrow(add, schema).collect()                  # a row for each dimension
    products = np.empty((dims, dims), object)
    for r in got:
        products[r.i] = [a + (b << _LIMB) + (c << 2 * _LIMB) for a, b, c in zip(r.a, r.b, r.c)]
    rest = sums - n * centre.astype(object)                        # what rounding left of the mean, times n
    return Fit(n, sums, n * products - np.outer(rest, rest))


# --- the factors --------------------------------------------------------------------

def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, L): ``v[order][:, order] = L L'`` up to rounding, L of as many columns as the numerical rank."""
    d = len(v)
    a, order = v.copy(), np.arange(d)
    tiny = d * np.finfo(float).eps * max(0.0, float(np.diag(v).max(initial=0.0)))
    low = np.zeros((d, d))
    for k in range(d):
        p = k + int(np.argmax(np.diag(a)[k:]))
        if a[p, p] <= tiny:
            return order, low[:, :k]
        for m in (a, low):
            m[[k, p]] = m[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1:, k] = a[k + 1:, k] / low[k, k]
        a[k + 1:, k + 1:] -= np.outer(low[k + 1:, k], low[k + 1:, k])
    return order, low


def _meetings(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rounds in which every two of ``n`` columns meet once, a column at most once a round."""
    m = n + n % 2
    seats = np.arange(m)
    for _ in range(m - 1):
        x, y = seats[:m // 2], seats[m // 2:][::-1]
        real = (x < n) & (y < n)
        yield x[real], y[real]
        seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])


def jacobi(columns: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(squared norms, unit columns) after rotating the columns until every two
    are orthogonal to rounding; by falling norm."""
    u = columns.T.copy()                      # a row for each column
    if not u.size:
        return np.zeros(0), u.T
    eps = np.finfo(float).eps * np.sqrt(u.shape[1])
    for _ in range(sweeps):
        turned = False
        for x, y in _meetings(len(u)):
            a, b = u[x], u[y]
            p, q, r = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
            on = np.abs(r) > eps * np.sqrt(p * q)
            if not on.any():
                continue
            turned = True
            x, y, a, b, p, q, r = x[on], y[on], a[on], b[on], p[on], q[on], r[on]
            z = (q - p) / (2 * r)
            t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.hypot(1.0, z))
            c = (1 / np.hypot(1.0, t))[:, None]
            s = c * t[:, None]
            u[x], u[y] = c * a - s * b, s * a + c * b
        if not turned:
            break
    norms = (u * u).sum(axis=1)
    by = np.argsort(-norms, kind="stable")
    return norms[by], (u[by] / np.sqrt(norms[by])[:, None]).T


@dataclass
class Components:
    values: np.ndarray        # eigenvalues, falling
    vectors: np.ndarray       # one column each
    trace: float


def principal(found: Fit, count: int = COMPONENTS) -> Components:
    v = found.covariance()
    order, low = pivoted_cholesky(v)
    values, columns = jacobi(low)
    vectors = np.zeros((found.dims, len(values)))
    vectors[order] = columns
    top = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[top, np.arange(len(values))])
    return Components(values[:count], vectors[:, :count], float(np.trace(v)))


# --- results ------------------------------------------------------------------------

class _Whitener:
    """What a task needs: deviations and whitened values of a block of rows."""

    def __init__(self, found: Fit, top: Components):
        self.n, self.dims, self.sums = found.n, found.dims, found.sums
        self.scale = top.vectors / np.sqrt(top.values)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact (whole numbers of Python where a long might not do)."""
        reach = int(np.abs(x).max(initial=0)) * self.n + max(abs(s) for s in self.sums.tolist())
        if reach < _SAFE:
            return x * self.n - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums

    def squares(self, dev: np.ndarray) -> list[int | None]:
        if dev.dtype != object:
            reach = int(np.abs(dev).max(initial=0))
            if reach * reach * self.dims < _SAFE:
                return (dev * dev).sum(axis=1).tolist()
        total = (dev.astype(object) ** 2).sum(axis=1).tolist()
        return [t if t < 1 << 63 else None for t in total]

    def whitened(self, dev: np.ndarray) -> np.ndarray:
        return (dev / self.n).astype(float) @ self.scale


def identity_error(rows: DataFrame, found: Fit, top: Components) -> float:
    """Largest absolute entry of the whitened values' covariance minus the identity."""
    k, w = len(top.values), _Whitener(found, top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros((k, k)), False
        for b in batches:
            z = w.whitened(w.deviations(_matrix(b, w.dims)))
            total += z.T @ z
            any_row = any_row or len(z) > 0
        if any_row:
            i, j = np.indices((k, k)).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "v"])

    cov = rows.select("x").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    off = F.abs(F.col("v") / found.n - (F.col("i") == F.col("j")).cast("double"))
    return float(cov.agg(F.max(off).alias("e")).first().e)


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           step: int = STEP, shift: int = SHIFT) -> DataFrame:
    """A row for each sound vector and component: id, component, n, deviation,
    whitened, explained, identity_error."""
    rows = grid(vectors, id_col, vector_col, step, shift)
    schema = f"{rows.schema['id'].dataType.simpleString()}, {RESULT}"
    found = fit(rows)
    top = principal(found, components) if found else None
    if top is None or not len(top.values):
        return rows.sparkSession.createDataFrame([], f"`{id_col}` {schema}")
    error, w, k = identity_error(rows, found, top), _Whitener(found, top), len(top.values)
    explained = top.values / top.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, BLOCK):
                part = b.slice(s, BLOCK)
                m = part.num_rows
                dev = w.deviations(_matrix(part, w.dims))
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n)), pa.array(w.squares(dev), pa.int64()).take(pa.array(each)),
                    pa.array(w.whitened(dev).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "x").mapInArrow(run, f"id {schema}").withColumnRenamed("id", id_col)
