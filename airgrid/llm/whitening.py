"""Whitening of vectors: pivoted Cholesky factor of their centred scatter, then one-sided Jacobi on the factor.

The scatter over all distinct vectors is summed in the tasks; what reaches the driver is one matrix, whose size is the
vectors' width squared and doesn't depend on their number. With P' V P = L L' (P the pivots' order), rotations from the
right make L's columns orthogonal: L J = U D. Then V = (P U) D^2 (P U)', so squared column norms are the eigenvalues and
normalised columns, put back in order, the components. Neither a covariance of rounded products nor its inverse root is
ever formed, which keeps small eigenvalues to high relative accuracy.

Entries are whole numbers, so the scatter about the whole part of the mean is exact as long as its entries stay below
2 ** 53, on any partitioning; the mean's fraction is taken off afterwards.

Defined results: vectors that are null or hold null or non-finite entries drop out. A shorter vector counts as padded
with zeros to the widest. Repeated rows and rows without vec_id are answered each; equal vectors count once in the fit.
Entries beyond a long end at its bounds. A component without variance (fewer directions than asked for, or one distinct
vector only) has whitened null, and explained 0, or null if there is no variance at all. A deviation beyond a long is null.
identity_error covers the components with variance; without any it is null. An empty table gives an empty result.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import arrow_schema, to_batch
from airgrid.session import Workspace

SCALE, COMPONENTS = 256, 4
#: Sums of one entry of the scatter are first added up in so many shares.
SHARES = 32
#: Rows that a task turns into a matrix at a time.
ROWS = 4096


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (n, rank) and the pivots with a[pivots][:, pivots] = L @ L.T; the rank ends where only rounding is left."""
    a, n = a.copy(), len(a)
    order, factor = np.arange(n), np.zeros((n, n))
    least = n * np.finfo(float).eps * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(n):
        p = k + int(a.diagonal()[k:].argmax())
        if not a[p, p] > least:
            return factor[:, :k], order
        for x in (a, factor):
            x[[k, p]] = x[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        column = a[k + 1 :, k] / factor[k, k]
        factor[k + 1 :, k] = column
        a[k + 1 :, k + 1 :] -= np.outer(column, column)
    return factor, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """`factor` with its columns rotated until they are orthogonal: each sweep meets every pair of columns once, in
    rounds of disjoint pairs."""
    columns = factor.T.copy()  # rows here, so that a column is contiguous
    n = len(columns)
    if n < 2:
        return columns.T
    seats = np.arange(n + n % 2)  # with an odd number, the last seat is empty
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            one, two = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
            full = (one < n) & (two < n)
            i, j = one[full], two[full]
            x, y = columns[i], columns[j]
            xx, yy, xy = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            size = np.sqrt(xx * yy)
            apart = np.divide(np.abs(xy), size, out=np.zeros_like(xy), where=size > 0)
            worst = max(worst, apart.max(initial=0.0))
            turn = apart > 1e-16
            tau = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
            t = np.where(turn, np.where(tau >= 0, 1.0, -1.0) / (np.abs(tau) + np.hypot(1.0, tau)), 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            columns[i], columns[j] = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
            seats[1:] = np.roll(seats[1:], 1)
        if worst < 1e-14:
            break
    return columns.T


def principal(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, of the directions with variance, and their unit components as columns."""
    factor, order = pivoted_cholesky(covariance)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(0))
    falling = np.argsort(-norms, kind="stable")
    components = np.zeros_like(turned)
    components[order] = turned / norms
    return norms[falling] ** 2, components[:, falling]


@dataclass
class Whitening:
    """A fitted transform: `n` distinct vectors with the whole-number `sums`, eigenvalues and components (width, rank)."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        """Whole part of the mean."""
        return np.array([s // self.n for s in self.sums], float)

    @property
    def rest(self) -> np.ndarray:
        """What the mean has beyond it."""
        return np.array([s % self.n / self.n for s in self.sums])

    def whiten(self, x: np.ndarray, k: int) -> np.ndarray:
        """(rows, k): NaN where a component has no variance. A row's values don't depend on the rows beside it."""
        centred = (x - self.centre) - self.rest
        out = np.full((len(x), k), np.nan)
        for c in range(min(k, len(self.values))):
            out[:, c] = (centred * self.components[:, c]).sum(1) / np.sqrt(self.values[c])
        return out

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum over dimensions of (n * x - sum) ** 2, exact; null beyond a long."""
        most = self.n * float(np.abs(x.astype(float)).max(initial=0.0)) + max(map(abs, self.sums), default=0)
        if most < 2**62 and most * most * max(1, x.shape[1]) < 2**62:
            return (((x * self.n) - np.array(self.sums, np.int64)) ** 2).sum(1).tolist()
        found = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [v if v < 2**63 else None for v in found]


def whole_numbers(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, x (array<long>: floor(scale * entry)) of the rows of `table` (vec_id, embedding) that take part."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.where(F.col("embedding").isNotNull()).where(finite)
    scaled = F.transform("embedding", lambda v: F.floor(v.cast("double") * float(scale)).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("x"))


def _widened(rows: DataFrame, width: int) -> DataFrame:
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))
    return rows.withColumn("x", F.when(F.size("x") < width, F.concat("x", zeros)).otherwise(F.col("x")))


def _matrices(batches, width: int):
    """Batches with the matrix of their x, at most ROWS rows at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            part = batch.slice(begin, ROWS)
            yield part, part.column("x").flatten().to_numpy().reshape(part.num_rows, width)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of vectors and each dimension's exact sum."""
    ddl = "j int, hi long, lo long"

    def run(batches):
        hi, lo, n = np.zeros(width, np.int64), np.zeros(width, np.int64), 0
        for _, x in _matrices(batches, width):
            hi += (x >> 32).sum(0)
            lo += (x & 0xFFFFFFFF).sum(0)
            n += len(x)
        yield to_batch({"j": np.arange(-1, width), "hi": np.append(0, hi), "lo": np.append(n, lo)}, arrow_schema(ddl))

    halves = fit.mapInArrow(run, ddl).groupBy("j").agg(*[F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("hi", "lo")])
    found = {r["j"]: int(r["hi"]) * 2**32 + int(r["lo"]) for r in halves.collect()}  # one row per dimension
    return found.get(-1, 0), [found.get(j, 0) for j in range(width)]


def _added(partial: DataFrame) -> DataFrame:
    """`partial` (i, share, row): per i the sum of the rows, share by share first."""
    ddl = "i int, row array<double>"

    def add(group: pa.Table) -> pa.Table:
        rows = np.stack(group["row"].to_numpy(zero_copy_only=False))
        return pa.table({"i": group["i"].slice(0, 1), "row": pa.array([rows.sum(0)], pa.list_(pa.float64()))})

    return partial.groupBy("i", "share").applyInArrow(add, ddl).groupBy("i").applyInArrow(add, ddl)


def _products(rows: DataFrame, width: int, size: int, centred) -> np.ndarray:
    """The sum over `rows` of the outer products of `centred`(x) (rows, size)."""
    ddl = "i int, share int, row array<double>"

    def run(batches):
        total = np.zeros((size, size))
        for _, x in _matrices(batches, width):
            y = centred(x)
            total += y.T @ y
        share = TaskContext.get().partitionId() % SHARES
        yield to_batch({"i": np.arange(size), "share": np.full(size, share), "row": list(total)}, arrow_schema(ddl))

    out = np.zeros((size, size))
    for r in _added(rows.mapInArrow(run, ddl)).collect():  # `size` rows of `size` numbers
        out[r["i"]] = r["row"]
    return out


def fit(distinct: DataFrame, width: int) -> Whitening:
    """`distinct` (a written stage): x, each distinct vector once, all of `width`."""
    n, sums = _sums(distinct, width)
    if not n:
        return Whitening(0, sums, 0.0, np.zeros(0), np.zeros((width, 0)))
    centre = np.array([s // n for s in sums], float)
    rest = np.array([s % n / n for s in sums])
    covariance = _products(distinct, width, width, lambda x: x - centre) / n - np.outer(rest, rest)
    values, components = principal((covariance + covariance.T) / 2)
    return Whitening(n, sums, float(np.trace(covariance)), values, components)


def identity_error(distinct: DataFrame, width: int, fitted: Whitening, k: int) -> float | None:
    """How far the covariance of the whitened fit list is from the identity, at most over its entries."""
    k = min(k, len(fitted.values))
    if not k:
        return None
    ones = _products(distinct, width, k + 1, lambda x: np.column_stack([np.ones(len(x)), fitted.whiten(x, k)]))
    mean = ones[0, 1:] / fitted.n
    moments = _products(distinct, width, k, lambda x: fitted.whiten(x, k) - mean)
    return float(np.abs(moments / fitted.n - np.eye(k)).max())


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, work: Workspace, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """`OUT` for every usable row of `table` (vec_id, embedding) and every component up to `components` or its width."""
    rows = work.keep(whole_numbers(table, scale), "vectors")
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = _widened(rows, width)
    distinct = work.keep(rows.select("x").distinct(), "distinct")
    fitted = fit(distinct, width)
    k = min(components, width)
    error = identity_error(distinct, width, fitted, k)
    shares = [float(v / fitted.trace) if fitted.trace > 0 else None for v in fitted.values[:k]]
    shares += [0.0 if fitted.trace > 0 else None] * (k - len(shares))

    def run(batches):
        for part, x in _matrices(batches, width):
            m = len(x)
            values = fitted.whiten(x, k).ravel()
            yield to_batch(
                {
                    "vec_id": part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                    "component": np.tile(np.arange(1, k + 1), m),
                    "n": np.full(m * k, fitted.n),
                    "deviation": [d for d in fitted.deviations(x) for _ in range(k)],
                    "whitened": pa.array(values, mask=np.isnan(values)),
                    "explained": shares * m,
                    "identity_error": [error] * (m * k),
                },
                arrow_schema(OUT),
            )

    return rows.mapInArrow(run, OUT)
