"""Whitening of vectors on their leading components, by mixed-precision refinement.

1. Every entry c becomes the integer floor(1024 c) + 100000.  One pass over the vectors gives their number, exact sums, mean
   and centred products; partial moments are merged in two levels of tasks, so the driver gets one matrix of dims x dims.
2. ``eigen``: eigenvectors of the covariance in float32, corrected in float64 by Ogita and Aishima's iteration, which needs
   matrix products alone.  Eigenvalues closer than the iteration can tell apart form clusters: the matrix, shifted by the cluster's
   mean and projected on its vectors, is solved by itself (again in float32, of the cluster's own scale) and refined on.
3. One pass measures the covariance of the whitened vectors, and one writes a row for each vector and component.

Defined results: vectors null, empty or holding null or non-finite entries are left out, as are those of another length than
the most common one (of equally common ones the shortest).  Null ids and repeated rows are vectors of their own.  A component without spread
(an eigenvalue of rounding size: fewer vectors than components, or equal ones) has a null ``whitened`` and takes no part in
``identity_error``, which is null if none does.  Entries beyond +-2**52 count as that.  A ``deviation`` beyond a long is
null.  No vectors, no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
WIDEST = 2.0 ** 52  # entries (times SCALE) are held within this, where doubles are integers
COMPONENTS, ROUNDS = 8, 30
ROWS, TASKS = 4096, 64  # vectors worked on at a time; tasks that merge partial moments
EPS = np.finfo(np.float64).eps
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Moments:
    """Number, exact integer sums, mean and sum of centred products of vectors."""
    n: int
    sums: list[int]
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, y: np.ndarray, sums: list[int]) -> Moments:
        mean = y.mean(0)
        return cls(len(y), sums, mean, (c := y - mean).T @ c)

    def __add__(self, o: Moments) -> Moments:
        n, apart = self.n + o.n, o.mean - self.mean
        products = self.products + o.products + np.outer(apart, apart) * (self.n * o.n / n)
        return Moments(n, [a + b for a, b in zip(self.sums, o.sums)], self.mean + apart * (o.n / n), products)

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([len(self.mean)], pa.int32()), pa.array([self.n], pa.int64()), pa.array([list(map(str, self.sums))], pa.list_(pa.string())),
             pa.array([self.mean.tobytes()], pa.binary()), pa.array([self.products.tobytes()], pa.binary())], MOMENTS)

    @classmethod
    def read(cls, row: dict) -> Moments:
        mean = np.frombuffer(row["mean"])
        return cls(row["n"], [int(s) for s in row["sums"]], mean, np.frombuffer(row["products"]).reshape(len(mean), len(mean)))


MOMENTS = ["dims", "n", "sums", "mean", "products"]
MOMENTS_DDL = "dims int, n long, sums array<string>, mean binary, products binary"


def usable(vector: Column) -> Column:
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & good


def integers(c: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * c), -WIDEST, WIDEST).astype(np.int64) + SHIFT


def _matrices(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, integer matrix) of the vectors of a batch, a matrix for each length that occurs."""
    lists = b.column("v")
    size = np.diff(lists.offsets.to_numpy())
    flat, start = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(size) - size
    for d in np.unique(size).tolist():
        of = np.flatnonzero(size == d)
        for lo in range(0, len(of), ROWS):
            rows = of[lo:lo + ROWS]
            yield rows, integers(flat[start[rows][:, None] + np.arange(d)])


def _sums(x: np.ndarray) -> list[int]:
    """Exact sums of the columns, in two halves that cannot overflow."""
    return [(int(h) << 20) + int(low) for h, low in zip((x >> 20).sum(0), (x & 0xFFFFF).sum(0))]


def _merged(partial: DataFrame) -> list[Moments]:
    """Partial moments of each length of vector, merged by ``TASKS`` tasks and then by one (of ``TASKS`` rows a length)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for b in batches:
            for row in b.to_pylist():
                m = Moments.read(row)
                held[row["dims"]] = held[row["dims"]] + m if row["dims"] in held else m
        yield from (m.batch() for m in held.values())

    for tasks in (TASKS, 1):
        partial = partial.repartition(tasks).mapInArrow(run, MOMENTS_DDL)
    return [Moments.read(r.asDict()) for r in partial.collect()]


def moments(vectors: DataFrame) -> Moments | None:
    """Moments of the integer vectors ``v`` of the most common length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for b in batches:
            for _, x in _matrices(b):
                m, d = Moments.of(x.astype(np.float64), _sums(x)), x.shape[1]
                held[d] = held[d] + m if d in held else m
        yield from (m.batch() for m in held.values())

    found = _merged(vectors.select("v").mapInArrow(run, MOMENTS_DDL))
    return min(found, key=lambda m: (-m.n, len(m.mean)), default=None)


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    scale = np.abs(a).max() if a.size else 0.0
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    solved, last = False, np.inf
    for _ in range(ROUNDS):
        x, values, width, change = _corrected(a, x)
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        if change > np.sqrt(EPS):  # what is far from its end says little about clusters
            continue
        if solved and (change <= 16 * EPS * len(a) or change > last / 2):  # rounding over a small gap is all that is left
            break
        for cluster in _clusters(values, width):
            x[:, cluster] = _sub_solved(a, x[:, cluster])
        solved, last = True, change
    for _ in range(2):  # unit and orthogonal to the last digit
        x = x + x @ (np.eye(len(a)) - x.T @ x) / 2
    return np.einsum("ij,ij->j", x, a @ x) * scale, x


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One step of Ogita and Aishima: the better vectors, their values, the width below which values are not told apart, and the change."""
    short, s = np.eye(len(a)) - x.T @ x, x.T @ a @ x
    values = np.diag(s) / (1 - np.diag(short))
    width = 2 * (np.linalg.norm(s - np.diag(values), 2) + np.linalg.norm(a, 2) * np.linalg.norm(short, 2))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > width
    e = np.where(apart, (s + values[None, :] * short) / np.where(apart, gap, 1.0), short / 2)
    return x + x @ e, values, width, float(np.abs(e).max())


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Runs of two or more of the falling values whose neighbours are within ``width``."""
    cuts = np.flatnonzero(values[:-1] - values[1:] > width) + 1
    return [c for c in np.split(np.arange(len(values)), cuts) if len(c) > 1]


def _sub_solved(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The cluster's vectors turned to the eigenvectors of the matrix less the cluster's mean value, projected on them."""
    inner, s = x.T @ x, x.T @ a @ x
    b = s - np.trace(s) / np.trace(inner) * inner
    size = np.abs(b).max()
    if size <= EPS * EPS:
        return x
    return x @ np.linalg.eigh(((b + b.T) / (2 * size)).astype(np.float32))[1].astype(np.float64)[:, ::-1]


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(n*x - S, exact, and the sums of its squares, null where they pass a long)."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums.tolist())) < 2 ** 63:
        apart = n * x - sums.astype(np.int64)
        if int(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 2 ** 63:
            return apart, pa.array((apart * apart).sum(1), pa.int64())
    apart = n * x.astype(object) - sums
    return apart, pa.array([t if t < 2 ** 63 else None for t in (apart * apart).sum(1)], pa.int64())


def whiten(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id_column, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""
    schema = f"`{id_column}` long, {RESULT}"
    base = rows.filter(usable(F.col(vector_column))).select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    fit = moments(base)
    if fit is None:
        return rows.sparkSession.createDataFrame([], schema)
    n, dims = fit.n, len(fit.mean)
    base = base.filter(F.size("v") == dims)
    covariance = fit.products / n
    values, vectors = eigen(covariance)
    k = min(components, dims)
    total = float(np.trace(covariance))
    spread = values[:k] > dims * EPS * max(abs(total), EPS)
    turn = vectors[:, :k] / np.sqrt(np.where(spread, values[:k], 1.0))
    explained = values[:k] / total if total > 0 else np.zeros(k)
    sums = np.array(fit.sums, dtype=object)
    mean = np.array([float(Fraction(s, n)) for s in fit.sums])

    def projected(x: np.ndarray, apart: np.ndarray | None = None) -> np.ndarray:
        return (x - mean if apart is None else (apart / n).astype(np.float64)) @ turn

    def spreads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            for _, x in _matrices(b):
                m = Moments.of(projected(x), [])
                held = held + m if held else m
        if held:
            yield held.batch()

    measured = _merged(base.select("v").mapInArrow(spreads, MOMENTS_DDL))[0]
    off = np.abs(measured.products / n - np.eye(k))[np.ix_(spread, spread)]
    error = float(off.max()) if off.size else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in _matrices(b):
                apart, deviation = _deviation(x, n, sums)
                m, each = len(at), np.repeat(np.arange(len(at)), k)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(at[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                     deviation.take(pa.array(each)), pa.array(projected(x, apart).ravel(), mask=np.tile(~spread, m)), pa.array(np.tile(explained, m)),
                     pa.array([error] * (m * k), pa.float64())], [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return base.mapInArrow(run, schema)
