"""Whitening of vectors by slicing the spectrum of their covariance.

Entries are put on a fixed-point grid, so that the sums and the sums of products, centred on the whole part of the mean, are
whole numbers: tasks add them up for their own rows, Spark adds up the tasks, and the covariance does not depend on the order
of rows. The driver gets one number for each pair of dimensions, however many rows there are.

The leading eigenvalues are then isolated one by one: the pivots of a factorization L D L' of the covariance less a shift tell
by their signs how many eigenvalues lie above the shift, and intervals are halved until they hold one each. Rayleigh quotient
iteration converges cubically from there, and two more counts certify the number of the eigenvalue found; what leaves its
interval or fails the counts is isolated further. Eigenvalues that cannot be told apart in doubles share an interval and get an
orthonormal basis by inverse iteration together.

Defined cases: a null or empty vector, one with a null or non-finite entry or an entry beyond ``LARGEST``, and one shorter than
the longest of the rest is dropped; without any left there are no rows. A direction without variance (a null space, a single
vector, equal vectors) has no component, so there may be fewer than asked for. Repeated rows and null ids count as rows;
columns other than the named ones are ignored. ``deviation`` is exact; beyond 64 bits (some 10**8 rows) the cast is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of this size and more don't fit the grid.
LARGEST = 2.0**40
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_EPS = float(np.finfo(float).eps)
#: The growth bound of symmetric pivoting with blocks of one and two.
_PIVOT = (1 + 17**0.5) / 8


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: the positive pivots of L D L' of the shifted matrix (Sylvester)."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive = len(a), 0, 0
    while k < n:
        here, below = abs(a[k, k]), np.abs(a[k + 1 :, k])
        most = below.max() if len(below) else 0.0
        size = 1
        if most > 0 and here < _PIVOT * most:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            widest = row.max()
            if here * widest < _PIVOT * most**2:
                size = 1 if abs(a[r, r]) >= _PIVOT * widest else 2
                to = k + size - 1
                a[[to, r]] = a[[r, to]]
                a[:, [to, r]] = a[:, [r, to]]
        if size == 2:  # a block of two has a negative determinant: one pivot of each sign
            positive += 1
            rest = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(a[k : k + 2, k : k + 2], rest.T)
        elif a[k, k] != 0:
            positive += a[k, k] > 0
            rest = a[k + 1 :, k]
            a[k + 1 :, k + 1 :] -= np.outer(rest, rest / a[k, k])
        k += size
    return int(positive)


def _solved(matrix: np.ndarray, shift: float, right: np.ndarray, nudge: float) -> np.ndarray:
    while True:
        try:
            found = np.linalg.solve(matrix - shift * np.eye(len(matrix)), right)
            if np.isfinite(found).all():
                return found
        except np.linalg.LinAlgError:
            pass
        shift, nudge = shift + nudge, 2 * nudge


def _apart(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for q in others:
            x = x - q * (q @ x)
    return x / np.linalg.norm(x)


def leading(matrix: np.ndarray, count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    n = len(matrix)
    count = min(count, n)
    radius = np.abs(matrix).sum(axis=1).max(initial=0.0)
    if not count or radius == 0:
        return np.zeros(count), np.eye(n)[:, :count]
    least = 8 * n * _EPS * radius  # intervals are not halved below this
    rng, values, vectors = np.random.default_rng(seed), [], []
    todo = [(-radius - least, radius + least, 0, n)]  # (low, high, eigenvalues above high, above low); the highest last
    while todo and len(values) < count:
        low, high, before, upto = todo.pop()
        if upto == before:
            continue
        middle = (low + high) / 2
        if upto - before == 1:
            near = [q for v, q in zip(values, vectors, strict=True) if v - high < 1e-3 * radius]
            x = _apart(_solved(matrix, middle, rng.standard_normal(n), least), near)
            value, before_last = middle, np.inf
            for _ in range(12):
                value = float(x @ matrix @ x)
                off = float(np.linalg.norm(matrix @ x - value * x))
                if off <= 4 * _EPS * radius or off >= before_last:
                    break
                before_last = off if off < 1e-8 * radius else np.inf  # no better than rounding allows
                x = _apart(_solved(matrix, value, x, least), near)
            if low - least <= value <= high + least and off <= least and above(matrix, value + least) <= before and above(matrix, value - least) >= upto:
                values.append(value)
                vectors.append(x)
                continue
        if high - low <= 2 * least:  # a cluster: any orthonormal basis of its space
            own = rng.standard_normal((n, upto - before))
            for _ in range(3):
                own = _solved(matrix, middle, own, least)
                for k in range(own.shape[1]):
                    own[:, k] = _apart(own[:, k], vectors + [own[:, j] for j in range(k)])
            for k in range(own.shape[1]):
                values.append(float(own[:, k] @ matrix @ own[:, k]))
                vectors.append(own[:, k])
            continue
        k = above(matrix, middle)
        todo += [(low, middle, k, upto), (middle, high, before, k)]
    values, vectors = np.asarray(values[:count]), np.stack(vectors[:count], axis=1)
    heaviest = vectors[np.abs(vectors).argmax(axis=0), np.arange(count)]
    return values, vectors * np.where(heaviest < 0, -1.0, 1.0)


@dataclass(frozen=True)
class Whitening:
    """What is fitted to all vectors. ``sums`` and ``centre`` are whole numbers on the grid."""

    scale: int
    offset: int
    n: int
    sums: tuple[int, ...]
    centre: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)


def _valid(vector: F.Column) -> F.Column:
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < LARGEST)), F.lit(False))  # NaN is greater than all


def _grid(batch: pa.RecordBatch, name: str, dim: int, scale: int, offset: int) -> np.ndarray:
    """The batch's vectors, all of them valid, as rows of whole numbers."""
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * flat.astype(np.float64)).astype(np.int64).reshape(-1, dim) + offset


def _products(x: np.ndarray) -> np.ndarray:
    """x'x, exact: in doubles while all sums are below 2**53, else in unbounded whole numbers."""
    most = int(np.abs(x).max(initial=0))
    if most * most * max(1, len(x)) < 1 << 53:
        return (x.astype(np.float64).T @ x.astype(np.float64)).astype(np.int64).astype(object)
    x = x.astype(object)
    return x.T @ x


def _added(rows: DataFrame, run, names: tuple[str, ...]) -> list:
    """Whole numbers of each task, as text of any length, added up by ``names``."""
    schema = ", ".join(f"{n} int" for n in names) + ", part string"
    return rows.mapInArrow(run, schema).groupBy(*names).agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()


def fit(vectors: DataFrame, components: int = 32, vec_col: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> Whitening | None:
    """Fit to all valid vectors of the greatest length, each entry c as floor(scale * c) + offset. None if there are none."""
    every = vectors.select(F.col(vec_col).cast("array<double>").alias("v")).filter(_valid(F.col("v")))
    dim = every.agg(F.max(F.size("v")).alias("d")).first()["d"]
    if not dim:
        return None
    own = every.filter(F.size("v") == dim)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim, object), 0
        for batch in batches:
            x = _grid(batch, "v", dim, scale, offset)
            n += len(x)
            total += x.sum(axis=0) if len(x) < 1 << 12 else x.astype(object).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()), pa.array([str(v) for v in (n, *total)], pa.string())], ["i", "part"])

    got = {r["i"]: int(r["total"]) for r in _added(own, sums, ("i",))}
    n = got.pop(-1)
    total = [got[i] for i in range(dim)]
    centre = [s // n for s in total]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((dim, dim), object)
        some = False
        for batch in batches:
            found, some = found + _products(_grid(batch, "v", dim, scale, offset) - np.asarray(centre)), True
        if some:
            i, j = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v) for v in found[i, j]], pa.string())], ["i", "j", "part"])

    off = [s - n * c for s, c in zip(total, centre, strict=True)]
    covariance = np.zeros((dim, dim))
    for r in _added(own, products, ("i", "j")):
        i, j = r["i"], r["j"]
        covariance[i, j] = covariance[j, i] = float(Fraction(n * int(r["total"]) - off[i] * off[j], n * n))
    values, basis = leading(covariance, components)
    keep = values > 64 * dim * _EPS * max(values[0], 0.0) if len(values) else values > 0
    return Whitening(scale, offset, n, tuple(total), tuple(centre), values[keep], basis[:, keep], float(np.trace(covariance)))


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Rows on the grid, less the mean, on the components, each with variance one."""
    off = np.asarray([(s - model.n * c) / model.n for s, c in zip(model.sums, model.centre, strict=True)])
    return ((x - np.asarray(model.centre)) - off) @ (model.vectors / np.sqrt(model.values))


def _deviations(x: np.ndarray, model: Whitening) -> list[int]:
    """sum((n x - sums)**2) of each row, exact."""
    off = np.asarray([s - model.n * c for s, c in zip(model.sums, model.centre, strict=True)], object)
    x = x - np.asarray(model.centre)
    most = int(np.abs(x).max(initial=0)) * model.n + int(max(off, default=0))
    if most * most * model.dim < 1 << 62:
        return ((model.n * x - off.astype(np.int64)) ** 2).sum(axis=1).tolist()
    return ((model.n * x.astype(object) - off) ** 2).sum(axis=1).tolist()


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened rows' covariance less the identity, measured over all rows."""
    k = len(model.values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, some = np.zeros((k + 1, k)), False
        for batch in batches:
            y = _whitened(_grid(batch, "v", model.dim, model.scale, model.offset), model)
            found, some = found + np.concatenate((y.T @ y, y.sum(axis=0)[None])), True
        if some:
            i, j = np.indices(found.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(found.ravel())], ["i", "j", "part"])

    total = np.zeros((k + 1, k))
    for r in rows.select("v").mapInArrow(moments, "i int, j int, part double").groupBy("i", "j").agg(F.sum("part").alias("total")).collect():
        total[r["i"], r["j"]] = r["total"] / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max(initial=0.0))


def whiten(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), one for each valid vector and component."""
    spark = vectors.sparkSession
    if model is None or not len(model.values):
        return spark.createDataFrame([], _OUT)
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(_valid(F.col("v")) & (F.size("v") == model.dim))
    error, k = identity_error(rows, model), len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _grid(batch, "v", model.dim, model.scale, model.offset)
            each = np.repeat(np.arange(len(x)), k)
            columns = [
                batch.column("id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), model.n, np.int64)),
                pa.array(_deviations(x, model), pa.int64()).take(pa.array(each)),
                pa.array(_whitened(x, model).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _OUT.split(", ")])

    return rows.mapInArrow(run, _OUT)
