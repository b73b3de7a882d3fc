"""Embedding whitening: leading principal components by spectrum slicing.

Entries become whole numbers, ``x = floor(64 * c) + 1000000``. The mean and the covariance are taken
over the *fit list*, each distinct x vector once. The covariance (one small square matrix, whose size
the dimension sets) is sliced: by Sylvester's law the LDLᵀ factorization of ``V - s*I`` has as many
positive pivots as V has eigenvalues above ``s``, so bisection on such counts isolates the k-th
eigenvalue; Rayleigh quotient iteration, which converges cubically, then finds it and its vector,
and two more counts certify that it is the k-th.

At scale: one shuffle, which makes vectors distinct (equal ones meet in their own task first);
sums and products are taken in blocks inside the tasks, and only sums of one small matrix a task
travel. Every row is projected where it lies.

Defined cases: rows whose vector is null or empty, holds null or non-finite entries, or whole
numbers beyond a long, take no part; nor do vectors of another length than the commonest (of
equally common lengths the shortest counts). Components whose eigenvalue is not above rounding
(as for a single distinct vector) are not returned, so an empty table gives no row. A deviation
beyond a long is null. Repeated rows and null ids keep their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.sizing import store

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
_LARGEST = float(1 << 62)


# --- eigenvalues --------------------------------------------------------------


def positive_pivots(matrix: np.ndarray) -> int:
    """The number of positive eigenvalues of a symmetric matrix, as LDLᵀ with pivots of one or two
    rows (chosen after Bunch and Kaufman) shows it."""
    a, k, found = np.array(matrix, np.float64), 0, 0
    size, alpha = len(a), (1 + 17**0.5) / 8
    while k < size:
        column = np.abs(a[k + 1 :, k])
        largest = column.max(initial=0.0)
        own, two = abs(a[k, k]), False
        if own < alpha * largest:
            r = k + 1 + int(column.argmax())
            others = np.abs(a[k:, r])
            others[r - k] = 0
            widest = others.max()
            if own * widest < alpha * largest**2:
                two = abs(a[r, r]) < alpha * widest
                to = k + 1 if two else k
                if to != r:
                    a[[to, r], k:] = a[[r, to], k:]
                    a[k:, [to, r]] = a[k:, [r, to]]
        if two:
            found += 1  # such a pair of rows has one eigenvalue of each sign
            pair, below = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= below @ np.linalg.solve(pair, below.T)
            k += 2
        else:
            pivot = a[k, k]
            if pivot != 0:
                found += pivot > 0
                below = a[k + 1 :, k]
                a[k + 1 :, k + 1 :] -= np.outer(below, below / pivot)
            k += 1
    return int(found)


class _Slices:
    """Counts of eigenvalues above a shift, and the narrowest known interval of each."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.identity = matrix, np.eye(len(matrix))
        self.bound = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
        self.grain = np.finfo(np.float64).eps * self.bound * max(len(matrix), 1)
        self.known: dict[float, int] = {}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = positive_pivots(self.matrix - shift * self.identity)
        return self.known[shift]

    def interval(self, number: int) -> tuple[float, float]:
        """Shifts around eigenvalue ``number`` (from 1, falling), the closest counted so far."""
        low = max((s for s, n in self.known.items() if n >= number), default=-self.bound - self.grain)
        high = min((s for s, n in self.known.items() if n < number), default=self.bound + self.grain)
        return low, high

    def halve(self, number: int) -> tuple[float, float]:
        low, high = self.interval(number)
        self.above((low + high) / 2)
        return self.interval(number)


def _polish(slices: _Slices, shift: float, earlier: np.ndarray, number: int) -> tuple[float, np.ndarray]:
    """Inverse iteration from ``shift``, then Rayleigh quotient iteration, apart from ``earlier`` vectors."""
    v, identity = slices.matrix, slices.identity
    vector = np.random.default_rng(number).standard_normal(len(v))
    value = shift
    for step in range(14):
        vector = vector - earlier @ (earlier.T @ vector)
        vector /= np.linalg.norm(vector)
        if step >= 3:
            value = float(vector @ v @ vector)
            if np.linalg.norm(v @ vector - value * vector) <= slices.grain / 4:
                break
        try:
            vector = np.linalg.solve(v - value * identity, vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            vector = np.linalg.solve(v - (value + slices.grain) * identity, vector)
    vector = vector - earlier @ (earlier.T @ vector)
    vector /= np.linalg.norm(vector)
    return float(vector @ v @ vector), vector


def _certified(slices: _Slices, value: float, vector: np.ndarray, number: int) -> tuple[float, np.ndarray] | None:
    """The pair, if counts on both sides of the value say that it is eigenvalue ``number``."""
    margin = 4 * slices.grain
    good = slices.above(value + margin) < number <= slices.above(value - margin)
    return (value, vector) if good else None


def leading(matrix: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues above rounding, falling, and their unit vectors as columns
    (the largest entry of each positive). Each number is certified by counts on both sides."""
    slices = _Slices(matrix)
    values, vectors = [], np.zeros((len(matrix), 0))
    for number in range(1, min(count, slices.above(slices.grain)) + 1):
        low, high = slices.interval(number)
        found = None
        while found is None and high - low > slices.grain:
            if slices.above(low) == number and slices.above(high) == number - 1:
                found = _certified(slices, *_polish(slices, (low + high) / 2, vectors, number), number)
            if found is None:
                low, high = slices.halve(number)
        if found is None:  # as good as equal to its neighbour: any vector of their common space will do
            found = _certified(slices, *_polish(slices, (low + high) / 2, vectors, number), number)
        if found is None:
            raise ArithmeticError(f"eigenvalue {number} is not certified by its counts")
        value, vector = found
        values.append(value)
        sign = 1.0 if vector[np.abs(vector).argmax()] >= 0 else -1.0
        vectors = np.column_stack([vectors, sign * vector])
    return np.array(values), vectors


# --- Spark --------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening; all but ``sums`` and ``basis`` are single numbers."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n``: whole parts are subtracted first, so nothing is lost to rounding."""
        whole = [round(s / self.n) for s in self.sums]
        part = np.array([(s - self.n * w) / self.n for s, w in zip(self.sums, whole, strict=True)])
        return (x - np.array(whole, np.int64)).astype(np.float64) - part

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.eigenvalues))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of ``(n * x - sums) ** 2`` of each row."""
        widest = np.abs(self.n * self.centred(x)).max(initial=0.0) + 1
        if self.n * (np.abs(x).max(initial=0) + 1.0) < _LARGEST and len(self.sums) * widest**2 < _LARGEST:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def quantized(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and the whole numbers ``x`` of the rows that take part."""
    def sound(c):
        size = F.abs(c.cast("double") * SCALE)
        return F.coalesce((size < _LARGEST) & ~F.isnan(size), F.lit(False))

    good = rows.where(F.coalesce(F.forall(vector, sound) & (F.size(vector) > 0), F.lit(False)))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    found = good.select(F.col(vec_id).alias("vec_id"), x.alias("x"))
    common = found.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").head()
    return found.where(F.size("x") == common.d) if common else found


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Column ``x`` as rows of a matrix."""
    column = batch.column("x")
    return column.flatten().to_numpy().reshape(len(column), -1)


def _summed(rows: DataFrame, part) -> dict[int, list]:
    """The sum over all tasks of the lists that ``part`` makes of each batch, by their number."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_matrix(batch))
                total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        if total is not None:
            lists = pa.array([np.asarray(t, np.float64) for t in total], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), lists], ["i", "part"])

    entries = rows.mapInArrow(sums, "i int, part array<double>").select("i", F.posexplode("part").alias("j", "value"))
    out: dict[int, list] = {}
    for r in entries.groupBy("i", "j").agg(F.sum("value").alias("value")).orderBy("i", "j").collect():
        out.setdefault(r.i, []).append(r.value)
    return out


def _exact_sums(rows: DataFrame) -> tuple[int, tuple[int, ...]]:
    """The number of rows and the exact sum of each entry."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            size = len(high)
            columns = [pa.array(range(size), pa.int32()), pa.array([n] * size), pa.array(high), pa.array(low)]
            yield pa.RecordBatch.from_arrays(columns, ["j", "n", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    parts = rows.mapInArrow(sums, "j int, n bigint, high bigint, low bigint")
    found = parts.groupBy("j").agg(F.sum("n").alias("n"), wide("high"), wide("low")).orderBy("j").collect()
    if not found:
        return 0, ()
    return found[0].n, tuple((int(r.high) << 32) + int(r.low) for r in found)


def fit(quantized_rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Mean, leading components and the check of the whitening over the distinct ``x``."""
    distinct = store(quantized_rows.select("x").distinct())
    n, sums = _exact_sums(distinct)
    if n == 0:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, None)
    bare = Whitening(n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0, None)

    def products(x: np.ndarray) -> list[np.ndarray]:
        z = bare.centred(x)
        return list(z.T @ z)

    rows = _summed(distinct.select("x"), products)
    covariance = np.array([rows[i] for i in sorted(rows)]) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading(covariance, components)
    trace = float(np.trace(covariance))
    found = Whitening(n, sums, values, vectors, trace, None)
    if not len(values):
        return found

    def whitened(x: np.ndarray) -> list[np.ndarray]:
        w = found.project(x)
        return [w.sum(axis=0), *(w.T @ w)]

    rows = _summed(distinct.select("x"), whitened)
    mean = np.array(rows[0]) / n
    spread = np.array([rows[i] for i in range(1, len(rows))]) / n - np.outer(mean, mean)
    error = float(np.abs(spread - np.eye(len(values))).max())
    return Whitening(n, sums, values, vectors, trace, error)


def project(quantized_rows: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id``, ``deviation`` and the list ``whitened`` of each row."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                lists = pa.array(list(model.project(x)), pa.list_(pa.float64()))
                columns = [batch.column("vec_id"), pa.array(model.deviations(x), pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "whitened"])

    kind = quantized_rows.schema["vec_id"].dataType.simpleString()
    return quantized_rows.mapInArrow(rows, f"vec_id {kind}, deviation bigint, whitened array<double>")
