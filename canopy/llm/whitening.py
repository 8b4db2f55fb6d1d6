"""Whitening of embeddings along their leading components, by spectrum slicing.

The sums and the covariance are Spark aggregates; the driver holds one
d x d matrix V (d: vector length).  The number of eigenvalues of V above a
shift s is the number of positive pivots of the LDL' factorisation of V - sI
(Sylvester's law of inertia).  Bisecting shifts by these counts isolates the
k-th largest eigenvalue in an interval of its own; inverse iteration from
there and Rayleigh quotient iteration converge to its vector (cubically), and
counts on both sides of each quotient certify that it is number k.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import workers_ready, written

COMPONENTS = 8
#: An entry c is worked with as the integer floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries whose integer is beyond this cannot be a long and count as non-finite.
LARGEST = 2.0 ** 62
EPS = np.finfo(float).eps


class Component(NamedTuple):
    value: float
    vector: np.ndarray
    residual: float


# ---- spectrum slicing (driver, one d x d matrix) -----------------------------------

def positive_pivots(a: np.ndarray) -> int:
    """Number of positive eigenvalues of a symmetric matrix, from LDL' with 1 x 1 and 2 x 2 pivots (Bunch-Kaufman)."""
    a, count, alpha = a.copy(), 0, (1 + 17 ** 0.5) / 8
    while len(a):
        column = np.abs(a[1:, 0])
        size, width = abs(a[0, 0]), 1
        if len(column) and column.max() > 0:
            r = int(column.argmax()) + 1
            off, swap = column[r - 1], None
            if size < alpha * off:
                row = np.abs(a[r])
                row[r] = 0
                if size * row.max() < alpha * off * off:
                    width, swap = (1, 0) if abs(a[r, r]) >= alpha * row.max() else (2, 1)
            if swap is not None and swap != r:
                a[[swap, r]] = a[[r, swap]]
                a[:, [swap, r]] = a[:, [r, swap]]
        rest = a[width:, :width]
        if width == 2:  # such a pivot block has one eigenvalue of each sign
            count += 1
            a = a[2:, 2:] - rest @ np.linalg.solve(a[:2, :2], rest.T)
        else:
            count += bool(a[0, 0] > 0)
            a = a[1:, 1:] - (rest @ rest.T / a[0, 0] if a[0, 0] else 0.0)
    return count


class Slices:
    """Inertia counts of V, kept by shift."""

    def __init__(self, v: np.ndarray):
        self.v = v
        self.norm = float(np.abs(v).sum(axis=1).max())
        self.tiny = 64 * len(v) * EPS * self.norm
        edge = self.norm + self.tiny
        self.counts = {edge: 0, -edge: len(v)}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = positive_pivots(self.v - shift * np.eye(len(self.v)))
        return self.counts[shift]

    def bracket(self, k: int, width: float) -> tuple[float, float]:
        """(low, high) with number k between: isolated and no wider than ``width``, or as narrow as counts can tell."""
        low = max(s for s, c in self.counts.items() if c >= k)
        high = min(s for s, c in self.counts.items() if c < k)
        while high - low > self.tiny and (self.above(low) > k or self.above(high) < k - 1 or high - low > width):
            mid = (low + high) / 2
            if self.above(mid) >= k:
                low = mid
            else:
                high = mid
        return low, high


def _iterate(v: np.ndarray, shift: float, found: list[Component], seed: int, tiny: float) -> Component:
    """Inverse iteration at ``shift``, then Rayleigh quotient iteration, orthogonal to the vectors ``found``."""
    eye, basis = np.eye(len(v)), np.array([c.vector for c in found]).reshape(-1, len(v))

    def unit(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x / np.linalg.norm(x)
            x = x - basis.T @ (basis @ x)
        return x / np.linalg.norm(x)

    def solved(x: np.ndarray, s: float) -> np.ndarray:
        while True:
            try:
                y = np.linalg.solve(v - s * eye, x)
                if np.isfinite(y).all():
                    return unit(y)
            except np.linalg.LinAlgError:
                pass
            s += tiny / 16  # exactly an eigenvalue: a step beside it

    def state(x: np.ndarray) -> Component:
        value = float(x @ v @ x)
        return Component(value, x, float(np.linalg.norm(v @ x - value * x)))

    x = unit(np.random.default_rng(seed).normal(size=len(v)))
    for _ in range(3):
        x = solved(x, shift)
    best = state(x)
    for _ in range(20):
        new = state(solved(best.vector, best.value))
        if new.residual >= best.residual:
            return best
        best = new
    return best


def leading_components(v: np.ndarray, components: int = COMPONENTS) -> list[Component]:
    """The largest eigenvalues of a covariance with unit vectors, by falling value; values that are zero but for rounding are left out.

    Equal eigenvalues come with orthogonal vectors of their space.  A vector's entry of largest size is positive.
    """
    slices, found = Slices(v), []
    for k in range(1, min(components, len(v)) + 1):
        if not slices.norm or slices.above(len(v) * EPS * slices.norm) < k:
            break
        width = slices.norm
        while True:
            low, high = slices.bracket(k, width)
            c = _iterate(v, (low + high) / 2, found, k, slices.tiny)
            around = slices.tiny + 2 * c.residual
            if slices.above(c.value + around) < k <= slices.above(c.value - around):
                break
            if high - low <= slices.tiny:
                raise ArithmeticError(f"component {k} was not found between {low} and {high}")
            width = (high - low) / 4
        sign = 1.0 if c.vector[np.abs(c.vector).argmax()] > 0 else -1.0
        found.append(c._replace(vector=sign * c.vector))
    return found


# ---- Spark jobs ---------------------------------------------------------------------

def _entries(column: pa.Array, width: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, integers) of the usable vectors of a batch, one length at a time (only ``width`` if given)."""
    sizes = column.value_lengths().fill_null(0).to_numpy()
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    start = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    for d in ([width] if width else np.unique(sizes[sizes > 0])):
        rows = np.flatnonzero(sizes == d)
        c = np.floor(SCALE * flat[start[rows][:, None] + np.arange(d)])
        with np.errstate(invalid="ignore"):
            good = (np.abs(c) < LARGEST).all(axis=1)
        if good.any():
            yield int(d), rows[good], c[good].astype(np.int64) + SHIFT


class Moments(NamedTuple):
    """Length of the vectors, their number and the exact sums of their integers."""

    width: int
    n: int
    sums: list[int]

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as long integers where they fit, as Python's otherwise."""
        largest = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums)))
        if largest >= 1 << 62:
            return self.n * x.astype(object) - np.array(self.sums, object)
        return self.n * x - np.array(self.sums, np.int64)


def moments(vectors: DataFrame) -> Moments | None:
    """Moments of the usable ones of ``vectors`` (vector); of several lengths the commonest counts (ties: the longest).  None: no usable row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for b in batches:
            for d, _, x in _entries(b["vector"]):
                n, high, low = held.get(d, (0, 0, 0))  # in two halves: neither sum leaves a long
                held[d] = n + len(x), high + (x >> 31).sum(axis=0), low + (x & 0x7FFFFFFF).sum(axis=0)
        for d, (n, high, low) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                                              pa.array(high), pa.array(low)], ["width", "at", "n", "high", "low"])

    each = vectors.select("vector").mapInArrow(run, "width int, at int, n bigint, high bigint, low bigint")
    sums = written(each.groupBy("width", "at").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]), "sums")
    best = sums.where("at = 0").orderBy(F.desc("n"), F.desc("width")).first()
    if best is None:
        return None
    rows = sums.where(F.col("width") == best.width).orderBy("at").collect()
    return Moments(best.width, best.n, [(r.high << 31) + r.low for r in rows])


def covariance(vectors: DataFrame, m: Moments) -> np.ndarray:
    """Covariance of the integers of the usable vectors: centred, multiplied, summed per task, then per row of the matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m.width, m.width))
        for b in batches:
            for _, _, x in _entries(b["vector"], m.width):
                c = m.numerators(x).astype(float) / m.n
                total += c.T @ c
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(m.width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["at", "products"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for at, row in zip(b["at"].to_pylist(), b["products"], strict=True):
                held[at] = held.get(at, 0.0) + row.values.to_numpy()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], ["at", "products"])

    schema = "at int, products array<double>"
    partial = vectors.select("vector").mapInArrow(run, schema).withColumn("part", F.spark_partition_id())
    rows = partial.repartition("at").sortWithinPartitions("at", "part").select("at", "products").mapInArrow(add, schema).collect()
    out = np.zeros((m.width, m.width))
    for r in rows:
        out[r.at] = r.products
    out = (out + out.T) / 2
    return out / m.n


def _decimals(values: np.ndarray) -> pa.Array:
    if values.dtype == object:
        return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))
    return pa.array(values).cast(pa.decimal128(38, 0))


def projected(vectors: DataFrame, m: Moments, found: list[Component]) -> DataFrame:
    """(id, deviation, whitened) of the usable ones of ``vectors`` (id, vector); deviation is decimal(38, 0)."""
    axes = np.array([c.vector / c.value ** 0.5 for c in found]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, rows, x in _entries(b["vector"], m.width):
                top = m.numerators(x)
                wide = top.dtype == object or int(np.abs(top).max()) ** 2 * d >= 1 << 63
                squares = (top.astype(object) ** 2 if wide else top * top).sum(axis=1)
                z = top.astype(float) / m.n @ axes
                yield pa.RecordBatch.from_arrays([b["id"].take(pa.array(rows)), _decimals(squares), pa.array(list(z), pa.list_(pa.float64()))],
                                                 ["id", "deviation", "whitened"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` (k entries) minus the identity, centred at its own mean."""
    z = [F.get("whitened", F.lit(i)) for i in range(k)]
    mean = rows.agg(*[F.avg(c) for c in z]).first()
    c = [x - F.lit(mean[i]) for i, x in enumerate(z)]
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    cov = rows.agg(*[F.avg(c[i] * c[j]) for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(cov, pairs, strict=True))


def whiten(table: DataFrame, id_col: str, vector_col: str, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error.

    A vector that is null, empty, or holds null or non-finite entries (or
    entries too large for a long) is dropped, and so is one that has not the
    commonest length of the table.  Every other row counts, repeated ones each.
    Components whose eigenvalue is zero but for rounding cannot be whitened
    and have no rows; so a table of one vector, like an empty one, gives no rows.
    Other columns are not read, so their names cannot clash.  deviation is
    decimal(38, 0), exact at any n.
    """
    spark = table.sparkSession
    workers_ready(spark)
    vectors = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    columns = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    m = moments(vectors)
    v = covariance(vectors, m) if m else None
    found = leading_components(v, components) if m else []
    if not found:
        kind = vectors.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")
    rows = written(projected(vectors, m, found), "whitened")
    explained = F.array(*[F.lit(c.value / float(np.trace(v))) for c in found])
    each = rows.select("id", "deviation", F.posexplode(F.arrays_zip("whitened", explained.alias("explained"))).alias("at", "c"))
    return each.select("id", (F.col("at") + 1).alias("component"), F.lit(m.n).cast("long").alias("n"), "deviation",
                       F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"),
                       F.lit(identity_error(rows, len(found))).alias("identity_error")).select(*columns)
