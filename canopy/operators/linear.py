"""Linear regression by full-batch gradient descent.

For squared loss the full-batch gradient depends on the data only through
the moments  n, sum z, sum y, sum z z^T, sum z y.  So training is ONE
aggregate over one scan (partial sums combine in the tasks; the result is
k^2 + 2k + 2 numbers) followed by ``steps`` updates on those k x k numbers
on the driver -- instead of one pass over the data per iteration.  Only for
more than GRAM_COLUMNS features are the rows kept and read once per step.

Update rule (plain gradient descent with decaying step, no regularisation):
    eta_t = step / sqrt(t),  t = 1..steps
    g_j   = mean((w.z + b - y) * z_j),   g_b = mean(w.z + b - y)
    w    -= eta_t * g,       b -= eta_t * g_b
Start: w = 0, b = 1.0 (the intercept slot of the weight vector starts at 1).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.functions.exact import Term, exact_totals, exact_values, products
from canopy.operators.scaling import Standardizer, fit_standardizer, mean_and_std, standardize
from canopy.session import ship_package


@dataclass(frozen=True)
class LinearModel:
    cols: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float
    dropped: int = 0        # training rows without a value or a label


#: Columns up to which every moment is an exact sum of its own.
EXACT_COLUMNS = 24
#: Columns up to which the k x k moments are gathered; wider tables are descended by gradients.
GRAM_COLUMNS = 4096


def _whole(df: DataFrame, cols: Sequence[str], label: str) -> tuple[DataFrame, list[str]]:
    """(features and label as doubles, NULL in every one where a row misses one; their names)."""
    names = [f"__m{i}" for i in range(len(cols) + 1)]
    rows = df.select(*[F.col("`" + c.replace("`", "``") + "`").cast("double").alias(n) for c, n in zip([*cols, label], names)])
    return rows, names


def moments(df: DataFrame, cols: Sequence[str], label: str = "label") -> dict:
    """n, dropped, sum z_i, sum y, sum z_i z_j, sum z_i y, from ONE aggregate over ONE scan.

    Rows with a missing feature or label take no part; ``dropped`` counts
    them.  Up to EXACT_COLUMNS the products are summed exactly, so the model is
    the same on any partitioning.  Beyond, every task adds up the Gramian of
    its rows block by block and the tasks' matrices are added by matrix row.
    """
    cols = list(cols)
    k = len(cols)
    ship_package(df.sparkSession)
    rows, names = _whole(df, cols, label)
    if k <= EXACT_COLUMNS:
        pairs = [(i, j) for i in range(k + 2) for j in range(i, k + 2)]

        def terms(*columns) -> list[Term]:
            *z, missing = columns
            gone = np.logical_or.reduce(missing)
            z.append(np.ones(len(gone)))
            return [("rows", z[-1]), *[(f"{i},{j}", np.ma.array(z[i] * z[j], mask=gone)) for i, j in pairs]]

        found = exact_totals(rows, [], names, terms).first()
        v = {n: float(x) for n, x in exact_values(found["totals"]).items()} if found else {}
        g = [[v.get(f"{min(i, j)},{max(i, j)}", 0.0) for j in range(k + 2)] for i in range(k + 2)]
        total = round(v.get("rows", 0.0))
    else:
        whole = F.expr(" AND ".join(f"{n} IS NOT NULL" for n in names))
        g, total = _gramian(rows.select(F.when(whole, F.array(*names, F.lit(1.0))).alias("z")), k + 2)
    n = round(g[k + 1][k + 1])
    return {"n": n, "dropped": total - n, "sy": g[k][k + 1], "sz": g[k + 1][:k], "szy": g[k][:k],
            "szz": [row[:k] for row in g[:k]]}


def _matrices(column: pa.Array, k: int) -> np.ndarray:
    """The rows of a batch that are not NULL, as a matrix."""
    kept = column.drop_null()
    return kept.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _added(parts: DataFrame) -> list[list[float]]:
    """The rows ``values`` of the tasks' ``parts`` (at, values), added up by ``at`` in the order of the tasks."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for at, row in zip(b["at"].to_pylist(), b["values"]):
                held[at] = held.get(at, 0.0) + row.values.to_numpy()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], ["at", "values"])

    by_row = parts.withColumn("part", F.spark_partition_id()).repartition("at").sortWithinPartitions("at", "part").select("at", "values")
    return [r["values"] for r in sorted(by_row.mapInArrow(add, "at int, values array<double>").collect())]


def _gramian(rows: DataFrame, k: int) -> tuple[list[list[float]], int]:
    """(sum of z z', number of rows with those whose z is NULL) of ``rows`` (z: k doubles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((k, k)), 0
        for b in batches:
            m = _matrices(b["z"], k)
            total += m.T @ m
            seen += b.num_rows
        if seen:
            values = [*total, np.full(1, float(seen))]
            yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array(values, pa.list_(pa.float64()))], ["at", "values"])

    found = _added(rows.mapInArrow(run, "at int, values array<double>"))
    return ([list(r) for r in found[:k]], round(found[k][0])) if found else ([[0.0] * k for _ in range(k)], 0)


def descend_by_gradients(rows: DataFrame, k: int, steps: int, step: float, intercept: bool, tol: float) -> tuple[list[float], float, int]:
    """(weights, intercept, dropped rows): the updates of ``descend`` with one pass per step, for k too large for k x k numbers.

    rows: z = features, label.  A task sends k + 3 numbers per step.
    """
    w, b, n, seen = np.zeros(k), 1.0 if intercept else 0.0, 0, 0
    for t in range(1, steps + 1):
        def run(batches: Iterator[pa.RecordBatch], w=w, b=b) -> Iterator[pa.RecordBatch]:
            g = np.zeros(k + 3)  # gradient, that of the intercept, rows, rows with those dropped
            for batch in batches:
                m = _matrices(batch["z"], k + 1)
                off = m[:, :k] @ w + b - m[:, k]
                g[:k] += off @ m[:, :k]
                g[k:] += off.sum(), len(m), batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([g], pa.list_(pa.float64()))], ["at", "values"])

        found = _added(rows.mapInArrow(run, "at int, values array<double>"))
        g = np.array(found[0]) if found else np.zeros(k + 3)
        n, seen = round(g[k + 1]), round(g[k + 2])
        if n == 0:
            raise ValueError("no training rows")
        eta = step / math.sqrt(t)
        new_w, new_b = w - eta * (g[:k] / n), b - eta * (g[k] / n) if intercept else b
        moved = math.sqrt(((new_w - w) ** 2).sum() + (new_b - b) ** 2)
        w, b = new_w, float(new_b)
        if tol > 0.0 and moved < tol * max(math.sqrt((w ** 2).sum() + b * b), 1.0):
            break
    return w.tolist(), b, seen - n


def descend(m: dict, steps: int = 100, step: float = 0.1, intercept: bool = True,
            tol: float = 0.0) -> tuple[list[float], float]:
    """Run the updates on the moments (driver, O(steps * k^2))."""
    k = len(m["sz"])
    n = float(m["n"])
    if n == 0:
        raise ValueError("no training rows")
    w = [0.0] * k
    b = 1.0 if intercept else 0.0
    szz, sz, szy = np.array(m["szz"]).reshape(k, k), np.array(m["sz"]), np.array(m["szy"])
    w = np.array(w)
    for t in range(1, steps + 1):
        g = (szz.T @ w + b * sz - szy) / n
        gb = (float(w @ sz) + b * n - m["sy"]) / n if intercept else 0.0
        eta = step / math.sqrt(t)
        new_w, new_b = w - eta * g, b - eta * gb
        moved = math.sqrt(float(((new_w - w) ** 2).sum()) + (new_b - b) ** 2)
        w, b = new_w, new_b
        if tol > 0.0 and moved < tol * max(math.sqrt(float((w ** 2).sum()) + b * b), 1.0):
            break
    w = w.tolist()
    return w, b


def linear_sgd(df: DataFrame, cols: Sequence[str], label: str = "label", steps: int = 100,
               step: float = 0.1, intercept: bool = True, tol: float = 0.0) -> LinearModel:
    """M7: fit on (already standardised) features: from the moments, or beyond GRAM_COLUMNS features by a pass per step."""
    cols = list(cols)
    ship_package(df.sparkSession)
    if len(cols) > GRAM_COLUMNS:
        rows, names = _whole(df, cols, label)
        whole = F.expr(" AND ".join(f"{n} IS NOT NULL" for n in names))
        rows = rows.select(F.when(whole, F.array(*names)).alias("z")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            w, b, dropped = descend_by_gradients(rows, len(cols), steps, step, intercept, tol)
            return LinearModel(tuple(cols), tuple(w), b, dropped)
        finally:
            rows.unpersist()
    m = moments(df, cols, label)
    w, b = descend(m, steps, step, intercept, tol)
    return LinearModel(tuple(cols), tuple(w), b, m["dropped"])


def scaled_linear_sgd(df: DataFrame, cols: Sequence[str], label: str = "label", steps: int = 100, step: float = 0.1,
                      intercept: bool = True, tol: float = 0.0) -> tuple[Standardizer, LinearModel]:
    """M11 + M7 from ONE scan: the standardiser of ``cols`` and the model on the features it scales.

    The exact sums of the raw values give both: the moments of z = (x - mean) / std
    follow from those of x without rounding.  As in two steps, the standardiser
    sees every value of a feature, the model only rows without a missing one.
    Beyond EXACT_COLUMNS features the two steps are taken.
    """
    cols = list(cols)
    k = len(cols)
    if k > EXACT_COLUMNS:
        stats = fit_standardizer(df, cols)
        return stats, linear_sgd(standardize(df, stats), cols, label, steps, step, intercept, tol)
    rows, names = _whole(df, cols, label)
    pairs = [(i, j) for i in range(k) for j in range(i, k + 1)]

    def terms(*columns) -> list[Term]:
        *xs, missing = columns
        gone = np.logical_or.reduce(missing)
        one = np.ones(len(gone))
        own = [(name, x, missing[i]) for i in range(k) for name, x in ((f"n{i}", one), (f"s{i}", xs[i]), *products(f"q{i}", xs[i], xs[i]))]
        whole = [(name, x, gone) for name, x in (("whole", one), *[(f"c{i}", x) for i, x in enumerate(xs)],
                                                *[t for i, j in pairs for t in products(f"c{i},{j}", xs[i], xs[j])])]
        return [("rows", one), *[(name, np.ma.array(x, mask=mask)) for name, x, mask in own + whole]]

    found = exact_totals(rows, [], names, terms).first()
    v = exact_values(found["totals"]) if found else {}
    n = int(v.get("whole", 0))
    if n == 0:
        raise ValueError("no training rows")
    if any(isinstance(x, float) for x in v.values()):
        raise ValueError("training values must be finite")
    figures = [mean_and_std(int(v[f"n{i}"]), v[f"s{i}"], v[f"q{i}"]) for i in range(k)]
    mean, std = ([f[at] for f in figures] for at in (0, 1))
    # a feature without spread is scaled to 0
    shift = [Fraction(m) for m in mean] + [Fraction(0)]
    scale = [Fraction(1) / Fraction(s) if s else Fraction(0) for s in std] + [Fraction(1)]

    def of_pair(i: int, j: int) -> float:
        c, a, b = v[f"c{min(i, j)},{max(i, j)}"], v[f"c{i}"], v[f"c{j}"]
        return float((c - shift[j] * a - shift[i] * b + n * shift[i] * shift[j]) * scale[i] * scale[j])

    m = {"n": n, "dropped": int(v["rows"]) - n, "sy": float(v[f"c{k}"]), "sz": [float((v[f"c{i}"] - n * shift[i]) * scale[i]) for i in range(k)],
         "szy": [of_pair(i, k) for i in range(k)], "szz": [[of_pair(i, j) for j in range(k)] for i in range(k)]}
    w, b = descend(m, steps, step, intercept, tol)
    return Standardizer(tuple(cols), tuple(mean), tuple(std)), LinearModel(tuple(cols), tuple(w), b, m["dropped"])


def predict_linear(df: DataFrame, model: LinearModel, output: str = "prediction") -> Column | DataFrame:
    """prediction = sum w_j x_j + b, as a projection."""
    expr = F.lit(0.0)
    for c, w in zip(model.cols, model.weights):
        expr = expr + F.col(c).cast("double") * F.lit(float(w))
    expr = expr + F.lit(float(model.intercept))
    return df.withColumn(output, expr)


def describe_linear(spark: SparkSession, model: LinearModel) -> DataFrame:
    """K4: one row per weight plus the intercept (term, weight)."""
    rows = [(c, float(w)) for c, w in zip(model.cols, model.weights)]
    rows.append(("intercept", float(model.intercept)))
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
    return spark.createDataFrame(rows, schema)
