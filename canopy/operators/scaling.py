"""Feature standardisation.

``fit_standardizer`` is one global aggregate (exact sums of every feature and
its squares, partial aggregation map-side); the fitted statistics are k pairs of
numbers, so they come back to the driver and are applied as literals: no
join, no broadcast, and the apply step is a narrow projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.functions.exact import Term, exact_totals, finished, products, root, with_one_group


@dataclass(frozen=True)
class Standardizer:
    cols: tuple[str, ...]
    mean: tuple[float | None, ...]
    std: tuple[float | None, ...]
    with_mean: bool = True
    with_std: bool = True


def mean_and_std(n: int, s: Fraction, q: Fraction) -> tuple[float, float | None]:
    """Mean and sample deviation of n values from their exact sum and sum of squares."""
    return float(s / n), root((n * q - s ** 2) / (n * (n - 1))) if n > 1 else None


def standardize_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A8 as rows: feature, mean, std (sample), n; from exact sums, so the same on any partitioning.

    std of one value is NULL, and of a feature without a value so is its mean;
    a value that is not finite makes both NaN.
    """
    rows = df.select(*[F.col("`" + c.replace("`", "``") + "`").cast("double").alias(f"__x{i}") for i, c in enumerate(cols)])

    def terms(*columns) -> list[Term]:
        *xs, missing = columns
        own = [[(f"n{i}", np.ones(len(x))), (f"s{i}", x), *products(f"q{i}", x, x)] for i, x in enumerate(xs)]
        return [(name, np.ma.array(x, mask=missing[i])) for i, some in enumerate(own) for name, x in some]

    def figures(v: dict, i: int) -> tuple:
        n, s, q = int(v.get(f"n{i}", 0)), v.get(f"s{i}"), v.get(f"q{i}")
        if not n:
            return None, None, 0
        return *((float("nan"), float("nan")) if isinstance(s, float) or isinstance(q, float) else mean_and_std(n, s, q)), n

    totals = with_one_group(exact_totals(rows, [], rows.columns, terms))
    wide = finished(totals, ", ".join(f"m{i} double, s{i} double, n{i} long" for i in range(len(cols))),
                    lambda v: tuple(x for i in range(len(cols)) for x in figures(v, i)))
    each = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"), F.col(f"n{i}").alias("n"))
                     for i, c in enumerate(cols)])
    return wide.select(F.explode(each).alias("s")).select("s.*")


def fit_standardizer(df: DataFrame, cols: Sequence[str], with_mean: bool = True,
                     with_std: bool = True) -> Standardizer:
    """Fit on ``df`` (pass the train part to avoid a hold-out leak)."""
    cols = list(cols)
    rows = {r["feature"]: r for r in standardize_stats(df, cols).collect()}
    return Standardizer(tuple(cols), tuple(rows[c]["mean"] for c in cols), tuple(rows[c]["std"] for c in cols), with_mean, with_std)


def scaled_column(stats: Standardizer, c: str):
    i = stats.cols.index(c)
    x = F.col(c).cast("double")
    if stats.with_mean:
        x = x - F.lit(float(stats.mean[i]) if stats.mean[i] is not None else None)
    if stats.with_std:
        s = stats.std[i]
        # zero or undefined spread -> 0.0, as Spark's StandardScaler does
        if s is None or s == 0.0:
            x = F.lit(0.0)
        else:
            x = x / F.lit(float(s))
    return x


def standardize(df: DataFrame, stats: Standardizer, keep: Sequence[str] = ()) -> DataFrame:
    """P5: scaled features, other columns untouched (label stays raw)."""
    scaled = {c: scaled_column(stats, c).alias(c) for c in stats.cols}
    out = [scaled[c] if c in scaled else F.col(c) for c in df.columns]
    return df.select(*out)
