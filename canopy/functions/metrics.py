"""Hold-out metrics as one-row DataFrames.

Every metric of a report comes from ONE aggregate, so the predictions
are produced once and scanned once; partial aggregation runs map-side and
only a few rows per partition are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.functions.exact import Term, exact_totals, finished, products, root, with_one_group


def predictions(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """The (prediction, label) pair."""
    return df.select(F.col(prediction).alias("prediction"), F.col(label).alias("label"))


def wrong(prediction: str | Column = "prediction", label: str | Column = "label") -> Column:
    """F1 as a Column: prediction differs from label (null-safe)."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    y = F.col(label) if isinstance(label, str) else label
    return ~p.eqNullSafe(y)


def mispredicted(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """rows whose prediction differs from the label."""
    return df.where(wrong(prediction, label))


def error_rate(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """A1 + A7: n_test, n_wrong, error_rate (NULL on an empty test set)."""
    w = wrong(prediction, label).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.coalesce(F.sum(w), F.lit(0).cast("long")).alias("n_wrong"),
        F.avg(w.cast("double")).alias("error_rate"),
    )


def pooled_error_rate(df: DataFrame, prediction: str = "prediction", label: str = "label",
                      tree_col: str = "tree_id") -> DataFrame:
    """A2: error over all (tree, row) pairs plus one row per tree.

    Output rows: ``tree_id`` NULL for the pooled figure.  Computed with a
    ROLLUP so per-tree and pooled numbers come from one aggregation.
    """
    w = wrong(prediction, label).cast("long")
    return df.rollup(tree_col).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum(w).alias("n_wrong"),
        F.avg(w.cast("double")).alias("error_rate"),
    )


def regression_metrics(df: DataFrame, prediction: str = "prediction", label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """N, n_missing, rmse, mae, r2_pearson, r2_sse over all rows, or per group of ``keys``, in one pass.

    All figures are over the pairs whose prediction and label are both
    present (``n`` counts them); ``n_missing`` counts the other rows.

    * r2_pearson = squared Pearson correlation, NULL when label or prediction is constant;
    * r2_sse = 1 - SSE/SST, NULL when the label is constant.

    They come from exact sums (of the values, their squares and their
    product), so they do not depend on the order or partitioning of the rows.
    A pair that is not finite makes them NaN.
    """
    totals = metric_totals(df, prediction, label, keys)
    return metrics_of(totals if keys else with_one_group(totals))


def metric_totals(df: DataFrame, prediction: str = "prediction", label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """(keys, totals): the exact sums that ``metrics_of`` reads; those of several groups, put together, are the sums of all their rows."""
    rows = df.select(*keys, F.col(prediction).cast("double").alias("__p"), F.col(label).cast("double").alias("__y"))

    def terms(p: np.ndarray, y: np.ndarray, missing: list[np.ndarray]) -> list[Term]:
        gone = missing[0] | missing[1]
        own = [("n", np.ones(len(p))), ("p", p), ("y", y), ("mae", np.abs(p - y)), *products("pp", p, p), *products("yy", y, y), *products("py", p, y)]
        return [("rows", np.ones(len(p))), *[(name, np.ma.array(x, mask=gone)) for name, x in own]]

    return exact_totals(rows, keys, ["__p", "__y"], terms)


def metrics_of(totals: DataFrame) -> DataFrame:
    """The figures of ``regression_metrics`` per row of ``metric_totals``."""
    def finish(v: dict) -> tuple:
        n, rows = int(v.get("n", 0)), int(v.get("rows", 0))
        if not n:
            return 0, rows, None, None, None, None
        if any(isinstance(x, float) for x in v.values()):
            return n, rows - n, *[float("nan")] * 4
        sse = v["pp"] - 2 * v["py"] + v["yy"]
        vary, varp, cov = n * v["yy"] - v["y"] ** 2, n * v["pp"] - v["p"] ** 2, n * v["py"] - v["p"] * v["y"]
        return (n, rows - n, root(sse / n), float(v["mae"] / n), float(cov ** 2 / (vary * varp)) if vary and varp else None,
                float(1 - sse * n / vary) if vary else None)

    return finished(totals, "n long, n_missing long, rmse double, mae double, r2_pearson double, r2_sse double", finish)
