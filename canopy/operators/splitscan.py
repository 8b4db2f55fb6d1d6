"""Best split search from binned histograms.

Shape of the computation (the same for one node or for every frontier node
of every tree at once):

1. ``long`` rows: group keys (e.g. tree_id, node_id), feature index, bin and
   statistics -- one row per (collapsed input row, feature).
2. histogram: ``groupBy(keys, feature, bin)`` with per-class weight sums
   (classification) or sum w, sum w*y, sum w*y^2 (regression).  Labels of a
   regression are rounded to ``label_digits`` decimals and summed as exact
   integers, so the sums do not depend on the order of the rows.  Partial
   aggregation runs map-side, so the shuffle carries at most
   partitions x keys x features x bins rows, independent of the row count.
3. running sums over bins with a window partitioned by (keys, feature):
   each window partition holds at most ``max_bins`` rows, so no task ever
   holds an unbounded group.
4. gain of every candidate; best per (keys, feature) by ``max_by``.

Gain formulas (fixed, equal to Spark's tree learner):
  gini(c)      = 1 - sum_k (c_k / n)^2
  variance     = (sum_y2 - sum_y^2 / n) / n
  gain         = imp(parent) - n_l/n * imp(left) - n_r/n * imp(right)
A split is valid when both sides have positive weight.  Ties go to the
lowest feature index, then the lowest threshold.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopy.operators.binning import add_bins, fit_bins, odd_labels, refuse_odd_labels

CLASSIFICATION = "classification"
REGRESSION = "regression"


def stat_columns(task: str, n_classes: int | None) -> list[str]:
    if task == CLASSIFICATION:
        return [f"c{k}" for k in range(n_classes)]
    return ["w", "s1", "s2"]


def stat_values(task: str, n_classes: int | None, side: str, label_digits: int) -> list[str]:
    """SQL of the statistics of a side ('L' running, 'T' total, 'R' the rest): class counts, or w, sum w*y, sum w*y^2.

    The sums of a regression are whole numbers until here, so the same rows
    give the same doubles in any order.
    """
    def one(s: str) -> str:
        return f"(T_{s} - L_{s})" if side == "R" else f"{side}_{s}"

    if task == CLASSIFICATION:
        return [one(s) for s in stat_columns(task, n_classes)]
    unit = f"{10.0 ** label_digits!r}D"
    return [one("w"), f"(CAST({one('s1')} AS DOUBLE) / {unit})", f"(CAST({one('s2')} AS DOUBLE) / {unit} / {unit})"]


#: Decimals of a regression label that the sums keep.
LABEL_DIGITS = 6


def row_stats(task: str, weight: Column | None, label: Column, label_digits: int = LABEL_DIGITS) -> list[Column]:
    """Aggregates that collapse rows of equal bins (and class): w, n and, for a regression, exact s1 and s2.

    ``weight`` must be whole-numbered (bootstrap counts); rows of weight 0 do
    not count in n.  s1 and s2 are the sums of w*q and w*q*q for
    q = round(label * 10^label_digits) (a label beyond 9e18 of these units fails).
    """
    w = F.lit(1).cast("long") if weight is None else weight.cast("long")
    out = [F.sum(w).cast("double").alias("w"), F.sum((w > 0).cast("long")).alias("n")]
    if task != CLASSIFICATION:
        q = F.round(label * F.lit(10.0 ** label_digits)).cast("long")
        wq = (w * q).cast("decimal(19,0)")
        out += [F.sum(wq).cast("decimal(38,0)").alias("s1"), F.sum(wq * q.cast("decimal(19,0)")).cast("decimal(38,0)").alias("s2")]
    return out


def histogram(long: DataFrame, keys: Sequence[str], task: str, n_classes: int | None = None) -> DataFrame:
    """(keys, feature, bin) -> weighted statistics, plus raw row count ``n_raw``, from rows with w, n and label or s1, s2."""
    if task == CLASSIFICATION:
        aggs = [F.sum(F.when(F.col("label") == F.lit(float(k)), F.col("w")).otherwise(F.lit(0.0))).alias(f"c{k}")
                for k in range(n_classes)]
    else:
        aggs = [F.sum("w").alias("w"), *[F.sum(s).cast("decimal(38,0)").alias(s) for s in ("s1", "s2")]]
    return long.groupBy(*keys, "feature", "bin").agg(*aggs, F.sum("n").alias("n_raw"))


def _sql_weight(task: str, xs: Sequence[str]) -> str:
    return "(" + " + ".join(xs) + ")" if task == CLASSIFICATION else xs[0]


def _sql_impurity(task: str, xs: Sequence[str]) -> str:
    n = _sql_weight(task, xs)
    if task == CLASSIFICATION:
        e = "1.0D"
        for x in xs:
            e = f"({e} - ({x} / {n}) * ({x} / {n}))"
        return e
    return f"(({xs[2]} - ({xs[1]} * {xs[1]}) / {n}) / {n})"


def candidates(hist: DataFrame, keys: Sequence[str], task: str,
               n_classes: int | None, label_digits: int = LABEL_DIGITS) -> DataFrame:
    """Every (keys, feature, bin) split candidate with its gain and side stats.

    The per-candidate arithmetic is written as SQL text (one expression per
    output column), so planning cost does not grow with classes x features.
    """
    stats = stat_columns(task, n_classes)
    part = Window.partitionBy(*keys, "feature")
    run = part.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # all running / total sums in ONE projection (one window pass per frame)
    df = hist.select(*keys, "feature", "bin",
                     *[F.sum(s).over(run).alias(f"L_{s}") for s in [*stats, "n_raw"]],
                     *[F.sum(s).over(part).alias(f"T_{s}") for s in [*stats, "n_raw"]])
    L, T, R = (stat_values(task, n_classes, side, label_digits) for side in "LTR")
    n_l, n_t = _sql_weight(task, L), _sql_weight(task, T)
    n_r = f"({n_t} - {n_l})"
    gain = (f"({_sql_impurity(task, T)} - ({n_l} / {n_t}) * {_sql_impurity(task, L)}"
            f" - ({n_r} / {n_t}) * {_sql_impurity(task, R)})")
    # the last bin (values above every threshold, and NaN) always has an
    # empty right side, so "both sides non-empty" also rules it out
    return df.where(f"{n_l} > 0 AND {n_r} > 0").selectExpr(
        *keys, "feature", "bin",
        f"{gain} AS gain",
        f"{n_l} AS n_left", f"{n_r} AS n_right",
        "L_n_raw AS raw_left", "T_n_raw - L_n_raw AS raw_right",
        f"array({', '.join(L)}) AS left_stats", f"array({', '.join(R)}) AS right_stats")


def threshold_table(spark, thresholds: Sequence[Sequence[float]], names: Sequence[str]) -> DataFrame:
    """(feature, bin, threshold, feature_name): features x bins rows at most."""
    rows = [(i, j, float(t), names[i]) for i, th in enumerate(thresholds) for j, t in enumerate(th)]
    return spark.createDataFrame(rows, "feature int, bin int, threshold double, feature_name string")


def best_per(cands: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Highest gain per ``keys``; ties -> lowest feature, then lowest bin."""
    order = F.struct(F.col("gain"), -F.col("feature"), -F.col("bin"))
    fields = [c for c in cands.columns if c not in keys]
    best = F.max_by(F.struct(*fields), order)
    return cands.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def collapsed(df: DataFrame, bins: Sequence[str], task: str, weights: dict[str, Column | None], label: str = "label",
              label_digits: int = LABEL_DIGITS) -> DataFrame:
    """Rows of equal bins (and class) as one row, with the statistics of every weight: <name>_w, <name>_n, ... per name of ``weights``.

    Histograms of the collapsed rows are those of the rows; partial
    aggregation keeps a frequent combination to one row per task.  Rows
    without a label take no part.
    """
    keys = [*bins, *([label] if task == CLASSIFICATION else [])]
    aggs = []
    for name, weight in weights.items():
        stats = row_stats(task, weight, F.col(label).cast("double"), label_digits)
        aggs += [s.alias(f"{name}_{k}") for s, k in zip(stats, STATS)]
    return _labelled(df, label).groupBy(*keys).agg(*aggs)


def uncollapsed(df: DataFrame, bins: Sequence[str], task: str, weights: dict[str, Column | None], label: str = "label",
                label_digits: int = LABEL_DIGITS) -> DataFrame:
    """The columns of ``collapsed``, one row per row: a projection without a shuffle."""
    out = [F.col(b) for b in bins] + ([F.col(label)] if task == CLASSIFICATION else [])
    for name, weight in weights.items():
        w = F.lit(1).cast("long") if weight is None else weight.cast("long")
        stats = [w.cast("double"), (w > 0).cast("long")]
        if task != CLASSIFICATION:
            q = F.round(F.col(label).cast("double") * F.lit(10.0 ** label_digits)).cast("long")
            wq = (w * q).cast("decimal(19,0)")
            stats += [wq.cast("decimal(38,0)"), (wq * q.cast("decimal(19,0)")).cast("decimal(38,0)")]
        out += [s.alias(f"{name}_{k}") for s, k in zip(stats, STATS)]
    return _labelled(df, label).select(*out)


def _labelled(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double")))


#: Combinations of bins (and class) that are always collapsed to: so few rows cost less than finding out.
FEW_COMBINATIONS = 1 << 16
#: One in this many row hashes is looked at to foresee what collapsing saves.
HASHES_ONE_IN = 64
#: Collapsing must leave at most this share of the rows.
WORTH = 0.5


def worth_collapsing(df: DataFrame, keys: Sequence[str], combinations: int) -> bool:
    """Does grouping ``df`` by ``keys`` leave few enough rows to pay for shuffling it?

    ``combinations``: how many groups there can be at most.  Beyond
    FEW_COMBINATIONS the rows of one hash of ``keys`` in HASHES_ONE_IN are
    counted, and their distinct hashes; only counts are shuffled.  Either
    answer gives the same histograms.
    """
    if combinations <= FEW_COMBINATIONS:
        return True
    some = df.select(F.xxhash64(*keys).alias("h")).where(F.pmod("h", F.lit(HASHES_ONE_IN)) == 0)
    r = some.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("h", 0.02).alias("groups")).first()
    return r["groups"] <= WORTH * r["rows"]


def compact(df: DataFrame, bins: Sequence[str], task: str, weights: dict[str, Column | None], thresholds: Sequence[Sequence[float]],
            n_classes: int | None) -> DataFrame:
    """``df`` (bins, label, weights) collapsed where that saves enough rows, else as it is; the columns are those of ``collapsed``."""
    keys = [*bins, *(["label"] if task == CLASSIFICATION else [])]
    combinations = math.prod([len(t) + 2 for t in thresholds]) * (n_classes or 1)  # a bin more than thresholds, or NULL
    form = collapsed if worth_collapsing(_labelled(df, "label"), keys, combinations) else uncollapsed
    return form(df, bins, task, weights)


#: Names of the statistics of a collapsed row (a classification has the first two).
STATS = ["w", "n", "s1", "s2"]


def split_scan(df: DataFrame, cols: Sequence[str], label: str = "label", task: str = CLASSIFICATION,
               max_bins: int = 100, n_classes: int | None = None,
               thresholds: Sequence[Sequence[float]] | None = None) -> DataFrame:
    """Best split of every feature over all rows of ``df`` (one node).

    Output: feature, feature_name, threshold, gain, n_left, n_right.
    """
    cols = list(cols)
    if task == CLASSIFICATION and (thresholds is not None or n_classes is not None):
        n_classes = num_classes(df, label, n_classes)
    if thresholds is None:
        want = label if task == CLASSIFICATION and n_classes is None else None
        thresholds, max_label = fit_bins(df, cols, max_bins, want)
        if want is not None:
            n_classes = int(max_label) + 1 if max_label is not None else 1
    bins = [f"__b{i}" for i in range(len(cols))]
    binned = add_bins(df.withColumn("label", F.col(label).cast("double")), cols, thresholds, bins, ["label"])
    rows = compact(binned, bins, task, {"x": None}, thresholds, n_classes)
    stats = STATS[:2] if task == CLASSIFICATION else STATS
    kept = [F.col("label")] if task == CLASSIFICATION else []
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(b).alias("bin")) for i, b in enumerate(bins)])
    long = (rows.select(*kept, *[F.col(f"x_{k}").alias(k) for k in stats], F.explode(pairs).alias("p"))
            .select(*kept, *stats, "p.feature", "p.bin").where(F.col("bin").isNotNull()))
    hist = histogram(long, [], task, n_classes)
    # one small shuffle by feature serves the running sums and the best pick
    best = best_per(candidates(hist.repartition("feature"), [], task, n_classes), ["feature"])
    # features x max_bins rows at most: Spark broadcasts it when its size allows
    thr = threshold_table(df.sparkSession, thresholds, cols)
    return best.join(thr, ["feature", "bin"]).select("feature", "feature_name", "threshold", "gain",
                                                     "n_left", "n_right")


def gini_split_scan(df: DataFrame, cols: Sequence[str], label: str = "label",
                    max_bins: int = 100, n_classes: int | None = None) -> DataFrame:
    """Best gini split per feature."""
    return split_scan(df, cols, label, CLASSIFICATION, max_bins, n_classes)


def variance_split_scan(df: DataFrame, cols: Sequence[str], label: str = "label",
                        max_bins: int = 100) -> DataFrame:
    """Best variance-reduction split per feature."""
    return split_scan(df, cols, label, REGRESSION, max_bins)


def num_classes(df: DataFrame, label: str = "label", n_classes: int | None = None) -> int:
    """Classes are 0..max(label), or the ``n_classes`` given; labels that are no class are refused.  One cheap aggregate."""
    y = F.col(label).cast("double")
    y = F.when(~F.isnan(y), y)
    r = df.agg(F.max(y).alias("top"), odd_labels(y, n_classes).alias("odd")).first()
    refuse_odd_labels(r["odd"])
    return n_classes or (int(r["top"]) + 1 if r["top"] is not None else 1)
