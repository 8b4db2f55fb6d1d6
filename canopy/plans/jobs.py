"""End-to-end jobs: the original programs re-expressed as Spark plans.

Each job: read labelled rows -> reproducible split -> fit -> node table ->
score the hold-out part -> ONE aggregate for the report.  Reports are
one-row DataFrames (K2) and can be written with
``canopy.sinks.reports.write_report``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.functions.columns import hash_unit, hex_unit, md5_hex, md5_unit
from canopy.functions.metrics import error_rate, metric_totals, metrics_of, regression_metrics, wrong
from canopy.operators import mltrees
from canopy.operators.growth import TreeSpec, grow_trees
from canopy.operators.linear import LinearModel, linear_sgd, predict_linear, scaled_linear_sgd
from canopy.operators.nodes import predict_classes, predict_mean
from canopy.operators.scaling import fit_standardizer, standardize
from canopy.operators.splits import hash_split, holdout_complement
from canopy.operators.splitscan import num_classes

#: Largest bootstrap count of one draw: a 32-bit uniform cannot reach beyond
#: it (the mass past 12 is below 1e-10), so nothing is cut off.
MAX_DRAW = 13
# Poisson(1) cumulative probabilities P(K <= k) = e^-1 * sum_{i<=k} 1/i!
_POISSON1_CDF = [math.exp(-1.0) * sum(1.0 / math.factorial(i) for i in range(k + 1))
                 for k in range(MAX_DRAW)]


def poisson_weight(u: Column) -> Column:
    """Inverse CDF of Poisson(1) for a uniform ``u`` (bootstrap count)."""
    expr = F.lit(float(len(_POISSON1_CDF)))
    for k in reversed(range(len(_POISSON1_CDF))):
        expr = F.when(u < F.lit(_POISSON1_CDF[k]), F.lit(float(k))).otherwise(expr)
    return expr


def bootstrap_weight(keys: Sequence[str], seed: int, tree: int, method: str = "md5") -> Column:
    """Poisson(1) bootstrap count of a row for one tree, from its key.

    ``md5``: uniform = 32 bits (slot tree % 4) of md5('<seed>|<tree // 4>|<key>'),
    so one md5 serves four trees and any SQL engine reproduces the draw;
    ``xxhash64``: one cheaper hash per tree, Spark only.
    """
    if method == "xxhash64":
        return poisson_weight(hash_unit(keys, f"{seed}|{tree}"))
    return poisson_weight(md5_unit(keys, f"{seed}|{tree // 4}", tree % 4))


#: Draws of one row of equal training rows at a time.
DRAW_CHUNK = 1000


def with_row_counts(train: DataFrame, cols: Sequence[str], label: str, seed: int, trees: int) -> tuple[DataFrame, list[Column]]:
    """Rows without a key: (collapsed rows, their bootstrap counts per tree).

    Equal rows are collapsed to one with their number c, and a tree's count is
    the sum of c Poisson(1) draws, one per occurrence k = 1..c from
    md5('<seed>|<tree // 4>|<row>|<k>').  A very frequent row is cut into
    chunks of DRAW_CHUNK occurrences, which are dealt out before drawing.
    """
    keys = [*cols, label]
    counts = train.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__c") - 1) / DRAW_CHUNK)))
    parts = counts.select("*", chunk.alias("__chunk"))
    first = F.col("__chunk") * DRAW_CHUNK + 1
    parts = parts.repartition(*keys, "__chunk").withColumn("__k", F.sequence(first, F.least(F.col("__c"), first + DRAW_CHUNK - 1)))

    def drawn(tree: int) -> Column:
        units = F.transform(F.col("__k"), lambda k: md5_unit([*keys, k], f"{seed}|{tree // 4}", tree % 4))
        return F.aggregate(units, F.lit(0.0), lambda acc, u: acc + poisson_weight(u))

    names = [f"__draw{t}" for t in range(trees)]
    rows = parts.select(*keys, *[drawn(t).alias(n) for t, n in enumerate(names)])
    return rows, [F.col(n) for n in names]


def _bootstrap(train: DataFrame, cols: list[str], label: str, key_cols: Sequence[str] | None, seed: int,
               trees: int, method: str) -> tuple[DataFrame, list[Column], list[str]]:
    """(rows, count per tree, columns the counts read) of a bootstrap by row key, or by occurrence without one."""
    if key_cols and method == "md5":
        # one md5 per row and four trees, as a column: the count's CASE then reads numbers
        digests = {f"__md5_{g}": md5_hex(list(key_cols), f"{seed}|{g}") for g in range(-(-trees // 4))}
        units = {f"__unit{t}": hex_unit(F.col(f"__md5_{t // 4}"), t % 4) for t in range(trees)}
        rows = train.select(*cols, label, *[c.alias(n) for n, c in digests.items()]).select(*cols, label, *[c.alias(n) for n, c in units.items()])
        return rows, [poisson_weight(F.col(n)) for n in units], list(units)
    if key_cols:
        carry = [k for k in key_cols if k not in cols and k != label]
        return train, [bootstrap_weight(list(key_cols), seed, t, method) for t in range(trees)], carry
    if method != "md5":
        raise ValueError("rows without a key are drawn by md5")
    rows, counts = with_row_counts(train, cols, label, seed, trees)
    return rows, counts, [f"__draw{t}" for t in range(trees)]


def bagged_forest(train: DataFrame, cols: Sequence[str], label: str = "label",
                  key_cols: Sequence[str] | None = None, trees: int = 3, attributes: int = 0,
                  seed: int = 0, task: str = "classification", max_depth: int = 5,
                  max_bins: int = 100, hash_method: str = "md5") -> DataFrame:
    """Forest with Poisson(1) bootstrap counts from a row hash.

    Tree t weights row r by its bootstrap count (``bootstrap_weight``; rows
    without a key: ``with_row_counts``); its features are the md5-drawn subset
    of tree t.  All trees grow together, one aggregation per level.  The
    result does not depend on partitioning.
    """
    cols = list(cols)
    n_t = mltrees.forest_size(trees)
    n_a = mltrees.num_attributes(attributes, len(cols))
    subsets = mltrees.draw_features(len(cols), n_t, n_a, seed)
    rows, counts, carry = _bootstrap(train, cols, label, key_cols, seed, n_t, hash_method)
    specs = [TreeSpec(t, subsets[t], counts[t]) for t in range(n_t)]
    return grow_trees(rows, cols, label, task, specs=specs, max_depth=max_depth, max_bins=max_bins, carry=carry)


def random_forest(train: DataFrame, cols: Sequence[str], label: str = "label",
                  key_cols: Sequence[str] | None = None, trees: int = 3, seed: int = 0,
                  task: str = "classification", max_depth: int = 5, max_bins: int = 100) -> DataFrame:
    """M3 / M4 on the level-wise grower: bootstrap counts by row, and ceil(sqrt(features)) features drawn for every node.

    Draws come from md5, so any SQL engine grows the same forest.
    """
    cols = list(cols)
    n_t = mltrees.forest_size(trees)
    rows, counts, carry = _bootstrap(train, cols, label, key_cols, seed, n_t, "md5")
    some = math.isqrt(len(cols) - 1) + 1
    specs = [TreeSpec(t, list(range(len(cols))), counts[t], some, seed) for t in range(n_t)]
    return grow_trees(rows, cols, label, task, specs=specs, max_depth=max_depth, max_bins=max_bins, carry=carry)


def subspace_forest(train: DataFrame, cols: Sequence[str], label: str = "label",
                    task: str = "classification", trees: int = 0, attributes: int = 0,
                    seed: int = 0, max_depth: int = 5, max_bins: int = 100) -> tuple[DataFrame, list]:
    """M5 / M6 with the level-wise grower: every tree sees all train rows and
    only its drawn features; all trees grow in the same pass per level
    (instead of one full training run per tree).  Returns (nodes, subsets)."""
    cols = list(cols)
    n_t = mltrees.num_trees(trees)
    n_a = mltrees.num_attributes(attributes, len(cols))
    subsets = mltrees.draw_features(len(cols), n_t, n_a, seed)
    specs = [TreeSpec(t, subsets[t]) for t in range(n_t)]
    nodes = grow_trees(train, cols, label, task, specs=specs, max_depth=max_depth, max_bins=max_bins)
    return nodes, subsets


@dataclass
class JobResult:
    nodes: DataFrame | None
    predictions: DataFrame
    report: DataFrame
    linear: LinearModel | None = None


def tree_job(df: DataFrame, cols: Sequence[str], label: str = "label", task: str = "classification",
             key_cols: Sequence[str] | None = None, train_frac: float = 0.6, max_depth: int = 5,
             max_bins: int = 100) -> JobResult:
    """Single tree: train on a hash sample, test on the rest.

    Without ``key_cols`` the hash is of the whole row, so rows of equal value
    fall on one side and no tested value occurs in train; with keys, the test
    part is the value complement of the train part.
    """
    train, test = _split(df, cols, label, key_cols, train_frac)
    if task == "classification":
        model = mltrees.tree_classify(train, cols, label, max_depth, max_bins)
        nodes = mltrees.forest_nodes(model, cols)
        pred = predict_classes(test.withColumnRenamed(label, "label") if label != "label" else test,
                               nodes, num_classes(df, label))
        return JobResult(nodes, pred, error_rate(pred))
    nodes = mltrees.forest_nodes(mltrees.tree_regress(train, cols, label, max_depth, max_bins), cols)
    pred = predict_mean(test, nodes)
    return JobResult(nodes, pred, regression_metrics(pred, "prediction", label))


def _split(df: DataFrame, cols: Sequence[str], label: str, key_cols: Sequence[str] | None, frac: float) -> tuple[DataFrame, DataFrame]:
    """(train, test) whose test values do not occur in train."""
    if not key_cols:
        return hash_split(df, df.columns, frac)
    train, _ = hash_split(df, list(key_cols), frac)
    return train, holdout_complement(df, train)


def _forest(train: DataFrame, cols: Sequence[str], label: str, key_cols: Sequence[str] | None, task: str, trees: int, seed: int, engine: str) -> DataFrame:
    """Node table of a forest: ``engine='level'`` is the reproducible one (the same on any partitioning), ``'ml'`` Spark's learner."""
    if engine == "level":
        return random_forest(train, cols, label, key_cols, trees, seed, task)
    fit = mltrees.forest_classify if task == "classification" else mltrees.forest_regress
    return mltrees.forest_nodes(fit(train, cols, label, trees=trees, seed=seed), cols)


def forest_classification_job(df: DataFrame, cols: Sequence[str], label: str = "label",
                              key_cols: Sequence[str] | None = None, train_frac: float = 0.6,
                              trees: int = 3, seed: int = mltrees.FOREST_SEED, engine: str = "level") -> JobResult:
    """Forest classification: split, fit, export nodes, hard vote, error.

    The forest does not depend on how the rows are partitioned (without
    ``key_cols`` equal rows are drawn by occurrence).
    """
    keys = list(key_cols) if key_cols else [*cols, label]
    train, test = hash_split(df, keys, train_frac)
    nodes = _forest(train, cols, label, key_cols, "classification", trees, seed, engine)
    k = num_classes(df, label)
    pred = predict_classes(test.withColumnRenamed(label, "label") if label != "label" else test, nodes, k)
    return JobResult(nodes, pred, error_rate(pred))


def forest_regression_job(df: DataFrame, cols: Sequence[str], label: str = "label",
                          key_cols: Sequence[str] | None = None, train_frac: float = 0.6,
                          trees: int = 3, seed: int = mltrees.FOREST_SEED, engine: str = "level") -> JobResult:
    """Forest regression: split, fit, export nodes, mean vote, metrics; the forest as in ``forest_classification_job``."""
    keys = list(key_cols) if key_cols else [*cols, label]
    train, test = hash_split(df, keys, train_frac)
    nodes = _forest(train, cols, label, key_cols, "regression", trees, seed, engine)
    pred = predict_mean(test, nodes)
    return JobResult(nodes, pred, regression_metrics(pred, "prediction", label))


def subspace_ensemble_job(df: DataFrame, cols: Sequence[str], label: str = "label",
                          task: str = "classification", key_cols: Sequence[str] | None = None,
                          train_frac: float = 0.6, trees: int = 0, attributes: int = 0,
                          seed: int = 0, engine: str = "level") -> JobResult:
    """Hand-made ensemble: per-tree, pooled and voted error (or metrics).

    ``engine='level'`` grows all trees together (one pass per level);
    ``engine='ml'`` fits one Spark tree per subset, one after another.
    """
    keys = list(key_cols) if key_cols else [*cols, label]
    train, test = hash_split(df, keys, train_frac)
    if engine == "ml":
        models, subsets = mltrees.subspace_ensemble(train, cols, label, task, trees, attributes, seed)
        nodes = mltrees.ensemble_nodes(models, subsets, cols)
    else:
        nodes, subsets = subspace_forest(train, cols, label, task, trees, attributes, seed)
    if task == "classification":
        pred = predict_classes(test, nodes, num_classes(df, label), keep_votes=True)
    else:
        pred = predict_mean(test, nodes, keep_votes=True)
    return JobResult(nodes, pred.drop("votes"), ensemble_report(pred, label, task))


def ensemble_report(scored: DataFrame, label: str = "label", task: str = "classification") -> DataFrame:
    """Rows kind = tree (one per tree), pooled (all pairs) and voted (the ensemble), from one pass over ``scored`` (label, votes, prediction).

    Classification: n_pairs, n_wrong, error_rate.  Regression: the metrics of
    ``regression_metrics``.
    """
    own = scored.select(F.col(label).alias("label"), F.posexplode(F.concat("votes", F.array("prediction"))).alias("tree_id", "prediction"),
                        F.size("votes").alias("n_trees"))
    voted = F.col("tree_id") == F.col("n_trees")
    if task != "classification":
        # every pair is added up once, for its tree or the ensemble; the pool's sums are those of the trees
        totals = metric_totals(own.withColumn("voted", voted), keys=["tree_id", "voted"])
        kinds = F.when(F.col("voted"), F.array(F.lit("voted"))).otherwise(F.array(F.lit("tree"), F.lit("pooled")))
        sums = totals.select("tree_id", "totals", F.explode(kinds).alias("kind"))
        sums = sums.groupBy("kind", F.when(F.col("kind") == "tree", F.col("tree_id")).alias("tree_id")).agg(F.flatten(F.collect_list("totals")).alias("totals"))
        return metrics_of(sums)
    # a tree's pairs count for the tree and for the pool; the ensemble's for itself
    kinds = F.when(voted, F.array(F.lit("voted"))).otherwise(F.array(F.lit("tree"), F.lit("pooled")))
    pairs = own.select("label", "prediction", "tree_id", F.explode(kinds).alias("kind"))
    pairs = pairs.withColumn("tree_id", F.when(F.col("kind") == "tree", F.col("tree_id")))
    bad = wrong("prediction", "label").cast("long")
    return pairs.groupBy("kind", "tree_id").agg(F.count(F.lit(1)).alias("n_pairs"), F.sum(bad).alias("n_wrong"), F.avg(bad.cast("double")).alias("error_rate"))


def linear_regression_job(df: DataFrame, cols: Sequence[str], label: str = "label",
                          key_cols: Sequence[str] | None = None, train_frac: float = 0.9,
                          steps: int = 100, step: float = 0.1, fit_on: str = "train") -> JobResult:
    """Scaled linear regression: scaler (train or all rows), GD, metrics.

    The hold-out part holds no value of the train part (see ``tree_job``).
    ``linear`` of the result is the fitted model on the scaled features.
    """
    train, test = _split(df, cols, label, key_cols, train_frac)
    if fit_on == "all":
        stats = fit_standardizer(df, cols)
        model = linear_sgd(standardize(train, stats), cols, label, steps, step)
    else:
        stats, model = scaled_linear_sgd(train, cols, label, steps, step)
    pred = predict_linear(standardize(test, stats), model)
    return JobResult(None, pred, regression_metrics(pred, "prediction", label), model)
