"""Registered queries: one per operator group of the survey (section 7.3).

Each query takes (spark, sf_dir), reads the test tables and returns a
DataFrame.  Training steps (fits) run as Spark jobs when the query is
built; the returned frame is the lazy scoring / reporting plan.  Float
outputs are rounded so that two engines summing in a different order
agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions.metrics import error_rate, mispredicted, pooled_error_rate, regression_metrics
from canopy.models import iris
from canopy.operators import mltrees
from canopy.operators.growth import TreeSpec, grow_trees
from canopy.operators.linear import describe_linear, predict_linear, scaled_linear_sgd
from canopy.operators.nodes import predict_classes, predict_mean
from canopy.operators.scaling import fit_standardizer, standardize, standardize_stats
from canopy.operators.splits import (exact_sample, exact_split, hash_split, hash_split_counts,
                                     holdout_complement, union_predictions)
from canopy.operators.splitscan import gini_split_scan, num_classes, variance_split_scan
from canopy.plans.inputs import (FEATURES, KEYS, LINEAR_TRAIN_FRAC, TRAIN_FRAC, iris_frame, iris_like,
                                 lineitem_binary, lineitem_flags, lineitem_price, table)
from canopy.session import scratch_path
from canopy.sinks.pmml import ModelMeta, forest_to_pmml, write_pmml
from canopy.sources.pmml import forest_from_pmml
from canopy.sources.points import label_at, parse_points

# ---- fixed values --------------------------------------------------------
COMPLEMENT_TRAIN_FRAC = 0.1
SUBSET_TREES = 3
SUBSET_SEED = 0
STATUS_CLASSES = ["F", "O"]
# ---------------------------------------------------------------------------


def _vector_width(emb: DataFrame) -> int:
    """Widest embedding (one global max aggregate); shorter vectors read NULL."""
    return int(emb.agg(F.max(F.size("embedding"))).first()[0] or 0)


def _r(c, n):
    return F.round(F.col(c), n).alias(c) if isinstance(c, str) else F.round(c, n)


# -------------------------------------------------------------- points (S/P)

def q_parse_points(spark: SparkSession, sf: str) -> DataFrame:
    """Lines built from part (trailing comma when p_size > 45)."""
    part = table(spark, sf, "part")
    line = F.concat(F.concat_ws(",", F.col("p_partkey").cast("string"), F.col("p_size").cast("string"),
                                F.col("p_retailprice").cast("string")),
                    F.when(F.col("p_size") > 45, F.lit(",")).otherwise(F.lit("")))
    lines = part.select(line.alias("value"))
    return parse_points(lines, ["p_partkey", "p_size", "p_retailprice"], None, mode="PERMISSIVE")


def q_label_at_index(spark: SparkSession, sf: str) -> DataFrame:
    """label = field 1 of (l_quantity, l_discount, l_tax, l_extendedprice)."""
    li = table(spark, sf, "lineitem")
    return label_at(li, ["l_quantity", "l_discount", "l_tax", "l_extendedprice"], 1)


# ------------------------------------------------------------ splits (D)

def q_hash_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """D3: rows per side of the md5 split of lineitem keys."""
    return hash_split_counts(table(spark, sf, "lineitem"), KEYS, TRAIN_FRAC)


def q_holdout_complement(spark: SparkSession, sf: str) -> DataFrame:
    """Value rows of lineitem not present in a 10% train part."""
    li = table(spark, sf, "lineitem")
    vals = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    train, _ = hash_split(li, KEYS, COMPLEMENT_TRAIN_FRAC)
    return holdout_complement(li.select(*vals), train.select(*vals))


def q_random_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """D1 + D2 with exact shares: rows and sums of each part of a random split and of a sample; equal rows may fall on both sides."""
    li = table(spark, sf, "lineitem").select(*FEATURES, "l_linestatus")
    a, b = exact_split(li, [0.6, 0.4], seed=42)
    s = exact_sample(li, 0.25, seed=7)
    parts = [p.withColumn("part", F.lit(n)) for n, p in (("split_train", a), ("split_test", b), ("sample", s))]
    return (parts[0].unionByName(parts[1]).unionByName(parts[2])
            .groupBy("part", "l_linestatus").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("quantity"),
                                                 F.round(F.sum("l_discount"), 4).alias("discount")))


# ------------------------------------------------------------ scaling

def _price_split(spark, sf, frac):
    return hash_split(lineitem_price(spark, sf), KEYS, frac)


def q_standardize_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Mean / sample std / n of the features on the train part."""
    train, _ = _price_split(spark, sf, TRAIN_FRAC)
    st = standardize_stats(train, FEATURES)
    return st.select("feature", _r("mean", 9), _r("std", 9), "n")


def q_standardize_rows(spark: SparkSession, sf: str) -> DataFrame:
    """P5 + M11: hold-out rows scaled with the train statistics."""
    train, test = _price_split(spark, sf, TRAIN_FRAC)
    stats = fit_standardizer(train, FEATURES)
    z = standardize(test, stats)
    return z.select(*KEYS, "label", *[_r(c, 8) for c in FEATURES])


# ------------------------------------------------------------ subsets

def q_feature_subset(spark: SparkSession, sf: str) -> DataFrame:
    """P6 + M9 + M10: md5-drawn feature positions per tree over embeddings."""
    emb = table(spark, sf, "embeddings")
    width = _vector_width(emb)
    n_attr = mltrees.num_attributes(0, width)
    subsets = mltrees.draw_features(width, SUBSET_TREES, n_attr, SUBSET_SEED)
    entries = [F.struct(F.lit(t).alias("tree_id"), F.lit(slot).alias("slot"), F.lit(f).alias("feature"),
                        F.get("embedding", f).cast("double").alias("value"))
               for t, idx in enumerate(subsets) for slot, f in enumerate(idx)]
    return (emb.select("vec_id", F.explode(F.array(*entries)).alias("e"))
               .select("vec_id", "e.tree_id", "e.slot", "e.feature", "e.value"))


# ------------------------------------------------------------ split scans

def q_gini_split_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Best gini split per feature, lineitem status label, train part."""
    train, _ = hash_split(lineitem_binary(spark, sf), KEYS, TRAIN_FRAC)
    s = gini_split_scan(train, FEATURES)
    return s.select("feature", "feature_name", "threshold", _r("gain", 12),
                    F.col("n_left").cast("long").alias("n_left"),
                    F.col("n_right").cast("long").alias("n_right"))


def q_variance_split_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Best variance split per feature, label l_extendedprice."""
    train, _ = _price_split(spark, sf, TRAIN_FRAC)
    s = variance_split_scan(train, FEATURES)
    return s.select("feature", "feature_name", "threshold", _r("gain", 4),
                    F.col("n_left").cast("long").alias("n_left"),
                    F.col("n_right").cast("long").alias("n_right"))


def _stump_nodes(train, task):
    return grow_trees(train, FEATURES, "label", task, max_depth=1, prune=False)


def q_stump_error(spark: SparkSession, sf: str) -> DataFrame:
    """M1 (depth 1) + I1 + A1: best gini stump, hold-out error."""
    train, test = hash_split(lineitem_binary(spark, sf), KEYS, TRAIN_FRAC)
    nodes = _stump_nodes(train, "classification")
    pred = predict_classes(test, nodes, 2)
    return error_rate(pred).select("n_test", "n_wrong", _r("error_rate", 12))


def q_stump_rmse(spark: SparkSession, sf: str) -> DataFrame:
    """M2 (depth 1) + I1 + A3-A6: best variance stump, hold-out metrics."""
    train, test = _price_split(spark, sf, TRAIN_FRAC)
    nodes = _stump_nodes(train, "regression")
    pred = predict_mean(test, nodes)
    m = regression_metrics(pred)
    return m.select("n", _r("rmse", 6), _r("mae", 6), _r("r2_pearson", 9), _r("r2_sse", 9))


def tree_levels_nodes(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = hash_split(lineitem_binary(spark, sf), KEYS, TRAIN_FRAC)
    return grow_trees(train, FEATURES, "label", "classification", max_depth=2, prune=False)


def q_tree_levels(spark: SparkSession, sf: str) -> DataFrame:
    """M1 depth 2: the split scan repeated per node, level by level."""
    n = tree_levels_nodes(spark, sf)
    return n.select("tree_id", "node_id", "depth", "feature_name", "threshold", "prediction",
                    "row_count", _r("gain", 12))


# ------------------------------------------------------------ document forests

def _iris_voted(spark, sf, forest, keep_votes=False):
    data = iris_like(spark, sf)
    return predict_classes(data, iris.forest_table(spark, forest), 3, keep_votes=keep_votes)


def q_score_forest_r(spark: SparkSession, sf: str) -> DataFrame:
    """I4 + A10: hard majority vote of the R-built forest."""
    return _iris_voted(spark, sf, iris.R_FOREST).select(*KEYS, "prediction")


def q_score_forest_spark(spark: SparkSession, sf: str) -> DataFrame:
    """I4 + A10: hard majority vote of the Spark-exported forest."""
    return _iris_voted(spark, sf, iris.SPARK_FOREST).select(*KEYS, "prediction")


def q_vote_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Share of tree votes per class (R-built forest)."""
    p = F.col("probability")
    return _iris_voted(spark, sf, iris.R_FOREST).select(
        *KEYS, *[F.round(p[i], 12).alias(f"p_{c}") for i, c in enumerate(iris.CLASSES)])


def q_mispredicted_rows(spark: SparkSession, sf: str) -> DataFrame:
    """rows whose voted class differs from the return-flag class."""
    v = _iris_voted(spark, sf, iris.R_FOREST).select(*KEYS, "label", "prediction")
    return mispredicted(v)


def q_error_rate(spark: SparkSession, sf: str) -> DataFrame:
    """A1 + A7: error of the voted class over all rows."""
    v = _iris_voted(spark, sf, iris.R_FOREST).select("label", "prediction")
    return error_rate(v).select("n_test", "n_wrong", _r("error_rate", 12))


def q_pooled_error(spark: SparkSession, sf: str) -> DataFrame:
    """A2 + D5: per-tree and pooled error over the union of tree predictions."""
    scored = _iris_voted(spark, sf, iris.R_FOREST, keep_votes=True)
    p = pooled_error_rate(union_predictions(scored, ["label"]))
    return p.select("tree_id", "n_pairs", "n_wrong", _r("error_rate", 12))


# ------------------------------------------------------------ regression ensembles

def _stump_ensemble(spark, sf):
    train, test = _price_split(spark, sf, TRAIN_FRAC)
    specs = [TreeSpec(t, [t]) for t in range(len(FEATURES))]
    nodes = grow_trees(train, FEATURES, "label", "regression", specs=specs, max_depth=1, prune=False)
    return predict_mean(test, nodes)


def q_mean_prediction(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of three one-feature regression stumps per hold-out row."""
    p = _stump_ensemble(spark, sf)
    return p.select(*KEYS, "label", _r("prediction", 4))


def q_regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Rmse, mae, squared Pearson R^2 and 1-SSE/SST of that ensemble."""
    m = regression_metrics(_stump_ensemble(spark, sf))
    return m.select("n", _r("rmse", 6), _r("mae", 6), _r("r2_pearson", 9), _r("r2_sse", 9))


# ------------------------------------------------------------ linear

def _linear(spark, sf):
    train, test = _price_split(spark, sf, LINEAR_TRAIN_FRAC)
    stats, model = scaled_linear_sgd(train, FEATURES, "label", steps=100, step=0.1)
    return model, standardize(test, stats)


def q_linear_sgd(spark: SparkSession, sf: str) -> DataFrame:
    """M7 + K4: weights after 100 full-batch steps on standardised features."""
    model, _ = _linear(spark, sf)
    return describe_linear(spark, model).select("term", _r("weight", 4))


def q_predict_linear(spark: SparkSession, sf: str) -> DataFrame:
    """Hold-out predictions of that model."""
    model, test = _linear(spark, sf)
    return predict_linear(test, model).select(*KEYS, "label", _r("prediction", 2))


# ------------------------------------------------------------ PMML (K1 S3 E*)

def q_pmml_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K1 + S3: R forest -> PMML file -> node table -> vote over lineitem rows."""
    meta = ModelMeta(tuple(iris.FEATURES), iris.LABEL, tuple(iris.CLASSES))
    path = scratch_path(spark, "pmml")
    write_pmml(forest_to_pmml(iris.forest_table(spark, iris.R_FOREST), meta), path)
    nodes, meta2 = forest_from_pmml(spark, path)
    return predict_classes(iris_like(spark, sf), nodes, len(meta2.classes)).select(*KEYS, "prediction")


def q_pmml_regression(spark: SparkSession, sf: str) -> DataFrame:
    """K1 (regression form) + S3: the three price stumps exported with
    functionName=regression / average, read back, mean vote per hold-out row."""
    train, test = _price_split(spark, sf, TRAIN_FRAC)
    specs = [TreeSpec(t, [t]) for t in range(len(FEATURES))]
    nodes = grow_trees(train, FEATURES, "label", "regression", specs=specs, max_depth=1, prune=False)
    path = scratch_path(spark, "pmml")
    write_pmml(forest_to_pmml(nodes, ModelMeta(tuple(FEATURES), "l_extendedprice", None)), path)
    back, meta = forest_from_pmml(spark, path)
    assert meta.regression
    return predict_mean(test, back).select(*KEYS, "label", _r("prediction", 4))


def q_pmml_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """A tree grown from lineitem, exported and read back."""
    nodes = tree_levels_nodes(spark, sf)
    meta = ModelMeta(tuple(FEATURES), "l_linestatus", tuple(STATUS_CLASSES))
    path = scratch_path(spark, "pmml")
    write_pmml(forest_to_pmml(nodes, meta), path)
    back, _ = forest_from_pmml(spark, path)
    return back.select("tree_id", "node_id", "depth", "feature_name", "threshold", "prediction",
                       "row_count")


def q_tree_depth5(spark: SparkSession, sf: str) -> DataFrame:
    """M1 at the original depth: gini tree of depth 5 grown level-wise
    (every node's split from the histogram scan), unpruned node table."""
    train, _ = hash_split(lineitem_binary(spark, sf), KEYS, TRAIN_FRAC)
    n = grow_trees(train, FEATURES, "label", "classification", max_depth=5, prune=False)
    return n.select("tree_id", "node_id", "depth", "feature_name", "threshold", "prediction",
                    "row_count", _r("gain", 12))


def q_subspace_vote(spark: SparkSession, sf: str) -> DataFrame:
    """M5 + I4 + A10: three depth-5 trees on md5-drawn pairs of lineitem
    features, grown together, hard vote on every hold-out row."""
    from canopy.plans.jobs import subspace_forest
    train, test = _flags_split(spark, sf)
    nodes, _ = subspace_forest(train, FEATURES, "label", "classification", 3, 2, seed=0)
    return predict_classes(test, nodes, 3).select(*KEYS, "label", "prediction")


def q_subspace_mean(spark: SparkSession, sf: str) -> DataFrame:
    """M6 + A11: three depth-5 variance trees on md5-drawn pairs of lineitem
    features, grown together, mean of the tree predictions per hold-out row."""
    from canopy.plans.jobs import subspace_forest
    train, test = _price_split(spark, sf, TRAIN_FRAC)
    nodes, _ = subspace_forest(train, FEATURES, "label", "regression", 3, 2, seed=0)
    return predict_mean(test, nodes).select(*KEYS, "label", _r("prediction", 4))


def q_describe_tree(spark: SparkSession, sf: str) -> DataFrame:
    """K3: indented If / Else / Predict text of the depth-2 tree."""
    from canopy.sinks.reports import describe_forest
    return describe_forest(tree_levels_nodes(spark, sf))


def q_stream_scores(spark: SparkSession, sf: str) -> DataFrame:
    """I4 + A10 on a stream: lineitem files as a file stream, scored per
    micro-batch, drained into a parquet sink with a checkpoint."""
    from canopy.streaming.scoring import read_stream, run_to_table, score_stream
    li = table(spark, sf, "lineitem")
    stream = iris_frame(read_stream(spark, f"{sf.rstrip('/')}/lineitem.parquet", li))
    scored = score_stream(stream, iris.forest_table(spark, iris.R_FOREST), 3)
    return run_to_table(spark, scored.select(*KEYS, "prediction"))


# ------------------------------------------------------------ ml learners (M1-M6 M14), rows-only

def _flags_split(spark, sf):
    return hash_split(lineitem_flags(spark, sf), KEYS, TRAIN_FRAC)


def q_tree_classify(spark: SparkSession, sf: str) -> DataFrame:
    """M1 + I1 + A1: Spark decision tree (gini, depth 5, 100 bins), hold-out error."""
    train, test = hash_split(lineitem_binary(spark, sf), KEYS, TRAIN_FRAC)
    model = mltrees.tree_classify(train, FEATURES, n_classes=2)
    nodes = mltrees.forest_nodes(model, FEATURES)
    return error_rate(predict_classes(test, nodes, 2))


def q_tree_regress(spark: SparkSession, sf: str) -> DataFrame:
    """M2 + I1 + A3-A6: Spark regression tree, hold-out metrics."""
    train, test = _price_split(spark, sf, TRAIN_FRAC)
    nodes = mltrees.forest_nodes(mltrees.tree_regress(train, FEATURES), FEATURES)
    m = regression_metrics(predict_mean(test, nodes))
    return m.select("n", _r("rmse", 6), _r("mae", 6), _r("r2_pearson", 9), _r("r2_sse", 9))


def _subspace(spark, sf, task):
    from canopy.plans.jobs import subspace_forest
    emb = table(spark, sf, "embeddings")
    width = _vector_width(emb)
    cols = [f"e{i}" for i in range(width)]
    wide = emb.select("vec_id", F.col("label").cast("double").alias("label"),
                      *[F.get("embedding", i).cast("double").alias(cols[i]) for i in range(width)])
    if task == "regression":
        # target: first embedding slot, features: the others
        wide = wide.withColumn("label", F.col(cols[0]))
        cols = cols[1:]
    train, test = hash_split(wide, ["vec_id"], TRAIN_FRAC)
    nodes, _ = subspace_forest(train, cols, "label", task, 3, 0)
    return nodes, test


def q_subspace_classify(spark: SparkSession, sf: str) -> DataFrame:
    """M5: one tree per md5-drawn feature subset of the embeddings, voted."""
    nodes, test = _subspace(spark, sf, "classification")
    return predict_classes(test, nodes, num_classes(table(spark, sf, "embeddings"))).select("vec_id", "label", "prediction")


def q_subspace_regress(spark: SparkSession, sf: str) -> DataFrame:
    """M6: regression trees on feature subsets (target: first embedding slot)."""
    nodes, test = _subspace(spark, sf, "regression")
    return predict_mean(test, nodes).select("vec_id", "label", _r("prediction", 4))


def q_subspace_report(spark: SparkSession, sf: str) -> DataFrame:
    """T6 as intended: per-tree and pooled hold-out error of the subspace
    ensemble (trees fed only their own features), lineitem return flags."""
    from canopy.plans.jobs import subspace_ensemble_job
    return subspace_ensemble_job(lineitem_flags(spark, sf), FEATURES, key_cols=KEYS, attributes=2).report


def q_bagged_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Poisson(1) hash weights + md5 feature draws, grown level-wise."""
    from canopy.plans.jobs import bagged_forest
    train, test = _flags_split(spark, sf)
    nodes = bagged_forest(train, FEATURES, "label", key_cols=KEYS, trees=3, attributes=2)
    return predict_classes(test, nodes, 3).select(*KEYS, "label", "prediction")


QUERIES = {
    "parse_points": q_parse_points,
    "label_at_index": q_label_at_index,
    "hash_split_counts": q_hash_split_counts,
    "holdout_complement": q_holdout_complement,
    "standardize_stats": q_standardize_stats,
    "standardize_rows": q_standardize_rows,
    "feature_subset": q_feature_subset,
    "gini_split_scan": q_gini_split_scan,
    "variance_split_scan": q_variance_split_scan,
    "stump_error": q_stump_error,
    "stump_rmse": q_stump_rmse,
    "tree_levels": q_tree_levels,
    "score_forest_r": q_score_forest_r,
    "score_forest_spark": q_score_forest_spark,
    "vote_shares": q_vote_shares,
    "mean_prediction": q_mean_prediction,
    "mispredicted_rows": q_mispredicted_rows,
    "error_rate": q_error_rate,
    "pooled_error": q_pooled_error,
    "regression_metrics": q_regression_metrics,
    "linear_sgd": q_linear_sgd,
    "predict_linear": q_predict_linear,
    "pmml_roundtrip": q_pmml_roundtrip,
    "pmml_nodes": q_pmml_nodes,
    "pmml_regression": q_pmml_regression,
    "stream_scores": q_stream_scores,
    "describe_tree": q_describe_tree,
    "tree_depth5": q_tree_depth5,
    "subspace_vote": q_subspace_vote,
    "subspace_mean": q_subspace_mean,
    "random_split_counts": q_random_split_counts,
    "tree_classify": q_tree_classify,
    "tree_regress": q_tree_regress,
    "subspace_classify": q_subspace_classify,
    "subspace_regress": q_subspace_regress,
    "bagged_forest": q_bagged_forest,
    "subspace_report": q_subspace_report,
}
