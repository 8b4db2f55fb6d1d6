"""Tree training with Spark's own learners.

Single trees and random forests are fitted with ``pyspark.ml`` (distributed
histogram aggregation per level, the learner the original jobs used).  The
fitted model is turned into the node table of ``growth.NODE_SCHEMA`` by
saving it (to the shared checkpoint folder) and reading its parquet node
data back: no driver-side walk of JVM objects.  Pre-order ml ids become heap
ids (root 1, children 2i / 2i+1) with one grouped pandas step per tree; a
tree is bounded by 2^(max_depth+1) nodes, so no group grows with the data.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.operators.growth import NODE_SCHEMA
from canopy.operators.nodes import MAX_NODES
from canopy.session import drop_scratch, scratch_path, ship_package
from canopy.sources.points import assemble, features_of

# Fixed settings of the original jobs.
DEFAULT_TREES = 3
MIN_TREES = 3
DEFAULT_DEPTH = 5
DEFAULT_BINS = 100
FOREST_SEED = 12345


def num_trees(requested: int | None) -> int:
    """M8, the rule of the subspace ensembles alone: 0 / unset or below 3 -> 3; otherwise as given."""
    if not requested or requested < MIN_TREES:
        return DEFAULT_TREES
    return int(requested)


def forest_size(requested: int) -> int:
    """Trees of a forest: the number asked for, at least one."""
    if requested < 1:
        raise ValueError("a forest needs at least one tree")
    return int(requested)


def num_attributes(requested: int | None, n_features: int) -> int:
    """M9: 0 / unset -> floor(sqrt(n)); clamped to 1..n."""
    a = int(requested) if requested else math.isqrt(n_features)
    return max(1, min(a, n_features))


def draw_features(n_features: int, n_trees: int, n_attributes: int, seed: int = 0) -> list[list[int]]:
    """Per tree, ``n_attributes`` distinct feature ids ranked by md5.

    rank key = md5('<seed>|<tree>|<feature>') as lowercase hex; the smallest
    keys win and keep that order.  Reproducible anywhere md5 exists.
    """
    out = []
    for t in range(n_trees):
        keyed = sorted(range(n_features),
                       key=lambda f: hashlib.md5(f"{seed}|{t}|{f}".encode()).hexdigest())
        out.append(keyed[:n_attributes])
    return out


def _vec(df: DataFrame, cols: Sequence[str], label: str, carry: Sequence[str] = (),
         n_classes: int | None = None) -> DataFrame:
    y = F.col(label).cast("double")
    if n_classes:
        # nominal label metadata: the learner takes the class count from it
        # instead of running its own pass over the data for max(label)
        y = y.alias("label", metadata={"ml_attr": {"type": "nominal", "num_vals": int(n_classes)}})
    else:
        y = y.alias("label")
    base = df.select(y, *[F.col(c) for c in cols], *[F.col(c) for c in carry])
    return features_of(base, cols, ["label", *carry])


def _fitted(est, data: DataFrame):
    """Fit on persisted input: the learner reads its rows several times."""
    data.persist()
    try:
        return est.fit(data)
    finally:
        data.unpersist()


def tree_classify(df: DataFrame, cols: Sequence[str], label: str = "label",
                  max_depth: int = DEFAULT_DEPTH, max_bins: int = DEFAULT_BINS,
                  impurity: str = "gini", weight_col: str | None = None,
                  n_classes: int | None = None):
    """M1: one classification tree (classes 0..k-1; k from the data unless given)."""
    est = DecisionTreeClassifier(maxDepth=max_depth, maxBins=max_bins, impurity=impurity)
    if weight_col:
        est.setWeightCol(weight_col)
    return _fitted(est, _vec(df, cols, label, [weight_col] if weight_col else [], n_classes))


def tree_regress(df: DataFrame, cols: Sequence[str], label: str = "label",
                 max_depth: int = DEFAULT_DEPTH, max_bins: int = DEFAULT_BINS):
    """M2: one regression tree (variance impurity)."""
    return _fitted(DecisionTreeRegressor(maxDepth=max_depth, maxBins=max_bins, impurity="variance"), _vec(df, cols, label))


def forest_classify(df: DataFrame, cols: Sequence[str], label: str = "label",
                    trees: int = DEFAULT_TREES, subset: str = "sqrt",
                    max_depth: int = DEFAULT_DEPTH, max_bins: int = DEFAULT_BINS,
                    seed: int = FOREST_SEED, n_classes: int | None = None):
    """M3: random forest classifier (bootstrap + per-node feature subsets)."""
    est = RandomForestClassifier(numTrees=forest_size(trees), featureSubsetStrategy=subset, impurity="gini",
                                 maxDepth=max_depth, maxBins=max_bins, seed=seed)
    return _fitted(est, _vec(df, cols, label, (), n_classes))


def forest_regress(df: DataFrame, cols: Sequence[str], label: str = "label",
                   trees: int = DEFAULT_TREES, subset: str = "sqrt",
                   max_depth: int = DEFAULT_DEPTH, max_bins: int = DEFAULT_BINS,
                   seed: int = FOREST_SEED):
    """M4: random forest regressor (variance impurity)."""
    est = RandomForestRegressor(numTrees=forest_size(trees), featureSubsetStrategy=subset, impurity="variance",
                                maxDepth=max_depth, maxBins=max_bins, seed=seed)
    return _fitted(est, _vec(df, cols, label))


def subspace_ensemble(df: DataFrame, cols: Sequence[str], label: str = "label",
                      task: str = "classification", trees: int = 0, attributes: int = 0,
                      seed: int = 0, max_depth: int = DEFAULT_DEPTH,
                      max_bins: int = DEFAULT_BINS):
    """M5 / M6: one tree per drawn feature subset, on all train rows.

    Each tree sees only its features (``VectorSlicer``), at fit AND at
    predict time.  The assembled frame is persisted for the tree loop.
    Returns (models, feature lists).
    """
    cols = list(cols)
    n_t = num_trees(trees)
    n_a = num_attributes(attributes, len(cols))
    subsets = draw_features(len(cols), n_t, n_a, seed)
    data = _vec(df, cols, label).select("label", "features").persist()
    models = []
    try:
        for idx in subsets:
            sliced = VectorSlicer(inputCol="features", outputCol="sub", indices=idx).transform(data)
            if task == "classification":
                est = DecisionTreeClassifier(featuresCol="sub", maxDepth=max_depth,
                                             maxBins=max_bins, impurity="gini")
            else:
                est = DecisionTreeRegressor(featuresCol="sub", maxDepth=max_depth,
                                            maxBins=max_bins, impurity="variance")
            models.append(est.fit(sliced))
    finally:
        data.unpersist()
    return models, subsets


# ---------------------------------------------------------------- node table

def _is_forest(model) -> bool:
    return isinstance(model, (RandomForestClassificationModel, RandomForestRegressionModel))


def _is_classifier(model) -> bool:
    return isinstance(model, (RandomForestClassificationModel, DecisionTreeClassificationModel))


def forest_nodes(model, cols: Sequence[str], tree_id: int = 0,
                 feature_map: Sequence[int] | None = None) -> DataFrame:
    """E1 + E2: node table of a fitted ml tree or forest (heap node ids).

    ``feature_map`` maps the model's feature index to an index of ``cols``
    (for trees fitted on a slice of the features).
    """
    spark = SparkSession.active()
    ship_package(spark)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    raw = spark.read.parquet(f"{path}/data")
    if _is_forest(model):
        flat = raw.select(F.col("treeID").cast("int").alias("tree_id"), "nodeData.*")
    else:
        flat = raw.withColumn("tree_id", F.lit(int(tree_id)))
    flat = flat.select(
        "tree_id", F.col("id").cast("long").alias("ml_id"), "prediction", "impurity",
        F.col("impurityStats").alias("stats"), F.col("rawCount").cast("long").alias("row_count"),
        "gain", F.col("leftChild").cast("long").alias("ml_left"),
        F.col("rightChild").cast("long").alias("ml_right"),
        F.col("split.featureIndex").cast("int").alias("ml_feature"),
        F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)).alias("ml_threshold"),
    )
    names = list(cols)
    fmap = list(feature_map) if feature_map is not None else list(range(len(names)))
    classifier = _is_classifier(model)

    def to_heap(pdf: pd.DataFrame) -> pd.DataFrame:
        by_id = {int(r.ml_id): r for r in pdf.itertuples(index=False)}
        heap = {}
        parent: dict[int, tuple[int, bool]] = {}
        depth = {}
        root = next(i for i in by_id if all(int(r.ml_left) != i and int(r.ml_right) != i
                                            for r in by_id.values()))
        stack = [(root, 1, 0)]
        while stack:
            mid, hid, d = stack.pop()
            heap[mid], depth[mid] = hid, d
            r = by_id[mid]
            if int(r.ml_left) >= 0:
                parent[int(r.ml_left)] = (hid, True)
                parent[int(r.ml_right)] = (hid, False)
                stack.append((int(r.ml_left), 2 * hid, d + 1))
                stack.append((int(r.ml_right), 2 * hid + 1, d + 1))
        rows = []
        for mid, r in by_id.items():
            leaf = int(r.ml_left) < 0
            f = None if leaf else fmap[int(r.ml_feature)]
            rows.append({
                "tree_id": int(r.tree_id), "node_id": heap[mid],
                "parent_id": parent[mid][0] if mid in parent else None,
                "is_left": parent[mid][1] if mid in parent else None,
                "depth": depth[mid], "feature": f,
                "feature_name": None if leaf else names[f],
                "threshold": None if leaf else float(r.ml_threshold),
                "left_id": None if leaf else heap[int(r.ml_left)],
                "right_id": None if leaf else heap[int(r.ml_right)],
                "prediction": float(r.prediction),
                "class_counts": [float(v) for v in r.stats] if classifier else None,
                "row_count": int(r.row_count),
                "impurity": float(r.impurity),
                "gain": None if leaf else float(r.gain),
            })
        out = pd.DataFrame(rows, columns=NODE_SCHEMA.fieldNames())
        return out.astype({"node_id": "int64", "depth": "int32", "tree_id": "int32",
                           "row_count": "int64"})

    # the model is on the driver already; its node table is as large, read once, and the saved files go
    size = flat.limit(MAX_NODES + 1).count()
    if size > MAX_NODES:
        raise ValueError(f"the model has more than {MAX_NODES} nodes")
    rows = flat.groupBy("tree_id").applyInPandas(to_heap, NODE_SCHEMA).collect()
    drop_scratch(spark, path)
    return spark.createDataFrame(rows, NODE_SCHEMA)


def ensemble_nodes(models: Sequence, subsets: Sequence[Sequence[int]], cols: Sequence[str]) -> DataFrame:
    """Node table of a subspace ensemble: tree t = models[t] on subsets[t]."""
    out = None
    for t, (m, idx) in enumerate(zip(models, subsets)):
        part = forest_nodes(m, cols, tree_id=t, feature_map=idx)
        out = part if out is None else out.unionByName(part)
    return out
