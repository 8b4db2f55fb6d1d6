"""Registered queries on wide tables and large models, with their SQL.

Like ``queries``, each takes (spark, sf_dir), reads the test tables and
returns a DataFrame.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.models import iris
from canopy.operators.growth import TreeSpec, grow_trees
from canopy.operators.nodes import predict_classes, predict_distribution, predict_mean
from canopy.operators.splits import hash_split
from canopy.plans.inputs import KEYS, TRAIN_FRAC, iris_like, lineitem_binary, table
from canopy.plans.oracle import KEYS as SQL_KEYS, SCORE_R, SCORE_SPARK, STATUS, _argmax2, _embedding_input, _train_input, _tree_levels_body, ensemble_sql, xval
from canopy.plans.queries import STATUS_CLASSES, _r, tree_levels_nodes
from canopy.session import scratch_path, stored
from canopy.sinks.pmml import ModelMeta, forest_to_pmml, write_forest, write_pmml
from canopy.sources.pmml import documents_from_pmml, forest_from_pmml, score_documents

WIDTH = 64
WIDE_DEPTH = 4


def q_wide_tree(spark: SparkSession, sf: str) -> DataFrame:
    """M12 + M14 on a wide table: one tree over all 64 slots of the embeddings, grown without shuffling a row."""
    cols = [f"e{i}" for i in range(WIDTH)]
    wide = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"),
                                                 *[F.get("embedding", i).cast("double").alias(c) for i, c in enumerate(cols)])
    train, test = hash_split(wide, ["vec_id"], TRAIN_FRAC)
    nodes = grow_trees(train, cols, "label", specs=[TreeSpec(0, list(range(WIDTH)))], max_depth=WIDE_DEPTH)
    return predict_classes(test, nodes, 10).select("vec_id", "label", "prediction")


def rank_tree(spark: SparkSession, values: DataFrame, feature: str, tree_id: int) -> DataFrame:
    """Node table of the search tree over ``values`` (v, distinct): the leaf of x predicts how many of them are below x.

    The ranks come from a sort in ranges: places inside each range, and the
    counts of the ranges before it.
    """
    ranges = stored(values.repartitionByRange("v").sortWithinPartitions("v").select(
        "v", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).alias("place")), "ranges")
    before, total = [], 0
    for r in ranges.groupBy("part").count().orderBy("part").collect():
        before.append((r["part"], total))
        total += r["count"]
    starts = spark.createDataFrame(before, "part int, before long")
    ranked = ranges.join(F.broadcast(starts), "part").select((F.col("before") + F.col("place")).alias("rank"), "v")
    depth = max(1, math.ceil(math.log2(max(total, 2))))
    ids = spark.range(1, 1 << (depth + 1)).withColumnRenamed("id", "node_id")
    d = (F.length(F.bin("node_id")) - 1).cast("int")
    place = F.col("node_id") - F.pow(F.lit(2.0), d.cast("double")).cast("long")
    span = F.pow(F.lit(2.0), (depth - d).cast("double")).cast("long")  # leaves below the node
    inner = d < depth
    last = F.when(inner, F.least(place * span + F.expr("1") * span / 2 - 1, F.lit(total - 1)).cast("long"))
    nodes = ids.select("node_id", d.alias("depth"), inner.alias("inner"), last.alias("rank"), F.least(place, F.lit(total - 1)).cast("double").alias("leaf"))
    up = F.col("node_id") > 1
    return nodes.join(ranked, "rank", "left").select(
        F.lit(tree_id).alias("tree_id"), "node_id", F.when(up, F.expr("node_id DIV 2")).alias("parent_id"), F.when(up, F.col("node_id") % 2 == 0).alias("is_left"),
        "depth", F.when(F.col("inner"), F.lit(tree_id)).alias("feature"), F.when(F.col("inner"), F.lit(feature)).alias("feature_name"),
        F.when(F.col("inner"), F.col("v")).alias("threshold"), F.when(F.col("inner"), F.col("node_id") * 2).alias("left_id"),
        F.when(F.col("inner"), F.col("node_id") * 2 + 1).alias("right_id"), F.when(~F.col("inner"), F.col("leaf")).alias("prediction"),
        F.lit(None).cast("array<double>").alias("class_counts"), F.lit(None).cast("long").alias("row_count"),
        F.lit(None).cast("double").alias("impurity"), F.lit(None).cast("double").alias("gain"))


RANKED = ["l_extendedprice", "l_orderkey"]


def _rank_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Search trees over the values of two columns: as many leaves as the table has values, or more."""
    li = table(spark, sf, "lineitem")
    trees = [rank_tree(spark, li.select(F.col(c).cast("double").alias("v")).where("v IS NOT NULL").distinct(), c, t) for t, c in enumerate(RANKED)]
    return stored(trees[0].unionByName(trees[1]), "nodes")


def q_score_large_model(spark: SparkSession, sf: str) -> DataFrame:
    """I4 with the model as a table: two search trees that grow with the data, joined level by level, mean vote."""
    rows = table(spark, sf, "lineitem").select(*KEYS, "l_extendedprice")
    return predict_mean(rows, _rank_forest(spark, sf), method="join").select(*KEYS, "l_extendedprice", "prediction")


def q_pmml_large_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K1 + E8 + S3 in parts: the search trees written as ordered text parts, read back as a stream and scored."""
    path = scratch_path(spark, "pmml")
    write_forest(_rank_forest(spark, sf), ModelMeta(tuple(RANKED), "place", None), path)
    nodes, _ = forest_from_pmml(spark, path)
    rows = table(spark, sf, "lineitem").select(*KEYS, "l_extendedprice")
    return predict_mean(rows, nodes, method="join").select(*KEYS, "l_extendedprice", "prediction")


def q_pmml_side_by_side(spark: SparkSession, sf: str) -> DataFrame:
    """S3 of several documents: two forests read from one folder, each row scored by both."""
    path = scratch_path(spark, "pmml")
    meta = ModelMeta(tuple(iris.FEATURES), iris.LABEL, tuple(iris.CLASSES))
    for name, forest in (("r", iris.R_FOREST), ("spark", iris.SPARK_FOREST)):
        write_pmml(forest_to_pmml(iris.forest_table(spark, forest), meta), f"{path}/{name}")
    nodes, metas = documents_from_pmml(spark, f"{path}/*")
    scored = score_documents(iris_like(spark, sf), nodes, metas)
    return scored.select(F.regexp_extract("path", "/(r|spark)/[^/]*$", 1).alias("model"), *KEYS, "prediction")


def q_leaf_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """I5, second form: class shares at the leaf of the depth-2 tree, per hold-out row."""
    _, test = hash_split(lineitem_binary(spark, sf), KEYS, TRAIN_FRAC)
    shares = predict_distribution(test, tree_levels_nodes(spark, sf), len(STATUS_CLASSES))
    return shares.select(*KEYS, "label", _r(F.get("probability", 1), 12).alias("p_open"), "prediction")


LARGE = {
    "wide_tree": q_wide_tree,
    "score_large_model": q_score_large_model,
    "pmml_large_roundtrip": q_pmml_large_roundtrip,
    "pmml_side_by_side": q_pmml_side_by_side,
    "leaf_distribution": q_leaf_distribution,
}

_PLACES = f"""
SELECT {SQL_KEYS}, l_extendedprice,
       ((dense_rank() OVER (ORDER BY l_extendedprice) - 1)::DOUBLE + (dense_rank() OVER (ORDER BY l_orderkey) - 1)::DOUBLE) / 2.0::DOUBLE AS prediction
FROM lineitem"""

_SHARES = _tree_levels_body() + f""",
te AS ({_train_input(STATUS, 600, test=True)}),
w1 AS (SELECT te.*, CASE WHEN {xval("r.f")} <= r.t THEN 2 ELSE 3 END AS side, r.L_c0 AS l0, r.L_c1 AS l1, r.T_c0 - r.L_c0 AS r0, r.T_c1 - r.L_c1 AS r1
       FROM te, root r),
w2 AS (SELECT w.*, k.f, k.t AS cut, k.L_c0 AS kl0, k.L_c1 AS kl1, k.T_c0 - k.L_c0 AS kr0, k.T_c1 - k.L_c1 AS kr1
       FROM w1 w LEFT JOIN lvl1 k ON k.node = w.side),
w3 AS (SELECT *, CASE WHEN f IS NULL THEN CASE side WHEN 2 THEN l0 ELSE r0 END WHEN {xval("f")} <= cut THEN kl0 ELSE kr0 END AS c0,
              CASE WHEN f IS NULL THEN CASE side WHEN 2 THEN l1 ELSE r1 END WHEN {xval("f")} <= cut THEN kl1 ELSE kr1 END AS c1 FROM w2)
SELECT {SQL_KEYS}, label, round(c1 / (c0 + c1), 12) AS p_open, {_argmax2("c0", "c1")} AS prediction FROM w3"""

LARGE_SQL = {
    "leaf_distribution": _SHARES,
    "wide_tree": ensemble_sql(WIDE_DEPTH, [list(range(WIDTH))], _embedding_input(False, None), _embedding_input(True, None), ["vec_id"], WIDTH, 10,
                              "classification", None, full_rule=True) + "\nSELECT vec_id, label, prediction FROM pred",
    "score_large_model": _PLACES,
    "pmml_large_roundtrip": _PLACES,
    "pmml_side_by_side": f"SELECT 'r' AS model, * FROM ({SCORE_R}) UNION ALL SELECT 'spark', * FROM ({SCORE_SPARK})",
}
