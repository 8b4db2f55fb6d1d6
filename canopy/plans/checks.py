"""Further registered queries: wide features, missing values, forests with drawn features, documents, splits as facts.

Like ``queries``, each takes (spark, sf_dir), reads the test tables and
returns a DataFrame.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions.metrics import regression_metrics
from canopy.models import iris
from canopy.operators import mltrees
from canopy.operators.linear import describe_linear, scaled_linear_sgd
from canopy.operators.nodes import predict_classes, predict_mean
from canopy.operators.splits import bernoulli_sample, hash_split, random_split
from canopy.operators.splitscan import gini_split_scan
from canopy.plans import jobs
from canopy.plans.inputs import (FEATURES, KEYS, LINEAR_TRAIN_FRAC, TRAIN_FRAC, flag_label, iris_like, lineitem_flags,
                                 lineitem_price, status_label, table)
from canopy.plans.queries import STATUS_CLASSES, _r, tree_levels_nodes
from canopy.session import scratch_path
from canopy.sinks.pmml import ModelMeta, forest_to_pmml, write_pmml
from canopy.sources.pmml import forest_from_pmml, pmml_meta, read_documents
from canopy.sources.points import MODES, read_points

WIDE = [*FEATURES, "l_extendedprice"]


def _wide(spark: SparkSession, sf: str, label) -> DataFrame:
    return table(spark, sf, "lineitem").select(*KEYS, label.alias("label"), *WIDE)


def q_gini_split_scan_wide(spark: SparkSession, sf: str) -> DataFrame:
    """M12 with a feature of many distinct values: exact cut points by rank."""
    train, _ = hash_split(_wide(spark, sf, status_label()), KEYS, TRAIN_FRAC)
    return gini_split_scan(train, WIDE).select("feature", "feature_name", "threshold", _r("gain", 12),
                                               F.col("n_left").cast("long").alias("n_left"), F.col("n_right").cast("long").alias("n_right"))


def q_bagged_forest_wide(spark: SparkSession, sf: str) -> DataFrame:
    """M14 with a feature of many distinct values."""
    train, test = hash_split(_wide(spark, sf, flag_label()), KEYS, TRAIN_FRAC)
    nodes = jobs.bagged_forest(train, WIDE, "label", key_cols=KEYS, trees=3, attributes=2)
    return predict_classes(test, nodes, 3).select(*KEYS, "label", "prediction")


def q_bagged_rows(spark: SparkSession, sf: str) -> DataFrame:
    """M14 without row keys: equal rows are drawn by occurrence; every row is then scored."""
    rows = lineitem_flags(spark, sf)
    nodes = jobs.bagged_forest(rows.select("label", *FEATURES), FEATURES, "label", trees=3, attributes=2)
    return predict_classes(rows, nodes, 3).select(*KEYS, "label", "prediction")


def q_forest_classify(spark: SparkSession, sf: str) -> DataFrame:
    """M3 + I4 + A10: forest with bootstrap by row and features drawn per node, hard vote per hold-out row."""
    train, test = hash_split(lineitem_flags(spark, sf), KEYS, TRAIN_FRAC)
    nodes = jobs.random_forest(train, FEATURES, key_cols=KEYS, seed=mltrees.FOREST_SEED)
    return predict_classes(test, nodes, 3).select(*KEYS, "label", "prediction")


def q_forest_regress(spark: SparkSession, sf: str) -> DataFrame:
    """M4 + A11: regression forest with bootstrap by row and features drawn per node, mean vote per hold-out row."""
    train, test = hash_split(lineitem_price(spark, sf), KEYS, TRAIN_FRAC)
    nodes = jobs.random_forest(train, FEATURES, key_cols=KEYS, seed=mltrees.FOREST_SEED, task="regression")
    return predict_mean(test, nodes).select(*KEYS, "label", _r("prediction", 4))


def _model_facts(model, nodes: DataFrame, test: DataFrame) -> DataFrame:
    """Facts of a Spark forest that hold on any cluster: trees, depth, counts that add up, rows scored unlike the model's own trees."""
    vectors = mltrees.assemble(test, FEATURES)
    for k, tree in enumerate(model.trees):
        tree.setPredictionCol(f"m{k}").setFeaturesCol("features")
        if hasattr(tree, "setRawPredictionCol"):
            tree.setRawPredictionCol("").setProbabilityCol("")
        vectors = tree.transform(vectors)
    own = [F.col(f"m{k}") for k in range(len(model.trees))]
    voted = predict_mean(vectors, nodes, keep_votes=True)
    unlike = voted.agg(F.count_if(F.exists(F.zip_with("votes", F.array(*own), lambda a, b: ~a.eqNullSafe(b)), lambda x: x)).alias("n_unlike"))
    kids = nodes.where("parent_id is not null").groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(F.sum("row_count").alias("below"))
    inner = nodes.where("left_id is not null").join(kids, ["tree_id", "node_id"])
    sums = inner.agg(F.coalesce(F.bool_and(F.col("below") == F.col("row_count")), F.lit(True)).alias("counts_add_up"))
    facts = nodes.agg(F.count_distinct("tree_id").alias("n_trees"), (F.max("depth") <= mltrees.DEFAULT_DEPTH).alias("depth_ok"))
    whole = facts.unionByName(sums, allowMissingColumns=True).unionByName(unlike, allowMissingColumns=True)
    return whole.agg(F.max("n_trees").alias("n_trees"), F.bool_and("depth_ok").alias("depth_ok"),
                     F.bool_and("counts_add_up").alias("counts_add_up"), F.max("n_unlike").alias("n_unlike"))


def q_forest_classify_ml(spark: SparkSession, sf: str) -> DataFrame:
    """M3 + E1 on Spark's own learner (its bootstrap depends on partitions): facts that always hold."""
    train, test = hash_split(lineitem_flags(spark, sf), KEYS, TRAIN_FRAC)
    model = mltrees.forest_classify(train, FEATURES, n_classes=3)
    return _model_facts(model, mltrees.forest_nodes(model, FEATURES), test)


def q_forest_regress_ml(spark: SparkSession, sf: str) -> DataFrame:
    """M4 + E1 on Spark's own learner: facts that always hold."""
    train, test = hash_split(lineitem_price(spark, sf), KEYS, TRAIN_FRAC)
    model = mltrees.forest_regress(train, FEATURES)
    return _model_facts(model, mltrees.forest_nodes(model, FEATURES), test)


def q_linear_sgd_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """M7 with missing features and labels: only complete rows count."""
    rows = lineitem_price(spark, sf)
    line = F.col("l_linenumber")
    rows = rows.withColumn("l_quantity", F.when(line != 3, F.col("l_quantity"))).withColumn("label", F.when(line != 5, F.col("label")))
    train, _ = hash_split(rows, KEYS, LINEAR_TRAIN_FRAC)
    _, model = scaled_linear_sgd(train, FEATURES, "label", steps=100, step=0.1)
    dropped = spark.createDataFrame([("dropped", float(model.dropped))], "term string, weight double")
    return describe_linear(spark, model).union(dropped).select("term", _r("weight", 4))


def q_regression_metrics_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """A3-A7 with missing predictions and labels."""
    line = F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select(F.when(line != 2, F.col("l_quantity") * 1500.0).alias("prediction"),
                                               F.when(line != 4, F.col("l_extendedprice")).alias("label"))
    return regression_metrics(rows).select("n", "n_missing", _r("rmse", 6), _r("mae", 6), _r("r2_pearson", 9), _r("r2_sse", 9))


# ------------------------------------------------------------ documents

def legacy_document(forest: list, features: list[str], classes: list[str], label: str) -> str:
    """A forest of nested tuples in the legacy dialect: inner nodes carry their own split under an unreliable operator."""
    def node(tree, number: int) -> str:
        if isinstance(tree, str):
            return f'<Node id="{number}" score="{tree}"/>'
        feature, threshold, left, right = tree
        operator = ("greaterThan", "lessOrEqual")[number % 2]
        return (f'<Node id="{number}"><SimplePredicate field="{feature}" operator="{operator}" value="{threshold}"/>'
                f'{node(left, 2 * number)}{node(right, 2 * number + 1)}</Node>')

    fields = "".join(f'<DataField name="{f}" optype="continuous" dataType="double"/>' for f in features)
    values = "".join(f'<Value value="{c}"/>' for c in classes)
    trees = "".join(f'<Segment id="{k + 1}"><TreeModel functionName="classification">{node(t, 1)}</TreeModel></Segment>' for k, t in enumerate(forest))
    return (f'<PMML version="4.2"><DataDictionary>{fields}<DataField name="{label}" optype="categorical" dataType="string">{values}</DataField>'
            f'</DataDictionary><MiningModel functionName="classification"><MiningSchema><MiningField name="{label}" usageType="predicted"/></MiningSchema>'
            f'<Segmentation multipleModelMethod="majorityVote">{trees}</Segmentation></MiningModel></PMML>')


def q_pmml_legacy_score(spark: SparkSession, sf: str) -> DataFrame:
    """S3 in the legacy dialect + I4 + A10: document text -> nodes -> vote over lineitem."""
    path = scratch_path(spark, "pmml")
    text = legacy_document(iris.SPARK_FOREST, iris.FEATURES, iris.CLASSES, iris.LABEL)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    nodes, meta = forest_from_pmml(spark, path)
    return predict_classes(iris_like(spark, sf), nodes, len(meta.classes)).select(*KEYS, "prediction")


def q_pmml_document_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Header, output fields, version and names of the document of a grown tree, read back as rows."""
    path = scratch_path(spark, "pmml")
    nodes = tree_levels_nodes(spark, sf)
    write_pmml(forest_to_pmml(nodes, ModelMeta(tuple(FEATURES), "l_linestatus", tuple(STATUS_CLASSES))), path)
    back, _ = forest_from_pmml(spark, path)
    meta = pmml_meta(read_documents(spark, path).where(F.trim("value") != ""))
    lists = {"features": "features", "classes": "classes", "outputs": "outputs"}
    texts = {"version": "version", "description": "description", "model_name": "model_name", "algorithm": "algorithm", "label": "label"}
    entries = [F.struct(F.lit(k).alias("field"), F.col(c).alias("value")) for k, c in texts.items()]
    entries += [F.struct(F.lit(k).alias("field"), F.array_join(c, ",").alias("value")) for k, c in lists.items()]
    fields = meta.select(F.explode(F.array(*entries)).alias("e")).select("e.field", "e.value")
    # every node's distribution adds up to its records
    whole = back.agg(F.concat_ws("/", F.count_if(F.aggregate("class_counts", F.lit(0.0), lambda a, x: a + x) == F.col("row_count")), F.count(F.lit(1))).alias("value"))
    return fields.union(whole.select(F.lit("distributions"), "value"))


# ------------------------------------------------------------ splits and lines as facts

def q_random_split_facts(spark: SparkSession, sf: str) -> DataFrame:
    """D1 + D2: what holds of Spark's random split and sample under any partitioning."""
    rows = table(spark, sf, "lineitem").select(*KEYS, "l_extendedprice")
    n = rows.count()
    a, b = random_split(rows, [0.6, 0.4], seed=42)
    s = bernoulli_sample(rows, 0.6, seed=42)
    both = a.unionAll(b)
    sigma = (n * 0.6 * 0.4) ** 0.5

    def near(k: int) -> bool:
        return abs(k - 0.6 * n) <= 5 * sigma

    facts = [(n, a.count() + b.count() == n, both.exceptAll(rows).isEmpty() and rows.exceptAll(both).isEmpty(), near(a.count()),
              s.exceptAll(rows).isEmpty(), near(s.count()))]
    return spark.createDataFrame(facts, "n_rows long, parts_add_up boolean, parts_are_the_rows boolean, part_near_share boolean, "
                                        "sample_of_the_rows boolean, sample_near_share boolean")


def q_read_points_modes(spark: SparkSession, sf: str) -> DataFrame:
    """S1 + S2: lines written as text and read in each mode; per mode the rows, the malformed ones and the label sum, or the failure."""
    names = ["p_partkey", "p_size", "p_retailprice"]
    part = table(spark, sf, "part")
    line = F.concat(F.concat_ws(",", *[F.col(c).cast("string") for c in names]), F.when(F.col("p_size") > 45, F.lit(",")).otherwise(F.lit("")))
    path = scratch_path(spark, "lines")
    part.select(line.alias("value")).write.text(path)
    out = []
    for mode in MODES:
        rows = read_points(spark, path, names, mode=mode)
        bad = F.count_if(F.col("_corrupt_record").isNotNull()) if "_corrupt_record" in rows.columns else F.lit(0).cast("long")
        try:
            r = rows.agg(F.count(F.lit(1)).alias("n"), bad.alias("bad"), F.round(F.sum("label"), 2).alias("total")).first()
            out.append((mode, False, r.n, r.bad, r.total))
        except PySparkException:
            out.append((mode, True, None, None, None))
    return spark.createDataFrame(out, "mode string, failed boolean, n_rows long, n_bad long, label_sum double")


def q_subspace_report_regress(spark: SparkSession, sf: str) -> DataFrame:
    """T8 as intended: per-tree, pooled and voted hold-out metrics of the regression ensemble."""
    report = jobs.subspace_ensemble_job(lineitem_price(spark, sf), FEATURES, task="regression", key_cols=KEYS, attributes=2).report
    return report.select("kind", "tree_id", "n", "n_missing", _r("rmse", 4), _r("mae", 4), _r("r2_pearson", 9), _r("r2_sse", 9))


CHECKS = {
    "gini_split_scan_wide": q_gini_split_scan_wide,
    "bagged_forest_wide": q_bagged_forest_wide,
    "bagged_rows": q_bagged_rows,
    "forest_classify": q_forest_classify,
    "forest_regress": q_forest_regress,
    "forest_classify_ml": q_forest_classify_ml,
    "forest_regress_ml": q_forest_regress_ml,
    "linear_sgd_nulls": q_linear_sgd_nulls,
    "regression_metrics_nulls": q_regression_metrics_nulls,
    "pmml_legacy_score": q_pmml_legacy_score,
    "pmml_document_fields": q_pmml_document_fields,
    "random_split_facts": q_random_split_facts,
    "read_points_modes": q_read_points_modes,
    "subspace_report_regress": q_subspace_report_regress,
}
