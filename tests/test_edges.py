"""Edge rows from FIXTURES.md: single class, constant column, NaN, NULL,
duplicates on both sides of a split, CSV files on disk end to end."""

from pyspark.sql import functions as F

from canopy.functions.metrics import error_rate
from canopy.operators.growth import grow_trees
from canopy.operators.nodes import predict_classes
from canopy.operators.splitscan import gini_split_scan
from canopy.operators.splits import hash_split, holdout_complement
from canopy.plans.inputs import FEATURES, KEYS, table
from canopy.plans.jobs import forest_classification_job
from canopy.session import scratch_path
from canopy.sinks.pmml import ModelMeta, forest_to_pmml, write_pmml
from canopy.sources.pmml import forest_from_pmml
from canopy.sources.points import read_points
from conftest import SF_SMALL


def test_single_class_gives_one_leaf(spark):
    df = spark.createDataFrame([(0.0, float(i % 7), 1.0) for i in range(50)], "label double, a double, b double")
    nodes = grow_trees(df, ["a", "b"], max_depth=3).collect()
    assert len(nodes) == 1 and nodes[0]["prediction"] == 0.0 and nodes[0]["impurity"] == 0.0


def test_constant_column_never_splits(spark):
    df = spark.createDataFrame([(float(i % 2), float(i % 5), 3.0) for i in range(40)],
                               "label double, a double, c double")
    scan = {r["feature_name"]: r for r in gini_split_scan(df, ["a", "c"]).collect()}
    assert "c" not in scan and "a" in scan
    nodes = grow_trees(df, ["a", "c"], max_depth=3).collect()
    assert all(r["feature_name"] in (None, "a") for r in nodes)


def test_nan_and_null_features(spark):
    rows = [(float(i % 2), float(i) if i % 9 else float("nan"), None if i % 11 == 0 else float(i % 3))
            for i in range(200)]
    df = spark.createDataFrame(rows, "label double, a double, b double")
    nodes = grow_trees(df, ["a", "b"], max_depth=2)
    assert all(r["threshold"] is None or r["threshold"] == r["threshold"] for r in nodes.collect())
    pred = predict_classes(df, nodes, 2).collect()
    # a NULL feature on a tree's path gives no vote -> NULL prediction, never a wrong class
    assert any(r["prediction"] is not None for r in pred)


def test_duplicates_across_split_and_complement(spark):
    li = table(spark, SF_SMALL, "lineitem")
    train, test = hash_split(li, KEYS, 0.6)
    vals = ["l_quantity", "l_discount"]
    comp = holdout_complement(li.select(*vals), train.select(*vals))
    # duplicates of a train value never reach the complement, even from the test side
    assert comp.join(train.select(*vals).distinct(), vals).count() == 0
    assert comp.count() <= test.count()


def test_csv_file_end_to_end(spark):
    li = table(spark, SF_SMALL, "lineitem")
    path = scratch_path(spark, "csv")
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    (li.select(F.concat_ws(",", *[F.col(c).cast("string") for c in FEATURES], flag.cast("double").cast("string")))
       .write.text(path))
    pts = read_points(spark, path, [*FEATURES, "species"])
    assert pts.columns == ["label", *FEATURES] and pts.count() == li.count()
    res = forest_classification_job(pts, FEATURES)
    assert res.report.first()["n_test"] > 0
    meta = ModelMeta(tuple(FEATURES), "species", ("A", "N", "R"))
    out = scratch_path(spark, "pmml")
    write_pmml(forest_to_pmml(res.nodes, meta), out)
    back, m2 = forest_from_pmml(spark, out)
    assert m2 == meta
    a = predict_classes(pts, res.nodes, 3).select("prediction").collect()
    b = predict_classes(pts, back, 3).select("prediction").collect()
    assert a == b


def test_empty_holdout(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "prediction double, label double").where("false")
    assert error_rate(df).first()["error_rate"] is None


def test_null_rows_left_out_of_a_features_scan(spark):
    rows = [(float(i % 2), float(i % 7), None if i % 4 == 0 else float(i % 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "label double, a double, b double")
    scan = {r["feature_name"]: r for r in gini_split_scan(df, ["a", "b"]).collect()}
    assert scan["a"]["n_left"] + scan["a"]["n_right"] == 400
    assert scan["b"]["n_left"] + scan["b"]["n_right"] == 300


def test_settings_object():
    import pytest as _pt
    from canopy.plans.params import EnsembleSettings
    s = EnsembleSettings.from_mapping({"NUM_OF_TREES": "0", "NUM_OF_ATTRIBUTES_PER_TREE": "5",
                                       "CLASS_LABEL_INDEX": "4",
                                       "ATTRIBUTE_NAMES": "Sepal.Length,Sepal.Width,Petal.Length,Petal.Width",
                                       "CLASS_LABEL_VALUES": "setosa,versicolor,virginica",
                                       "CLASS_LABEL_NAME": "Species"})
    assert s.trees() == 3 and s.attributes(4) == 4
    assert s.field_names(5) == ["Sepal.Length", "Sepal.Width", "Petal.Length", "Petal.Width", "Species"]
    with _pt.raises(ValueError):
        EnsembleSettings(label_index=50, attribute_names=("a", "b", "c", "d")).validate(5)
