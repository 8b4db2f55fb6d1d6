import math

import pytest
from pyspark.sql import functions as F

from canopy.models import iris
from canopy.operators.growth import NODE_SCHEMA
from canopy.operators.nodes import collect_trees, predict_classes, predict_mean, score_nodes, tree_columns
from canopy.plans.inputs import iris_like
from conftest import SF_SMALL


def test_case_and_walk_agree(spark):
    data = iris_like(spark, SF_SMALL)
    nodes = iris.forest_table(spark, iris.R_FOREST)
    trees = collect_trees(nodes)
    a = data.select(F.array(*tree_columns(trees, "case")).alias("v"))
    b = data.select(F.array(*tree_columns(trees, "walk")).alias("v"))
    assert a.collect() == b.collect()


def test_missing_values(spark):
    nodes = iris.forest_table(spark, iris.R_FOREST)
    df = spark.createDataFrame(
        [(None, 3.0, 1.0, 0.2), (5.0, 3.0, 1.0, float("nan"))],
        "`Sepal.Length` double, `Sepal.Width` double, `Petal.Length` double, `Petal.Width` double")
    for method in ("case", "walk"):
        rows = score_nodes(df, nodes, method).collect()
        # NULL Sepal.Length: tree 0 tests it first -> NULL vote; others decide on Petal.Width
        assert rows[0]["votes"][0] is None and rows[0]["votes"][1] == 0.0
        # NaN Petal.Width goes right at tree 1's root (left would be setosa = 0.0)
        assert rows[1]["votes"][1] == 1.0


def stumps(spark, votes):
    """One-leaf trees that vote as given (None: a split on a column that is NULL)."""
    rows = []
    for t, v in enumerate(votes):
        if v is None:
            rows += [(t, 1, None, None, 0, 0, "x", 0.0, 2, 3, None, None, None, None, None),
                     (t, 2, 1, True, 1, None, None, None, None, None, 0.0, None, None, None, None),
                     (t, 3, 1, False, 1, None, None, None, None, None, 0.0, None, None, None, None)]
        else:
            rows.append((t, 1, None, None, 0, None, None, None, None, None, v, None, None, None, None))
    return spark.createDataFrame(rows, NODE_SCHEMA)


def test_votes(spark):
    df = spark.createDataFrame([(None,)], "x double")

    def of(votes, n=3):
        nodes = stumps(spark, votes)
        r = predict_classes(df, nodes, n).first()
        return r["prediction"], predict_mean(df, nodes).first()["prediction"], r["probability"]

    assert of([0.0, 1.0, 1.0])[0] == 1.0 and math.isclose(of([0.0, 1.0, 1.0])[1], 2 / 3)
    assert of([2.0, 1.0, None]) == (1.0, 1.5, [0.0, 0.5, 0.5])     # ties -> lowest class
    assert of([None, None]) == (None, None, None)
    assert of([2.0, 0.0, 1.0])[0] == 0.0


def test_vote_outside_the_classes_is_refused(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    for bad in (12.0, -1.0, 0.5):
        with pytest.raises(ValueError, match="outside the classes"):
            predict_classes(df, stumps(spark, [0.0, bad]), 10)


def test_hard_vote_is_not_probability_sum(spark):
    # three trees: two vote class 1 weakly, one votes 0; hard vote must be 1
    df = spark.createDataFrame([(1.0,)], "x double")
    assert predict_classes(df, stumps(spark, [1.0, 1.0, 0.0]), 2).first()["prediction"] == 1.0


