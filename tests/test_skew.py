"""A third of all rows on one key: results stay whole and exact."""

from pyspark.sql import functions as F

from canopy.operators.growth import grow_trees
from canopy.operators.splits import holdout_complement


def _hot(spark, n=30000):
    # one value holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
        (F.col("id") % 5).cast("double").alias("x"))


def test_complement_hot_value_in_train(spark):
    df = _hot(spark)
    train = df.where("k IN (7, 1, 2)")
    out = holdout_complement(df, train)
    pdf = df.toPandas()
    tdf = set(map(tuple, train.toPandas().values.tolist()))
    expect = sum(1 for r in pdf.values.tolist() if tuple(r) not in tdf)
    assert out.count() == expect


def test_complement_hot_value_kept_whole(spark):
    df = _hot(spark)
    train = df.where("k = 1")
    out = holdout_complement(df, train)
    hot = df.where("k = 7").count()
    assert out.where("k = 7").count() == hot >= 10000


def test_tree_on_hot_node(spark):
    df = _hot(spark).select(F.when(F.col("k") == 7, 1.0).otherwise(0.0).alias("label"),
                            F.col("k").cast("double").alias("k"), "x")
    nodes = grow_trees(df, ["k", "x"], max_depth=2).collect()
    root = [r for r in nodes if r["node_id"] == 1][0]
    assert root["row_count"] == 30000 and root["feature_name"] == "k"
