"""Results that do not depend on partitions, missing values, frequent rows or settings out of range."""

import pytest
from pyspark.sql import functions as F

from canopy.functions.columns import md5_unit
from canopy.functions.metrics import regression_metrics
from canopy.operators import mltrees
from canopy.operators.binning import fit_thresholds
from canopy.operators.growth import grow_trees
from canopy.operators.linear import linear_sgd, moments
from canopy.operators.splits import hash_split
from canopy.plans.jobs import bagged_forest, linear_regression_job, poisson_weight, with_row_counts
from canopy.session import drop_scratch, ensure_checkpoint_dir, scratch_path


def table(nodes):
    return sorted(tuple(r) for r in nodes.collect())


def test_forest_is_the_same_under_any_partitioning(spark):
    rows = spark.range(300_000).select("id", (F.col("id") % 3).cast("double").alias("label"),
                                       F.sin("id").alias("a"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0).alias("b"))
    cuts, forests = [], []
    for parts in (3, 8, 17):
        dealt = rows.repartition(parts, "id")
        cuts.append(fit_thresholds(dealt, ["a", "b"]))
        forests.append(table(bagged_forest(dealt, ["a", "b"], key_cols=["id"], trees=2, max_depth=3)))
    assert cuts[0] == cuts[1] == cuts[2] and len(cuts[0][0]) == 99
    assert forests[0] == forests[1] == forests[2]


def test_regression_tree_is_the_same_under_any_order(spark):
    rows = spark.range(20_000).select((F.sin("id") * 1000).alias("label"), (F.col("id") % 40).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    first = table(grow_trees(rows, ["a", "b"], task="regression", max_depth=4))
    assert first == table(grow_trees(rows.orderBy(F.xxhash64("label")).repartition(5), ["a", "b"], task="regression", max_depth=4))


@pytest.mark.parametrize("task", ["classification", "regression"])
def test_rows_without_a_label_do_not_count(spark, task):
    rows = spark.range(400).select((F.col("id") % 2 * 9.0).alias("label"), (F.col("id") % 2).cast("double").alias("a"))
    more = rows.union(rows.select(F.lit(None).cast("double"), "a")).union(rows.limit(5).select(F.lit(float("nan")), "a"))
    assert table(grow_trees(more, ["a"], task=task, max_depth=1)) == table(grow_trees(rows, ["a"], task=task, max_depth=1))


def test_missing_values_leave_the_line_alone(spark):
    rows = spark.range(700).select((F.col("id") * 3.0 / 700 + 2).alias("label"), (F.col("id") / 700).alias("x"))
    holes = rows.union(rows.select("label", F.lit(None).cast("double"))).union(rows.select(F.lit(None).cast("double"), "x"))
    a, b = linear_sgd(rows, ["x"]), linear_sgd(holes, ["x"])
    assert b.dropped == 1400 and a.weights == pytest.approx(b.weights) and a.intercept == pytest.approx(b.intercept)
    assert moments(rows.where("false"), ["x"])["n"] == 0


def test_metrics_are_over_complete_pairs(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (3.0, 2.5), (4.0, 4.5)]
    whole = regression_metrics(spark.createDataFrame(rows, "prediction double, label double")).first()
    holes = regression_metrics(spark.createDataFrame([*rows, (None, 9.0), (7.0, None)], "prediction double, label double")).first()
    assert holes["n"] == 4 and holes["n_missing"] == 2 and whole["n_missing"] == 0
    assert all(holes[c] == pytest.approx(whole[c]) for c in ("rmse", "mae", "r2_pearson", "r2_sse"))


def test_equal_rows_are_drawn_one_by_one(spark):
    """600 rows of two values: every tree's class totals stay within five standard deviations."""
    rows = spark.range(6000).select((F.col("id") % 2).cast("double").alias("label"), F.lit(1.0).alias("a"))
    drawn, counts = with_row_counts(rows, ["a"], "label", 3, 5)
    sums = drawn.groupBy("label").agg(*[F.sum(c).alias(f"t{k}") for k, c in enumerate(counts)]).collect()
    for r in sums:
        assert all(abs(r[f"t{k}"] - 3000) < 5 * 3000 ** 0.5 for k in range(5)) and len({r[f"t{k}"] for k in range(5)}) > 1
    root = bagged_forest(rows, ["a"], trees=4, max_depth=1).where("node_id = 1").collect()
    assert all(min(r["class_counts"]) > 2700 for r in root)


def test_poisson_counts_have_the_right_mean(spark):
    got = spark.range(100_000).select(poisson_weight(md5_unit(["id"], "draw", 1)).alias("w")).agg(F.avg("w"), F.variance("w")).first()
    assert abs(got[0] - 1) < 0.02 and abs(got[1] - 1) < 0.03


def test_settings_out_of_range_are_refused(spark):
    rows = spark.range(10).select(F.lit(1.0).alias("label"), F.col("id").cast("double").alias("a"))
    for frac in (0.0004, 0.99961, -0.1, 1.1):
        with pytest.raises(ValueError):
            hash_split(rows, ["a"], frac)
    with pytest.raises(ValueError):
        mltrees.forest_classify(rows, ["a"], trees=0)
    assert mltrees.forest_classify(rows, ["a"], trees=1, n_classes=2).getNumTrees == 1
    with pytest.raises(ValueError):
        grow_trees(rows, ["a"], max_depth=40)


def test_scratch_is_only_below_the_checkpoint_folder(spark, monkeypatch):
    with pytest.raises(ValueError):
        drop_scratch(spark, "/tmp/elsewhere")
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_linear_job_returns_its_model(spark):
    rows = spark.range(500).select((F.col("id") * 2.0).alias("label"), F.col("id").cast("double").alias("x"))
    result = linear_regression_job(rows, ["x"])
    assert result.linear.cols == ("x",) and len(result.linear.weights) == 1


def test_wide_moments_are_one_plan(spark):
    """A hundred features: the moments equal sums by hand, without a column per pair."""
    rows = spark.range(50).select(F.col("id").cast("double").alias("label"), *[((F.col("id") * (k + 1)) % 11).cast("double").alias(f"x{k}") for k in range(100)])
    m = moments(rows, [f"x{k}" for k in range(100)])
    x = [[(i * (k + 1)) % 11 for k in range(100)] for i in range(50)]
    assert m["n"] == 50 and m["szz"][3][97] == sum(r[3] * r[97] for r in x) and m["szy"][5] == sum(i * r[5] for i, r in enumerate(x))
