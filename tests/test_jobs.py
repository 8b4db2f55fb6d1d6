from pyspark.sql import functions as F

from canopy.functions.metrics import metric_totals, regression_metrics
from canopy.models import iris
from canopy.plans.inputs import FEATURES, KEYS, lineitem_flags, lineitem_price, table
from canopy.plans import jobs
from canopy.plans.jobs import (forest_classification_job, linear_regression_job, poisson_weight,
                               subspace_ensemble_job)
from canopy.sinks.reports import describe_forest
from canopy.streaming.scoring import read_stream, run_to_table, score_stream, stream_error_counts
from canopy.plans.inputs import iris_frame
from conftest import SF_SMALL


def test_forest_job_report(spark):
    res = forest_classification_job(lineitem_flags(spark, SF_SMALL), FEATURES, key_cols=KEYS)
    r = res.report.first()
    assert r["n_test"] > 0 and 0.0 <= r["error_rate"] <= 1.0
    assert res.nodes.select("tree_id").distinct().count() == 3


def test_subspace_job_reports_per_tree_and_pooled(spark):
    res = subspace_ensemble_job(lineitem_flags(spark, SF_SMALL), FEATURES, key_cols=KEYS, attributes=2)
    rows = {(r["kind"], r["tree_id"]): r for r in res.report.collect()}
    assert set(rows) == {("pooled", None), ("tree", 0), ("tree", 1), ("tree", 2), ("voted", None)}
    assert rows[("pooled", None)]["n_pairs"] == sum(rows[("tree", t)]["n_pairs"] for t in (0, 1, 2))
    assert rows[("voted", None)]["n_pairs"] == rows[("tree", 0)]["n_pairs"]


def test_linear_job(spark):
    res = linear_regression_job(lineitem_price(spark, SF_SMALL), FEATURES, key_cols=KEYS)
    r = res.report.first()
    assert r["n"] > 0 and r["rmse"] > 0


def test_poisson_weights_mean_one(spark):
    df = spark.range(20000).select(F.rand(7).alias("u"))
    m = df.select(F.avg(poisson_weight(F.col("u"))).alias("m"), F.variance(poisson_weight(F.col("u"))).alias("v")).first()
    assert abs(m["m"] - 1.0) < 0.03 and abs(m["v"] - 1.0) < 0.05


def test_describe_forest_layout(spark):
    lines = [r["line"] for r in describe_forest(iris.forest_table(spark, iris.R_FOREST))
             .where("tree_id = 1").orderBy("line_no").collect()]
    assert lines == [" If (Petal.Width <= 0.7)", "  Predict: 0.0", " Else (Petal.Width > 0.7)",
                     "  If (Petal.Length <= 4.95)", "   Predict: 1.0", "  Else (Petal.Length > 4.95)",
                     "   Predict: 2.0"]


def test_stream_scoring_equals_batch(spark):
    li = table(spark, SF_SMALL, "lineitem")
    nodes = iris.forest_table(spark, iris.R_FOREST)
    stream = iris_frame(read_stream(spark, f"{SF_SMALL}/lineitem.parquet", li))
    assert stream.isStreaming
    out = run_to_table(spark, score_stream(stream, nodes, 3).select(*KEYS, "prediction"))
    from canopy.operators.nodes import predict_classes
    batch = predict_classes(iris_frame(li), nodes, 3).select(*KEYS, "prediction")
    assert sorted(out.collect()) == sorted(batch.collect())


def test_stream_error_counts_is_streaming(spark):
    li = table(spark, SF_SMALL, "lineitem")
    stream = iris_frame(read_stream(spark, f"{SF_SMALL}/lineitem.parquet", li))
    agg = stream_error_counts(score_stream(stream, iris.forest_table(spark, iris.R_FOREST), 3))
    q = agg.writeStream.outputMode("complete").format("memory").queryName("err_counts") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    r = spark.table("err_counts").first()
    assert r["n_test"] == li.count()


def test_cli_jobs_end_to_end(spark):
    from canopy.plans.cli import run
    from canopy.session import scratch_path
    li = table(spark, SF_SMALL, "lineitem")
    path = scratch_path(spark, "cli-csv")
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    li.select(F.concat_ws(",", *[F.col(c).cast("string") for c in FEATURES],
                          F.col("l_extendedprice").cast("string"), flag.cast("double").cast("string"))) \
      .write.text(path)
    names = ",".join([*FEATURES, "price", "flag"])
    out = run(["forest-classify", "--input", path, "--names", names, "--classes", "A,N,R",
               "--pmml", scratch_path(spark, "cli-pmml")], spark)
    assert out["report"][0]["n_test"] > 0
    out = run(["linear", "--input", path, "--names", names, "--label", "price"], spark)
    assert out["report"][0]["n"] > 0
    out = run(["tree-regress", "--input", path, "--names", names, "--label", "3"], spark)
    assert out["report"][0]["rmse"] > 0
    out = run(["ensemble-classify", "--input", path, "--names", names, "--attributes", "2"], spark)
    assert any(r["tree_id"] is None for r in out["report"])


def test_cli_takes_settings_and_prints_the_line(spark):
    from canopy.plans.cli import run
    from canopy.session import scratch_path
    path = scratch_path(spark, "cli-csv")
    spark.range(400).selectExpr("concat_ws(',', id % 7, id % 5, id % 3, id % 2) AS value").write.text(path)
    out = run(["ensemble-classify", "--input", path, "--set", "ATTRIBUTE_NAMES=a,b,c", "--set", "NUM_OF_TREES=4",
               "--set", "NUM_OF_ATTRIBUTES_PER_TREE=2", "--set", "CLASS_LABEL_NAME=y"], spark)
    assert sum(r["kind"] == "tree" for r in out["report"]) == 4
    line = run(["linear", "--input", path, "--names", "a,b,c,y"], spark)
    assert set(line["weights"]) == {"a", "b", "c"} and line["dropped"] == 0
    regress = run(["ensemble-regress", "--input", path, "--names", "a,b,c,y"], spark)
    assert {r["kind"] for r in regress["report"]} == {"tree", "pooled", "voted"}
    bag = run(["bagged-forest", "--input", path, "--names", "a,b,c,y", "--trees", "1"], spark)
    assert bag["report"][0]["n_test"] > 0


def test_forest_jobs_do_not_depend_on_partitions(spark):
    """SURVEY T5: the same rows dealt otherwise grow the same forest and give the same report, with row keys and without."""
    from canopy.plans.inputs import FEATURES, KEYS, lineitem_flags, lineitem_price
    for job, rows in ((jobs.forest_classification_job, lineitem_flags(spark, SF_SMALL)), (jobs.forest_regression_job, lineitem_price(spark, SF_SMALL))):
        for keys in (KEYS, None):
            data = rows if keys else rows.select("label", *FEATURES)
            seen = set()
            for dealt in (data.coalesce(1), data.repartition(7, "l_tax")):
                r = job(dealt, FEATURES, key_cols=keys)
                seen.add(str(sorted(map(str, r.nodes.collect()))) + str(r.report.collect()))
            assert len(seen) == 1


def test_regression_report_adds_up_every_pair_once(spark, monkeypatch):
    """The pool's sums are put together from those of the trees, with the figures of all pairs."""
    rows = [(float(i % 7), [float(i % 5), None if i % 11 == 0 else float(i % 3)], float(i % 4)) for i in range(90)]
    scored = spark.createDataFrame(rows, "label double, votes array<double>, prediction double").repartition(3)
    read = []
    monkeypatch.setattr(jobs, "metric_totals", lambda df, **kw: read.append(df.count()) or metric_totals(df, **kw))
    got = {(r["kind"], r["tree_id"]): tuple(r)[2:] for r in jobs.ensemble_report(scored, task="regression").collect()}
    assert read == [90 * 3]
    pairs = {("tree", 0): [(v[0], y) for y, v, _ in rows], ("tree", 1): [(v[1], y) for y, v, _ in rows], ("voted", None): [(p, y) for y, _, p in rows]}
    pairs["pooled", None] = pairs["tree", 0] + pairs["tree", 1]
    for key, some in pairs.items():
        assert got.pop(key) == tuple(regression_metrics(spark.createDataFrame(some, "prediction double, label double")).first())
    assert not got
