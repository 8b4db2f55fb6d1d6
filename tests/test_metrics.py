import math

from canopy.functions.metrics import error_rate, mispredicted, pooled_error_rate, regression_metrics


def test_error_rate_and_empty(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (2.0, 2.0), (None, 1.0)], "prediction double, label double")
    r = error_rate(df).first()
    assert (r["n_test"], r["n_wrong"]) == (4, 2) and r["error_rate"] == 0.5
    assert mispredicted(df).count() == 2
    empty = error_rate(df.where("false")).first()
    assert empty["n_test"] == 0 and empty["error_rate"] is None


def test_pooled(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (0, 0.0, 1.0), (1, 1.0, 1.0), (1, 1.0, 1.0)],
                               "tree_id int, prediction double, label double")
    rows = {r["tree_id"]: r for r in pooled_error_rate(df).collect()}
    assert rows[None]["error_rate"] == 0.25 and rows[0]["error_rate"] == 0.5 and rows[1]["error_rate"] == 0.0


def test_regression_metrics(spark):
    pts = [(1.0, 1.5), (2.0, 1.5), (3.0, 3.5), (4.0, 3.0)]
    df = spark.createDataFrame(pts, "label double, prediction double")
    r = regression_metrics(df).first()
    err = [p - y for y, p in pts]
    assert math.isclose(r["rmse"], math.sqrt(sum(e * e for e in err) / 4))
    assert math.isclose(r["mae"], sum(abs(e) for e in err) / 4)
    ybar = sum(y for y, _ in pts) / 4
    sst = sum((y - ybar) ** 2 for y, _ in pts)
    assert math.isclose(r["r2_sse"], 1 - sum(e * e for e in err) / sst)
    import numpy as np
    c = np.corrcoef([y for y, _ in pts], [p for _, p in pts])[0, 1]
    assert math.isclose(r["r2_pearson"], c * c, rel_tol=1e-9)


def test_constant_label_and_prediction(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "label double, prediction double")
    r = regression_metrics(df).first()
    assert r["r2_pearson"] is None and r["r2_sse"] is None
    df2 = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    r2 = regression_metrics(df2).first()
    assert r2["r2_pearson"] is None or r2["r2_pearson"] != r2["r2_pearson"] or r2["r2_pearson"] == 0.0
