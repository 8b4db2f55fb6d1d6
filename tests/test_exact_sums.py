"""Sums, metrics, scaling and linear models that are the same to the last bit on any partitioning."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopy.functions.exact import exact_totals, exact_values, products, root
from canopy.functions.metrics import regression_metrics
from canopy.operators import linear
from canopy.operators.linear import linear_sgd, moments, scaled_linear_sgd
from canopy.operators.scaling import fit_standardizer, standardize, standardize_stats


def total(df, terms):
    found = exact_totals(df, [], ["x"], terms).first()
    return exact_values([r.asDict() for r in found["totals"]]) if found else {}


def test_sums_are_exact(spark):
    """Cancellation, every size of number, zeros and NULLs: the sum is that of rational numbers."""
    rng = random.Random(3)
    values = [rng.choice([1e300, -1e300, 1.7e308, -1.7e308, 5e-324, -3e-310, 0.1, -3.5, 2.0 ** 32, 2.0 ** 64 - 2048, -2.0 ** -32, math.nextafter(2.0 ** 32, 0), 0.0, -0.0,
                          None, rng.gauss(0, 1), rng.gauss(0, 1e20), rng.gauss(0, 1e-20)]) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    whole = [Fraction(v) for v in values if v is not None]

    def terms(x, missing):
        some = np.where((np.abs(x) < 1e100) & (np.abs(x) > 1e-100), x, 0.0)
        return [("s", np.ma.array(x, mask=missing[0])), *products("q", some, some)]

    for parts in (1, 7):
        v = total(df.repartition(parts), terms)
        assert v["s"] == sum(whole) and v["q"] == sum(x * x for x in whole if 10 ** -100 < abs(x) < 10 ** 100)
    assert total(df.limit(0), terms) == {}


@pytest.mark.parametrize(("odd", "want"), [((math.inf,), math.inf), ((math.inf, -math.inf), math.nan), ((math.nan, -math.inf), math.nan), ((-math.inf, -math.inf), -math.inf)])
def test_values_that_are_not_finite(spark, odd, want):
    df = spark.createDataFrame([(1.0,), (2.0,), *[(o,) for o in odd]], "x double")
    got = total(df, lambda x, missing: [("s", x)])["s"]
    assert got == want or (math.isnan(got) and math.isnan(want))


def test_root():
    for x in (Fraction(2), Fraction(1, 3), Fraction(10) ** 40, Fraction(1, 10 ** 40), Fraction(0)):
        assert root(x) == pytest.approx(math.sqrt(float(x)), rel=1e-15)


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(3), rng.gauss(1e6, 1), None if rng.random() < 0.05 else rng.gauss(0, 1e-3), rng.gauss(5, 100), rng.gauss(1e6, 2)) for _ in range(3000)]
    return spark.createDataFrame(rows, "k int, a double, b double, c double, label double").persist()


def layouts(df):
    return [df.coalesce(1), df.repartition(2), df.repartition(11, "c"), df.orderBy("a")]


def test_metrics_and_scaling_do_not_depend_on_the_layout(table):
    """Values far from zero, where plain sums differ from one layout to another."""
    seen = {str(sorted(regression_metrics(d, "a", "label", ["k"]).collect())) + str(regression_metrics(d, "b", "label").collect())
            + str(sorted(standardize_stats(d, ["a", "b", "c"]).collect())) for d in layouts(table)}
    assert len(seen) == 1
    got = {r["feature"]: r for r in standardize_stats(table, ["a", "b"]).collect()}
    a = [Fraction(r["a"]) for r in table.collect()]
    mean = sum(a) / len(a)
    assert got["a"]["mean"] == float(mean)
    assert got["a"]["std"] == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in a) / (len(a) - 1)), rel=1e-15)


def test_linear_models_do_not_depend_on_the_layout(table):
    models = []
    for d in layouts(table):
        models.append(linear_sgd(standardize(d, fit_standardizer(d, ["a", "b", "c"])), ["a", "b", "c"]))
    assert len({(m.weights, m.intercept, m.dropped) for m in models}) == 1 and models[0].dropped > 0


def test_scaler_and_model_from_one_scan(table):
    """The same standardiser, and the same model but for the roundings of the scaled values, as in two steps."""
    cols = ["a", "b", "c"]
    stats, model = scaled_linear_sgd(table, cols)
    assert stats == fit_standardizer(table, cols)
    two = linear_sgd(standardize(table, stats), cols)
    assert np.allclose(model.weights, two.weights, rtol=1e-6) and math.isclose(model.intercept, two.intercept, rel_tol=1e-9) and model.dropped == two.dropped
    assert len({str(scaled_linear_sgd(d, cols)) for d in layouts(table)}) == 1
    flat = table.withColumn("a", F.lit(7.0))
    assert scaled_linear_sgd(flat, cols)[1].weights[0] == 0.0
    with pytest.raises(ValueError, match="no training rows"):
        scaled_linear_sgd(table.limit(0), cols)


def test_empty_tables(spark, table):
    none = table.limit(0)
    assert [tuple(r) for r in standardize_stats(none, ["a"]).collect()] == [("a", None, None, 0)]
    assert regression_metrics(none, "a", "label", ["k"]).collect() == []
    for k in (1, 30):
        assert moments(none.select("label", *[F.col("a").alias(f"x{i}") for i in range(k)]), [f"x{i}" for i in range(k)])["n"] == 0


@pytest.fixture(scope="module")
def wide(spark):
    names = [f"x{i}" for i in range(40)]
    rows = spark.range(500).select("id", *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(2001)) / 1000 - 1).alias(n) for i, n in enumerate(names)])
    rows = rows.withColumn("label", F.col("x0") * 3 - F.col("x7") + 0.5).withColumn("x3", F.when(F.col("id") % 50 != 0, F.col("x3")))
    return rows.drop("id").persist(), names


def test_forms_of_the_moments_agree(wide, monkeypatch):
    """Exact sums, the tasks' Gramians and a pass per step: the same model from the same rows."""
    df, names = wide
    gram = moments(df.repartition(3), names)
    monkeypatch.setattr(linear, "EXACT_COLUMNS", 100)
    exact = moments(df, names)
    assert (gram["n"], gram["dropped"]) == (exact["n"], exact["dropped"]) == (490, 10)
    assert np.allclose(gram["szz"], exact["szz"], rtol=1e-12, atol=1e-12) and np.allclose(gram["szy"], exact["szy"])
    one = linear_sgd(df, names, steps=20, step=0.5)
    monkeypatch.setattr(linear, "GRAM_COLUMNS", 10)
    other = linear_sgd(df.repartition(3), names, steps=20, step=0.5)
    assert np.allclose(one.weights, other.weights) and math.isclose(one.intercept, other.intercept) and one.dropped == other.dropped


def test_moments_read_the_table_once(spark, wide, tmp_path, monkeypatch):
    df, names = wide
    path = str(tmp_path / "rows")
    df.write.parquet(path)
    scans = []
    for module in (linear,):
        real = module.exact_totals
        monkeypatch.setattr(module, "exact_totals", lambda *a, real=real: (lambda t: (scans.append(t._jdf.queryExecution().executedPlan().toString().count("Scan parquet")), t)[1])(real(*a)))
    moments(spark.read.parquet(path), names[:3])
    assert scans == [1]
