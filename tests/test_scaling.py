import math

from pyspark.ml.feature import StandardScaler

from canopy.operators.scaling import fit_standardizer, standardize
from canopy.plans.inputs import FEATURES, table
from canopy.sources.points import assemble
from conftest import SF_SMALL


def test_matches_ml_scaler(spark):
    li = table(spark, SF_SMALL, "lineitem").select(*FEATURES).limit(500)
    li = li.persist()
    stats = fit_standardizer(li, FEATURES)
    ours = standardize(li, stats).collect()
    vec = assemble(li, FEATURES)
    m = StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="z").fit(vec)
    theirs = m.transform(vec).select("z").collect()
    for a, b in zip(ours, theirs):
        for i in range(len(FEATURES)):
            assert math.isclose(a[i], b["z"][i], rel_tol=1e-9, abs_tol=1e-12)


def test_zero_variance_gives_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    out = standardize(df, fit_standardizer(df, ["a", "b"])).collect()
    assert [r["b"] for r in out] == [0.0, 0.0]
