from pyspark.sql import functions as F

from canopy.operators import mltrees
from canopy.operators.growth import grow_trees
from canopy.operators.nodes import predict_classes, predict_mean
from canopy.operators.splitscan import gini_split_scan, variance_split_scan
from canopy.plans.inputs import FEATURES, KEYS, lineitem_binary, lineitem_flags, lineitem_price
from canopy.plans.jobs import bagged_forest
from canopy.sources.points import assemble
from conftest import SF_MID, SF_SMALL


def _ml_root(model):
    return model._java_obj.rootNode()


def test_gini_scan_equals_ml_stump(spark):
    df = lineitem_binary(spark, SF_MID)
    best = sorted(gini_split_scan(df, FEATURES).collect(), key=lambda r: (-r["gain"], r["feature"]))[0]
    m = mltrees.tree_classify(df, FEATURES, max_depth=1)
    nodes = {r["node_id"]: r for r in mltrees.forest_nodes(m, FEATURES).collect()}
    assert nodes[1]["feature_name"] == best["feature_name"]
    assert nodes[1]["threshold"] == best["threshold"]
    assert abs(nodes[1]["gain"] - best["gain"]) < 1e-12


def test_variance_scan_equals_ml_stump(spark):
    df = lineitem_price(spark, SF_MID)
    best = sorted(variance_split_scan(df, FEATURES).collect(), key=lambda r: (-r["gain"], r["feature"]))[0]
    m = mltrees.tree_regress(df, FEATURES, max_depth=1)
    nodes = {r["node_id"]: r for r in mltrees.forest_nodes(m, FEATURES).collect()}
    assert nodes[1]["feature_name"] == best["feature_name"]
    assert nodes[1]["threshold"] == best["threshold"]
    assert abs(nodes[1]["gain"] - best["gain"]) / best["gain"] < 1e-9


def test_grown_tree_predicts_like_ml_tree(spark):
    df = lineitem_flags(spark, SF_SMALL)
    ours = grow_trees(df, FEATURES, "label", "classification", max_depth=4)
    m = mltrees.tree_classify(df, FEATURES, max_depth=4)
    theirs = m.transform(assemble(df, FEATURES)).select(*KEYS, F.col("prediction").alias("ml"))
    mine = predict_classes(df, ours, 3).select(*KEYS, "prediction")
    joined = mine.join(theirs, KEYS)
    assert joined.where(F.col("prediction") != F.col("ml")).count() == 0


def test_ml_node_table_scores_like_transform(spark):
    df = lineitem_flags(spark, SF_MID)
    m = mltrees.tree_classify(df, FEATURES, max_depth=5)
    nodes = mltrees.forest_nodes(m, FEATURES)
    mine = predict_classes(df, nodes, 3).select(*KEYS, "prediction")
    theirs = m.transform(assemble(df, FEATURES)).select(*KEYS, F.col("prediction").alias("ml"))
    assert mine.join(theirs, KEYS).where(F.col("prediction") != F.col("ml")).count() == 0


def test_tree_invariant_under_repartition(spark):
    df = lineitem_binary(spark, SF_SMALL)
    a = grow_trees(df, FEATURES, max_depth=3).orderBy("node_id").collect()
    b = grow_trees(df.repartition(5, "l_orderkey"), FEATURES, max_depth=3).orderBy("node_id").collect()
    assert a == b


def test_bagged_forest_invariant_under_repartition(spark):
    df = lineitem_flags(spark, SF_SMALL)
    a = bagged_forest(df, FEATURES, key_cols=KEYS, trees=3, attributes=2, max_depth=3)
    b = bagged_forest(df.repartition(3), FEATURES, key_cols=KEYS, trees=3, attributes=2, max_depth=3)
    cols = ["tree_id", "node_id", "feature_name", "threshold", "prediction", "row_count"]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())
    assert a.select("tree_id").distinct().count() == 3


def test_subspace_trees_use_only_their_features(spark):
    df = lineitem_flags(spark, SF_SMALL)
    models, subsets = mltrees.subspace_ensemble(df, FEATURES, "label", "classification", 3, 2, seed=1)
    nodes = mltrees.ensemble_nodes(models, subsets, FEATURES).collect()
    for r in nodes:
        if r["feature"] is not None:
            assert r["feature"] in subsets[r["tree_id"]]


def test_sizing_rules():
    assert [mltrees.num_trees(x) for x in (0, 1, 2, 3, 7, -1, None)] == [3, 3, 3, 3, 7, 3, 3]
    assert mltrees.num_attributes(0, 4) == 2 and mltrees.num_attributes(0, 50) == 7
    assert mltrees.num_attributes(5, 50) == 5 and mltrees.num_attributes(9, 4) == 4
    subs = mltrees.draw_features(10, 3, 4, seed=7)
    assert all(len(set(s)) == 4 for s in subs) and subs == mltrees.draw_features(10, 3, 4, seed=7)


def test_walk_routing_equals_case_routing(spark, monkeypatch):
    import canopy.operators.growth as G
    df = lineitem_flags(spark, SF_SMALL)
    cols = ["tree_id", "node_id", "feature_name", "threshold", "prediction", "row_count"]
    a = G.grow_trees(df, FEATURES, max_depth=4).select(*cols).collect()
    monkeypatch.setattr(G, "CASE_LIMIT", 0)
    b = G.grow_trees(df, FEATURES, max_depth=4).select(*cols).collect()
    assert sorted(a) == sorted(b) and len(a) > 7


def test_hard_vote_differs_from_ml_soft_vote(spark):
    """T4: Spark's forest sums leaf probabilities; the model contract is a
    hard majority vote.  Both come from the same trees, so wherever they
    differ the hard vote must equal the most frequent per-tree class."""
    df = lineitem_flags(spark, SF_MID)
    model = mltrees.forest_classify(df, FEATURES, trees=3, n_classes=3)
    nodes = mltrees.forest_nodes(model, FEATURES)
    ours = predict_classes(df, nodes, 3, keep_votes=True).select(*KEYS, "prediction", "votes")
    ml = model.transform(assemble(df, FEATURES)).select(*KEYS, F.col("prediction").alias("soft"))
    j = ours.join(ml, KEYS)
    diff = j.where(F.col("prediction") != F.col("soft"))
    assert diff.count() > 0
    for r in diff.limit(50).collect():
        v = [x for x in r["votes"] if x is not None]
        counts = {c: v.count(c) for c in set(v)}
        top = max(counts.values())
        assert r["prediction"] == min(c for c, n in counts.items() if n == top)


def test_gradient_descent_approaches_closed_form(spark):
    from pyspark.ml.regression import LinearRegression
    from canopy.operators.linear import descend, moments
    from canopy.operators.scaling import fit_standardizer, standardize
    df = lineitem_price(spark, SF_SMALL)
    z = standardize(df, fit_standardizer(df, FEATURES))
    w, b = descend(moments(z, FEATURES, "label"), steps=20000, step=1.0)
    ols = LinearRegression(regParam=0.0, standardization=False, solver="normal").fit(assemble(z, FEATURES))
    for a, c in zip(w, ols.coefficients):
        assert abs(a - c) <= 1e-3 * max(1.0, abs(c))
    assert abs(b - ols.intercept) <= 1e-3 * abs(ols.intercept)


def test_regression_forest_mean_equals_spark(spark):
    """The mean vote over the node table equals Spark's forest prediction."""
    df = lineitem_price(spark, SF_MID)
    model = mltrees.forest_regress(df, FEATURES)
    nodes = mltrees.forest_nodes(model, FEATURES)
    ours = predict_mean(df, nodes).select(*KEYS, "l_quantity", "l_discount", "l_tax", "prediction")
    theirs = model.transform(assemble(df, FEATURES)).select(*KEYS, "l_quantity", "l_discount", "l_tax",
                                                            F.col("prediction").alias("ml"))
    j = ours.join(theirs, [*KEYS, "l_quantity", "l_discount", "l_tax"])
    assert j.count() > 0
    assert j.where(F.abs(F.col("prediction") - F.col("ml")) > 1e-6 * F.abs(F.col("ml"))).count() == 0
