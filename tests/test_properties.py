"""Property checks against brute force in plain Python (hypothesis)."""

import bisect
import itertools
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


from canopy.models import iris
from canopy.operators.binning import add_bins, fit_thresholds
from canopy.operators.nodes import predict_classes
from test_nodes import stumps

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _py_tree(node, x):
    if isinstance(node, str):
        return float(iris.CLASSES.index(node))
    f, t, left, right = node
    v = x[iris.FEATURES.index(f)]
    return _py_tree(left if v <= t else right, x)


def _py_vote(votes, k):
    v = [x for x in votes if x is not None]
    if not v:
        return None
    counts = [v.count(float(c)) for c in range(k)]
    return float(counts.index(max(counts)))


def test_forests_on_a_grid_match_python(spark):
    grid = list(itertools.product([4.3, 5.0, 5.35, 5.8, 6.5, 6.85, 7.9], [2.0, 2.2, 2.65, 3.0, 3.25, 4.4],
                                  [1.0, 1.9, 2.45, 4.7, 4.85, 4.95, 5.05, 6.9], [0.1, 0.5, 0.7, 1.5, 1.6, 1.7, 2.5]))
    df = spark.createDataFrame(grid, ", ".join(f"`{f}` double" for f in iris.FEATURES))
    for forest in (iris.R_FOREST, iris.SPARK_FOREST):
        out = predict_classes(df, iris.forest_table(spark, forest), 3).collect()
        for r in out:
            x = [r[f] for f in iris.FEATURES]
            assert r["prediction"] == _py_vote([_py_tree(t, x) for t in forest], 3)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 3).map(float)), min_size=1, max_size=7))
def test_majority_vote_matches_python(spark, votes):
    df = spark.createDataFrame([(None,)], "x double")
    assert predict_classes(df, stumps(spark, votes), 4).first()["prediction"] == _py_vote(votes, 4)


@SETTINGS
@given(st.lists(st.one_of(st.floats(-1e300, 1e300, allow_nan=False), st.integers(-5, 5).map(float)), min_size=1, max_size=300), st.integers(2, 12))
def test_cut_points_are_ranks(spark, values, max_bins):
    """Few distinct values: all midpoints; more: the values at the ranks ceil(i n / max_bins), whatever the partitions."""
    s = sorted(values)
    distinct = sorted(set(values))
    if len(distinct) <= max_bins:
        want = [(a + b) / 2 for a, b in zip(distinct[:-1], distinct[1:], strict=True)]
    else:
        want = sorted({s[-(-i * len(s) // max_bins) - 1] for i in range(1, max_bins)})
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert fit_thresholds(df.repartition(3), ["x"], max_bins)[0] == want


@SETTINGS
@given(st.lists(st.floats(-100, 100, allow_nan=False), min_size=1, max_size=30, unique=True),
       st.lists(st.one_of(st.none(), st.just(math.nan), st.floats(-120, 120, allow_nan=False)),
                min_size=1, max_size=60))
def test_bins_match_bisect(spark, thresholds, values):
    thr = sorted(thresholds)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    out = {r["i"]: r["b"] for r in add_bins(df, ["x"], [thr], ["b"], ["i"]).collect()}
    for i, v in enumerate(values):
        if v is None:
            assert out[i] is None
        elif math.isnan(v):
            assert out[i] == len(thr)           # NaN: last bin, always right
        else:
            assert out[i] == bisect.bisect_left(thr, v)   # number of thresholds < v


VAL = st.one_of(st.none(), st.just(math.nan), st.integers(0, 3).map(float))


@SETTINGS
@given(st.lists(st.tuples(VAL, st.sampled_from(["a", "b", None])), min_size=0, max_size=40),
       st.lists(st.tuples(VAL, st.sampled_from(["a", "b", None])), min_size=0, max_size=20))
def test_complement_matches_brute_force(spark, left, right):
    from canopy.operators.splits import holdout_complement

    def key(r):  # value equality with NULL = NULL and NaN = NaN (Spark's null-safe, NaN-aware =)
        return tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in r)

    schema = "x double, s string"
    out = holdout_complement(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))
    expect = sorted((key(r) for r in left if key(r) not in {key(t) for t in right}), key=repr)
    assert sorted((key(tuple(r)) for r in out.collect()), key=repr) == expect


def _random_tree(draw_split, depth, node=1, rows=None):
    """Random heap-id tree rows for NODE_SCHEMA (tree 0)."""
    rows = [] if rows is None else rows
    split = draw_split(depth)
    if split is None:
        rows.append((0, node, node // 2 if node > 1 else None, (node % 2 == 0) if node > 1 else None,
                     node.bit_length() - 1, None, None, None, None, None, float(node % 3), None, 1, None, None))
        return rows
    f, t = split
    rows.append((0, node, node // 2 if node > 1 else None, (node % 2 == 0) if node > 1 else None,
                 node.bit_length() - 1, f, iris.FEATURES[f], t, 2 * node, 2 * node + 1, float(node % 3),
                 None, 1, None, None))
    _random_tree(draw_split, depth - 1, 2 * node, rows)
    _random_tree(draw_split, depth - 1, 2 * node + 1, rows)
    return rows


@SETTINGS
@given(st.data())
def test_random_trees_roundtrip_and_score_alike(spark, data):
    from canopy.operators.growth import NODE_SCHEMA
    from canopy.operators.nodes import collect_trees, tree_columns
    from canopy.session import scratch_path
    from canopy.sinks.pmml import ModelMeta, forest_to_pmml, write_pmml
    from canopy.sources.pmml import forest_from_pmml

    def draw_split(depth):
        if depth == 0 or data.draw(st.booleans()):
            return None
        return data.draw(st.integers(0, 3)), data.draw(st.sampled_from([0.5, 1.0, 2.25, 3.0, 4.75, 6.5]))

    rows = _random_tree(draw_split, 4)
    nodes = spark.createDataFrame(rows, NODE_SCHEMA)
    pts = [(a, b, c, d) for a in (0.0, 1.0, 3.0, 5.0, 7.0) for b in (0.5, 2.25, 4.0)
           for c in (1.0, 4.75, 6.9) for d in (None, 0.5, 3.0)]
    df = spark.createDataFrame(pts, ", ".join(f"`{f}` double" for f in iris.FEATURES))
    trees = collect_trees(nodes)
    a = df.select(*tree_columns(trees, "case")).collect()
    b = df.select(*tree_columns(trees, "walk")).collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    path = scratch_path(spark, "pmml-prop")
    write_pmml(forest_to_pmml(nodes, ModelMeta(tuple(iris.FEATURES), iris.LABEL, tuple(iris.CLASSES))), path)
    back, _ = forest_from_pmml(spark, path)
    cols = ["tree_id", "node_id", "parent_id", "is_left", "depth", "feature_name", "threshold",
            "left_id", "right_id", "prediction"]
    assert sorted(back.select(*cols).collect()) == sorted(nodes.select(*cols).collect())
