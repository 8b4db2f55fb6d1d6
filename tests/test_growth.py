"""Growth by histogram subtraction and with or without collapsed rows: the same trees as counting everything."""

import random

import pytest
from pyspark.sql import functions as F

from canopy.operators import growth, splitscan
from canopy.operators.growth import TreeSpec, grow_trees
from canopy.operators.splitscan import collapsed, compact, gini_split_scan, uncollapsed, worth_collapsing
from test_plans import plan_of

COLS = ["a", "b", "c"]


def rows_of(n, missing, seed=4):
    rng = random.Random(seed)

    def value(k):
        return None if rng.random() < missing else float("nan") if rng.random() < missing / 4 else float(rng.randrange(k))

    return [(float(rng.randrange(3)), rng.randrange(4), value(4), value(7), value(40)) for _ in range(n)]


def brute(rows, features, task, depth, weight=lambda r: 1):
    """{node id: (feature, threshold, row count, class counts or w, sum, squares)} by trying every split of every node."""
    values = {f: sorted({r[2 + f] for r in rows if r[2 + f] is not None and r[2 + f] == r[2 + f]}) for f in features}
    cuts = {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in values.items()}

    def stats(part):
        if task == "classification":
            return [sum(weight(r) for r in part if r[0] == k) for k in range(3)]
        return [sum(weight(r) for r in part), sum(weight(r) * r[0] for r in part), sum(weight(r) * r[0] ** 2 for r in part)]

    def impurity(s):
        # in the order of the operator, so that equal gains tie
        if task == "classification":
            e = 1.0
            for c in s:
                e = e - (c / sum(s)) * (c / sum(s))
            return e
        return (s[2] - (s[1] * s[1]) / s[0]) / s[0]

    def size(s):
        return sum(s) if task == "classification" else s[0]

    out = {}

    def grow(node, part, d):
        here = stats(part)
        best = None
        if d < depth and size(here):
            for f in features:
                known = [r for r in part if r[2 + f] is not None]
                for t in cuts[f]:
                    left = [r for r in known if r[2 + f] <= t]
                    right = [r for r in known if not r[2 + f] <= t]
                    ls, rs, ts = stats(left), stats(right), stats(known)
                    if size(ls) > 0 and size(rs) > 0:
                        gain = impurity(ts) - (size(ls) / size(ts)) * impurity(ls) - (size(rs) / size(ts)) * impurity(rs)
                        if best is None or gain > best[0]:
                            best = (gain, f, t, left, right)
        split = best is not None and best[0] > 1e-12 and impurity(here) > 0
        out[node] = (best[1] if split else None, best[2] if split else None, len(part), here)
        if split:
            grow(2 * node, best[3], d + 1)
            grow(2 * node + 1, best[4], d + 1)

    grow(1, [r for r in rows if weight(r) > 0], 0)
    return out


@pytest.mark.parametrize("form", ["collapsed", "uncollapsed"])
@pytest.mark.parametrize("missing", [0.0, 0.15])
@pytest.mark.parametrize("task", ["classification", "regression"])
def test_trees_equal_full_counting(spark, monkeypatch, task, missing, form):
    """Three trees at once (subsets, weights); rows with missing values fall out of some splits."""
    monkeypatch.setattr(splitscan, "worth_collapsing", lambda *_: form == "collapsed")
    rows = rows_of(700, missing)
    df = spark.createDataFrame(rows, "label double, w int, a double, b double, c double").repartition(5)
    specs = [TreeSpec(0, [0, 1, 2]), TreeSpec(1, [1, 2], F.col("w").cast("double")), TreeSpec(2, [0, 2])]
    nodes = grow_trees(df, COLS, "label", task, specs=specs, max_depth=4, carry=["w"], min_gain=1e-12, prune=False).collect()
    for spec in specs:
        want = brute(rows, spec.features, task, 4, (lambda r: r[1]) if spec.weight is not None else (lambda r: 1))
        got = {r["node_id"]: (r["feature"], r["threshold"], r["row_count"]) for r in nodes if r["tree_id"] == spec.tree_id}
        assert got == {k: v[:3] for k, v in want.items()}
        if task == "classification":
            assert all(r["class_counts"] == want[r["node_id"]][3] for r in nodes if r["tree_id"] == spec.tree_id)


def test_half_the_rows_are_expanded(spark, monkeypatch):
    """Below the root no level expands more than half of the rows, features and trees."""
    seen, histogram = [], growth.histogram
    monkeypatch.setattr(growth, "histogram", lambda long, *a: (seen.append(long.count()), histogram(long, *a))[1])
    monkeypatch.setattr(splitscan, "worth_collapsing", lambda *_: False)
    df = spark.createDataFrame(rows_of(2000, 0.0), "label double, w int, a double, b double, c double")
    nodes = grow_trees(df, COLS, "label", specs=[TreeSpec(t, [0, 1, 2]) for t in range(2)], max_depth=5, prune=False)
    assert nodes.agg(F.max("depth")).first()[0] == 5
    assert seen[0] == 2000 * (3 + 1) * 2 and len(seen) == 5 and all(n <= 2000 * 3 * 2 / 2 for n in seen[1:])


def test_wide_rows_are_not_shuffled(spark):
    """64 features: hardly two rows share their bins, so no row is shuffled; few combinations, or many equal rows, are collapsed."""
    bins = [f"b{i}" for i in range(64)]
    wide = spark.range(20_000).select(F.lit(1.0).alias("label"), *[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(50)).cast("int").alias(b) for i, b in enumerate(bins)])
    cuts = [[0.0] * 49] * 64
    assert "Exchange" not in plan_of(compact(wide, bins, "classification", {"x": None}, cuts, 2), "simple")
    assert "Exchange" in plan_of(compact(wide.withColumns({b: F.col("b0") % 7 for b in bins}), bins, "classification", {"x": None}, cuts, 2), "simple")
    assert worth_collapsing(wide, bins[:2], 2500) and not worth_collapsing(wide, bins, 50 ** 64)
    few = wide.select("label", *[(F.col(b) % 2).alias(b) for b in bins[:3]])
    a, b = (form(few, bins[:3], "regression", {"x": None}).groupBy(*bins[:3]).agg(*[F.sum(f"x_{k}") for k in splitscan.STATS]) for form in (collapsed, uncollapsed))
    assert sorted(a.collect()) == sorted(b.collect())


@pytest.mark.parametrize("bad", [-1.0, 1.5, float("inf")])
def test_labels_that_are_no_classes_are_refused(spark, bad):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 2.0), (bad, 3.0), (None, 4.0), (float("nan"), 5.0)], "label double, a double")
    for fit in (lambda d: gini_split_scan(d, ["a"]), lambda d: grow_trees(d, ["a"]), lambda d: splitscan.num_classes(d),
                lambda d: grow_trees(d, ["a"], n_classes=2), lambda d: gini_split_scan(d, ["a"], n_classes=2)):
        with pytest.raises(ValueError, match="no classes"):
            fit(df)
        fit(df.where(F.col("label").isNull() | (F.col("label") != bad)))
    good = df.where("label in (0, 1)")
    with pytest.raises(ValueError, match="no classes"):
        grow_trees(good, ["a"], n_classes=1)


def test_labels_of_rows_without_values_count(spark):
    """A class that occurs only where every feature is missing is still a class."""
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 2.0), (2.0, None), (2.0, float("nan"))], "label double, a double")
    root = grow_trees(df, ["a"]).where("node_id = 1").first()
    assert root["class_counts"] == [1.0, 1.0, 2.0] and root["row_count"] == 4
