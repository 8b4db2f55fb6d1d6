"""Models held as tables: joined scoring, leaf distributions, documents in parts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopy.operators import mltrees
from canopy.operators.growth import NODE_SCHEMA
from canopy.operators.nodes import predict_classes, predict_distribution, predict_mean, score_nodes
from canopy.operators.treejoin import joined_votes
from canopy.plans.inputs import FEATURES, lineitem_flags
from canopy.sinks.pmml import ModelMeta, forest_to_pmml, write_forest
from canopy.sources.pmml import chunks_meta, document_chunks, document_lines, parsed_chunks
from conftest import SF_SMALL


def random_tree(rng, tree, features, depth, classes):
    """Node rows of a tree that stops at random, and the same as nested tuples."""
    rows = []

    def grow(node, parent, left, d):
        if d == depth or (d > 2 and rng.random() < 0.1):
            p = float(rng.randrange(classes)) if rng.random() > 0.02 else None
            counts = [float(rng.randrange(5)) for _ in range(classes)]
            rows.append((tree, node, parent, left, d, None, None, None, None, None, p, counts, None, None, None))
            return
        f = rng.randrange(len(features))
        rows.append((tree, node, parent, left, d, f, features[f], rng.choice([-1.0, 0.0, 0.5, rng.random()]), 2 * node, 2 * node + 1, None, None, None, None, None))
        grow(2 * node, node, True, d + 1)
        grow(2 * node + 1, node, False, d + 1)

    grow(1, None, None, 0)
    return rows


@pytest.fixture(scope="module")
def forest(spark):
    rng = random.Random(8)
    names = ["a", "b`c", "d e", "__n"]
    rows = [r for t in (0, 3, 7) for r in random_tree(rng, t, names, 11, 3)]
    data = [tuple(rng.choice([None, float("nan"), 0.0, 0.5, rng.uniform(-2, 2), rng.random(), rng.random()]) for _ in names) for _ in range(500)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id long, a double, `b``c` double, `d e` double, `__n` double")
    return spark.createDataFrame(rows, NODE_SCHEMA), df, rows


def walk(rows, names, row):
    """The leaf row each tree leads to (None: a missing value on the way)."""
    out = []
    for t in sorted({r[0] for r in rows}):
        tree = {r[1]: r for r in rows if r[0] == t}
        node = tree[1]
        while node is not None and node[8] is not None:
            x = row[names.index(node[6])]
            node = None if x is None else tree[node[8] if x <= node[7] else node[9]]
        out.append(node)
    return out


@pytest.mark.parametrize(("top", "broadcast"), [(256, 1_000_000), (0, 1_000_000), (5, 0), (100, 20)])
def test_joined_votes_equal_the_walk(forest, top, broadcast):
    nodes, df, rows = forest
    scored, names = joined_votes(df, nodes, top_nodes=top, broadcast_nodes=broadcast)
    assert scored.columns == [*df.columns, "__v0", "__v3", "__v7"]
    got = {r["id"]: [r[n] for n in names] for r in scored.collect()}
    for r in df.collect():
        want = [None if leaf is None else leaf[10] for leaf in walk(rows, df.columns[1:], r[1:])]
        assert got[r["id"]] == want


def test_large_levels_move_the_rows_once(forest):
    """Levels that are not broadcast are joined together: one join per eight levels of a tree, also below leaves and missing values."""
    nodes, df, rows = forest
    scored, names = joined_votes(df, nodes, top_nodes=20, broadcast_nodes=0)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") <= 3 * 2  # levels 2 to 11
    got = {r["id"]: [r[n] for n in names] for r in scored.collect()}
    leaves, _ = joined_votes(df, nodes, top_nodes=20, broadcast_nodes=0, value="node_id")
    ids = {r["id"]: [r[n] for n in names] for r in leaves.collect()}
    for r in df.collect():
        reached = walk(rows, df.columns[1:], r[1:])
        assert got[r["id"]] == [None if leaf is None else leaf[10] for leaf in reached]
        assert ids[r["id"]] == [None if leaf is None else leaf[1] for leaf in reached]


def test_joins_are_generated_as_several_methods(forest):
    """A JVM only interprets the method of a dozen joins."""
    nodes, df, _ = forest
    scored, _ = joined_votes(df, nodes, top_nodes=5)
    joins = most = 0
    for line in scored._jdf.queryExecution().optimizedPlan().toString().splitlines():
        joins = 0 if "Repartition" in line else joins + ("Join LeftOuter" in line)
        most = max(most, joins)
    assert most == 3


def test_forms_of_scoring_agree(forest):
    nodes, df, _ = forest
    assert str(sorted(score_nodes(df, nodes, "join").collect())) == str(sorted(score_nodes(df, nodes, "walk").collect()))
    for predict in (lambda m: predict_classes(df, nodes, 3, m, keep_votes=True), lambda m: predict_mean(df, nodes, m)):
        assert str(sorted(predict("join").collect())) == str(sorted(predict("walk").collect()))
    with pytest.raises(ValueError, match="outside the classes"):
        predict_classes(df, nodes, 2, "join")


def test_leaf_distributions(forest):
    nodes, df, rows = forest
    for method in ("join", "walk"):
        got = {r["id"]: r for r in predict_distribution(df, nodes, 3, method).collect()}
        for r in df.collect():
            shares = [np.array(leaf[11]) / sum(leaf[11]) for leaf in walk(rows, df.columns[1:], r[1:]) if leaf is not None and sum(leaf[11]) > 0]
            want = np.mean(shares, axis=0) if shares else None
            assert (got[r["id"]]["probability"] is None) == (want is None)
            if want is not None:
                assert np.allclose(got[r["id"]]["probability"], want)
                assert got[r["id"]]["prediction"] == float(np.argmax(np.round(got[r["id"]]["probability"], 15)))


def test_distributions_are_those_of_the_learner(spark):
    df = lineitem_flags(spark, SF_SMALL)
    model = mltrees.forest_classify(df, FEATURES, n_classes=3)
    mine = predict_distribution(df, mltrees.forest_nodes(model, FEATURES), 3)
    got = np.array([r["probability"] for r in mine.select("probability").collect()])
    own = model.transform(mltrees.assemble(df, FEATURES))
    want = np.array([r["probability"].toArray() for r in own.select("probability").collect()])
    assert np.allclose(got, want, atol=1e-12)


def complete_forest(spark, trees, depth):
    """Complete trees over column x in [0, 1): a leaf's prediction is its place from the left."""
    ids = spark.range(1, 1 << (depth + 1)).withColumnRenamed("id", "node_id")
    d = F.floor(F.log2(F.col("node_id"))).cast("int")
    place = F.col("node_id") - F.pow(F.lit(2.0), d.cast("double")).cast("long")
    width = F.pow(F.lit(2.0), -d.cast("double"))
    inner = d < depth
    n = ids.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree_id"), "node_id", F.when(F.col("node_id") > 1, F.expr("node_id DIV 2")).alias("parent_id"),
                   F.when(F.col("node_id") > 1, F.col("node_id") % 2 == 0).alias("is_left"), d.alias("depth"), F.when(inner, F.lit(0)).alias("feature"),
                   F.when(inner, F.lit("x")).alias("feature_name"), F.when(inner, (place + 0.5) * width).alias("threshold"),
                   F.when(inner, F.col("node_id") * 2).alias("left_id"), F.when(inner, F.col("node_id") * 2 + 1).alias("right_id"),
                   F.when(~inner, place.cast("double")).alias("prediction"), F.lit(None).cast("array<double>").alias("class_counts"),
                   F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("double").alias("impurity"), F.lit(None).cast("double").alias("gain"))
    return n


def test_a_million_nodes_are_scored(spark):
    nodes = complete_forest(spark, 2, 18)
    df = spark.range(20_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(1 << 30)).alias("x"))
    wrong = predict_mean(df, nodes).where(F.col("prediction") != F.ceil(F.col("x") * (1 << 18)) - F.when(F.col("x") > 0, 1).otherwise(0))
    assert nodes.count() > 1_000_000 and wrong.count() == 0


def test_one_document_is_parsed_by_many_tasks(spark, tmp_path):
    """A document in parts is cut into chunks, which are parsed apart; wherever it is cut, the nodes are the same."""
    nodes = complete_forest(spark, 3, 5)
    meta = ModelMeta(("x",), "place", None)
    write_forest(nodes.repartition(3), meta, str(tmp_path / "doc"))
    kept = ["tree_id", "node_id", "parent_id", "is_left", "depth", "feature_name", "threshold", "left_id", "right_id", "prediction"]
    want = sorted(map(str, nodes.select(*kept).collect()))
    lines = document_lines(spark, str(tmp_path / "doc"), parts=True)
    for size in (1, 2, 7, 50_000):
        chunks = document_chunks(lines, size)
        assert chunks.where("start IS NULL").count() == 0 and (size > 7 or chunks.count() >= 3 * 63 // size)
        assert sorted(map(str, parsed_chunks(chunks).select(*kept).collect())) == want
        assert [tuple(r["features"]) for r in chunks_meta(chunks).collect()] == [("x",)]


def test_cut_tags_are_read_as_a_stream(spark, tmp_path):
    """A document whose lines end inside a tag has no chunk of its own to begin with."""
    text = forest_to_pmml(complete_forest(spark, 2, 3), ModelMeta(("x",), "place", None)).first()[0]
    (tmp_path / "cut.pmml").write_text(text.replace("<Node ", "<Node\n "))
    (tmp_path / "whole.pmml").write_text(text.replace("><", ">\n<"))
    chunks = document_chunks(document_lines(spark, str(tmp_path)), 3)
    assert {r["document"].rsplit("/", 1)[1] for r in chunks.where("start IS NULL").collect()} == {"cut.pmml"}
    got = parsed_chunks(chunks).groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.sum("prediction").alias("p")).collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["n"], r["p"]) for r in got) == [("cut.pmml", 30, 56.0), ("whole.pmml", 30, 56.0)]
    assert chunks_meta(chunks).count() == 2
