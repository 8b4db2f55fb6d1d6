import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from canopy.models import iris
from canopy.operators.growth import NODE_SCHEMA
from canopy.operators.nodes import predict_classes, score_nodes
from canopy.plans.checks import legacy_document
from canopy.plans.inputs import KEYS, iris_like
from canopy.session import scratch_path
from canopy.sinks.pmml import ModelMeta, forest_to_pmml, write_forest, write_pmml
from canopy.sources.pmml import DocumentParser, documents_from_pmml, forest_from_pmml, parse_document, read_documents, score_documents
from conftest import SF_SMALL

META = ModelMeta(tuple(iris.FEATURES), iris.LABEL, tuple(iris.CLASSES))
COLS = ["tree_id", "node_id", "parent_id", "is_left", "depth", "feature_name", "threshold",
        "left_id", "right_id", "prediction"]

LEGACY = legacy_document([("width", 0.25, "low", ("height", 7.0, ("width", 0.5, "mid", "low"), "high"))], ["width", "height"], ["low", "mid", "high"], "grade")


def test_roundtrip_both_forests(spark):
    for forest in (iris.R_FOREST, iris.SPARK_FOREST):
        nodes = iris.forest_table(spark, forest)
        path = scratch_path(spark, "pmml-test")
        write_pmml(forest_to_pmml(nodes, META), path)
        back, meta = forest_from_pmml(spark, path)
        assert meta == META
        assert sorted(back.select(*COLS).collect()) == sorted(nodes.select(*COLS).collect())


def test_document_shape(spark):
    doc = forest_to_pmml(iris.forest_table(spark, iris.R_FOREST), META).first()["pmml"]
    root = ET.fromstring(doc)
    ns = "{http://www.dmg.org/PMML-4_2}"
    assert root.get("version") == "4.2"
    segs = root.findall(f".//{ns}Segment")
    assert [s.get("id") for s in segs] == ["1", "2", "3"]
    assert root.find(f".//{ns}Segmentation").get("multipleModelMethod") == "majorityVote"
    nodes = root.findall(f".//{ns}Node")
    assert len(nodes) == 39
    assert sum(1 for n in nodes if not n.findall(f"{ns}Node")) == 21
    for s in segs:
        ms = s.find(f".//{ns}MiningSchema")
        usage = [(m.get("name"), m.get("usageType")) for m in ms]
        assert usage[0] == ("Species", "predicted") and len(usage) == 5


def test_legacy_dialect(spark):
    meta, rows = parse_document(LEGACY)
    assert meta["label"] == "grade" and meta["classes"] == ["low", "mid", "high"]
    by_id = {r[2]: r for r in rows}
    assert (by_id[1][7], by_id[1][8]) == ("width", 0.25) and (by_id[3][7], by_id[3][8]) == ("height", 7.0)
    assert [by_id[i][11] for i in (2, 7, 12, 13)] == [0.0, 2.0, 1.0, 0.0]


def _two_way(left, right, value=5.0):
    return (f'<PMML version="4.2"><DataDictionary><DataField name="y" optype="categorical"><Value value="n"/><Value value="p"/></DataField>'
            f'<DataField name="a" optype="continuous"/></DataDictionary><TreeModel functionName="classification"><Node id="1"><True/>'
            f'<Node id="2" score="p"><SimplePredicate field="a" operator="{left}" value="{value}"/></Node>'
            f'<Node id="3" score="n"><SimplePredicate field="a" operator="{right}" value="{value}"/></Node></Node></TreeModel></PMML>')


@pytest.mark.parametrize(("left", "right", "votes"), [
    ("lessOrEqual", "greaterThan", [1.0, 1.0, 0.0]), ("lessThan", "greaterOrEqual", [1.0, 0.0, 0.0]),
    ("greaterThan", "lessOrEqual", [0.0, 0.0, 1.0]), ("greaterOrEqual", "lessThan", [0.0, 1.0, 1.0])])
def test_operators_at_the_threshold(spark, left, right, votes):
    _, rows = parse_document(_two_way(left, right))
    nodes = spark.createDataFrame([r[1:] for r in rows], NODE_SCHEMA)
    data = spark.createDataFrame([(4.0,), (5.0,), (6.0,)], "a double").coalesce(1)
    assert [r["votes"][0] for r in score_nodes(data, nodes).collect()] == votes


def test_predicates_that_are_no_complements_are_refused():
    for left, right in (("lessOrEqual", "greaterOrEqual"), ("lessThan", "greaterThan"), ("equal", "notEqual")):
        with pytest.raises(ValueError, match="complements"):
            parse_document(_two_way(left, right))


def test_several_documents_are_refused(spark):
    path = scratch_path(spark, "pmml-test")
    doc = _two_way("lessOrEqual", "greaterThan")
    spark.createDataFrame([(doc,), (doc,)], "value string").repartition(2).write.text(path)
    if read_documents(spark, path).where("trim(value) <> ''").count() > 1:
        with pytest.raises(ValueError, match="several"):
            forest_from_pmml(spark, path)


def test_distributions_survive(spark):
    nodes = spark.createDataFrame([(0, 1, None, None, 0, 0, "a", 0.5, 2, 3, 1.0, [4.0, 6.0], 10, None, None),
                                   (0, 2, 1, True, 1, None, None, None, None, None, 0.0, [4.0, 1.0], 5, None, None),
                                   (0, 3, 1, False, 1, None, None, None, None, None, 1.0, [0.0, 5.0], 5, None, None)], NODE_SCHEMA)
    doc = forest_to_pmml(nodes, ModelMeta(("a",), "y", ("n", "p"), model_name="m")).first()["pmml"]
    meta, back = parse_document(doc)
    assert {r[2]: r[12] for r in back} == {1: [4.0, 6.0], 2: [4.0, 1.0], 3: [0.0, 5.0]}
    assert meta["model_name"] == "m" and meta["outputs"] == ["Predicted_y", "Probability_n", "Probability_p"]


def test_regression_export(spark):
    rows = [(0, 1, None, None, 0, 0, "a", 0.5, 2, 3, None, None, 10, None, None),
            (0, 2, 1, True, 1, None, None, None, None, None, 1.25, None, 4, None, None),
            (0, 3, 1, False, 1, None, None, None, None, None, 7.5, None, 6, None, None)]
    nodes = spark.createDataFrame(rows, NODE_SCHEMA)
    meta = ModelMeta(("a",), "y", None)
    doc = forest_to_pmml(nodes, meta).first()["pmml"]
    assert 'functionName="regression"' in doc and 'multipleModelMethod="average"' in doc
    m, back = parse_document(doc)
    assert m["regression"] and sorted(r[11] for r in back if r[6] is None) == [1.25, 7.5]


def test_scores_after_roundtrip_equal(spark):
    nodes = iris.forest_table(spark, iris.SPARK_FOREST)
    path = scratch_path(spark, "pmml-test")
    write_pmml(forest_to_pmml(nodes, META), path)
    back, _ = forest_from_pmml(spark, path)
    data = iris_like(spark, SF_SMALL)
    a = score_nodes(data, nodes).select("votes").collect()
    b = score_nodes(data, back).select("votes").collect()
    assert a == b


def test_spark_regression_forest_roundtrip(spark):
    from canopy.operators import mltrees
    from canopy.operators.nodes import predict_mean
    from canopy.plans.inputs import FEATURES, lineitem_price
    df = lineitem_price(spark, SF_SMALL)
    nodes = mltrees.forest_nodes(mltrees.forest_regress(df, FEATURES), FEATURES)
    path = scratch_path(spark, "pmml-test")
    write_pmml(forest_to_pmml(nodes, ModelMeta(tuple(FEATURES), "price", None)), path)
    back, meta = forest_from_pmml(spark, path)
    assert meta.regression and meta.features == tuple(FEATURES)
    a = predict_mean(df, nodes).select("prediction").collect()
    b = predict_mean(df, back).select("prediction").collect()
    assert a == b


def _forest(spark, trees, depth):
    from test_large_models import complete_forest
    return complete_forest(spark, trees, depth)


def test_parts_are_the_document(spark):
    """The parts in order of their names are one well-formed document, the same as the one-row form, and read back as the same nodes."""
    import glob
    nodes = _forest(spark, 3, 9)
    meta = ModelMeta(("x",), "y", None)
    path = scratch_path(spark, "pmml-test")
    nodes = nodes.union(iris.forest_table(spark, [iris.R_FOREST[2]]).withColumn("tree_id", F.lit(3)).withColumn("feature_name", F.when(F.col("left_id").isNotNull(), F.lit("x"))))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_forest(nodes, meta, path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(glob.glob(path.removeprefix("file:") + "/part-*"))
    text = "".join(open(f, encoding="utf-8").read() for f in files)
    assert len(files) > 1 and text.replace("\n", "") == forest_to_pmml(nodes, meta).first()["pmml"]
    ET.fromstring(text)
    back, found = forest_from_pmml(spark, path)
    assert found == meta
    assert sorted(back.select(*COLS).collect()) == sorted(nodes.select(*COLS).collect())


def test_parser_takes_any_cut(spark):
    doc = forest_to_pmml(iris.forest_table(spark, iris.R_FOREST), META).first()["pmml"]
    whole = parse_document(doc)
    for size in (1, 7, 1000):
        parser = DocumentParser()
        rows = [r for i in range(0, len(doc), size) for r in parser.feed(doc[i:i + size])] + [*parser.close()]
        assert (parser.meta, sorted(rows, key=lambda r: (r[1], r[2]))) == whole
    parser = DocumentParser()
    most = 0
    for i in range(0, len(doc), 50):
        for _ in parser.feed(doc[i:i + 50]):
            pass
        most = max(most, sum(1 for _ in parser.stack[0].iter()) if parser.stack else 0)
    assert most < 60 < doc.count("<")  # what has been read is not kept


def test_documents_side_by_side(spark):
    path = scratch_path(spark, "pmml-test")
    forests = [iris.R_FOREST, iris.SPARK_FOREST]
    for k, forest in enumerate(forests):
        write_pmml(forest_to_pmml(iris.forest_table(spark, forest), META), f"{path}/{k}")
    nodes, meta = documents_from_pmml(spark, f"{path}/*")
    assert meta.count() == 2 and nodes.select("path").distinct().count() == 2
    data = iris_like(spark, SF_SMALL)
    got = score_documents(data, nodes, meta)
    for k, forest in enumerate(forests):
        want = predict_classes(data, iris.forest_table(spark, forest), 3).select(*KEYS, "prediction")
        mine = got.where(F.col("path").contains(f"/{k}/")).select(*KEYS, "prediction")
        assert mine.exceptAll(want).isEmpty() and want.exceptAll(mine).isEmpty()
