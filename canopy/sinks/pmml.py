"""Node table -> PMML 4.2 document.

The document is assembled as Spark rows, one line each: every node becomes
its open tag, predicate and shares, and a leaf also the close tags that follow
it.  Ids are heap ids, so a leaf closes itself and as many ancestors as its
path ends in steps to the right: no line needs to know the next one.  Sorted
by (tree, path), head and tail lines around, the lines are the document.
``write_forest`` sorts them in ranges and writes one text part per range, for
models of any size; ``forest_to_pmml`` joins them to one row for small ones.

Standard form (each child carries its parent's split):
  * left child ``<SimplePredicate operator="lessOrEqual" .../>``,
    right child ``operator="greaterThan"``; ``<True/>`` on the root and on
    every segment;
  * classification: leaf ``score`` is the class name, the forest combines by
    ``majorityVote``; regression: ``score`` is the number, ``average``;
  * the mining schema lists the label once as ``predicted`` and every
    feature as ``active``; version ``4.2``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from xml.sax.saxutils import quoteattr

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NS = "http://www.dmg.org/PMML-4_2"

# ---- fixed values --------------------------------------------------------
VERSION = "4.2"
# ---------------------------------------------------------------------------

#: Nodes of a model that one document may hold (it is one text row).
MAX_NODES = 500_000


@dataclass(frozen=True)
class ModelMeta:
    features: tuple[str, ...]
    label: str
    classes: tuple[str, ...] | None = None      # None -> regression
    model_name: str = "canopy"
    algorithm: str = "tree ensemble"
    description: str = "Tree ensemble"
    version: str = VERSION

    @property
    def regression(self) -> bool:
        return self.classes is None


def _q(s: str) -> str:
    return quoteattr(str(s))


def _header(meta: ModelMeta) -> str:
    fields = [f"<DataField name={_q(f)} optype=\"continuous\" dataType=\"double\"/>" for f in meta.features]
    if meta.regression:
        label_field = f"<DataField name={_q(meta.label)} optype=\"continuous\" dataType=\"double\"/>"
    else:
        values = "".join(f"<Value value={_q(c)}/>" for c in meta.classes)
        label_field = (f"<DataField name={_q(meta.label)} optype=\"categorical\" dataType=\"string\">"
                       f"{values}</DataField>")
    return (f"<PMML xmlns=\"{NS}\" version={_q(meta.version)}>"
            f"<Header description={_q(meta.description)}/>"
            f"<DataDictionary numberOfFields=\"{len(meta.features) + 1}\">{label_field}{''.join(fields)}"
            f"</DataDictionary>")


def _mining_schema(meta: ModelMeta) -> str:
    rows = [f"<MiningField name={_q(meta.label)} usageType=\"predicted\"/>"]
    rows += [f"<MiningField name={_q(f)} usageType=\"active\"/>" for f in meta.features]
    return "<MiningSchema>" + "".join(rows) + "</MiningSchema>"


def _output(meta: ModelMeta) -> str:
    rows = [f"<OutputField name={_q('Predicted_' + meta.label)} feature=\"predictedValue\"/>"]
    if not meta.regression:
        rows += [f"<OutputField name={_q('Probability_' + c)} optype=\"continuous\" dataType=\"double\" "
                 f"feature=\"probability\" value={_q(c)}/>" for c in meta.classes]
    return "<Output>" + "".join(rows) + "</Output>"


def _xml_attr(c: Column) -> Column:
    """Escape a string Column for use inside double quotes."""
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    c = F.replace(c, F.lit('"'), F.lit("&quot;"))
    return c


def node_lines(nodes: DataFrame, meta: ModelMeta) -> DataFrame:
    """One row per node (tree_id, key, line): its tags, and the close tags due after a leaf.

    ``key`` is the heap id as a binary path ('1', '10', '11', ...), so
    sorting by it gives pre-order.
    """
    pid = F.col("parent_id")
    # the child carries its parent's split
    parent = nodes.select(F.col("tree_id").alias("p_tree"), F.col("node_id").alias("p_id"),
                          F.col("feature_name").alias("p_feature"), F.col("threshold").alias("p_thr"))
    joined = nodes.join(parent, (nodes.tree_id == parent.p_tree) & (pid == parent.p_id), "left")
    thr_txt = F.regexp_replace(F.col("p_thr").cast("string"), r"\.0$", "")
    op = F.when(F.col("is_left"), F.lit("lessOrEqual")).otherwise(F.lit("greaterThan"))
    predicate = F.when(pid.isNull(), F.lit("<True/>")).otherwise(F.concat(
        F.lit("<SimplePredicate field=\""), _xml_attr(F.col("p_feature")), F.lit("\" operator=\""), op,
        F.lit("\" value=\""), thr_txt, F.lit("\"/>")))
    leaf = F.col("left_id").isNull()
    if meta.regression:
        score = F.regexp_replace(F.col("prediction").cast("string"), r"\.0$", "")
    else:
        names = F.array(*[F.lit(c) for c in meta.classes])
        # guard: a NULL index must give no score, not an element
        score = F.when(F.col("prediction").isNotNull(),
                       _xml_attr(F.element_at(names, F.col("prediction").cast("int") + 1)))
    count = F.when(F.col("row_count").isNotNull(),
                   F.concat(F.lit(" recordCount=\""), F.col("row_count").cast("string"), F.lit("\"")))
    distribution = F.lit("")
    if not meta.regression:
        # one share per class, so the declared probabilities have their values
        entries = F.transform(F.arrays_zip(names, F.col("class_counts")), lambda e: F.concat(
            F.lit("<ScoreDistribution value=\""), _xml_attr(e["0"]), F.lit("\" recordCount=\""),
            F.regexp_replace(e["class_counts"].cast("string"), r"\.0$", ""), F.lit("\"/>")))
        distribution = F.when(F.size("class_counts") == len(meta.classes), F.array_join(entries, "")).otherwise(F.lit(""))
    # every node carries its score (leaves: the answer; inner nodes: the
    # fallback when no child predicate is true)
    open_tag = F.concat(F.lit("<Node id=\""), F.col("node_id").cast("string"), F.lit("\""),
                        F.coalesce(F.concat(F.lit(" score=\""), score, F.lit("\"")), F.lit("")),
                        F.coalesce(count, F.lit("")), F.lit(">"), predicate, F.coalesce(distribution, F.lit("")))
    key = F.bin(F.col("node_id"))
    rights = F.length(F.regexp_extract(F.substring(key, 2, 64), "1*$", 0))
    return joined.select("tree_id", key.alias("key"), open_tag.alias("__open"), rights.alias("__rights"), leaf.alias("__leaf")).select(
        "tree_id", "key", F.concat("__open", F.when(F.col("__leaf"), F.expr("repeat('</Node>', 1 + __rights)")).otherwise(F.lit(""))).alias("line"))


def document_lines(nodes: DataFrame, meta: ModelMeta) -> DataFrame:
    """The lines of the document (part, tree_id, key, line): in the order of the first three they are the document."""
    function = "regression" if meta.regression else "classification"
    method = "average" if meta.regression else "majorityVote"
    schema = _mining_schema(meta)
    head = (f"{_header(meta)}<MiningModel modelName={_q(meta.model_name)} functionName=\"{function}\">"
            f"{schema}{_output(meta)}<Segmentation multipleModelMethod=\"{method}\">")
    tree_head = (f"<True/><TreeModel modelName={_q(meta.model_name)} functionName=\"{function}\" "
                 f"algorithmName={_q(meta.algorithm)} splitCharacteristic=\"binarySplit\">{schema}")
    number = (F.col("tree_id") + 1).cast("string")
    around = F.array(F.struct(F.lit("0").alias("key"), F.concat(F.lit('<Segment id="'), number, F.lit('">' + tree_head)).alias("line")),
                     F.struct(F.lit("2").alias("key"), F.lit("</TreeModel></Segment>").alias("line")))
    trees = nodes.where(F.col("parent_id").isNull()).select("tree_id", F.explode(around).alias("l")).select("tree_id", "l.key", "l.line")
    body = trees.unionByName(node_lines(nodes, meta)).select(F.lit(1).alias("part"), "tree_id", "key", "line")
    ends = nodes.sparkSession.createDataFrame([(0, 0, "", head), (2, 0, "", "</Segmentation></MiningModel></PMML>")],
                                              "part int, tree_id int, key string, line string")
    return ends.unionByName(body)


def forest_to_pmml(nodes: DataFrame, meta: ModelMeta) -> DataFrame:
    """K1: one row ``pmml`` holding the whole document, for models of at most MAX_NODES nodes (``write_forest`` has no such limit)."""
    size = nodes.limit(MAX_NODES + 1).count()
    if size > MAX_NODES:
        raise ValueError(f"a document in one row holds at most {MAX_NODES} nodes: use write_forest")
    ordered = F.array_sort(F.collect_list(F.struct("part", "tree_id", "key", "line")))
    return document_lines(nodes, meta).agg(F.array_join(F.transform(ordered, lambda s: s["line"]), "").alias("pmml"))


def write_forest(nodes: DataFrame, meta: ModelMeta, path: str) -> None:
    """The document of a model of any size below ``path``, as text parts whose order by name is the order of the text.

    The lines are sorted in ranges, so a part is written by the task that holds
    its range and nothing is gathered; reading the parts in turn gives the document.
    """
    lines = document_lines(nodes, meta)
    lines.orderBy("part", "tree_id", "key").select("line").write.mode("overwrite").text(path)


def write_pmml(doc: DataFrame, path: str) -> None:
    """Write the one-row document as a single text file part."""
    doc.coalesce(1).write.mode("overwrite").text(path)
