"""Model and metric reports (K2, K3).

``describe_forest`` lays a node table out as the familiar indented
If / Else / Predict text, one row per line, ordered per tree by the node's
binary path (heap id in base 2), so the layout is a projection + a sort
within each tree -- no driver-side recursion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def describe_forest(nodes: DataFrame) -> DataFrame:
    """K3: (tree_id, line_no, line) text of every tree.

    inner node: ``If (<feature> <= <t>)`` then the left subtree, then
    ``Else (<feature> > <t>)`` then the right subtree; leaf:
    ``Predict: <value>``.  Indent = depth + 1 spaces.
    """
    key = F.bin(F.col("node_id"))
    pad = F.repeat(F.lit(" "), F.col("depth") + 1)
    thr = F.col("threshold").cast("string")
    leaf = F.col("left_id").isNull()
    lines = F.when(
        leaf,
        F.array(F.struct(key.alias("k"), F.concat(pad, F.lit("Predict: "),
                                                   F.col("prediction").cast("string")).alias("line"))),
    ).otherwise(F.array(
        F.struct(key.alias("k"), F.concat(pad, F.lit("If ("), F.col("feature_name"), F.lit(" <= "), thr,
                                          F.lit(")")).alias("line")),
        # sorts after every key of the left subtree and before the right one
        F.struct(F.concat(key, F.lit("0~")).alias("k"),
                 F.concat(pad, F.lit("Else ("), F.col("feature_name"), F.lit(" > "), thr,
                          F.lit(")")).alias("line")),
    ))
    rows = nodes.select("tree_id", F.explode(lines).alias("l")).select("tree_id", "l.k", "l.line")
    order = Window.partitionBy("tree_id").orderBy("k")
    return rows.select("tree_id", F.row_number().over(order).alias("line_no"), "line")


def write_report(report: DataFrame, path: str) -> None:
    """K2: persist a (small) report as parquet."""
    report.coalesce(1).write.mode("overwrite").parquet(path)
