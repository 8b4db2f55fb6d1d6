"""Connected components of an edge table, in rounds that each write their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst); component is the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and then
    follows that label one step (pointer jumping), so the number of rounds
    grows with the logarithm of a component's diameter in practice.  Labels
    are aggregated map-side before they are shuffled, so a hub node sends one
    row per task.  An edge with a null end is ignored; an empty edge table
    gives an empty result.
    """
    ends = edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).where("a is not null and b is not null and a <> b")
    links = written(ends.union(ends.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = written(links.groupBy(F.col("a").alias("node"))
                     .agg(F.min("b").alias("least"))
                     .select("node", F.least("node", "least").alias("label"), F.lit(True).alias("changed")), "labels")
    while not labels.where("changed").isEmpty():
        old = labels.select("node", "label")
        near = (links.join(old.select(F.col("node").alias("b"), F.col("label").alias("l")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l")))
        best = old.join(near, "node").select("node", "label", F.least("label", "l").alias("best"))
        jump = old.select(F.col("node").alias("best"), F.col("label").alias("root"))
        labels = written(best.join(jump, "best", "left")
                         .select("node", F.least("best", F.coalesce("root", "best")).alias("new"), "label")
                         .select("node", F.col("new").alias("label"), (F.col("new") != F.col("label")).alias("changed")), "labels")
    return labels.select("node", F.col("label").alias("component"))
