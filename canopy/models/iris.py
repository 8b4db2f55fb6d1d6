"""The two bundled Iris forests, as fixed model values.

Each tree is written as nested tuples ``(feature, threshold, left, right)``
with a class name at the leaves: go left when ``x[feature] <= threshold``.
``to_node_rows`` turns them into node-table rows with heap ids (root 1,
children 2i and 2i+1).  They are used to score rows derived from the test
tables and as PMML round-trip fixtures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from canopy.operators.growth import NODE_SCHEMA

# ---- fixed values (must stay exactly as in the two published documents) ----
FEATURES = ["Sepal.Length", "Sepal.Width", "Petal.Length", "Petal.Width"]
CLASSES = ["setosa", "versicolor", "virginica"]
LABEL = "Species"

SL, SW, PL, PW = FEATURES
se, ve, vi = CLASSES

# forest exported from Spark (thresholds are data values)
SPARK_FOREST = [
    (PL, 1.9, se, (PW, 1.7, (SL, 7.0, (PL, 4.9, (PW, 1.6, ve, vi), (SW, 2.2, vi, ve)), vi), vi)),
    (PL, 1.9, se, (PL, 4.7, ve, (SW, 2.7, (PL, 4.9, ve, (PW, 1.6, ve, vi)), vi))),
    (PW, 0.5, se, (PW, 1.6, (PL, 4.7, ve, (SW, 2.2, vi, (SW, 2.7, ve, vi))),
                   (PW, 1.7, (SL, 4.9, vi, ve), vi))),
]

# forest built in R (thresholds are midpoints)
R_FOREST = [
    (SL, 5.35, (PL, 2.45, se, ve), (PL, 4.85, (PW, 0.7, se, ve), vi)),
    (PW, 0.7, se, (PL, 4.95, ve, vi)),
    (PW, 0.7, se,
     (SL, 6.85,
      (SW, 3.25,
       (PL, 4.85, (PL, 4.75, ve, (SW, 3.0, (PW, 1.6, ve, vi), ve)), (PL, 4.95, (SW, 2.65, ve, vi), vi)),
       (SL, 6.5, (PL, 5.05, ve, vi), vi)),
      (PW, 1.5, ve, vi))),
]
# ---------------------------------------------------------------------------


def to_node_rows(forest, features=FEATURES, classes=CLASSES) -> list[tuple]:
    """Nested tuples -> rows of ``NODE_SCHEMA`` (class index as prediction)."""
    rows = []

    def walk(t, tree, node, parent, is_left, depth):
        if isinstance(node, str):
            rows.append((t, node_id_of[0], parent, is_left, depth, None, None, None, None, None,
                         float(classes.index(node)), None, None, None, None))
            return
        feat, thr, left, right = node
        me = node_id_of[0]
        rows.append((t, me, parent, is_left, depth, features.index(feat), feat, float(thr),
                     2 * me, 2 * me + 1, None, None, None, None, None))
        node_id_of[0] = 2 * me
        walk(t, tree, left, me, True, depth + 1)
        node_id_of[0] = 2 * me + 1
        walk(t, tree, right, me, False, depth + 1)

    for t, tree in enumerate(forest):
        node_id_of = [1]
        walk(t, tree, tree, None, None, 0)
    return rows


def forest_table(spark: SparkSession, forest) -> DataFrame:
    """A fixed forest as a node table DataFrame."""
    return spark.createDataFrame(to_node_rows(forest), NODE_SCHEMA)
