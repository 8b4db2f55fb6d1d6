"""Labelled inputs derived from the test tables (FIXTURES.md section 4).

Every query reads the given parquet tables, so its work grows with them.
Only the columns a query needs are selected, so the parquet scan reads
those columns alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values --------------------------------------------------------
FEATURES = ["l_quantity", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
TRAIN_FRAC = 0.6
LINEAR_TRAIN_FRAC = 0.9
RETURNFLAG_CLASSES = ["A", "N", "R"]
# lineitem -> Iris ranges (affine; same double operations in every engine)
#   Sepal.Length = 4.3 + (l_quantity - 1) / 49 * 3.6
#   Sepal.Width  = 2.0 + l_discount * 24
#   Petal.Length = 1.0 + l_tax / 0.08 * 5.9
#   Petal.Width  = 0.1 + l_extendedprice / 105000 * 2.4
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def status_label() -> Column:
    """Binary label: l_linestatus 'O' -> 1.0, else 0.0."""
    return F.when(F.col("l_linestatus") == "O", F.lit(1.0)).otherwise(F.lit(0.0))


def flag_label() -> Column:
    """Three-class label from l_returnflag: A -> 0, N -> 1, R -> 2."""
    c = F.col("l_returnflag")
    return (F.when(c == "A", F.lit(0.0)).when(c == "N", F.lit(1.0))
             .when(c == "R", F.lit(2.0)))


def lineitem_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(*KEYS, status_label().alias("label"), *FEATURES)


def lineitem_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(*KEYS, flag_label().alias("label"), *FEATURES)


def lineitem_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(*KEYS, F.col("l_extendedprice").alias("label"), *FEATURES)


def iris_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iris_frame(table(spark, sf_dir, "lineitem"))


def iris_frame(li: DataFrame) -> DataFrame:
    """lineitem rows (batch or stream) -> Iris-range features + flag label."""
    lit = F.lit
    return li.select(
        *KEYS,
        flag_label().alias("label"),
        (lit(4.3) + (F.col("l_quantity") - lit(1.0)) / lit(49.0) * lit(3.6)).alias("Sepal.Length"),
        (lit(2.0) + F.col("l_discount") * lit(24.0)).alias("Sepal.Width"),
        (lit(1.0) + F.col("l_tax") / lit(0.08) * lit(5.9)).alias("Petal.Length"),
        (lit(0.1) + F.col("l_extendedprice") / lit(105000.0) * lit(2.4)).alias("Petal.Width"),
    )
