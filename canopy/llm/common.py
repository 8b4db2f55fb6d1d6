"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.session import scratch_path, ship_package

#: Largest table (rows) that is broadcast in a join; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """The table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, kind: str, row_group_mb: int = 0) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again.

    Cuts the lineage: a lost executor costs no earlier stage, and later
    stages do not compute ``df`` again.  ``row_group_mb`` bounds what the
    writer buffers (for rows of several megabytes).
    """
    return written_at(df, kind, row_group_mb)[0]


def written_at(df: DataFrame, kind: str, row_group_mb: int = 0) -> tuple[DataFrame, str]:
    """As ``written``, with the path, for a table that is dropped (``drop_scratch``) once it has been read for the last time."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    (df.write.option("parquet.block.size", row_group_mb << 20) if row_group_mb else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def text_or_empty(column: str | Column) -> Column:
    """A text column with null read as the empty text."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c, F.lit(""))


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when its counted ``rows`` are within ``limit``."""
    return F.broadcast(df) if rows <= limit else df


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the column's text, modulo ``modulus`` (a null id reads as the empty text)."""
    return F.crc32(text_or_empty(F.col(column).cast("string"))) % F.lit(modulus)


def workers_ready(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers."""
    ship_package(spark)
