"""The corpus pipeline: documents through the operators, one written table per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from canopy.llm import stages
from canopy.llm.common import documents, written

#: (name, function) in order; a function takes (spark, docs, sf_dir).
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", stages.language_id),
    ("line_dedup", stages.line_dedup),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("pii", stages.pii),
    ("packing", stages.packing),
]

#: The stages are not expressible in SQL; tests/llm checks them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents`` below ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
