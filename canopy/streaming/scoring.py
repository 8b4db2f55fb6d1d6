"""Scoring streams with a node table.

A node table compiles to plain Column expressions, so a streaming
DataFrame is scored exactly like a batch one: a stateless projection per
micro-batch, no state store, no shuffle.  The only extra pieces are the
source (file stream over the table's files) and a fault-tolerant sink
(parquet files plus a checkpoint folder under the shared checkpoint dir),
so a lost executor or a restarted query resumes from the last committed
batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.operators.nodes import predict_classes, predict_mean
from canopy.session import scratch_path


def as_glob(path: str) -> str:
    """A single-file path as a one-file glob (the file stream source lists
    folders or globs, not bare files)."""
    if any(ch in path for ch in "*?[{") or path.endswith("/"):
        return path
    return f"{path[:-1]}[{path[-1]}]"


def read_stream(spark: SparkSession, path: str, like: DataFrame, max_files: int | None = None) -> DataFrame:
    """Parquet files under ``path`` (file, folder or glob) as a stream with
    the schema of ``like``."""
    reader = spark.readStream.schema(like.schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader.parquet(as_glob(path))


def score_stream(stream: DataFrame, nodes: DataFrame, n_classes: int | None = None) -> DataFrame:
    """Hard vote (``n_classes`` given) or mean vote over a streaming frame."""
    if n_classes is None:
        return predict_mean(stream, nodes)
    return predict_classes(stream, nodes, n_classes)


def run_to_table(spark: SparkSession, stream: DataFrame, out: str | None = None) -> DataFrame:
    """Drain every available input into parquet (exactly-once file sink with
    a checkpoint) and return the written table as a batch DataFrame."""
    out = out or scratch_path(spark, "stream-out")
    q = (stream.writeStream.format("parquet").outputMode("append")
               .option("path", out).option("checkpointLocation", out + "-checkpoint")
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def stream_error_counts(scored: DataFrame, label: str = "label") -> DataFrame:
    """Running n_test / n_wrong over a scored stream (complete-mode aggregate;
    two counters of state, whatever the stream length)."""
    wrong = (~F.col("prediction").eqNullSafe(F.col(label))).cast("long")
    return scored.agg(F.count(F.lit(1)).alias("n_test"), F.sum(wrong).alias("n_wrong"))
