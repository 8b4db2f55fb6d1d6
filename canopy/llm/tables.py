"""Fixed-size count tables: built per task with numpy, summed by Spark, read by every task.

A table has a set number of slots (a documented parameter of the operator
that uses it), so its size is bounded whatever the corpus; the counts in it
cover all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import workers_ready, written

BLOCK = 1 << 14
#: The first of two summing steps deals a block to this many tasks.
FAN = 16


def _rows(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    blocks = [(i, table[i * BLOCK:(i + 1) * BLOCK]) for i in range(-(-len(table) // BLOCK))]
    blocks = [(i, b) for i, b in blocks if b.any()]
    for at in range(0, len(blocks), 16):
        some = blocks[at:at + 16]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in some], pa.int32()),
                                          pa.array([zstandard.compress(b.astype("<u4" if b.max() < 1 << 32 else "<i8").tobytes(), 1) for _, b in some], pa.binary()),
                                          pa.array([b.max() < 1 << 32 for _, b in some], pa.bool_())], ["block", "data", "short"])


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for block, data, short in zip(b["block"].to_pylist(), b["data"].to_pylist(), b["short"].to_pylist(), strict=True):
            x = np.frombuffer(zstandard.decompress(data), "<u4" if short else "<i8")
            if block in total:
                total[block] += x
            else:
                total[block] = x.astype(np.int64)
    for block, x in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zstandard.compress(x.astype("<i8").tobytes(), 1)], pa.binary()),
                                          pa.array([False])], ["block", "data", "short"])


SCHEMA = "block int, data binary, short boolean"


def counted(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], slots: int) -> np.ndarray:
    """The table of ``slots`` counts summed over all tasks.

    ``count`` turns one task's batches into its own table.  Blocks of the
    tables are summed in two shuffles (first among some tasks, then all), so
    that no task reads every other task's tables; the driver gets one table.
    """
    workers_ready(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _rows(count(batches))

    parts = rows.mapInArrow(run, SCHEMA).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    some = parts.repartition("block", "salt").select("block", "data", "short").mapInArrow(_sum, SCHEMA)
    total = written(some.repartition("block").mapInArrow(_sum, SCHEMA), "table")
    out = np.zeros(slots, np.int64)
    for r in total.toLocalIterator():
        x = np.frombuffer(zstandard.decompress(r.data), "<i8")
        out[r.block * BLOCK:r.block * BLOCK + len(x)] = x
    return out
