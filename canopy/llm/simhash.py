"""SimHash near-duplicates through segment popcounts.

A 64-bit fingerprint is mapped to the bit counts of its 32 segments.  The
Manhattan distance of two such vectors is at most the Hamming distance of the
fingerprints, so a grid range-join on the vectors finds every pair that can
link: each vector is placed into all lattice cells within half the distance,
and two vectors share a cell exactly if their Manhattan distance is within
the limit.  Fingerprints that share a cell with another one are then verified
exactly the same way on the 64 bits themselves: two of them are within
``max_bits`` exactly if flipping at most ``max_bits / 2`` bits of each can
give the same word.  Both steps count the members of a key instead of
listing pairs, so a group of G copies costs O(G) rows, not O(G^2).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import text_or_empty, workers_ready, written
from canopy.llm.components import connected_components

SEED = 42

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (np.arange(8, dtype=np.uint16) * 256)[None, :]


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit majority fingerprint of the word shingles of a UTF-8 text (0 if it has no word)."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: n - shingle + 1]
    ends = ends[shingle - 1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        s, e = starts[at:at + (1 << 16)].tolist(), ends[at:at + (1 << 16)].tolist()
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(s, e, strict=True)), np.uint64, len(s))
        lanes = h.astype("<u8").view(np.uint8).reshape(-1, 8) + _LANES
        total += (np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS).ravel()
    bits = (total * 2 > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) per row of ``docs``; fp is the fingerprint as a signed long.  Null text: empty."""
    workers_ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(run, f"id {kind}, fp bigint")


def segment_counts(fp: Column) -> Column:
    """The bit counts of the 32 two-bit segments of ``fp``, each in its segment's place."""
    low, high = F.lit(0x5555555555555555), F.shiftrightunsigned(fp, 1)
    return F.shiftleft(high.bitwiseAND(fp).bitwiseAND(low), 1).bitwiseOR(high.bitwiseXOR(fp).bitwiseAND(low))


def _one_step(cell: Column) -> Column:
    """``cell`` and the cells one step from it: one segment's count one more or less.

    Counts are taken modulo 4 (-1 and 3 are one), which only puts more
    vectors into a cell.
    """
    def moved(at: Column, by: int) -> Column:
        count = F.call_function("shiftrightunsigned", cell, at).bitwiseAND(F.lit(3).cast("long"))
        change = count.bitwiseXOR((count + by).bitwiseAND(F.lit(3).cast("long")))
        return cell.bitwiseXOR(F.call_function("shiftleft", change, at))

    at = F.sequence(F.lit(0), F.lit(62), F.lit(2))
    return F.concat(F.array(cell), F.transform(at, lambda i: moved(i, 1)), F.transform(at, lambda i: moved(i, 3)))


def segment_cells(fp: Column, radius: int) -> Column:
    """All lattice cells within Manhattan ``radius`` of the segment bit counts of ``fp``, each as one long."""
    cells = F.array(segment_counts(fp))
    for _ in range(radius):
        cells = F.array_distinct(F.flatten(F.transform(cells, _one_step)))
    return cells


def flipped_words(fp: Column, radius: int) -> Column:
    """All 64-bit words within Hamming ``radius`` of ``fp``."""
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(64), r)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in signed]), lambda m: m.bitwiseXOR(fp))


def _sharing(keys: DataFrame) -> DataFrame:
    """Of ``keys`` (key, fp): rows whose key has another fp too, with the key's smallest fp as ``hub``.

    ``keys`` holds many rows per fingerprint, which size estimates miss; the
    hint keeps the join from broadcasting them.
    """
    hubs = (keys.groupBy("key").agg(F.min("fp").alias("hub"), F.max("fp").alias("top"))
            .where("hub <> top").select("key", "hub"))
    return keys.join(hubs.hint("merge"), "key")


def linked(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """Star edges (src, dst) whose components are those of the graph 'Hamming distance <= max_bits' on ``distinct`` (fp)."""
    if max_bits % 2 or not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0, 2 or 4")
    half = max_bits // 2
    if not half:
        return distinct.select(F.col("fp").alias("src"), F.col("fp").alias("dst")).where("false")
    cells = distinct.select("fp", F.explode(segment_cells(F.col("fp"), half)).alias("key"))
    near = written(_sharing(cells).select("fp").distinct(), "near")
    words = near.select("fp", F.explode(flipped_words(F.col("fp"), half)).alias("key"))
    return _sharing(words).where("fp <> hub").select(F.col("fp").alias("src"), F.col("hub").alias("dst")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """(id, fp, component_id) per row of ``docs``.

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id
    is the smallest id reachable by links.  Null and empty texts have
    fingerprint zero and link like any other.  Repeated rows give repeated
    results; a component whose ids are all null has a null component_id.
    """
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fps")
    reps = written(fps.groupBy("fp").agg(F.min("id").alias("rep")), "reps")
    comps = connected_components(linked(reps.select("fp"), max_bits)).select(F.col("node").alias("fp"), "component")
    joined = reps.join(comps, "fp", "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    joined = written(joined, "members")
    best = written(joined.groupBy("component").agg(F.min("rep").alias("component_id")), "components")
    member = written(joined.select("fp", "component").join(best, "component").select("fp", "component_id"), "members")
    return fps.join(member, "fp").select("id", "fp", "component_id")
