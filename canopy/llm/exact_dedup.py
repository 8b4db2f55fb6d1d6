"""Exact deduplication with two passes over a Bloom filter.

Pass one sets a few bits per row in a blocked Bloom filter (one 64-bit word
per row) and keeps the bits that at least two rows set.  Pass two probes it:
a row with any bit set by itself alone is the only one with its text and
passes straight through; only the rest is grouped by a SHA-256 of the text.
A false positive costs a shuffle of one narrow row, never a wrong result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import small, text_or_empty, written

BITS_PER_ROW = 16
PROBES = 4


def _word(h: Column, words: int) -> Column:
    return F.pmod(h, F.lit(words).cast("long"))


def _bits(h: Column) -> Column:
    """The distinct bit numbers (0-63) a hash sets in its word."""
    g = F.xxhash64(h, F.lit(1))
    return F.array_distinct(F.array(*[F.shiftrightunsigned(g, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(PROBES)]))


def _mask(bits: Column) -> Column:
    return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))


def repeated_bits(hashes: DataFrame, words: int) -> DataFrame:
    """Pass one: (word, twice) with the bits that at least two rows of ``hashes`` (h) set."""
    each = hashes.select(_word(F.col("h"), words).alias("word"), F.explode(_bits(F.col("h"))).alias("bit"))
    twice = each.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    return twice.groupBy("word").agg(F.bit_or(one).alias("twice"))


def with_candidates(rows: DataFrame, h: str, bits_per_row: int = BITS_PER_ROW) -> DataFrame:
    """``rows`` plus ``candidate``: may another row have the same hash ``h``?  (No false negatives.)"""
    n = rows.count()
    words = max(1, n * bits_per_row // 64)
    filt = written(repeated_bits(rows.select(F.col(h).alias("h")), words), "bloom")
    key = F.col(h)
    probe = filt.select(F.col("word").alias("_word"), F.col("twice").alias("_twice"))
    mask = _mask(_bits(key))
    return (rows.withColumn("_word", _word(key, words))
            .join(small(probe, filt.count()), "_word", "left")
            .withColumn("candidate", F.coalesce(F.col("_twice").bitwiseAND(mask) == mask, F.lit(False)))
            .drop("_word", "_twice"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 bits_per_row: int = BITS_PER_ROW) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, sha (32 bytes).

    Equal means the same text, unchanged; null counts as the empty text.  Of
    equal texts the largest id stays (``keep_id``; null ids only when all are
    null).  Repeated rows count in ``group_size``; rows that share the largest
    id name one document and are all ``kept``.  Other columns of ``docs`` are
    not read, so their names cannot clash.
    """
    text = text_or_empty(text_col)
    rows = written(docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("sha"),
                               F.xxhash64(text).alias("h")), "hashes")
    marked = written(with_candidates(rows, "h", bits_per_row).select("id", "sha", "candidate"), "marked")
    alone = marked.where("not candidate").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    maybe = marked.where("candidate").select("id", "sha")
    # written, so that the join below deals both sides itself and can split the rows of a large group
    groups = written(maybe.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    found = maybe.join(groups, "sha").select("id", "keep_id", "group_size", "sha")
    return alone.union(found).withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay (all columns).  Only candidate rows are shuffled, by their digest."""
    text = text_or_empty(F.col(f"_row.{text_col}"))
    rows = docs.select(F.struct("*").alias("_row")).withColumn("_h", F.xxhash64(text))
    marked = with_candidates(rows, "_h")
    maybe = marked.where("candidate").select("_row", F.sha2(text, 256).alias("_sha"), F.col(f"_row.{id_col}").alias("_id"))
    best = written(maybe.groupBy("_sha").agg(F.max("_id").alias("_keep")), "groups")
    stay = maybe.join(best, "_sha").where(F.col("_id").eqNullSafe(F.col("_keep"))).select("_row.*")
    return marked.where("not candidate").select("_row.*").union(stay)
