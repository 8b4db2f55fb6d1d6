"""Train / hold-out splits and value complement.

``hash_split`` is the reproducible split: a row goes to train when the md5
bucket of its key columns is below ``frac * 1000``.  It needs no shuffle, no
seed and no knowledge of partitioning, so the same rows land on the same
side on any cluster and after any task retry.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.functions.columns import HASH_BUCKETS, hash_bucket, md5_hex
from canopy.operators.binning import exact_ranks
from canopy.session import stored


def bucket_cut(frac: float) -> int:
    """Number of train buckets; a fraction that is no whole number of buckets is rejected."""
    if not 0.0 <= frac <= 1.0:
        raise ValueError("frac must be in [0, 1]")
    cut = round(frac * HASH_BUCKETS)
    if abs(frac * HASH_BUCKETS - cut) > 1e-9:
        raise ValueError(f"frac must be a multiple of 1/{HASH_BUCKETS}: {frac}")
    return cut


def train_predicate(cols: Sequence[str], frac: float, salt: str = "", method: str = "md5"):
    """Column: True for rows that fall in the train part."""
    return hash_bucket(cols, salt, method) < F.lit(bucket_cut(frac))


def hash_split(df: DataFrame, cols: Sequence[str], frac: float = 0.6,
               salt: str = "", method: str = "md5") -> tuple[DataFrame, DataFrame]:
    """D3: (train, test) by hash bucket of ``cols``; equal keys share a side.

    ``method='md5'`` is reproducible outside Spark; ``'xxhash64'`` is cheaper.
    """
    pred = train_predicate(cols, frac, salt, method)
    return df.where(pred), df.where(~pred)


def hash_split_counts(df: DataFrame, cols: Sequence[str], frac: float = 0.6) -> DataFrame:
    """Rows per side of ``hash_split`` (one pass, two output rows)."""
    side = F.when(train_predicate(cols, frac), F.lit("train")).otherwise(F.lit("test"))
    return df.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n_rows"))


def random_split(df: DataFrame, weights: Sequence[float] = (0.6, 0.4),
                 seed: int | None = None) -> list[DataFrame]:
    """Spark's random split (depends on partitioning; prefer hash_split or exact_split)."""
    return df.randomSplit(list(weights), seed)


def bernoulli_sample(df: DataFrame, frac: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=frac, seed=seed)


#: Occurrences of one row that are numbered in one go.
OCCURRENCES = 1000


def numbered_rows(df: DataFrame) -> DataFrame:
    """The rows of ``df`` with ``__k``: equal rows are numbered 1, 2, ... (which of them has which number means nothing).

    Equal rows are counted first (map-side combine), and a frequent row is
    written out again in chunks that are dealt to different tasks.
    """
    cols = df.columns
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__c"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__c") - 1) / OCCURRENCES)))
    parts = counts.select(*cols, "__c", chunk.alias("__chunk")).repartition(*cols, "__chunk")
    first = F.col("__chunk") * OCCURRENCES + 1
    return parts.select(*cols, F.explode(F.sequence(first, F.least(F.col("__c"), first + OCCURRENCES - 1))).alias("__k"))


def exact_split(df: DataFrame, weights: Sequence[float] = (0.6, 0.4), seed: int = 0) -> list[DataFrame]:
    """D1 with exact shares: a random split whose parts end at the ranks floor(share * rows + 1/2), the same on any partitioning.

    A row's rank is that of md5('<seed>|<row>|<occurrence>'), so of equal rows
    some may fall on either side.  The cuts are exact ranks of the hashes'
    first 52 bits, found by counting; at a cut that several rows share, their whole hashes decide.
    """
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    cols = df.columns
    rows = numbered_rows(df).withColumn("__h", md5_hex([*cols, "__k"], str(seed)))
    rows = stored(rows.select(*cols, "__h", F.conv(F.substring("__h", 1, 13), 16, 10).cast("long").cast("double").alias("__u")), "split")
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.min("__u").alias("lo"), F.max("__u").alias("hi")).first()
    total, ends, upto = sum(weights), [], 0.0
    for w in weights[:-1]:
        upto += w
        ends.append(math.floor(upto / total * r["n"] + 0.5))
    inner = sorted({e for e in ends if 0 < e < r["n"]})
    cuts = exact_ranks(rows.select(F.lit(0).alias("feature"), F.col("__u").alias("value")), {0: inner}, {0: (r["lo"], r["hi"])})[0] if inner else {}
    # rows of the wanted rank or before it: below the cut, or among the first of those at it
    at_cut = rows.where(F.col("__u").isin(list(set(cuts.values())))) if cuts else None
    last = {}
    for e, u in cuts.items():
        need = e - rows.where(F.col("__u") < u).count()
        last[e] = at_cut.where(F.col("__u") == u).orderBy("__h").limit(need).agg(F.max("__h")).first()[0]

    def before(e: int) -> Column:
        if e <= 0 or e >= r["n"]:
            return F.lit(e > 0)
        return (F.col("__u") < cuts[e]) | ((F.col("__u") == cuts[e]) & (F.col("__h") <= last[e]))

    bounds = [0, *ends, r["n"]]
    return [rows.where(before(b) & ~before(a)).select(*cols) for a, b in zip(bounds, bounds[1:])]


def exact_sample(df: DataFrame, frac: float, seed: int = 0) -> DataFrame:
    """D2 with an exact share: floor(frac * rows + 1/2) rows drawn without replacement (the first part of ``exact_split``)."""
    if not 0.0 <= frac <= 1.0:
        raise ValueError("frac must be in [0, 1]")
    return exact_split(df, [frac, 1.0 - frac], seed)[0]


def holdout_complement(df: DataFrame, train: DataFrame) -> DataFrame:
    """Rows of ``df`` with no equal row in ``train`` (by value, null-safe).

    Duplicates in ``df`` whose value is not in ``train`` are all kept (this is
    neither ``subtract`` -- which de-duplicates -- nor ``exceptAll``).

    Plan: ``train`` is de-duplicated first; the distinct aggregate combines
    map-side, so a value repeated by a third of all rows reaches the join as
    one row.  The anti join then has unique build keys; Spark broadcasts that
    side only when its measured size is under the broadcast threshold and
    AQE splits a skewed probe partition.
    """
    cols = df.columns
    right = train.select(*[F.col(c).alias(f"__r_{i}") for i, c in enumerate(cols)]).distinct()
    cond = None
    for i, c in enumerate(cols):
        term = df[c].eqNullSafe(right[f"__r_{i}"])
        cond = term if cond is None else cond & term
    return df.join(right, cond, "left_anti")


def union_predictions(scored: DataFrame, keep: Sequence[str], votes: str = "votes") -> DataFrame:
    """Per-tree predictions stacked with a ``tree_id`` column, from one pass over ``scored``.

    ``scored`` holds one array of votes per row (by tree id); every row gives
    one output row per tree, so the table is read once for any number of trees.
    """
    return scored.select(*[F.col(c) for c in keep], F.posexplode(F.col(votes)).alias("tree_id", "prediction"))
