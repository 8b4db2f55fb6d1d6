"""Split candidates per feature (the bins every tree is grown on).

Rule:

* a feature with at most ``max_bins`` distinct values gets every midpoint
  between consecutive distinct values as a candidate threshold, so the split
  search on it is exact;
* a feature with more distinct values gets up to ``max_bins - 1`` cut points:
  its values at the ranks ceil(i n / max_bins), exactly.

Both come from additive counts, so the candidates are the same on any
partitioning.  The ranks are found by refinement: values are counted in a
bounded number of equal intervals, only the intervals that hold a wanted rank
are divided further, until each holds one value; a few passes suffice.  A
distinct-count sketch only tells which features may be low-cardinality (up to
twice ``max_bins``, twenty times its error); their distinct values decide.
NaN never becomes a candidate (it always goes right); NULL rows are ignored;
infinite values count as the largest finite ones.
"""

from __future__ import annotations

from collections.abc import Sequence

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Intervals per pass of the refinement.
INTERVALS = 1024
_LARGEST = 1.7976931348623157e308


def melt(df: DataFrame, cols: Sequence[str], label: str | None = None) -> DataFrame:
    """Wide feature columns -> rows (feature index, value), NULLs dropped; a ``label`` is feature -1."""
    named = [*enumerate(cols), *([(-1, label)] if label is not None else [])]
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("value")) for i, c in named])
    return df.select(F.explode(pairs).alias("p")).select("p.feature", "p.value").where(F.col("value").isNotNull())


def odd_labels(label: Column, n_classes: int | None = None) -> Column:
    """Aggregate: labels that are no class (negative, fractional, or beyond 0..n_classes-1)."""
    odd = (label < 0) | (label != F.floor(label))
    return F.count_if(odd if n_classes is None else odd | (label >= n_classes))


def refuse_odd_labels(odd: int) -> None:
    if odd:
        raise ValueError(f"{odd} labels are no classes: a class is a whole number from 0 to the number of classes less 1")


def exact_ranks(vals: DataFrame, wanted: dict[int, list[int]], ends: dict[int, tuple[float, float]]) -> dict[int, dict[int, float]]:
    """The values at the ``wanted`` ranks (from 1) of each feature of ``vals`` (feature, value).

    ends: least and largest value per feature.  What reaches the driver, and
    what is broadcast, has at most one row per wanted rank.
    """
    spark = vals.sparkSession
    found: dict[int, dict[int, float]] = {f: {} for f in wanted}
    # an open part: (feature, least, largest, rows before it, ranks in it)
    parts = {f: (f, *ends[f], 0, ranks) for f, ranks in wanted.items()}
    rows = vals.select(F.col("feature").alias("part"), "value")
    while True:
        for part in [p for p, (_, lo, hi, _, _) in parts.items() if lo == hi]:
            f, lo, _, _, ranks = parts.pop(part)
            found[f].update(dict.fromkeys(ranks, lo))
        if not parts:
            return found
        table = spark.createDataFrame([(p, lo, hi) for p, (_, lo, hi, _, _) in parts.items()], "part int, lo double, hi double")
        share = F.try_divide(F.col("value") / 2 - F.col("lo") / 2, F.col("hi") / 2 - F.col("lo") / 2)
        place = F.coalesce(F.floor(share * INTERVALS), F.when(F.col("value") > F.col("lo"), INTERVALS).otherwise(0))
        rows = rows.join(F.broadcast(table), "part").select("part", F.least(place, F.lit(INTERVALS - 1)).cast("int").alias("place"), "value")
        held = rows.groupBy("part", "place").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        order = Window.partitionBy("part").orderBy("place")
        held = held.withColumn("upto", F.sum("n").over(order))
        ranks = spark.createDataFrame([(p, r - before) for p, (_, _, _, before, rs) in parts.items() for r in rs], "part int, rank long")
        hit = (held.join(F.broadcast(ranks), "part").where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
               .groupBy("part", "place", "lo", "hi").agg(F.max(F.col("upto") - F.col("n")).alias("before"), F.collect_list("rank").alias("ranks")).collect())
        new = {}
        for k, r in enumerate(sorted(hit, key=lambda r: (r.part, r.place))):
            f, _, _, before, _ = parts[r.part]
            new[k] = (r.part, r.place, (f, r.lo, r.hi, before + r.before, [before + x for x in r.ranks]))
        parts = {k: v for k, (_, _, v) in new.items()}
        steps = spark.createDataFrame([(p, q, k) for k, (p, q, _) in new.items()], "part int, place int, next int")
        rows = rows.join(F.broadcast(steps), ["part", "place"]).select(F.col("next").alias("part"), "value")


def fit_bins(df: DataFrame, cols: Sequence[str], max_bins: int = 100,
             label: str | None = None) -> tuple[list[list[float]], float | None]:
    """(sorted thresholds per feature, max label or None); labels that are no classes are refused.

    Values are melted to (feature, value) rows (a streaming explode feeding
    the partial aggregate, nothing materialised), so every feature's counts
    merge in their own reduce tasks instead of all in one.
    """
    if max_bins < 2:
        raise ValueError("max_bins must be >= 2")
    cols = list(cols)
    # the label rides along as one more value (feature -1), so its facts come from the same pass
    vals = melt(df, cols, label).where(~F.isnan("value"))
    vals = vals.withColumn("value", F.greatest(F.least("value", F.lit(_LARGEST)), F.lit(-_LARGEST)))
    aggs = [F.approx_count_distinct("value", 0.05).alias("nd"), F.count(F.lit(1)).alias("n"),
            F.min("value").alias("lo"), F.max("value").alias("hi"), odd_labels(F.col("value")).alias("odd")]
    about = {r["feature"]: r for r in vals.groupBy("feature").agg(*aggs).collect()}
    facts = about.pop(-1, None)
    if facts is not None:
        refuse_odd_labels(facts["odd"])
    vals = vals.where("feature >= 0")
    vals = vals.select("feature", "value")
    low = [f for f, r in about.items() if r["nd"] <= 2 * max_bins]
    exact: dict[int, list[float]] = {}
    if low:
        rows = (vals.where(F.col("feature").isin(low)).distinct()
                    .groupBy("feature").agg(F.sort_array(F.collect_list("value")).alias("vs")).collect())
        exact = {r["feature"]: list(r["vs"]) for r in rows}
    many = [f for f in about if len(exact.get(f, ())) > max_bins or f not in exact]
    ranks = {f: sorted({-(-i * about[f]["n"] // max_bins) for i in range(1, max_bins)}) for f in many}
    cuts = exact_ranks(vals.where(F.col("feature").isin(many)), ranks, {f: (about[f]["lo"], about[f]["hi"]) for f in many}) if many else {}
    out: list[list[float]] = []
    for i in range(len(cols)):
        if i in cuts:
            out.append(sorted(set(cuts[i].values())))
        else:
            vs = exact.get(i, [])  # none: all NULL / NaN, no split possible
            out.append([a / 2.0 + b / 2.0 if abs(a + b) == math.inf else (a + b) / 2.0 for a, b in zip(vs[:-1], vs[1:])])
    return out, facts["hi"] if facts is not None else None


def fit_thresholds(df: DataFrame, cols: Sequence[str], max_bins: int = 100) -> list[list[float]]:
    """Sorted candidate thresholds for each of ``cols`` (list per feature)."""
    return fit_bins(df, cols, max_bins)[0]


def add_bins(df: DataFrame, cols: Sequence[str], thresholds: Sequence[Sequence[float]],
             names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns + one INT bin column per feature (``names``).

    A bin is the number of thresholds below the value (NaN in the last bin;
    NULL stays NULL), computed by ``Bucketizer`` -- a binary
    search inside the JVM whose plan size does not grow with the number of
    thresholds, so hundreds of features x bins stay cheap to plan and run.
    Bucket boundaries are the next double above each threshold, so the
    half-open buckets [s_i, s_i+1) hold exactly the values x with
    thresholds[i-1] < x <= thresholds[i].
    """
    xs = [f"__x{i}" for i in range(len(cols))]
    base = df.select(*keep, *[F.col(c).cast("double").alias(x) for c, x in zip(cols, xs)])
    split_idx = [i for i, th in enumerate(thresholds) if th]
    if split_idx:
        splits = [[-math.inf] + [math.nextafter(float(t), math.inf) for t in thresholds[i]] + [math.inf]
                  for i in split_idx]
        base = Bucketizer(splitsArray=splits, inputCols=[xs[i] for i in split_idx],
                          outputCols=[f"__k{i}" for i in split_idx], handleInvalid="keep").transform(base)
    bins = []
    for i in range(len(cols)):
        if thresholds[i]:
            # NaN lands in Bucketizer's extra bucket; fold it into the last bin.
            # (least() skips NULLs, so NULL must be kept NULL explicitly)
            b = F.when(F.col(xs[i]).isNotNull(),
                       F.least(F.col(f"__k{i}").cast("int"), F.lit(len(thresholds[i]))))
        else:
            b = F.when(F.col(xs[i]).isNotNull(), F.lit(0))
        bins.append(b.alias(names[i]))
    return base.select(*keep, *bins)
