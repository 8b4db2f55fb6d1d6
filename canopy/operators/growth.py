"""Level-wise growth of many trees at once, as DataFrame jobs.

One level of every tree costs ONE aggregation over the data:

* each row is routed to its current node in every tree by a nested CASE
  built from the splits found so far (rows that reached a leaf drop out);
* of the two children of a split only the one with fewer rows is counted: its
  rows are expanded to (tree, node, feature, bin) for the features of that
  tree and aggregated into histograms (map-side combine first), and its
  sibling's histogram is the parent's, kept from the level before, less that
  (whole-numbered sums, so it is the same to the last bit).  Where rows fell
  out of a split by a missing value, both children are counted;
* the split scan of ``splitscan`` picks the best split per (tree, node).

The only thing that comes back to the driver is the best split per frontier
node: at most trees x 2^depth rows.  The training frame is persisted
(memory and disk) for the ``max_depth`` passes and released afterwards.

Bootstrap weights and feature subsets are fixed data per tree (a hash of the
row content, md5-ranked feature ids), so a tree does not change when the
input is repartitioned or a task is retried.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.operators.binning import add_bins, fit_bins
from canopy.operators.nodes import CASE_LIMIT
from canopy.operators.splitscan import (CLASSIFICATION, LABEL_DIGITS, STATS, best_per, candidates, compact, histogram,
                                         num_classes, stat_columns, stat_values)

NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType(), False),
    T.StructField("node_id", T.LongType(), False),
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("is_left", T.BooleanType(), True),
    T.StructField("depth", T.IntegerType(), False),
    T.StructField("feature", T.IntegerType(), True),
    T.StructField("feature_name", T.StringType(), True),
    T.StructField("threshold", T.DoubleType(), True),
    T.StructField("left_id", T.LongType(), True),
    T.StructField("right_id", T.LongType(), True),
    T.StructField("prediction", T.DoubleType(), True),
    T.StructField("class_counts", T.ArrayType(T.DoubleType()), True),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("impurity", T.DoubleType(), True),
    T.StructField("gain", T.DoubleType(), True),
])


@dataclass
class TreeSpec:
    """What makes one tree of an ensemble different from the others."""
    tree_id: int
    features: list[int]                 # indices into the feature list
    weight: Column | None = None        # per-row count (bootstrap); None = 1
    node_features: int | None = None    # features drawn anew for every node; None = all of the tree's
    seed: int = 0                       # of the drawing per node


@dataclass
class _Node:
    tree_id: int
    node_id: int
    depth: int
    stats: list[float]
    row_count: int
    feature: int | None = None
    threshold: float | None = None
    gain: float | None = None
    children: tuple[int, int] | None = None
    extra: dict = field(default_factory=dict)


def _predict(task: str, stats: Sequence[float]) -> float | None:
    if task == CLASSIFICATION:
        if not stats or sum(stats) <= 0:
            return None
        best = max(stats)
        return float(stats.index(best))  # lowest class on ties
    w, wy = stats[0], stats[1]
    return wy / w if w > 0 else None


def _impurity(task: str, stats: Sequence[float]) -> float | None:
    if task == CLASSIFICATION:
        n = sum(stats)
        if n <= 0:
            return None
        imp = 1.0
        for c in stats:
            f = c / n
            imp = imp - f * f
        return imp
    w, wy, wy2 = stats
    if w <= 0:
        return None
    return (wy2 - (wy * wy) / w) / w


def _route_sql(nodes: dict, tree_id: int, node_id: int) -> str:
    node = nodes.get((tree_id, node_id))
    if node is None or (node.children is None and not node.extra.get("counted")):
        return "CAST(NULL AS BIGINT)"
    if node.children is None:
        return f"{node_id}L"
    b = f"__b{node.feature}"
    left = _route_sql(nodes, tree_id, node.children[0])
    right = _route_sql(nodes, tree_id, node.children[1])
    # x <= threshold[j]  <=>  bin <= j ; NULL value -> NULL bin -> no node
    return (f"CASE WHEN {b} IS NULL THEN CAST(NULL AS BIGINT) "
            f"WHEN {b} <= {node.extra['split_bin']} THEN {left} ELSE {right} END")


def route(nodes: dict, tree_id: int, node_id: int = 1) -> Column:
    """Nested CASE over bin columns giving a row's node to count it in (NULL = none).

    Built as SQL text: one expression object per tree, however many nodes.
    """
    return F.expr(_route_sql(nodes, tree_id, node_id))


def route_walk(nodes: dict, tree_id: int, depth: int, used: Sequence[int]) -> Column:
    """Routing for large partial trees: walk ``depth`` steps from the root
    with the splits held in map literals (expression size linear in nodes)."""
    splits = [(nid, n.feature, n.extra["split_bin"]) for (t, nid), n in nodes.items()
              if t == tree_id and n.children is not None]
    live = [nid for (t, nid), n in nodes.items()
            if t == tree_id and n.children is None and n.extra.get("counted")]
    slot = {f: i for i, f in enumerate(used)}
    empty = "CAST(map() AS map<bigint,int>)"
    fmap = F.expr("map(" + ", ".join(f"{nid}L, {slot[f]}" for nid, f, _ in splits) + ")" if splits else empty)
    bmap = F.expr("map(" + ", ".join(f"{nid}L, {b}" for nid, _, b in splits) + ")" if splits else empty)
    bins = F.array(*[F.col(f"__b{f}") for f in used])
    frontier = F.expr("array(" + ", ".join(f"{nid}L" for nid in live) + ")") if live \
        else F.expr("array(-1L)")

    def step(n, _):
        f = F.element_at(fmap, n)
        b = F.get(bins, f)
        return (F.when(n.isNull(), F.lit(None).cast("long"))
                 .when(f.isNull(), n)
                 .when(b.isNull(), F.lit(None).cast("long"))
                 .when(b <= F.element_at(bmap, n), n * 2)
                 .otherwise(n * 2 + 1))

    end = F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(1).cast("long"), step)
    return F.when(F.array_contains(frontier, end), end)


#: Deepest tree the grower takes: the driver holds at most trees x 2^depth nodes.
MAX_DEPTH = 16


def drawn_for_node(spec: TreeSpec) -> Column:
    """Is a histogram's feature among those drawn for its node?

    The features of the tree are ranked by md5('<seed>|<tree>|<node>|<feature>')
    and the first ``node_features`` count, so any SQL engine draws the same.
    """
    def rank(f: Column) -> Column:
        return F.md5(F.concat_ws("|", F.lit(str(spec.seed)), F.lit(str(spec.tree_id)), F.col("node_id").cast("string"), f.cast("string")))

    ranked = F.array_sort(F.transform(F.array(*[F.lit(f) for f in spec.features]), lambda f: F.struct(rank(f).alias("h"), f.alias("f"))))
    return F.array_contains(F.transform(F.slice(ranked, 1, spec.node_features), lambda x: x["f"]), F.col("feature"))


#: Nodes up to which their list is broadcast.
BROADCAST_NODES = 1_000_000


def _siblings(built: DataFrame, known: DataFrame, derived: Sequence[tuple[int, int]], stats: Sequence[str]) -> DataFrame:
    """The histograms of the nodes ``derived``: those of their parents (``known``) less those of their siblings (``built``).

    Rows may share (tree, node, feature, bin); summed up they are the histogram.
    """
    table = known.sparkSession.createDataFrame(list(derived), "tree_id int, child long")
    table = F.broadcast(table) if len(derived) <= BROADCAST_NODES else table
    of_parent = known.join(table.withColumn("node_id", F.expr("child DIV 2")), ["tree_id", "node_id"])
    of_sibling = built.join(table.withColumn("node_id", F.col("child").bitwiseXOR(F.lit(1))), ["tree_id", "node_id"])

    def at_child(df: DataFrame, sign: int) -> DataFrame:
        return df.select("tree_id", F.col("child").alias("node_id"), "feature", "bin",
                         *[(F.col(s) if sign > 0 else -F.col(s)).cast(known.schema[s].dataType).alias(s) for s in stats])

    return at_child(of_parent, 1).unionAll(at_child(of_sibling, -1))


def grow_trees(df: DataFrame, cols: Sequence[str], label: str = "label",
               task: str = CLASSIFICATION, specs: Sequence[TreeSpec] | None = None,
               max_depth: int = 5, max_bins: int = 100, n_classes: int | None = None,
               thresholds: Sequence[Sequence[float]] | None = None,
               min_gain: float = 0.0, carry: Sequence[str] = (), prune: bool = True) -> DataFrame:
    """Grow every tree in ``specs`` level by level; return the node table.

    ``carry`` names extra columns the per-tree weight expressions read.
    ``prune`` merges two leaf children with the same prediction into their
    parent, bottom-up (as Spark's tree learner does); predictions do not
    change.

    The training rows are read and persisted once, binned, and, where a
    sample of row hashes shows that this saves enough rows, collapsed to the
    distinct combinations of bins (and class) with their summed statistics;
    otherwise they stay as they are and no row is shuffled.  Every level
    re-reads this form.  Rows without a label are left out; a label that is no
    class (negative, fractional, or beyond ``n_classes``) is refused.
    """
    spark: SparkSession = df.sparkSession
    cols = list(cols)
    if not 0 <= max_depth <= MAX_DEPTH:
        raise ValueError(f"max_depth must be in 0..{MAX_DEPTH}")
    if specs is None:
        specs = [TreeSpec(0, list(range(len(cols))))]
    keep = list(dict.fromkeys([*cols, label, *carry]))
    # read (and split, where a filter decides the train part) once for all fitting passes
    data = df.select(*[F.col(c) for c in keep]).where(F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double"))).persist(StorageLevel.MEMORY_AND_DISK)
    binned = known = hist = None
    try:
        given = thresholds is not None or n_classes is not None
        if thresholds is None:
            want_label = label if task == CLASSIFICATION and n_classes is None else None
            thresholds, max_label = fit_bins(data, cols, max_bins, want_label)
            if want_label is not None:
                n_classes = int(max_label) + 1 if max_label is not None else 1
        if task == CLASSIFICATION and (given or n_classes is None):
            n_classes = num_classes(data, label, n_classes)
        used_all = sorted({f for s in specs for f in s.features})
        bins = [f"__b{f}" for f in used_all]
        # trees without a row weight share one set of statistics
        group = {s.tree_id: f"t{s.tree_id}" if s.weight is not None else "all" for s in specs}
        weights = {group[s.tree_id]: s.weight for s in specs}
        weighted = {g: f"__w_{g}" for g, w in weights.items() if w is not None}
        pre = data.select(
            F.col(label).cast("double").alias("label"),
            *[weights[g].alias(name) for g, name in weighted.items()],
            *[F.col(cols[f]) for f in used_all])
        rows = add_bins(pre, [cols[f] for f in used_all], [thresholds[f] for f in used_all], bins, ["label", *weighted.values()])
        binned = compact(rows, bins, task, {g: F.col(weighted[g]) if g in weighted else None for g in weights},
                         [thresholds[f] for f in used_all], n_classes).persist(StorageLevel.MEMORY_AND_DISK)
        names = STATS[:2] if task == CLASSIFICATION else STATS
        kept = ["label"] if task == CLASSIFICATION else []
        nodes: dict[tuple[int, int], _Node] = {}
        frontier = {(s.tree_id, 1) for s in specs}
        for s in specs:
            nodes[(s.tree_id, 1)] = _Node(s.tree_id, 1, 0, [], 0, extra={"counted": True})
        spec_by_id = {s.tree_id: s for s in specs}
        root_stats = [F.expr(x) for x in stat_values(task, n_classes, "T", LABEL_DIGITS)]

        for depth in range(max_depth + 1):
            if not frontier:
                break
            if depth == max_depth and depth > 0:
                break  # leaves: statistics already known from the parent's split
            live = sorted({t for t, _ in frontier})
            size = {t: sum(1 for (tt, _) in nodes if tt <= t) for t in live}  # with the trees before it
            routes = [(route(nodes, t) if size[t] <= CASE_LIMIT
                       else route_walk(nodes, t, depth, used_all)).alias(f"__n{t}") for t in live]
            routed = binned.select(*kept, *routes, *[F.col(f"{g}_{k}") for g in sorted({group[t] for t in live}) for k in names], *bins)

            # per tree a list of one struct per feature, plus a totals entry (feature -1) for the root
            def entries(t):
                stats = [F.col(f"{group[t]}_{k}").alias(k) for k in names]
                features = ([(-1, F.lit(0))] if depth == 0 else []) + \
                    ([(f, F.col(f"__b{f}")) for f in spec_by_id[t].features] if depth < max_depth else [])
                each = F.array(*[F.struct(F.lit(t).alias("tree_id"), F.col(f"__n{t}").alias("node_id"), F.lit(f).alias("feature"),
                                          b.alias("bin"), *stats) for f, b in features])
                # rows that are not counted in this tree are not expanded for it
                return F.when(F.col(f"__n{t}").isNotNull() & (F.col(f"{group[t]}_w") > 0), each).otherwise(F.expr(nothing))

            amounts = "w: double, n: bigint" + ("" if task == CLASSIFICATION else ", s1: decimal(38,0), s2: decimal(38,0)")
            nothing = f"CAST(array() AS array<struct<tree_id: int, node_id: bigint, feature: int, bin: int, {amounts}>>)"
            long = (routed.select(*kept, F.explode(F.concat(*[entries(t) for t in live])).alias("e")).select(*kept, "e.*")
                    .where(F.col("bin").isNotNull()))
            hist = histogram(long, ["tree_id", "node_id"], task, n_classes)
            sums = [*stat_columns(task, n_classes), "n_raw"]
            derived = sorted(k for k in frontier if not nodes[k].extra["counted"])
            if derived:
                hist = hist.select("tree_id", "node_id", "feature", "bin", *sums).unionAll(_siblings(hist, known, derived, sums))
            hist = hist.repartition("tree_id", "node_id", "feature")
            if derived:
                hist = (hist.groupBy("tree_id", "node_id", "feature", "bin")
                        .agg(*[F.sum(c).cast(known.schema[c].dataType).alias(c) for c in sums]).where("n_raw > 0"))
            hist = hist.persist(StorageLevel.MEMORY_AND_DISK)
            parts = []
            if depth < max_depth:
                # running sums per (tree, node, feature); the best per node then merges partial maxima
                drawn = hist.where(F.col("feature") >= 0)
                for t in live:
                    if spec_by_id[t].node_features is not None:
                        drawn = drawn.where((F.col("tree_id") != t) | drawn_for_node(spec_by_id[t]))
                cands = candidates(drawn, ["tree_id", "node_id"], task, n_classes)
                parts.append(best_per(cands, ["tree_id", "node_id"])
                             .withColumn("stats", F.lit(None).cast("array<double>"))
                             .withColumn("n_raw", F.lit(None).cast("long")))
            if depth == 0:
                # root statistics ride in the same job (the histogram exchange
                # is reused); deeper nodes inherit theirs from the parent's split
                tot = hist.where(F.col("feature") == -1)
                tot = tot.select("tree_id", "node_id", *[F.col(s).alias(f"T_{s}") for s in stat_columns(task, n_classes)], "n_raw")
                tot = tot.select("tree_id", "node_id", F.array(*root_stats).alias("stats"), "n_raw")
                parts.append(tot if not parts else
                             tot.select(*[F.col(c) if c in tot.columns else F.lit(None).cast(t).alias(c)
                                          for c, t in parts[0].dtypes]))
            rows = parts[0].unionByName(parts[1]).collect() if len(parts) == 2 else parts[0].collect()
            if known is not None:
                known.unpersist()
            known = hist
            totals = [r for r in rows if r["stats"] is not None]
            best_rows = [r for r in rows if r["stats"] is None]
            best = {(r["tree_id"], r["node_id"]): r for r in best_rows}
            for r in totals:
                n = nodes[(r["tree_id"], r["node_id"])]
                n.stats = [float(v) for v in r["stats"]]
                n.row_count = int(r["n_raw"])
            new_frontier = set()
            for key in frontier:
                n = nodes[key]
                n.extra["counted"] = False
                b = best.get(key)
                imp = _impurity(task, n.stats) if n.stats else None
                if b is None or b["gain"] is None or not b["gain"] > min_gain or not imp:
                    continue
                n.feature, n.gain = int(b["feature"]), float(b["gain"])
                n.threshold = float(thresholds[n.feature][int(b["bin"])])
                n.extra["split_bin"] = int(b["bin"])
                lid, rid = 2 * n.node_id, 2 * n.node_id + 1
                n.children = (lid, rid)
                raws = {lid: int(b["raw_left"]), rid: int(b["raw_right"])}
                # a sibling is the parent less the smaller child, unless rows with a missing value are in neither
                smaller = lid if raws[lid] <= raws[rid] else rid
                whole = sum(raws.values()) == n.row_count
                for cid, side in ((lid, "left_stats"), (rid, "right_stats")):
                    nodes[(n.tree_id, cid)] = _Node(n.tree_id, cid, depth + 1, [float(v) for v in b[side]], raws[cid],
                                                    extra={"counted": cid == smaller or not whole, "is_left": cid == lid, "parent": n.node_id})
                    new_frontier.add((n.tree_id, cid))
            frontier = new_frontier
        if prune:
            _prune(nodes, task)
        return _node_table(spark, nodes, cols, task)
    finally:
        for held in (data, binned, known, hist):
            if held is not None:
                held.unpersist()


def _prune(nodes: dict, task: str) -> None:
    for key in sorted(nodes, key=lambda k: -nodes[k].depth):
        n = nodes.get(key)
        if n is None or n.children is None:
            continue
        kids = [nodes.get((n.tree_id, c)) for c in n.children]
        if all(k is not None and k.children is None for k in kids) and \
                _predict(task, kids[0].stats) == _predict(task, kids[1].stats):
            for c in n.children:
                del nodes[(n.tree_id, c)]
            n.children, n.feature, n.threshold, n.gain = None, None, None, None


def _node_table(spark: SparkSession, nodes: dict, cols: Sequence[str], task: str) -> DataFrame:
    rows = []
    for (tree_id, node_id), n in sorted(nodes.items()):
        leaf = n.children is None
        rows.append((
            int(tree_id), int(node_id),
            int(n.extra["parent"]) if "parent" in n.extra else None,
            n.extra.get("is_left"),
            int(n.depth),
            None if leaf else n.feature,
            None if leaf else cols[n.feature],
            None if leaf else n.threshold,
            None if leaf else int(n.children[0]),
            None if leaf else int(n.children[1]),
            _predict(task, n.stats),
            [float(v) for v in n.stats] if task == CLASSIFICATION else None,
            int(n.row_count),
            _impurity(task, n.stats),
            None if leaf else n.gain,
        ))
    return spark.createDataFrame(rows, NODE_SCHEMA)
