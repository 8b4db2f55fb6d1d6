"""Scoring rows with a node table.

A model is a node table (``growth.NODE_SCHEMA``): go left when
``x[feature_name] <= threshold``.  Scoring compiles each tree into ONE
Column expression, so it is a narrow projection: no join with the model,
no shuffle, whole-stage codegen over the scan.

* ``case``: nested CASE WHEN per tree (best for the usual depth <= 10
  trees; constant-folded and codegen'd).
* ``walk``: the tree as array literals (feature slot, threshold, children,
  prediction) walked by ``aggregate`` for ``depth`` steps -- expression size
  stays linear in the node count, for models too large for CASE trees.

* ``join``: the model stays a table (``treejoin``), one join per level; for
  models of more than LITERAL_NODES nodes, of any size.

For the first two the model is collected to the driver, after its size is checked.

Missing values: a NULL feature gives a NULL vote for that tree; NaN goes
right (``NaN <= t`` is false).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.operators.treejoin import BROADCAST_NODES, joined_votes
from canopy.session import stored

#: Nodes of all trees of one projection up to which the CASE form is used.
#: Measured: three trees of 255 nodes compile and score 300,000 rows in 1.3 s
#: (walk: 5 s); three of 511 nodes no longer compile.  Both forms give the
#: same votes.
CASE_LIMIT = 768
#: Nodes up to which a model is compiled into the plan; larger ones are joined (three trees of
#: 65,535 nodes as literals take a minute to plan).
LITERAL_NODES = 20_000
#: Most nodes that may be asked to be held on the driver (``max_nodes``).
MAX_NODES = 2_000_000


def _c(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def collect_trees(nodes: DataFrame, max_nodes: int = MAX_NODES) -> dict[int, dict[int, dict]]:
    """Node table -> {tree_id: {node_id: row-dict}} after a size check."""
    # one bounded job: at most max_nodes + 1 rows ever reach the driver
    rows = (nodes.select("tree_id", "node_id", "feature_name", "threshold", "left_id",
                         "right_id", "prediction").limit(max_nodes + 1).collect())
    if len(rows) > max_nodes:
        raise ValueError(f"model has more than max_nodes={max_nodes} nodes")
    trees: dict[int, dict[int, dict]] = {}
    for r in rows:
        trees.setdefault(int(r["tree_id"]), {})[int(r["node_id"])] = r.asDict()
    return trees


def _root(tree: dict[int, dict]) -> int:
    children = {v["left_id"] for v in tree.values()} | {v["right_id"] for v in tree.values()}
    roots = [k for k in tree if k not in children]
    if len(roots) != 1:
        raise ValueError(f"tree has {len(roots)} roots")
    return roots[0]


def _lit_double(v) -> str:
    return "CAST(NULL AS DOUBLE)" if v is None else f"{float(v)!r}D"


def _case_sql(tree: dict[int, dict], node_id: int) -> str:
    n = tree[node_id]
    if n["left_id"] is None:
        return _lit_double(n["prediction"])
    name = n["feature_name"].replace("`", "``")
    x = f"CAST(`{name}` AS DOUBLE)"
    return (f"CASE WHEN {x} IS NULL THEN CAST(NULL AS DOUBLE) "
            f"WHEN {x} <= {_lit_double(n['threshold'])} THEN {_case_sql(tree, n['left_id'])} "
            f"ELSE {_case_sql(tree, n['right_id'])} END")


def case_expr(tree: dict[int, dict], node_id: int | None = None) -> Column:
    """I4 (case): nested CASE for one tree; NULL feature -> NULL.

    Written as SQL text so a tree costs one expression object to build.
    """
    return F.expr(_case_sql(tree, _root(tree) if node_id is None else node_id))


def _arr(values: Sequence, kind: str) -> Column:
    if kind == "double":
        body = ", ".join("CAST(NULL AS DOUBLE)" if v is None else f"{float(v)!r}D" for v in values)
        return F.expr(f"array({body})") if values else F.array().cast("array<double>")
    body = ", ".join(str(int(v)) for v in values)
    return F.expr(f"array({body})")


def walk_expr(tree: dict[int, dict]) -> Column:
    """I4 (walk): array-walk form for one tree; linear in node count."""
    ids = sorted(tree)
    pos = {nid: i for i, nid in enumerate(ids)}
    names = sorted({n["feature_name"] for n in tree.values() if n["left_id"] is not None})
    slot = {nm: i for i, nm in enumerate(names)}
    feat = _arr([slot[tree[i]["feature_name"]] if tree[i]["left_id"] is not None else -1 for i in ids], "int")
    thr = _arr([tree[i]["threshold"] if tree[i]["left_id"] is not None else 0.0 for i in ids], "double")
    left = _arr([pos[tree[i]["left_id"]] if tree[i]["left_id"] is not None else -1 for i in ids], "int")
    right = _arr([pos[tree[i]["right_id"]] if tree[i]["right_id"] is not None else -1 for i in ids], "int")
    pred = _arr([tree[i]["prediction"] for i in ids], "double")
    x = F.array(*[_c(nm).cast("double") for nm in names]) if names else F.array().cast("array<double>")
    # depth of the tree from heap ids when available, else node count bound
    depth = max(int(i).bit_length() for i in ids) if all(i >= 1 for i in ids) else len(ids)
    start = F.lit(pos[_root(tree)])

    def step(i, _):
        f = feat[i]
        xv = x[f]
        return (F.when(i < 0, i)
                 .when(f < 0, i)
                 .when(xv.isNull(), F.lit(-1))
                 .when(xv <= thr[i], left[i])
                 .otherwise(right[i]))

    leaf = F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), start, step)
    return F.when(leaf < 0, F.lit(None).cast("double")).otherwise(pred[leaf])


def joins_model(nodes: DataFrame, method: str) -> bool:
    """Is the model scored as a table: on request, or because it is too large for the plan?"""
    return method == "join" or (method == "auto" and nodes.limit(LITERAL_NODES + 1).count() > LITERAL_NODES)


def tree_columns(trees: dict[int, dict[int, dict]], method: str = "auto") -> list[Column]:
    out, nodes = [], 0
    for t in sorted(trees):
        tree = trees[t]
        nodes += len(tree)
        m = method if method != "auto" else ("case" if nodes <= CASE_LIMIT else "walk")
        out.append(case_expr(tree) if m == "case" else walk_expr(tree))
    return out


def score_nodes(df: DataFrame, nodes: DataFrame, method: str = "auto",
                votes: str = "votes", max_nodes: int = MAX_NODES) -> DataFrame:
    """Add ``votes`` = array of per-tree predictions (by tree_id)."""
    if joins_model(nodes, method):
        scored, names = joined_votes(df, nodes)
        return scored.select(*[_c(c) for c in df.columns], F.array(*names).alias(votes))
    trees = collect_trees(nodes, max_nodes)
    return df.withColumn(votes, F.array(*tree_columns(trees, method)))


def _tree_frame(df: DataFrame, nodes: DataFrame, method: str, max_nodes: int, n_classes: int | None = None):
    """(rows with a vote column per tree, those columns, their names, some votes outside 0..n_classes-1)."""
    if joins_model(nodes, method):
        scored, names = joined_votes(df, nodes)
        p = F.col("prediction")
        odd = nodes.where(F.col("left_id").isNull() & ((p < 0) | (p >= n_classes) | (p != F.floor(p)))).select(p).distinct().limit(5) if n_classes else None
        return scored, [F.col(n) for n in names], names, sorted(r[0] for r in odd.collect()) if n_classes else []
    trees = collect_trees(nodes, max_nodes)
    cols = tree_columns(trees, method)
    names = [f"__v{t}" for t in range(len(cols))]
    # the per-tree CASE trees are projected once; the vote below reads them
    leaves = {n["prediction"] for tree in trees.values() for n in tree.values() if n["left_id"] is None}
    odd = sorted(p for p in leaves if p is not None and n_classes and not (0 <= p < n_classes and p == int(p)))
    return df.select("*", *[c.alias(n) for c, n in zip(cols, names)]), [F.col(n) for n in names], names, odd[:5]


def predict_classes(df: DataFrame, nodes: DataFrame, n_classes: int, method: str = "auto",
                    keep_votes: bool = False, max_nodes: int = MAX_NODES) -> DataFrame:
    """I2 + A10 + I5: hard majority vote (ties -> lowest class) and vote shares.

    Counts per class are plain CASE sums over the per-tree columns, so the
    whole vote stays in whole-stage codegen (no lambda functions).  A model
    that votes for anything but 0..n_classes-1 is refused.
    """
    scored, v, names, odd = _tree_frame(df, nodes, method, max_nodes, n_classes)
    if odd:
        raise ValueError(f"the model votes for {odd}, outside the classes 0..{n_classes - 1}")
    counts = ["(" + " + ".join(f"CASE WHEN {n} = {float(k)!r}D THEN 1 ELSE 0 END" for n in names) + ")"
              for k in range(n_classes)]
    valid = "(" + " + ".join(f"CASE WHEN {n} IS NOT NULL THEN 1 ELSE 0 END" for n in names) + ")"
    if n_classes == 1:
        pred = f"CASE WHEN {valid} > 0 THEN 0.0D END"
    else:
        best = "greatest(" + ", ".join(f"named_struct('n', {c}, 'neg', {-k})" for k, c in enumerate(counts)) + ")"
        pred = f"CASE WHEN {valid} > 0 THEN CAST(-({best}).neg AS DOUBLE) END"
    prob = f"CASE WHEN {valid} > 0 THEN array({', '.join(f'{c} / {valid}' for c in counts)}) END"
    cols = [_c(c) for c in df.columns] + [F.expr(pred).alias("prediction"), F.expr(prob).alias("probability")]
    if keep_votes:
        cols.append(F.array(*v).alias("votes"))
    return scored.select(*cols)


def predict_mean(df: DataFrame, nodes: DataFrame, method: str = "auto",
                 keep_votes: bool = False, max_nodes: int = MAX_NODES) -> DataFrame:
    """I2 + A11: mean of the non-NULL tree predictions."""
    scored, v, names, _ = _tree_frame(df, nodes, method, max_nodes)
    valid = "(" + " + ".join(f"CASE WHEN {n} IS NOT NULL THEN 1 ELSE 0 END" for n in names) + ")"
    total = "(0.0D" + "".join(f" + coalesce({n}, 0.0D)" for n in names) + ")"
    cols = [_c(c) for c in df.columns] + [F.expr(f"CASE WHEN {valid} > 0 THEN {total} / {valid} END")
                                             .alias("prediction")]
    if keep_votes:
        cols.append(F.array(*v).alias("votes"))
    return scored.select(*cols)


def predict_distribution(df: DataFrame, nodes: DataFrame, n_classes: int, method: str = "auto", max_nodes: int = MAX_NODES) -> DataFrame:
    """I5, second form: ``probability`` = mean over the trees of the class shares at the leaf a row reaches; ``prediction`` = its largest (ties -> lowest class).

    Every tree gives a row its leaf's node id, which is looked up in the table
    of leaves (``class_counts``): broadcast when its size is within the limit.
    A tree without a vote (missing feature) or a leaf without counts takes no part.
    """
    if joins_model(nodes, method):
        at, names = joined_votes(df, nodes, prefix="__leaf", value="node_id")
    else:
        trees = collect_trees(nodes.withColumn("prediction", F.col("node_id").cast("double")), max_nodes)
        names = [f"__leaf{t}" for t in sorted(trees)]
        at = df.select("*", *[c.alias(n) for c, n in zip(tree_columns(trees, method), names)])
    total = F.aggregate("class_counts", F.lit(0.0), lambda acc, v: acc + v)
    leaves = stored(nodes.where(F.col("left_id").isNull()).select("tree_id", "node_id", F.when(
        total > 0, F.transform("class_counts", lambda v: v / total)).alias("share")), "leaves")
    sizes = {r["tree_id"]: r["n"] for r in leaves.groupBy("tree_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    for t, name in zip(sorted(sizes), names):
        table = leaves.where(F.col("tree_id") == t).select(F.col("node_id").cast("double").alias(f"__at{t}"), F.col("share").alias(f"__share{t}"))
        table = F.broadcast(table) if sizes[t] <= BROADCAST_NODES else table
        at = at.join(table, F.col(name) == F.col(f"__at{t}"), "left")
    shares = [F.col(f"__share{t}") for t in sorted(sizes)]
    n = sum((F.when(s.isNotNull(), 1).otherwise(0) for s in shares), F.lit(0))
    mean = [sum((F.coalesce(F.get(s, k), F.lit(0.0)) for s in shares), F.lit(0.0)) / n for k in range(n_classes)]
    best = F.greatest(*[F.struct(F.get("probability", k).alias("p"), F.lit(-k).alias("k")) for k in range(n_classes)]) if n_classes > 1 else None
    out = at.select(*[_c(c) for c in df.columns], F.when(n > 0, F.array(*mean)).alias("probability"))
    top = F.lit(0.0) if best is None else (-best["k"]).cast("double")
    return out.withColumn("prediction", F.when(F.col("probability").isNotNull(), top))
