"""Scoring with a model held as a table (I4 for models of any size).

The node table is never on the driver.  The first levels of all trees, a
bounded number of nodes, are compiled into CASE expressions as in ``nodes``;
they deal the rows to the subtrees below.  From there a tree is followed on its
own.  A level of it is one join of the rows with that level's nodes on the node
they have reached, broadcast when its counted nodes are within
``broadcast_nodes``.  Larger levels, for which rows have to move, are joined
PACKED at a time: the nodes below one node are a row of their table, and a row
that has met them takes several steps.  There the nodes reached are many, and
rows that are done already get keys of their own, dealt by a hash, so that they
do not meet in one task.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.session import stored

#: Nodes of all trees together in the levels that are compiled.
TOP_NODES = 256
#: Nodes of one tree's level up to which the level is broadcast.
BROADCAST_NODES = 1_000_000
#: Levels that one join takes where rows have to move (at most 2^PACKED - 1 nodes in a row of the model).
PACKED = 8
#: Joins of one plan; beyond, the rows are written and read again.
JOINS_PER_PLAN = 48
#: Joins that are generated as one method: the JVM only interprets a method of more than 8000 bytes.
JOINS_PER_METHOD = 3

_NODE = ["tree_id", "node_id", "depth", "feature_name", "threshold", "left_id", "right_id", "prediction"]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _top_sql(tree: dict[int, dict], node_id: int, vote: bool, value: str) -> str:
    """Nested CASE of a tree's first levels: the node to go on from, or the vote of a leaf among them."""
    kind = "DOUBLE" if vote else "BIGINT"
    nothing = f"CAST(NULL AS {kind})"
    n = tree.get(node_id)
    if n is None:
        return nothing if vote else f"{node_id}L"
    if n["left_id"] is None:
        v = n[value]
        return nothing if v is None or not vote else f"{float(v)!r}D"
    x = f"CAST({_quoted(n['feature_name'])} AS DOUBLE)"
    return (f"CASE WHEN {x} IS NULL THEN {nothing} WHEN {x} <= {float(n['threshold'])!r}D THEN {_top_sql(tree, n['left_id'], vote, value)} "
            f"ELSE {_top_sql(tree, n['right_id'], vote, value)} END")


def joined_votes(df: DataFrame, nodes: DataFrame, prefix: str = "__v", value: str = "prediction", top_nodes: int = TOP_NODES,
                 broadcast_nodes: int = BROADCAST_NODES) -> tuple[DataFrame, list[str]]:
    """(``df`` with one vote column per tree, their names in order of tree id).

    A vote is the ``prediction`` of the leaf a row reaches, or its ``node_id``;
    NULL when a feature on the way is NULL (NaN goes right).
    """
    spark = df.sparkSession
    model = stored(nodes.select(*_NODE), "model", by=["depth"])
    sizes = {(r["tree_id"], r["depth"]): r["n"] for r in model.groupBy("tree_id", "depth").agg(F.count(F.lit(1)).alias("n")).collect()}
    trees = sorted({t for t, _ in sizes})
    deepest = max((d for _, d in sizes), default=-1)
    top = 0
    while top <= deepest and sum(n for (_, d), n in sizes.items() if d <= top) <= top_nodes:
        top += 1
    by_tree: dict[int, dict[int, dict]] = defaultdict(dict)
    for r in model.where(F.col("depth") < max(top, 1)).collect():
        by_tree[r["tree_id"]][r["node_id"]] = r.asDict()
    roots = {t: [i for i, n in by_tree[t].items() if n["depth"] == 0] for t in trees}
    odd = [t for t, r in roots.items() if len(r) != 1]
    if odd:
        raise ValueError(f"tree {odd[0]} has {len(roots[odd[0]])} roots")
    used = sorted(r["feature_name"] for r in model.where("left_id IS NOT NULL").select("feature_name").distinct().limit(len(df.columns) + 1).collect())
    missing = [u for u in used if u not in df.columns]
    if missing:
        raise ValueError(f"the model reads {missing[:5]}, which the rows do not have")
    compiled = {t: by_tree[t] if top else {} for t in trees}
    own = [F.col(_quoted(c)) for c in df.columns]
    x = [F.col(_quoted(u)).cast("double") for u in used]
    slots = F.create_map(*[c for i, u in enumerate(used) for c in (F.lit(u), F.lit(i))]) if used else None
    heap = {r["tree_id"]: r["heap"] for r in model.groupBy("tree_id").agg(F.every(_is_heap()).alias("heap")).collect()} if max(sizes.values(), default=0) > broadcast_nodes else {}
    state, joins = df, 0
    for t in trees:
        node, vote = f"__n{t}", f"{prefix}{t}"
        state = state.select("*", F.expr(_top_sql(compiled[t], roots[t][0], False, value)).alias(node), F.expr(_top_sql(compiled[t], roots[t][0], True, value)).alias(vote))
        depth, since = top, 0
        while (t, depth) in sizes:
            if joins and joins % JOINS_PER_PLAN == 0:
                state = stored(state, "votes")
            if since % JOINS_PER_METHOD == 0:
                state = _apart(state)
            joins, since = joins + 1, since + 1
            small = sizes[t, depth] <= broadcast_nodes
            levels = 1
            while heap.get(t) and not small and levels < PACKED and sizes.get((t, depth + levels), 0) > broadcast_nodes:
                levels += 1
            table = model.where((F.col("tree_id") == t) & F.col("depth").between(depth, depth + levels - 1))
            state = _step(state, table, node, vote, x, slots, value, small) if levels == 1 else _steps(state, table, depth, levels, node, vote, x, slots, value)
            depth += levels
        state = state.drop(node)
    names = [f"{prefix}{t}" for t in trees]
    return state.select(*own, *names), names


def _is_heap() -> Column:
    """Are a node's id and its children's those of a heap (root 1, children 2i and 2i + 1), as ``_steps`` reads them?"""
    i = F.col("node_id")
    root = (i >= 1) & (F.length(F.bin(i)) == F.col("depth") + 1)
    return F.coalesce(root & (F.col("left_id").isNull() | ((F.col("left_id") == 2 * i) & (F.col("right_id") == 2 * i + 1))), F.lit(False))


def _slot(slots: Column | None) -> Column:
    return F.when(F.col("left_id").isNotNull(), slots[F.col("feature_name")] if slots is not None else F.lit(None).cast("int"))


def _value(x: list[Column], slot: str) -> Column:
    """The feature that ``slot`` numbers."""
    at = F
    for i, c in enumerate(x):
        at = at.when(F.col(slot) == i, c)
    return at if x else F.lit(None).cast("double")


def _dealt(node: str, x: list[Column]) -> Column:
    """The key of a join that moves the rows: the node reached, and for rows that are done a negative number by their values."""
    return F.coalesce(F.col(node), -1 - F.pmod(F.xxhash64(*x, F.lit(0)), F.lit(1 << 30)))


def _apart(state: DataFrame) -> DataFrame:
    """The same rows in the same partitions; what follows is generated as a method of its own."""
    return state.coalesce((1 << 31) - 1)


def _step(state: DataFrame, level: DataFrame, node: str, vote: str, x: list[Column], slots: Column | None, value: str, small: bool) -> DataFrame:
    """Rows that are at a node of ``level`` (one tree's) go one step down, or get their vote."""
    table = level.select(F.col("node_id").alias("__at"), _slot(slots).alias("__slot"), F.col("threshold").alias("__t"),
                         F.col("left_id").alias("__l"), F.col("right_id").alias("__r"), F.col(value).cast("double").alias("__p"))
    kept = [F.col(_quoted(c)) for c in state.columns if c not in (node, vote)]
    key, table = (F.col(node), F.broadcast(table)) if small else (_dealt(node, x), table)
    both = state.withColumn("__key", key).join(table, F.col("__key") == F.col("__at"), "left")
    v = _value(x, "__slot")
    down = F.when(F.col("__slot").isNotNull() & v.isNotNull(), F.when(v <= F.col("__t"), F.col("__l")).otherwise(F.col("__r")))
    here = F.col("__at").isNotNull()
    return both.select(*kept, F.when(here, down).otherwise(F.col(node)).alias(node),
                       F.when(here & F.col("__slot").isNull(), F.col("__p")).otherwise(F.col(vote)).alias(vote))


def _steps(state: DataFrame, nodes: DataFrame, depth: int, levels: int, node: str, vote: str, x: list[Column], slots: Column | None, value: str) -> DataFrame:
    """As ``_step``, ``levels`` steps down a tree with heap ids by one join: ``nodes`` are its levels from ``depth`` on.

    A row of the table is a node at ``depth`` with the nodes below it in order
    of their ids; a node knows where in that list its left child is, the right one follows.
    """
    below = (F.col("depth") - depth).cast("int")
    up = F.pow(F.lit(2.0), below.cast("double")).cast("long")
    root = F.expr(f"shiftright(node_id, cast(depth - {depth} as int))")
    packed = nodes.select(root.alias("__at"), (F.col("node_id") - root * up + up).cast("int").alias("rel"), _slot(slots).alias("slot"), F.col("threshold").alias("t"),
                          F.col(value).cast("double").alias("p"))
    packed = packed.groupBy("__at").agg(F.sort_array(F.collect_list(F.struct("rel", "slot", "t", "p"))).alias("__all"))
    packed = packed.select("__at", F.expr("transform(__all, e -> e.slot)").alias("__slot"), F.expr("transform(__all, e -> e.t)").alias("__t"),
                           F.expr("transform(__all, e -> e.p)").alias("__p"),
                           F.expr("transform(__all, e -> if(e.slot is null, 0, cast(array_position(__all.rel, 2 * e.rel) as int)))").alias("__l"))
    values = F.array(*x) if x else F.array().cast("array<double>")
    both = state.withColumn("__key", _dealt(node, x)).join(packed, F.col("__key") == F.col("__at"), "left").withColumn("__x", values)
    # place in the list (0: below it, or lost by a missing value) and node; at a leaf both stay
    step = """(s, i) -> CASE WHEN s.at = 0 OR __slot[s.at - 1] IS NULL THEN s
        WHEN __x[__slot[s.at - 1]] IS NULL THEN named_struct('at', 0, 'node', CAST(NULL AS BIGINT))
        WHEN __x[__slot[s.at - 1]] <= __t[s.at - 1] THEN named_struct('at', __l[s.at - 1], 'node', 2 * s.node)
        ELSE named_struct('at', IF(__l[s.at - 1] = 0, 0, __l[s.at - 1] + 1), 'node', 2 * s.node + 1) END"""
    end = F.expr(f"aggregate(sequence(1, {levels}), named_struct('at', 1, 'node', __at), {step})")
    kept = [F.col(_quoted(c)) for c in state.columns if c not in (node, vote)]
    here, leaf = F.col("__at").isNotNull(), F.col("__end.at") > 0
    return both.withColumn("__end", end).select(
        *kept, F.when(here, F.when(~leaf, F.col("__end.node"))).otherwise(F.col(node)).alias(node),
        F.when(here & leaf, F.expr("__p[__end.at - 1]")).otherwise(F.col(vote)).alias(vote))
