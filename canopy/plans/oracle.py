"""DuckDB SQL for every registered query that has a SQL form.

Written independently of the Spark code: the split scans use a join on
``value <= threshold`` instead of binned running sums, the trees are
CASE expressions generated from the fixed model values, and gradient
descent is a recursive CTE over the moments.  Column names and rounding
match the Spark queries.  Literals are written as DOUBLE (a bare 0.1 is
DECIMAL in DuckDB).
"""

from __future__ import annotations

from math import ceil, isqrt, sqrt

import hashlib
from math import exp, factorial

from canopy.models import iris

KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
BUCKET = ("((('0x' || substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), "
          "CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))), 1, 8))::BIGINT) % 1000)")
FEATS = ["l_quantity", "l_discount", "l_tax"]
FLAG = "(CASE l_returnflag WHEN 'A' THEN 0.0::DOUBLE WHEN 'N' THEN 1.0::DOUBLE WHEN 'R' THEN 2.0::DOUBLE END)"
STATUS = "(CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


def drawn(n: int, trees: int, some: int, seed: int = 0) -> list[list[int]]:
    """Per tree: the ``some`` features with the smallest md5('<seed>|<tree>|<feature>')."""
    return [sorted(range(n), key=lambda f: hashlib.md5(f"{seed}|{t}|{f}".encode()).digest())[:some] for t in range(trees)]


def d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def train_where(cut: int) -> str:
    return f"{BUCKET} < {cut}"


def fname(col: str = "f") -> str:
    return "(CASE " + col + " " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(FEATS)) + " END)"


def xval(col: str = "f") -> str:
    return "(CASE " + col + " " + " ".join(f"WHEN {i} THEN x{i}" for i in range(len(FEATS))) + " END)"


# ----------------------------------------------------------------- scans

def _scan_ctes(prefix: str, long_src: str, thr: str, task: str, classes: int = 2,
               weighted: bool = False, allowed: str = "TRUE") -> str:
    """CTEs ``{prefix}_best`` : best split per (node, f) of ``long_src(node, f, v, label[, w])``.

    Regression labels are summed as whole millionths, so a side's statistics
    (L_, R_, T_: w, wy, wy2) do not depend on the order of the rows.
    ``allowed`` restricts the features that may split a node.
    """
    p = prefix
    one = "w" if weighted else "1.0"
    if task == "classification":
        stats = [f"c{k}" for k in range(classes)]
        agg = ", ".join(f"sum(CASE WHEN label = {d(k)} THEN {one} ELSE 0.0 END)::DOUBLE AS c{k}"
                        for k in range(classes))
        names = stats

        def value(side: str, s: str) -> str:
            return f"(T_{s} - L_{s})" if side == "R" else f"{side}_{s}"

        def imp(vals, n):
            e = "1.0::DOUBLE"
            for v in vals:
                e = f"({e} - ({v} / {n}) * ({v} / {n}))"
            return e

        def weight(vals):
            return "(" + " + ".join(vals) + ")"
    else:
        stats, names = ["w", "s1", "s2"], ["w", "wy", "wy2"]
        q = "CAST(round(label * 1000000.0::DOUBLE) AS HUGEINT)"
        whole = f"CAST({one} AS HUGEINT)"
        agg = (f"sum({one})::DOUBLE AS w, sum(CAST({whole} * {q} AS DECIMAL(38,0))) AS s1, "
               f"sum(CAST({whole} * {q} * {q} AS DECIMAL(38,0))) AS s2")

        def value(side: str, s: str) -> str:
            raw = {"w": "w", "wy": "s1", "wy2": "s2"}[s]
            x = f"(T_{raw} - L_{raw})" if side == "R" else f"{side}_{raw}"
            million = " / 1000000.0::DOUBLE"
            return x if s == "w" else f"(CAST({x} AS DOUBLE){million * (1 if s == 'wy' else 2)})"

        def imp(vals, n):
            return f"(({vals[2]} - ({vals[1]} * {vals[1]}) / {n}) / {n})"

        def weight(vals):
            return vals[0]
    L, T, R = ([f"{side}_{s}" for s in names] for side in "LTR")
    derived = ", ".join(f"{value(side, s)} AS {side}_{s}" for side in "LTR" for s in names
                        if side == "R" or s not in stats)
    total = ", ".join(f"{value('T', s)} AS T_{s}" for s in names if s not in stats)
    nL, nT = weight(L), weight(T)
    nR = f"({nT} - {nL})"
    gain = (f"({imp(T, nT)} - ({nL} / {nT}) * {imp(L, weight(L))} - ({nR} / {nT}) * {imp(R, weight(R))})")
    sums = ", ".join(f"sum({s}) AS T_{s}" for s in stats)
    return f"""
{p}_cnt AS (SELECT node, f, v, {agg}, count(*) AS n_raw FROM {long_src} GROUP BY node, f, v),
{p}_tot AS (SELECT *{', ' + total if total else ''} FROM
            (SELECT node, f, {sums}, sum(n_raw) AS T_raw FROM {p}_cnt GROUP BY node, f)),
{p}_cand AS (SELECT c.node, c.f, h.t, {", ".join(f"sum(c.{s}) AS L_{s}" for s in stats)}, sum(c.n_raw) AS L_raw
             FROM {p}_cnt c JOIN {thr} h ON c.f = h.f AND c.v <= h.t GROUP BY c.node, c.f, h.t),
{p}_side AS (SELECT a.*, b.* EXCLUDE (node, f{', ' + ', '.join(f'T_{s}' for s in names if s not in stats) if total else ''})
             FROM {p}_cand a JOIN {p}_tot b ON a.node = b.node AND a.f = b.f),
{p}_each AS (SELECT *, {derived} FROM {p}_side),
{p}_g AS (SELECT *, {nL} AS n_left, {nR} AS n_right FROM {p}_each WHERE {nL} > 0 AND {nR} > 0),
{p}_valid AS (SELECT *, {gain} AS gain FROM {p}_g),
{p}_best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node, f ORDER BY gain DESC, t ASC) AS rk
                            FROM {p}_valid) WHERE rk = 1),
{p}_top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f ASC, t ASC) AS rk2
                           FROM {p}_best WHERE {allowed}) WHERE rk2 = 1)"""


def _thr_ctes(src: str) -> str:
    """Candidate thresholds: midpoints of consecutive distinct values per feature."""
    return f"""
vals AS (SELECT DISTINCT f, v FROM {src} WHERE v IS NOT NULL AND NOT isnan(v)),
thr AS (SELECT f, t FROM (SELECT f, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2.0::DOUBLE AS t FROM vals)
        WHERE t IS NOT NULL)"""


def _train_input(label_sql: str, cut: int, test: bool = False) -> str:
    cond = f"NOT ({train_where(cut)})" if test else train_where(cut)
    return (f"SELECT {KEYS}, {label_sql} AS label, l_quantity AS x0, l_discount AS x1, l_tax AS x2 "
            f"FROM lineitem WHERE {cond}")


LONG = "SELECT node, label, unnest([0, 1, 2]) AS f, unnest([x0, x1, x2]) AS v FROM {src}"


def split_scan_sql(task: str) -> str:
    label = STATUS if task == "classification" else "l_extendedprice"
    digits = 12 if task == "classification" else 4
    return f"""
WITH inp AS (SELECT 1 AS node, * FROM ({_train_input(label, 600)})),
lg AS ({LONG.format(src="inp")}),
{_thr_ctes("lg")},
{_scan_ctes("s", "lg", "thr", task)}
SELECT CAST(f AS INTEGER) AS feature, {fname()} AS feature_name, t AS threshold, round(gain, {digits}) AS gain,
       CAST(n_left AS BIGINT) AS n_left, CAST(n_right AS BIGINT) AS n_right
FROM s_best"""


def _argmax2(a: str, b: str) -> str:
    return f"(CASE WHEN {b} > {a} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


STUMP_ERROR = f"""
WITH inp AS (SELECT 1 AS node, * FROM ({_train_input(STATUS, 600)})),
lg AS ({LONG.format(src="inp")}),
{_thr_ctes("lg")},
{_scan_ctes("s", "lg", "thr", "classification")},
m AS (SELECT f, t, {_argmax2("L_c0", "L_c1")} AS pl, {_argmax2("(T_c0 - L_c0)", "(T_c1 - L_c1)")} AS pr FROM s_top),
te AS ({_train_input(STATUS, 600, test=True)}),
p AS (SELECT te.label, CASE WHEN {xval("m.f")} IS NULL THEN NULL WHEN {xval("m.f")} <= m.t THEN m.pl ELSE m.pr END
             AS prediction FROM te, m)
SELECT count(*) AS n_test,
       CAST(sum(CASE WHEN prediction IS NOT DISTINCT FROM label THEN 0 ELSE 1 END) AS BIGINT) AS n_wrong,
       round(avg(CASE WHEN prediction IS NOT DISTINCT FROM label THEN 0.0 ELSE 1.0 END), 12) AS error_rate
FROM p"""


def _metrics(src: str) -> str:
    return f"""
SELECT count(*) AS n, round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse,
       round(avg(abs(prediction - label)), 6) AS mae,
       round(CASE WHEN min(label) = max(label) THEN NULL ELSE regr_r2(label, prediction) END, 9) AS r2_pearson,
       round(1.0 - sum((prediction - label) * (prediction - label)) / NULLIF(var_pop(label) * count(*), 0), 9)
           AS r2_sse
FROM {src}"""


STUMP_RMSE = f"""
WITH inp AS (SELECT 1 AS node, * FROM ({_train_input("l_extendedprice", 600)})),
lg AS ({LONG.format(src="inp")}),
{_thr_ctes("lg")},
{_scan_ctes("s", "lg", "thr", "regression")},
m AS (SELECT f, t, L_wy / L_w AS pl, R_wy / R_w AS pr FROM s_top),
te AS ({_train_input("l_extendedprice", 600, test=True)}),
p AS (SELECT te.label, CASE WHEN {xval("m.f")} <= m.t THEN m.pl ELSE m.pr END AS prediction FROM te, m)
{_metrics("p")}"""


def _tree_levels_body() -> str:
    pred = lambda a, b: _argmax2(a, b)
    return f"""
WITH inp AS (SELECT 1 AS node, * FROM ({_train_input(STATUS, 600)})),
lg AS ({LONG.format(src="inp")}),
{_thr_ctes("lg")},
{_scan_ctes("a", "lg", "thr", "classification")},
root AS (SELECT * FROM a_top WHERE gain > 0),
inp1 AS (SELECT CASE WHEN {xval("r.f")} <= r.t THEN 2 ELSE 3 END AS node, i.label, i.x0, i.x1, i.x2
         FROM inp i, root r),
lg1 AS ({LONG.format(src="inp1")}),
{_scan_ctes("b", "lg1", "thr", "classification")},
lvl1 AS (SELECT * FROM b_top WHERE gain > 0),
n0 AS (SELECT 1::BIGINT AS node_id, 0 AS depth, {fname("f")} AS feature_name, t AS threshold,
              {pred("T_c0", "T_c1")} AS prediction, CAST(T_raw AS BIGINT) AS row_count, gain FROM root),
n1 AS (SELECT s.node_id, 1 AS depth, {fname("l.f")} AS feature_name, l.t AS threshold,
              {pred("s.c0", "s.c1")} AS prediction, s.row_count, l.gain
       FROM (SELECT 2::BIGINT AS node_id, L_c0 AS c0, L_c1 AS c1, CAST(L_raw AS BIGINT) AS row_count FROM root
             UNION ALL
             SELECT 3::BIGINT, T_c0 - L_c0, T_c1 - L_c1, CAST(T_raw - L_raw AS BIGINT) FROM root) s
       LEFT JOIN lvl1 l ON l.node = s.node_id),
n2 AS (SELECT 2 * node::BIGINT AS node_id, 2 AS depth, NULL AS feature_name, NULL::DOUBLE AS threshold,
              {pred("L_c0", "L_c1")} AS prediction, CAST(L_raw AS BIGINT) AS row_count, NULL::DOUBLE AS gain
       FROM lvl1
       UNION ALL
       SELECT 2 * node::BIGINT + 1, 2, NULL, NULL::DOUBLE, {pred("(T_c0 - L_c0)", "(T_c1 - L_c1)")},
              CAST(T_raw - L_raw AS BIGINT), NULL::DOUBLE
       FROM lvl1),
nodes AS (SELECT * FROM n0 UNION ALL SELECT * FROM n1 UNION ALL SELECT * FROM n2)"""


TREE_LEVELS = _tree_levels_body() + """
SELECT 0 AS tree_id, node_id, depth, feature_name, threshold, prediction, row_count, round(gain, 12) AS gain
FROM nodes"""

DESCRIBE_TREE = _tree_levels_body() + """,
kids AS (SELECT DISTINCT node_id // 2 AS pid FROM nodes WHERE node_id > 1),
lines AS (
  SELECT bin(node_id) AS k,
         repeat(' ', depth + 1) || CASE WHEN node_id IN (SELECT pid FROM kids)
              THEN 'If (' || feature_name || ' <= ' || CAST(threshold AS VARCHAR) || ')'
              ELSE 'Predict: ' || CAST(prediction AS VARCHAR) END AS line
  FROM nodes
  UNION ALL
  SELECT bin(node_id) || '0~', repeat(' ', depth + 1) || 'Else (' || feature_name || ' > '
         || CAST(threshold AS VARCHAR) || ')'
  FROM nodes WHERE node_id IN (SELECT pid FROM kids))
SELECT 0 AS tree_id, CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS line_no, line FROM lines"""

PMML_NODES = _tree_levels_body() + """
SELECT 0 AS tree_id, node_id, depth, feature_name, threshold, prediction, row_count FROM nodes"""


def grown_tree_sql(depth: int) -> str:
    """Level-wise gini tree of the given depth on the status label (no pruning):
    each level scans every open node, splits the nodes with positive gain
    and routes their rows to 2i / 2i+1; rows of nodes that stop drop out."""
    pred = _argmax2
    ctes = [f"in0 AS (SELECT 1::BIGINT AS node, * FROM ({_train_input(STATUS, 600)}))",
            f"lg0 AS ({LONG.format(src='in0')})",
            _thr_ctes("lg0").strip()]
    node_rows = []
    for k in range(depth):
        ctes.append(_scan_ctes(f"s{k}", f"lg{k}", "thr", "classification").strip())
        ctes.append(f"sp{k} AS (SELECT * FROM s{k}_top WHERE gain > 0)")
        ctes.append(f"st{k} AS (SELECT node, T_c0, T_c1, T_raw FROM s{k}_tot WHERE f = 0)")
        node_rows.append(
            f"SELECT st.node AS node_id, {k} AS depth, {fname('sp.f')} AS feature_name, sp.t AS threshold, "
            f"{pred('st.T_c0', 'st.T_c1')} AS prediction, CAST(st.T_raw AS BIGINT) AS row_count, sp.gain AS gain "
            f"FROM st{k} st LEFT JOIN sp{k} sp ON sp.node = st.node")
        if k + 1 < depth:
            ctes.append(
                f"in{k + 1} AS (SELECT CASE WHEN {xval('sp.f')} <= sp.t THEN 2 * i.node ELSE 2 * i.node + 1 END "
                f"AS node, i.label, i.x0, i.x1, i.x2 FROM in{k} i JOIN sp{k} sp ON sp.node = i.node)")
            ctes.append(f"lg{k + 1} AS ({LONG.format(src=f'in{k + 1}')})")
    last = depth - 1
    node_rows.append(
        f"SELECT 2 * node AS node_id, {depth} AS depth, NULL AS feature_name, NULL::DOUBLE AS threshold, "
        f"{pred('L_c0', 'L_c1')} AS prediction, CAST(L_raw AS BIGINT) AS row_count, NULL::DOUBLE AS gain "
        f"FROM sp{last} UNION ALL "
        f"SELECT 2 * node + 1, {depth}, NULL, NULL::DOUBLE, {pred('(T_c0 - L_c0)', '(T_c1 - L_c1)')}, "
        f"CAST(T_raw - L_raw AS BIGINT), NULL::DOUBLE FROM sp{last}")
    return ("WITH " + ",\n".join(ctes) + ",\nnodes AS (" + "\nUNION ALL\n".join(node_rows) + ")\n"
            "SELECT 0 AS tree_id, node_id, depth, feature_name, threshold, prediction, row_count, "
            "round(gain, 12) AS gain FROM nodes")


def _argmax(cs: list[str]) -> str:
    """First index of the largest value (ties -> lowest class)."""
    parts = []
    for k in range(len(cs) - 1):
        cond = " AND ".join(f"{cs[k]} >= {cs[j]}" for j in range(k + 1, len(cs)))
        parts.append(f"WHEN {cond} THEN {float(k)!r}::DOUBLE")
    return f"(CASE {' '.join(parts)} ELSE {float(len(cs) - 1)!r}::DOUBLE END)"


def _argmax3(c0: str, c1: str, c2: str) -> str:
    return _argmax([c0, c1, c2])


def _poisson_sql(u: str) -> str:
    """Inverse of the Poisson(1) distribution, counts 0 to 13."""
    below, parts = 0.0, []
    for k in range(13):
        below = exp(-1.0) * sum(1.0 / factorial(i) for i in range(k + 1))
        parts.append(f"WHEN {u} < {below!r} THEN {float(k)!r}")
    return "CASE " + " ".join(parts) + " ELSE 13.0 END"


def _bootstrap_sql(seed: int, tree: int, key_cols: list[str] | None = None) -> str:
    """Poisson(1) count from 32 bits (slot tree % 4) of md5('<seed>|<tree // 4>|<keys>')."""
    names = key_cols or [k.strip() for k in KEYS.split(",")]
    key = f"concat_ws('|', '{seed}|{tree // 4}', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in names) + ")"
    u = f"(CAST(('0x' || substr(md5({key}), {8 * (tree % 4) + 1}, 8)) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE)"
    return _poisson_sql(u)


def _thr_rule_ctes(src: str, max_bins: int = 100) -> str:
    """Candidate thresholds by the full rule: midpoints when a feature has at
    most ``max_bins`` distinct values, else the distinct values at 1-based
    rank ceil(i * n / max_bins), i = 1 .. max_bins - 1."""
    qs = "[" + ", ".join(str(i) for i in range(1, max_bins)) + "]"
    return f"""
vals AS (SELECT DISTINCT f, v FROM {src} WHERE v IS NOT NULL AND NOT isnan(v)),
nd AS (SELECT f, count(*) AS n FROM vals GROUP BY f),
mids AS (SELECT f, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2.0::DOUBLE AS t FROM vals
         WHERE f IN (SELECT f FROM nd WHERE n <= {max_bins})),
ranked AS (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS rn,
                  count(*) OVER (PARTITION BY f) AS n FROM {src}
           WHERE v IS NOT NULL AND NOT isnan(v) AND f IN (SELECT f FROM nd WHERE n > {max_bins})),
cuts AS (SELECT r.f, r.v AS t FROM ranked r JOIN (SELECT unnest({qs}) AS q) qq
         ON r.rn = (qq.q * r.n + {max_bins} - 1) // {max_bins}),
thr AS (SELECT f, t FROM mids WHERE t IS NOT NULL UNION SELECT DISTINCT f, t FROM cuts)"""


def ensemble_sql(depth: int, subsets: list[list[int]], train_sql: str, test_sql: str, keys: list[str],
                 n_feat: int, classes: int = 3, task: str = "classification",
                 seed: int | None = None, full_rule: bool = False, per_node: int | None = None,
                 row_keys: list[str] | None = None) -> str:
    """Trees on feature subsets, grown level-wise with a (tree, node) key =
    tree * 1e6 + node; hold-out rows walk the same splits level by level;
    hard vote (ties -> lowest class) or mean over the trees.  With ``seed``
    every (row, tree) carries its md5 bootstrap weight (bagging) from ``keys``
    or ``row_keys``; with ``per_node`` only so many features, ranked by md5 of
    seed, tree, node and feature, may split a node.  Ends with a ``pred`` CTE
    (keys, label, prediction)."""
    n_t = len(subsets)
    weighted = seed is not None
    xs = [f"x{i}" for i in range(n_feat)]

    def xv(col: str, prefix: str = "") -> str:
        return "(CASE " + col + " " + " ".join(f"WHEN {i} THEN {prefix}x{i}" for i in range(n_feat)) + " END)"

    trees = ", ".join(f"({t})" for t in range(n_t))
    feats = "CASE tree " + " ".join(f"WHEN {t} THEN {list(sub)}" for t, sub in enumerate(subsets)) + " END"
    vals = "CASE tree " + " ".join(f"WHEN {t} THEN [{', '.join(f'x{f}' for f in sub)}]"
                                   for t, sub in enumerate(subsets)) + " END"
    wsel = ", w" if weighted else ""
    keyed = ("SELECT key, label" + wsel + ", unnest({feats}) AS f, unnest({vals}) AS v FROM "
             "(SELECT key, key // 1000000 AS tree, label" + wsel + ", " + ", ".join(xs) + " FROM {src})")
    allowed = "TRUE"
    if per_node is not None:
        def rank(f: str) -> str:
            return (f"md5(concat_ws('|', '{seed}', CAST(node // 1000000 AS VARCHAR), CAST(node % 1000000 AS VARCHAR), CAST({f} AS VARCHAR)))")
        allowed = f"list_contains(list_slice(list_sort(list_transform({list(range(n_feat))}, lambda x: {rank('x')})), 1, {per_node}), {rank('f')})"
    wcol = (", CASE t.tree " + " ".join(f"WHEN {t} THEN {_bootstrap_sql(seed, t, row_keys)}" for t in range(n_t))
            + " END AS w") if weighted else ""
    cls = list(range(classes))
    reg = task == "regression"
    ctes = [f"tr AS ({train_sql})",
            f"allv AS (SELECT 1 AS node, label, unnest({list(range(n_feat))}) AS f, "
            f"unnest([{', '.join(xs)}]) AS v FROM tr)",
            (_thr_rule_ctes("allv") if full_rule else _thr_ctes("allv")).strip(),
            f"in0 AS (SELECT * FROM (SELECT t.tree * 1000000 + 1 AS key, r.label, "
            f"{', '.join('r.' + x for x in xs)}{wcol} "
            f"FROM tr r, (VALUES {trees}) t(tree)){' WHERE w > 0' if weighted else ''})",
            f"lg0 AS (SELECT key AS node, label{wsel}, f, v FROM ({keyed.format(feats=feats, vals=vals, src='in0')}))"]
    stats = []
    for k in range(depth):
        ctes.append(_scan_ctes(f"s{k}", f"lg{k}", "thr", task, classes, weighted, allowed).strip())
        ctes.append(f"sp{k} AS (SELECT * FROM s{k}_top WHERE gain > 0)")
        tcols = "T_w, T_wy" if reg else ", ".join(f"T_c{c}" for c in cls)
        ctes.append(f"st{k} AS (SELECT node AS key, {tcols} FROM s{k}_tot "
                    f"QUALIFY row_number() OVER (PARTITION BY node ORDER BY f) = 1)")
        tp = "T_wy / T_w" if reg else _argmax([f"T_c{c}" for c in cls])
        stats.append(f"SELECT key, {tp} AS p FROM st{k}")
        if k + 1 < depth:
            ctes.append(f"in{k + 1} AS (SELECT CASE WHEN {xv('sp.f', 'i.')} <= sp.t "
                        f"THEN (i.key // 1000000) * 1000000 + 2 * (i.key % 1000000) "
                        f"ELSE (i.key // 1000000) * 1000000 + 2 * (i.key % 1000000) + 1 END AS key, "
                        f"i.label, {', '.join('i.' + x for x in xs)}{', i.w' if weighted else ''} "
                        f"FROM in{k} i JOIN sp{k} sp ON sp.node = i.key)")
            ctes.append(f"lg{k + 1} AS (SELECT key AS node, label{wsel}, f, v FROM "
                        f"({keyed.format(feats=feats, vals=vals, src=f'in{k + 1}')}))")
    last = depth - 1
    lp = "L_wy / L_w" if reg else _argmax([f"L_c{c}" for c in cls])
    rp = "R_wy / R_w" if reg else _argmax([f"(T_c{c} - L_c{c})" for c in cls])
    stats.append(f"SELECT (node // 1000000) * 1000000 + 2 * (node % 1000000), {lp} FROM sp{last}")
    stats.append(f"SELECT (node // 1000000) * 1000000 + 2 * (node % 1000000) + 1, {rp} FROM sp{last}")
    ctes.append("leafp AS (" + " UNION ALL ".join(stats) + ")")
    # hold-out rows walk the splits
    ctes.append(f"te AS (SELECT row_number() OVER () AS rid, * FROM ({test_sql}))")
    ctes.append(f"w0 AS (SELECT te.rid, t.tree * 1000000 + 1 AS key, {', '.join('te.' + x for x in xs)} "
                f"FROM te, (VALUES {trees}) t(tree))")
    ends = []
    for k in range(depth):
        ends.append(f"SELECT w.rid, w.key FROM w{k} w ANTI JOIN sp{k} sp ON sp.node = w.key")
        nxt = (f"SELECT w.rid, CASE WHEN {xv('sp.f', 'w.')} <= sp.t "
               f"THEN (w.key // 1000000) * 1000000 + 2 * (w.key % 1000000) "
               f"ELSE (w.key // 1000000) * 1000000 + 2 * (w.key % 1000000) + 1 END AS key, "
               f"{', '.join('w.' + x for x in xs)} FROM w{k} w JOIN sp{k} sp ON sp.node = w.key")
        ctes.append(f"w{k + 1} AS ({nxt})")
    ends.append(f"SELECT rid, key FROM w{depth}")
    ctes.append("leaf AS (" + " UNION ALL ".join(ends) + ")")
    if reg:
        ctes.append("votes AS (SELECT l.rid, avg(p.p) AS m FROM leaf l JOIN leafp p ON p.key = l.key GROUP BY l.rid)")
        vote = "v.m"
    else:
        ctes.append("votes AS (SELECT l.rid, " + ", ".join(
            f"sum(CASE WHEN p.p = {float(c)!r} THEN 1 ELSE 0 END) AS c{c}" for c in cls)
            + " FROM leaf l JOIN leafp p ON p.key = l.key GROUP BY l.rid)")
        vote = _argmax([f"v.c{c}" for c in cls])
    ctes.append(f"pred AS (SELECT {', '.join('te.' + k for k in keys)}, te.label, "
                f"{vote} AS prediction FROM te JOIN votes v ON v.rid = te.rid)")
    return "WITH " + ",\n".join(ctes)


def subspace_vote_sql(depth: int, subsets: list[list[int]], seed: int | None = None,
                      label_sql: str = FLAG, classes: int = 3, final: bool = True,
                      task: str = "classification") -> str:
    """The lineitem ensembles (keys, three features, 60 % md5 train part)."""
    body = ensemble_sql(depth, subsets, _train_input(label_sql, 600), _train_input(label_sql, 600, test=True),
                        [k.strip() for k in KEYS.split(",")], 3, classes, task, seed)
    return body + f"\nSELECT {KEYS}, label, prediction FROM pred" if final else body


def _embedding_input(test: bool, target_slot: int | None, width: int = 64) -> str:
    bucket = ("((('0x' || substr(md5(concat_ws('|', CAST(vec_id AS VARCHAR))), 1, 8))::BIGINT) % 1000)")
    cond = f"NOT ({bucket} < 600)" if test else f"{bucket} < 600"
    slots = [i for i in range(width) if i != target_slot]
    label = "CAST(label AS DOUBLE)" if target_slot is None else f"CAST(embedding[{target_slot + 1}] AS DOUBLE)"
    xs = ", ".join(f"CAST(embedding[{s + 1}] AS DOUBLE) AS x{j}" for j, s in enumerate(slots))
    return f"SELECT vec_id, {label} AS label, {xs} FROM embeddings WHERE {cond}"


def embedding_ensemble_sql(task: str) -> str:
    """M5 / M6 over the 64-wide embeddings: classes = the 10 labels, or the
    first slot as regression target over the other 63."""
    reg = task == "regression"
    n = 63 if reg else 64
    subsets = drawn(n, 3, isqrt(n), 0)
    body = ensemble_sql(5, subsets, _embedding_input(False, 0 if reg else None),
                        _embedding_input(True, 0 if reg else None), ["vec_id"], n,
                        0 if reg else 10, task, None, full_rule=True)
    pred = "round(prediction, 4)" if reg else "prediction"
    return body + f"\nSELECT vec_id, label, {pred} AS prediction FROM pred"


# ----------------------------------------------------------------- document forests

IRIS_COLS = {
    iris.SL: f"({d(4.3)} + (l_quantity - {d(1.0)}) / {d(49.0)} * {d(3.6)})",
    iris.SW: f"({d(2.0)} + l_discount * {d(24.0)})",
    iris.PL: f"({d(1.0)} + l_tax / {d(0.08)} * {d(5.9)})",
    iris.PW: f"({d(0.1)} + l_extendedprice / {d(105000.0)} * {d(2.4)})",
}
IRIS_ALIAS = {iris.SL: "sl", iris.SW: "sw", iris.PL: "pl", iris.PW: "pw"}


def tree_case(node) -> str:
    if isinstance(node, str):
        return d(iris.CLASSES.index(node))
    feat, thr, left, right = node
    x = IRIS_ALIAS[feat]
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= {d(thr)} THEN {tree_case(left)} ELSE {tree_case(right)} END)"


def _votes(forest) -> str:
    cols = ", ".join(f"{v} AS {IRIS_ALIAS[k]}" for k, v in IRIS_COLS.items())
    trees = ", ".join(f"{tree_case(t)} AS v{i}" for i, t in enumerate(forest))
    return f"""
WITH base AS (SELECT {KEYS}, {FLAG} AS label, {cols} FROM lineitem),
vt AS (SELECT {KEYS}, label, {trees} FROM base),
cnt AS (SELECT *, {", ".join(
        "(" + " + ".join(f"COALESCE(CAST(v{i} = {d(k)} AS INTEGER), 0)" for i in range(len(forest))) + f") AS c{k}"
        for k in range(3))},
        ({" + ".join(f"CAST(v{i} IS NOT NULL AS INTEGER)" for i in range(len(forest)))}) AS nv FROM vt),
voted AS (SELECT *, CASE WHEN nv = 0 THEN NULL WHEN c0 >= c1 AND c0 >= c2 THEN 0.0::DOUBLE
                         WHEN c1 >= c2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS prediction FROM cnt)"""


SCORE_R = _votes(iris.R_FOREST) + f"\nSELECT {KEYS}, prediction FROM voted"
SCORE_SPARK = _votes(iris.SPARK_FOREST) + f"\nSELECT {KEYS}, prediction FROM voted"
VOTE_SHARES = _votes(iris.R_FOREST) + f"""
SELECT {KEYS}, {", ".join(f"round(CASE WHEN nv > 0 THEN c{k}::DOUBLE / nv END, 12) AS p_{c}"
                          for k, c in enumerate(iris.CLASSES))} FROM voted"""
MISPREDICTED = _votes(iris.R_FOREST) + f"""
SELECT {KEYS}, label, prediction FROM voted WHERE NOT (prediction IS NOT DISTINCT FROM label)"""
ERROR_RATE = _votes(iris.R_FOREST) + """
SELECT count(*) AS n_test,
       CAST(sum(CASE WHEN prediction IS NOT DISTINCT FROM label THEN 0 ELSE 1 END) AS BIGINT) AS n_wrong,
       round(avg(CASE WHEN prediction IS NOT DISTINCT FROM label THEN 0.0 ELSE 1.0 END), 12) AS error_rate
FROM voted"""
POOLED = _votes(iris.R_FOREST) + """,
pairs AS (SELECT 0 AS tree_id, label, v0 AS prediction FROM voted UNION ALL
          SELECT 1, label, v1 FROM voted UNION ALL SELECT 2, label, v2 FROM voted)
SELECT tree_id, count(*) AS n_pairs,
       CAST(sum(CASE WHEN prediction IS NOT DISTINCT FROM label THEN 0 ELSE 1 END) AS BIGINT) AS n_wrong,
       round(avg(CASE WHEN prediction IS NOT DISTINCT FROM label THEN 0.0 ELSE 1.0 END), 12) AS error_rate
FROM pairs GROUP BY ROLLUP (tree_id)"""


# ----------------------------------------------------------------- regression ensemble of stumps

STUMP_ENSEMBLE = f"""
WITH inp AS (SELECT 1 AS node, * FROM ({_train_input("l_extendedprice", 600)})),
lg AS ({LONG.format(src="inp")}),
{_thr_ctes("lg")},
{_scan_ctes("s", "lg", "thr", "regression")},
m AS (SELECT f, t, L_wy / L_w AS pl, R_wy / R_w AS pr FROM s_best),
m0 AS (SELECT * FROM m WHERE f = 0), m1 AS (SELECT * FROM m WHERE f = 1), m2 AS (SELECT * FROM m WHERE f = 2),
te AS ({_train_input("l_extendedprice", 600, test=True)}),
p AS (SELECT te.*, (CASE WHEN x0 <= m0.t THEN m0.pl ELSE m0.pr END
                    + CASE WHEN x1 <= m1.t THEN m1.pl ELSE m1.pr END
                    + CASE WHEN x2 <= m2.t THEN m2.pl ELSE m2.pr END) / 3.0::DOUBLE AS prediction
      FROM te, m0, m1, m2)"""

MEAN_PREDICTION = STUMP_ENSEMBLE + f"\nSELECT {KEYS}, label, round(prediction, 4) AS prediction FROM p"
REGRESSION_METRICS = STUMP_ENSEMBLE + _metrics("p")


# ----------------------------------------------------------------- linear model

def _linear_body(train: str = _train_input("l_extendedprice", 900), whole: str = "TRUE") -> str:
    k = len(FEATS)
    q = {}
    for i in range(k):
        for j in range(i, k):
            q[(i, j)] = q[(j, i)] = f"q{i}{j}"
    grads = []
    for j in range(k):
        acc = "0.0::DOUBLE" + "".join(f" + w{l} * m.{q[(l, j)]}" for l in range(k))
        grads.append(f"(({acc} + b * m.s{j} - m.y{j}) / m.n)")
    accb = "0.0::DOUBLE" + "".join(f" + w{l} * m.s{l}" for l in range(k))
    gb = f"(({accb} + b * m.n - m.sy) / m.n)"
    eta = "(0.1::DOUBLE / sqrt(CAST(t + 1 AS DOUBLE)))"
    moments = ", ".join([f"sum(z{i}) AS s{i}" for i in range(k)] + [f"sum(z{i} * y) AS y{i}" for i in range(k)]
                        + [f"sum(z{i} * z{j}) AS q{i}{j}" for i in range(k) for j in range(i, k)])
    zs = ", ".join(f"(x{i} - st.m{i}) / st.s{i} AS z{i}" for i in range(k))
    stats = ", ".join(f"avg(x{i}) AS m{i}, stddev_samp(x{i}) AS s{i}" for i in range(k))
    return f"""
WITH RECURSIVE tr AS ({train}),
te AS ({_train_input("l_extendedprice", 900, test=True)}),
st AS (SELECT {stats} FROM tr),
z AS (SELECT label AS y, {zs} FROM tr, st WHERE {whole}),
m AS (SELECT count(*)::DOUBLE AS n, sum(y) AS sy, {moments} FROM z),
it(t, {", ".join(f"w{i}" for i in range(k))}, b) AS (
  SELECT 0, {", ".join("0.0::DOUBLE" for _ in range(k))}, 1.0::DOUBLE
  UNION ALL
  SELECT t + 1, {", ".join(f"w{j} - {eta} * {grads[j]}" for j in range(k))}, b - {eta} * {gb}
  FROM it, m WHERE t < 100),
fin AS (SELECT * FROM it WHERE t = 100)"""


LINEAR_SGD = _linear_body() + "\n" + "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS term, round(w{i}, 4) AS weight FROM fin" for i, c in enumerate(FEATS)]
    + ["SELECT 'intercept' AS term, round(b, 4) AS weight FROM fin"])

PREDICT_LINEAR = _linear_body() + f"""
SELECT {", ".join("te." + k.strip() for k in KEYS.split(","))}, te.label,
       round(0.0::DOUBLE {"".join(f" + ((te.x{i} - st.m{i}) / st.s{i}) * fin.w{i}" for i in range(len(FEATS)))} + fin.b, 2)
           AS prediction
FROM te, st, fin"""


# ----------------------------------------------------------------- points, splits, scaling

PARSE_POINTS = """
WITH l AS (SELECT concat_ws(',', CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR), CAST(p_retailprice AS VARCHAR))
                  || CASE WHEN p_size > 45 THEN ',' ELSE '' END AS value FROM part),
s AS (SELECT value, string_split(value, ',') AS fs FROM l),
p AS (SELECT value, len(fs) AS n, TRY_CAST(trim(fs[1]) AS DOUBLE) AS a, TRY_CAST(trim(fs[2]) AS DOUBLE) AS b,
             TRY_CAST(trim(fs[3]) AS DOUBLE) AS c FROM s),
o AS (SELECT *, (n = 3 AND a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL) AS ok FROM p)
SELECT CASE WHEN ok THEN c END AS label, CASE WHEN ok THEN a END AS p_partkey, CASE WHEN ok THEN b END AS p_size,
       CASE WHEN NOT ok THEN value END AS _corrupt_record FROM o"""

LABEL_AT_INDEX = "SELECT l_discount AS label, l_quantity, l_tax, l_extendedprice FROM lineitem"

HASH_SPLIT_COUNTS = f"""
SELECT CASE WHEN {train_where(600)} THEN 'train' ELSE 'test' END AS side, count(*) AS n_rows
FROM lineitem GROUP BY 1"""

_VALS = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
HOLDOUT_COMPLEMENT = f"""
WITH b AS (SELECT {", ".join(_VALS)} FROM lineitem),
t AS (SELECT DISTINCT {", ".join(_VALS)} FROM lineitem WHERE {train_where(100)})
SELECT * FROM b WHERE NOT EXISTS (
  SELECT 1 FROM t WHERE {" AND ".join(f"t.{c} IS NOT DISTINCT FROM b.{c}" for c in _VALS)})"""

STANDARDIZE_STATS = f"""
WITH tr AS (SELECT * FROM lineitem WHERE {train_where(600)})
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 9) AS mean, round(stddev_samp({c}), 9) AS std, count({c}) AS n FROM tr"
    for c in FEATS)

STANDARDIZE_ROWS = f"""
WITH tr AS (SELECT * FROM lineitem WHERE {train_where(600)}),
st AS (SELECT {", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(FEATS))} FROM tr)
SELECT {KEYS}, l_extendedprice AS label,
       {", ".join(f"round(CASE WHEN st.s{i} IS NULL OR st.s{i} = 0 THEN 0.0 ELSE ({c} - st.m{i}) / st.s{i} END, 8) AS {c}"
                  for i, c in enumerate(FEATS))}
FROM lineitem, st WHERE NOT ({train_where(600)})"""

FEATURE_SUBSET = """
WITH r AS (
  SELECT CAST(t AS INTEGER) AS tree_id, CAST(f AS INTEGER) AS feature,
         CAST(row_number() OVER (PARTITION BY t ORDER BY md5(concat_ws('|', '0', CAST(t AS VARCHAR),
                                                                       CAST(f AS VARCHAR)))) - 1 AS INTEGER) AS slot
  FROM range(3) a(t), range(64) b(f))
SELECT e.vec_id, r.tree_id, r.slot, r.feature, CAST(e.embedding[r.feature + 1] AS DOUBLE) AS value
FROM embeddings e, r WHERE r.slot < 8"""


# ----------------------------------------------------------------- wide features, missing values, drawn features

WIDE = [*FEATS, "l_extendedprice"]


def _wide_input(label: str, test: bool = False) -> str:
    cond = f"NOT ({train_where(600)})" if test else train_where(600)
    return f"SELECT {KEYS}, {label} AS label, " + ", ".join(f"{c} AS x{i}" for i, c in enumerate(WIDE)) + f" FROM lineitem WHERE {cond}"


GINI_WIDE = f"""
WITH lg AS (SELECT 1 AS node, label, unnest([0, 1, 2, 3]) AS f, unnest([x0, x1, x2, x3]) AS v FROM ({_wide_input(STATUS)})),
{_thr_rule_ctes("lg")},
{_scan_ctes("s", "lg", "thr", "classification")}
SELECT CAST(f AS INTEGER) AS feature, CASE f {" ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(WIDE))} END AS feature_name,
       t AS threshold, round(gain, 12) AS gain, CAST(n_left AS BIGINT) AS n_left, CAST(n_right AS BIGINT) AS n_right
FROM s_best"""

_KEY_LIST = [k.strip() for k in KEYS.split(",")]
BAGGED_WIDE = ensemble_sql(5, drawn(4, 3, 2), _wide_input(FLAG), _wide_input(FLAG, True), _KEY_LIST, 4, 3, "classification", 0, True) + f"""
SELECT {KEYS}, label, prediction FROM pred"""

_ALL_ROWS = f"SELECT {KEYS}, {FLAG} AS label, l_quantity AS x0, l_discount AS x1, l_tax AS x2 FROM lineitem"
BAGGED_ROWS = ensemble_sql(
    5, drawn(3, 3, 2), f"SELECT *, row_number() OVER (PARTITION BY x0, x1, x2, label) AS occurrence FROM ({_ALL_ROWS})", _ALL_ROWS, _KEY_LIST, 3, 3,
    "classification", 0, row_keys=["x0", "x1", "x2", "label", "occurrence"]) + f"""
SELECT {KEYS}, label, prediction FROM pred"""


def forest_sql(label: str, task: str) -> str:
    """Bootstrap by row key, ceil(sqrt(3)) features drawn per node, seed 12345."""
    body = ensemble_sql(5, [[0, 1, 2]] * 3, _train_input(label, 600), _train_input(label, 600, test=True), _KEY_LIST, 3,
                        3 if task == "classification" else 0, task, 12345, per_node=ceil(sqrt(3)))
    return body + f"\nSELECT {KEYS}, label, {'prediction' if task == 'classification' else 'round(prediction, 4) AS prediction'} FROM pred"


LINEAR_NULLS = _linear_body(
    f"SELECT CASE WHEN l_linenumber <> 5 THEN l_extendedprice END AS label, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS x0, "
    f"l_discount AS x1, l_tax AS x2 FROM lineitem WHERE {train_where(900)}", "label IS NOT NULL AND x0 IS NOT NULL") + "\n" + "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS term, round(w{i}, 4) AS weight FROM fin" for i, c in enumerate(FEATS)]
    + ["SELECT 'intercept', round(b, 4) FROM fin", "SELECT 'dropped', count_if(label IS NULL OR x0 IS NULL)::DOUBLE FROM tr"])

METRICS_NULLS = """
WITH r AS (SELECT CASE WHEN l_linenumber <> 2 THEN l_quantity * 1500.0::DOUBLE END AS prediction,
                  CASE WHEN l_linenumber <> 4 THEN l_extendedprice END AS label FROM lineitem),
p AS (SELECT * FROM r WHERE prediction IS NOT NULL AND label IS NOT NULL),
m AS (""" + _metrics("p") + """)
SELECT m.*, (SELECT count(*) FROM r) - m.n AS n_missing FROM m"""

DOCUMENT_FIELDS = _tree_levels_body() + """
SELECT unnest(['version', 'description', 'model_name', 'algorithm', 'label', 'features', 'classes', 'outputs']) AS field,
       unnest(['4.2', 'Tree ensemble', 'canopy', 'tree ensemble', 'l_linestatus', 'l_quantity,l_discount,l_tax', 'F,O',
               'Predicted_l_linestatus,Probability_F,Probability_O']) AS value
UNION ALL SELECT 'distributions', count(*) || '/' || count(*) FROM nodes"""

MODEL_FACTS = "SELECT 3::BIGINT AS n_trees, TRUE AS depth_ok, TRUE AS counts_add_up, 0::BIGINT AS n_unlike"

SPLIT_FACTS = """
SELECT count(*) AS n_rows, TRUE AS parts_add_up, TRUE AS parts_are_the_rows, TRUE AS part_near_share,
       TRUE AS sample_of_the_rows, TRUE AS sample_near_share FROM lineitem"""

POINT_MODES = """
WITH p AS (SELECT p_size > 45 AS bad, p_retailprice AS label FROM part)
SELECT 'FAILFAST' AS mode, TRUE AS failed, NULL::BIGINT AS n_rows, NULL::BIGINT AS n_bad, NULL::DOUBLE AS label_sum
UNION ALL SELECT 'PERMISSIVE', FALSE, count(*), count_if(bad)::BIGINT, round(sum(CASE WHEN NOT bad THEN label END), 2) FROM p
UNION ALL SELECT 'DROPMALFORMED', FALSE, count_if(NOT bad)::BIGINT, 0, round(sum(CASE WHEN NOT bad THEN label END), 2) FROM p"""

_REGRESSION_ROW = """count(*) AS n, 0::BIGINT AS n_missing, round(sqrt(avg((prediction - label) * (prediction - label))), 4) AS rmse,
       round(avg(abs(prediction - label)), 4) AS mae, round(regr_r2(label, prediction), 9) AS r2_pearson,
       round(1.0 - sum((prediction - label) * (prediction - label)) / (var_pop(label) * count(*)), 9) AS r2_sse"""
SUBSPACE_REPORT_REGRESS = subspace_vote_sql(5, drawn(3, 3, 2, 0), None, "l_extendedprice", 0, final=False, task="regression") + f""",
pt AS (SELECT CAST(l.key // 1000000 AS INTEGER) AS tree_id, te.label, p.p AS prediction
       FROM leaf l JOIN leafp p ON p.key = l.key JOIN te ON te.rid = l.rid)
SELECT 'tree' AS kind, tree_id, {_REGRESSION_ROW} FROM pt GROUP BY tree_id
UNION ALL SELECT 'pooled', NULL::INTEGER, {_REGRESSION_ROW} FROM pt
UNION ALL SELECT 'voted', NULL::INTEGER, {_REGRESSION_ROW} FROM pred"""


def _ranked_rows(seed: int) -> str:
    """Rows of lineitem by md5 of seed, row and occurrence: ``place`` from 1, ``n`` rows."""
    cols = ", ".join([*FEATS, "l_linestatus"])
    row = ", ".join(f"CAST({c} AS VARCHAR)" for c in [*FEATS, "l_linestatus"])
    return f"""SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '{seed}', {row}, CAST(k AS VARCHAR)))) AS place, count(*) OVER () AS n
       FROM (SELECT {cols}, row_number() OVER (PARTITION BY {cols}) AS k FROM lineitem)"""


RANDOM_SPLIT = f"""
WITH parts AS (
  SELECT CASE WHEN place <= floor(0.6 * n + 0.5) THEN 'split_train' ELSE 'split_test' END AS part, * FROM ({_ranked_rows(42)})
  UNION ALL SELECT 'sample', * FROM ({_ranked_rows(7)}) WHERE place <= floor(0.25 * n + 0.5))
SELECT part, l_linestatus, count(*) AS n_rows, round(sum(l_quantity), 2) AS quantity, round(sum(l_discount), 4) AS discount
FROM parts GROUP BY ALL"""

ORACLE_SQL = {
    "random_split_counts": RANDOM_SPLIT,
    "gini_split_scan_wide": GINI_WIDE,
    "bagged_forest_wide": BAGGED_WIDE,
    "bagged_rows": BAGGED_ROWS,
    "forest_classify": forest_sql(FLAG, "classification"),
    "forest_regress": forest_sql("l_extendedprice", "regression"),
    "forest_classify_ml": MODEL_FACTS,
    "forest_regress_ml": MODEL_FACTS,
    "linear_sgd_nulls": LINEAR_NULLS,
    "regression_metrics_nulls": METRICS_NULLS,
    "pmml_legacy_score": SCORE_SPARK,
    "pmml_document_fields": DOCUMENT_FIELDS,
    "random_split_facts": SPLIT_FACTS,
    "read_points_modes": POINT_MODES,
    "subspace_report_regress": SUBSPACE_REPORT_REGRESS,
    "parse_points": PARSE_POINTS,
    "label_at_index": LABEL_AT_INDEX,
    "hash_split_counts": HASH_SPLIT_COUNTS,
    "holdout_complement": HOLDOUT_COMPLEMENT,
    "standardize_stats": STANDARDIZE_STATS,
    "standardize_rows": STANDARDIZE_ROWS,
    "feature_subset": FEATURE_SUBSET,
    "gini_split_scan": split_scan_sql("classification"),
    "variance_split_scan": split_scan_sql("regression"),
    "stump_error": STUMP_ERROR,
    "stump_rmse": STUMP_RMSE,
    "tree_levels": TREE_LEVELS,
    "score_forest_r": SCORE_R,
    "score_forest_spark": SCORE_SPARK,
    "vote_shares": VOTE_SHARES,
    "mean_prediction": MEAN_PREDICTION,
    "mispredicted_rows": MISPREDICTED,
    "error_rate": ERROR_RATE,
    "pooled_error": POOLED,
    "regression_metrics": REGRESSION_METRICS,
    "linear_sgd": LINEAR_SGD,
    "predict_linear": PREDICT_LINEAR,
    "pmml_roundtrip": SCORE_R,
    "pmml_nodes": PMML_NODES,
    "pmml_regression": MEAN_PREDICTION,
    "stream_scores": SCORE_R,
    "describe_tree": DESCRIBE_TREE,
    "tree_depth5": grown_tree_sql(5),
    "subspace_vote": subspace_vote_sql(5, drawn(3, 3, 2, 0)),
    "bagged_forest": subspace_vote_sql(5, drawn(3, 3, 2, 0), seed=0),
    # Spark's own tree learner grows the same tree (same candidates, gains and ties)
    "tree_classify": subspace_vote_sql(5, [[0, 1, 2]], None, STATUS, 2, final=False) + """
SELECT count(*) AS n_test,
       CAST(sum(CASE WHEN prediction IS NOT DISTINCT FROM label THEN 0 ELSE 1 END) AS BIGINT) AS n_wrong,
       avg(CASE WHEN prediction IS NOT DISTINCT FROM label THEN 0.0 ELSE 1.0 END) AS error_rate
FROM pred""",
    "subspace_report": subspace_vote_sql(5, drawn(3, 3, 2, 0), final=False) + """,
pt AS (SELECT CAST(l.key // 1000000 AS INTEGER) AS tree_id, te.label, p.p AS prediction
       FROM leaf l JOIN leafp p ON p.key = l.key JOIN te ON te.rid = l.rid),
w AS (SELECT tree_id, CASE WHEN prediction IS NOT DISTINCT FROM label THEN 0 ELSE 1 END AS bad FROM pt),
v AS (SELECT CASE WHEN prediction IS NOT DISTINCT FROM label THEN 0 ELSE 1 END AS bad FROM pred)
SELECT 'tree' AS kind, tree_id, count(*) AS n_pairs, CAST(sum(bad) AS BIGINT) AS n_wrong,
       avg(bad::DOUBLE) AS error_rate FROM w GROUP BY tree_id
UNION ALL SELECT 'pooled', NULL::INTEGER, count(*), CAST(sum(bad) AS BIGINT), avg(bad::DOUBLE) FROM w
UNION ALL SELECT 'voted', NULL::INTEGER, count(*), CAST(sum(bad) AS BIGINT), avg(bad::DOUBLE) FROM v""",
    "subspace_mean": subspace_vote_sql(5, drawn(3, 3, 2, 0), None, "l_extendedprice", 0,
                                       final=False, task="regression")
    + f"\nSELECT {KEYS}, label, round(prediction, 4) AS prediction FROM pred",
    "subspace_classify": embedding_ensemble_sql("classification"),
    "subspace_regress": embedding_ensemble_sql("regression"),
    "tree_regress": subspace_vote_sql(5, [[0, 1, 2]], None, "l_extendedprice", 0, final=False,
                                      task="regression") + _metrics("pred"),
}
