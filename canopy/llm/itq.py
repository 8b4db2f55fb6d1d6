"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

Unit vectors are turned into binary codes: principal directions, then a
rotation that iterative quantisation learns on a bounded sample so that the
signs are balanced and lose little.  A few rotations give one code each; the
codes are cut into substrings, and each substring position is a hash table
(the multi-index).  Vectors of one label that agree in a whole substring meet
in a bucket, where the original vectors decide by their cosine.  Buckets are
worked in square blocks of bounded size; a pair that meets in several tables
counts in the first one only, so links are counted without listing pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import workers_ready, written
from canopy.llm.components import connected_components

#: Distinct vectors that the rotations are learned on, at most (the hash of the vector picks them).
SAMPLE = 8192
ROTATIONS = 2
TABLE_BITS = 16
ROUNDS = 30
#: Rows of one side of a block of a bucket.
BLOCK_ROWS = 1024


def usable(vector: str | Column) -> Column:
    """Is a vector comparable: not null or empty, all components finite, not all zero?"""
    v = F.col(vector) if isinstance(vector, str) else vector
    d = F.transform(v, lambda x: x.cast("double"))
    finite = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(d, lambda x: x != 0), F.lit(False))


def learn_rotations(x: np.ndarray, rotations: int = ROTATIONS, rounds: int = ROUNDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(centre, projection) pairs: a code is the signs of (vector - centre) @ projection, for unit vectors.

    Every other code is centred at the mean, which balances its bits; those
    between are centred at the origin, which holds near vectors together even
    where most of the table is one group around the mean.  Short vectors give
    short codes, so they get more of them: the codes have ``rotations`` x 64
    bits together, or a little more.
    """
    bits = min(64, x.shape[1]) // 4 * 4 or x.shape[1]
    out = []
    for seed in range(-(-rotations * 64 // bits)):
        centre = x.mean(axis=0) if seed % 2 == 0 else np.zeros(x.shape[1])
        c = x - centre
        _, _, axes = np.linalg.svd(c.T @ c)
        main = axes[:bits].T
        v = c @ main
        r, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
        for _ in range(rounds):
            signs = np.where(v @ r >= 0, 1.0, -1.0)
            a, _, b = np.linalg.svd(v.T @ signs)
            r = a @ b
        out.append((centre, main @ r))
    return out


def substrings(x: np.ndarray, codes: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Rows of table keys: every TABLE_BITS bits of every code."""
    keys = []
    for centre, p in codes:
        bits = ((x - centre) @ p >= 0)
        for at in range(0, bits.shape[1], TABLE_BITS):
            part = bits[:, at:at + TABLE_BITS]
            keys.append(part @ (1 << np.arange(part.shape[1])))
    return np.stack(keys, axis=1).astype(np.int32)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled with zeros."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column.to_pylist()):
        out[i, :len(v)] = v
    return out


def _units(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.maximum(big, 5e-324)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 5e-324)


def local_links(keys: np.ndarray, units: np.ndarray, times: np.ndarray, side: np.ndarray, table: int,
                threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) per row of one block: links not met in an earlier table, weighted by copies; root names linked rows.

    side 0 and 1: rows of different sides are compared, or all rows if there is one side.
    """
    near = units @ units.T >= threshold
    np.fill_diagonal(near, False)
    if side.any():
        near &= side[:, None] != side[None, :]
    fresh = near.copy()
    a, b = np.nonzero(near)
    if table and len(a):
        met = (keys[a, :table] == keys[b, :table]).any(axis=1)
        fresh[a[met], b[met]] = False
    links = fresh @ times
    root = np.arange(len(units))
    if len(a):
        while True:
            new = root.copy()
            np.minimum.at(new, a, root[b])
            new = new[new]
            if (new == root).all():
                break
            root = new
    return links, root


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.98) -> DataFrame:
    """(id, n_links, component_id) per row of ``table``.

    Rows of equal, non-null labels link if the cosine of their vectors, in
    double precision, is at least ``threshold``.  Vectors that are null,
    empty, zero or hold null or non-finite components, and rows without a
    label, link with nothing; vectors of different lengths do not link.
    Equal vectors are compared once for all their copies.  Repeated rows are
    vectors of their own that link with each other.  component_id is the
    smallest id reachable (a row's own id where it links with nothing).
    """
    spark = table.sparkSession
    workers_ready(spark)
    rows = table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    ok = F.col("label").isNotNull() & usable("v")
    classes = written(rows.where(ok).groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("times"))
                      .select(F.monotonically_increasing_id().alias("node"), "label", "v", "rep", "times"), "vectors")
    about = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    lone = rows.where(~ok).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if not about.n:
        return lone
    width, share = about.width, min(1.0, SAMPLE / about.n)
    picked = classes.where(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < int(share * (1 << 20))).select("v").limit(SAMPLE).toArrow()
    sample = _units(_matrix(picked["v"].combine_chunks(), width)) if len(picked) else np.eye(width)
    model = spark.sparkContext.broadcast(learn_rotations(sample))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = substrings(_units(_matrix(b["v"], width)), model.value)
            flat = pa.array(keys.ravel())
            yield pa.RecordBatch.from_arrays([b["node"], b["group"], pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1]), flat)],
                                             ["node", "group", "keys"])

    # label and length of a vector, as one string: only vectors of a group are compared
    grouped = classes.withColumn("group", F.concat_ws(":", F.size("v"), F.col("label").cast("string")))
    codes = written(grouped.select("node", "group", "v").mapInArrow(encode, "node bigint, group string, keys array<int>"), "codes")
    places = codes.select("node", "group", "keys", F.posexplode("keys").alias("table", "key"))
    buckets = (places.groupBy("group", "table", "key").agg(F.count(F.lit(1)).alias("n")).where("n >= 2"))
    buckets = written(buckets.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")), "buckets")
    members = (places.join(buckets, ["group", "table", "key"])
               .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select("node", "keys", "group", "table", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       (F.col("own") > F.col("other")).cast("int").alias("side")))
    met = members.join(classes.select("node", "v", "times"), "node")
    block = ["group", "table", "key", "i", "j"]
    dealt = met.repartition(*block).sortWithinPartitions(*block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block_links(rows: pa.Table) -> pa.RecordBatch | None:
            if len(rows) < 2:
                return None
            keys = np.stack(rows["keys"].to_pylist())
            node = rows["node"].to_numpy()
            links, root = local_links(keys, _units(_matrix(rows["v"].combine_chunks(), width)), rows["times"].to_numpy().astype(np.float64),
                                      rows["side"].to_numpy(), rows["table"][0].as_py(), threshold)
            some = np.flatnonzero((links > 0) | (root != np.arange(len(root))))
            if not len(some):
                return None
            return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some].astype(np.int64)), pa.array(node[root[some]])], ["node", "links", "hub"])

        def groups(t: pa.Table, final: bool) -> Iterator[pa.Table]:
            """The whole blocks of the sorted rows ``t``; the last one stays held unless ``final``."""
            names = np.array([hash(x) for x in zip(*(t[c].to_pylist() for c in block), strict=True)])
            at = np.concatenate([[0], np.flatnonzero(names[1:] != names[:-1]) + 1, [len(names)]])
            for a, b in zip(at[:-1] if final else at[:-2], at[1:] if final else at[1:-1], strict=True):
                yield t.slice(a, b - a)
            held[:] = [] if final else t.slice(at[-2]).to_batches()

        for b in batches:
            if b.num_rows:
                for rows in groups(pa.Table.from_batches([*held, b]), False):
                    if (out := block_links(rows)) is not None:
                        yield out
        if held:
            for rows in groups(pa.Table.from_batches(held), True):
                if (out := block_links(rows)) is not None:
                    yield out

    found = written(dealt.mapInArrow(run, "node bigint, links bigint, hub bigint"), "links")
    edges = found.where("node <> hub").select(F.col("node").alias("src"), F.col("hub").alias("dst")).distinct()
    comps = connected_components(edges)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(comps, "node", "left").join(links, "node", "left").select(
        "label", "v", "rep", "node", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    named = written(named, "named")
    best = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = written(named.join(best, "component").select("label", "v", "n_links", "component_id"), "classes")
    return rows.where(ok).join(known, ["label", "v"]).select("id", "n_links", "component_id").union(lone)
