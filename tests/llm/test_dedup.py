"""Exact and SimHash deduplication against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from canopy.llm import exact_dedup, simhash
from canopy.llm.components import connected_components
from llm_cases import empty, tricky  # noqa: F401


def components(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(500, x) for x in range(501, 560)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame([*links, (1, None)], "src int, dst int")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == components([x for x in links if x[0] != x[1]], nodes)
    assert connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def expected_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    out = []
    for i, t in rows:
        sha = hashlib.sha256((t or "").encode()).hexdigest()
        ids = [x for x in groups[sha] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[sha]), i == keep, sha))
    return sorted(out, key=repr)


def test_exact_edges(tricky, empty):
    got = exact_dedup.exact_groups(tricky).select("id", "keep_id", "group_size", "kept", F.lower(F.hex("sha"))).collect()
    rows = [(r.doc_id, r.text) for r in tricky.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in got), key=repr) == expected_exact(rows)
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_hot_group(spark):
    rows = [(i, "copy" if i % 3 == 0 else f"text {i % 700}") for i in range(3000)]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    got = got.select("id", "keep_id", "group_size", "kept", F.lower(F.hex("sha"))).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected_exact(rows)


def test_exact_drop_keeps_rows(tricky):
    kept = exact_dedup.drop_exact_duplicates(tricky)
    assert kept.columns == tricky.columns
    texts = Counter((r.text or "") for r in kept.collect())
    assert set(texts) == {(r.text or "") for r in tricky.collect()}
    assert texts["Hello World from here"] == 2  # the two rows that share the largest id


def test_bloom_has_no_false_negative(spark):
    rows = spark.range(20_000).select(F.xxhash64((F.col("id") % 15_000)).alias("h"), "id")
    found = exact_dedup.with_candidates(rows, "h")
    repeated = found.where("id % 15000 < 5000")
    assert repeated.where("not candidate").count() == 0
    assert found.where("id % 15000 >= 5000 and candidate").count() < 1000


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words)] if 0 < len(words) < k else [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_simhash_edges(tricky, empty):
    got = [tuple(r) for r in simhash.near_duplicates(tricky).collect()]
    rows = [(r.doc_id, r.text) for r in tricky.select("doc_id", "text").collect()]
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    links = [(a, b) for _, a in fps for _, b in fps if a < b and bin(a ^ b).count("1") <= 2]
    comp = components(links, {f for _, f in fps})
    least = defaultdict(list)
    for i, f in fps:
        if i is not None:
            least[comp[f]].append(i)
    want = [(i, signed(f), min(least[comp[f]]) if least[comp[f]] else None) for i, f in fps]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(empty).count() == 0


def test_fingerprint_splits_long_texts():
    text = " ".join(f"w{i}" for i in range(70_000))
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("max_bits", [0, 2, 4])
def test_links_are_those_of_all_pairs(spark, max_bits):
    """Random fingerprints with near ones planted around them, and chains that only links of links join."""
    rng = random.Random(max_bits)
    fps = {0, (1 << 64) - 1}
    for _ in range(120):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(rng.randrange(4)):
            f ^= sum({1 << rng.randrange(64) for _ in range(rng.randrange(1, 6))})
            fps.add(f)
    got = connected_components(simhash.linked(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), max_bits)).collect()
    nodes = sorted(signed(f) for f in fps)
    mask = (1 << 64) - 1
    want = components([(a, b) for a in nodes for b in nodes if a < b and bin((a ^ b) & mask).count("1") <= max_bits], nodes)
    assert {n: dict((r.node, r.component) for r in got).get(n, n) for n in nodes} == want


def test_large_near_group_stays_linear(spark):
    """One ball of a thousand fingerprints: the rows made follow their number, not its square."""
    rng = random.Random(1)
    fps = {sum({1 << rng.randrange(64) for _ in range(2)}) for _ in range(1000)} | {0}
    edges = simhash.linked(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), 2)
    assert edges.count() <= 65 * len(fps)
    assert connected_components(edges).select("component").distinct().count() == 1


def test_only_the_places_of_dropped_lines_are_kept(spark):
    """When the texts are moved, the line table and what was made of it are gone from the disk."""
    from canopy.llm import linededup
    from canopy.session import ensure_checkpoint_dir

    line = "a line of twelve words that every document of this table has again " * 2
    docs = spark.createDataFrame([(i, f"own words {i}\n{line}\nend {i}") for i in range(12)], "doc_id long, text string")
    jvm, root = spark._jvm, ensure_checkpoint_dir(spark)
    folder = jvm.org.apache.hadoop.fs.Path(root)

    def kinds():
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
        return {f.getPath().getName() for f in files}

    before = kinds()
    out = linededup.drop_recurring(docs)
    assert {name.split("-")[1] for name in kinds() - before} == {"drops"}
    assert sorted((r["doc_id"], r["n_dropped"]) for r in out.collect()) == [(i, int(i > 0)) for i in range(12)]
