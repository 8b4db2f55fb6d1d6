"""Spelling variants, word BPE and whitening against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from canopy.llm import variants, whitening, wordbpe
from canopy.llm.queries import ORACLE_SQL, WORD_BPE, op13_spelling_variants
from llm_cases import CLASHES, SF, empty, tricky  # noqa: F401

PATH = public_tokenizers.path(WORD_BPE)


# ---- spelling variants ----------------------------------------------------------------

def vocabulary_want(rows):
    counts = Counter()
    for doc, text in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_want(vocabulary):
    around, form = defaultdict(set), {}
    by_rest = defaultdict(set)
    for w in vocabulary:
        for i in range(len(w)):
            by_rest[w[:i] + w[i + 1:]].add(w)
        by_rest[w].add(w)
    for group in by_rest.values():
        for a in group:
            around[a] |= {b for b in group if near(a, b)}
    for w, n in vocabulary.items():
        best = min(around[w], key=lambda x: (-vocabulary[x], x), default=None)
        if best is not None and vocabulary[best] >= 2 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (n, len(around[w]), form.get(w), vocabulary.get(form.get(w)), root(w)) for w, n in vocabulary.items()}


def as_dict(df):
    rows = df.collect()
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("repeat", [1, 4])
def test_variants_edges(spark, tricky, empty, repeat):
    docs = tricky
    for _ in range(repeat - 1):
        docs = docs.union(tricky)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert as_dict(variants.spelling_variants(docs)) == variants_want(vocabulary_want(rows))
    assert variants.spelling_variants(empty).count() == 0


def test_variants_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = as_dict(op13_spelling_variants(spark, SF))
    assert got == variants_want(vocabulary_want((r.doc_id, r.text) for r in docs.collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == {w: (n, k, f, m, r) for w, f, r, n, k, m in con.sql(ORACLE_SQL["op13_spelling_variants"]).fetchall()}


@pytest.mark.parametrize("block_rows", [2, 5, 1024])
def test_variants_blocks(spark, block_rows):
    """However often keys are divided, every link is found once: dense words, ties, chains, long words, repeated letters."""
    rng = random.Random(5)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(5, 9))) for _ in range(400)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "émile", "emile", "émiles", "x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1500}
    words |= {"chain" + c * i for c in "kl" for i in range(8)}
    table = {w: rng.choice([3, 3, 6, 7, 12, 50, 1000]) for w in sorted(words)}
    df = spark.createDataFrame(list(table.items()), "word string, n long").select("*", *[F.lit("clash").alias(c) for c in CLASHES if c != "word"], F.lit(0).alias("m"))
    got = as_dict(variants.group_variants(df, block_rows))
    assert got == variants_want(table)
    assert sum(r[1] for r in got.values()) > 1000


def test_variants_null_words(spark):
    df = spark.createDataFrame([(None, 5), ("alone", 3)], "word string, n long")
    assert as_dict(variants.group_variants(df)) == {"alone": (3, 0, None, None, "alone")}


# ---- word BPE ---------------------------------------------------------------------------

def library():
    return wordbpe.model(PATH).tokenizer


def ids_of(text, size=wordbpe.SLICE, buffer=wordbpe.BUFFER):
    m = wordbpe.model(PATH)
    encoder = wordbpe.Encoder(m, wordbpe.sufficient_lookahead(list(m.rank)), buffer)
    return [i for part in encoder.encode(text, size) for i in part]


def digest(text):
    ids = library().encode(text or "", add_special_tokens=False).ids
    decoded = library().decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize(("size", "buffer", "part"), [(wordbpe.SLICE, wordbpe.BUFFER, wordbpe.PART), (40, 8, 30), (5, 3, 1)])
def test_word_bpe_digests(spark, tricky, empty, size, buffer, part):
    """Ids and text are the library's, whatever the sizes of slices, buffer and parts."""
    more = [(100, "a" * 5000), (101, "日本語のテキスト、" * 300), (102, "can't I'll we're o'clock '''s" * 20), (103, "<|endoftext|> a <|startoftext|>"),
            (104, "İstanbul ΑΣΣ Σς ẹ́́ क़ 가각가"), (105, "!?'" * 200 + "s"), (106, "word　word word x")]
    docs = tricky.select("doc_id", F.when(F.length("text") > 5000, F.substring("text", 1, 5000 if size < 100 else 500_000)).otherwise(F.col("text")).alias("text"))
    docs = docs.union(spark.createDataFrame(more, "doc_id long, text string"))
    got = wordbpe.round_trip_digests(docs, PATH, size=size, buffer=buffer, part=part).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r.doc_id, *digest(r.text)) for r in docs.collect()), key=repr)
    assert wordbpe.round_trip_digests(empty, PATH).count() == 0


def test_word_bpe_parts(spark, tricky):
    """The parts of encode() and decode() joined per text are what the digests are of."""
    docs = tricky.where("doc_id < 10 and doc_id <> 6")
    got = defaultdict(lambda: [b"", ""])
    for r in wordbpe.decode(wordbpe.encode(docs, PATH, part=100), PATH).collect():
        got[r.id] = [got[r.id][0] + r.ids, got[r.id][1] + r.text]
    for r in docs.collect():
        ids = library().encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[r.doc_id][0], "<u4").tolist() == ids
        assert got[r.doc_id][1] == library().decode(ids, skip_special_tokens=False)


def test_word_bpe_all_characters():
    """Every code point, between letters and marks, as the library has it."""
    text = [f"a{chr(c)}b!{chr(c)}?" for c in [*range(0xD800), *range(0xE000, 0x30000, 3), *range(0xE0000, 0xE0200)]]
    encoder = wordbpe.Encoder(wordbpe.model(PATH), wordbpe.sufficient_lookahead(list(wordbpe.model(PATH).rank)))
    want = library().encode_batch(text, add_special_tokens=False)
    assert all([i for part in encoder.encode(t) for i in part] == w.ids for t, w in zip(text, want, strict=True))


def test_word_bpe_keeps_clashing_columns_out(tricky):
    assert wordbpe.encode(tricky, PATH).columns == ["id", "last", "ids"]


def test_word_bpe_added_tokens(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> B<|startoftext|>")], "doc_id long, text string")
    row = wordbpe.decode(wordbpe.encode(docs, PATH, added_as_text=False), PATH).first()
    tok = type(library()).from_file(PATH)
    want = tok.encode("a <|endoftext|> B<|startoftext|>", add_special_tokens=False).ids
    assert np.frombuffer(row.ids, "<u4").tolist() == want and row.text == tok.decode(want, skip_special_tokens=False)


def test_word_bpe_plain_text(spark):
    """The plain decoding gives the normal form's pre-tokens back, a space after each; characters over several tokens and parts too."""
    text = "Hello, World's naïve 12 日本語 😀 ﷺ"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = wordbpe.decode(wordbpe.encode(docs, PATH, size=3, part=1), PATH, plain=True).collect()
    want = regex.findall(r"'s|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", text.lower())
    assert len(rows) > 5 and "".join(r.text for r in rows) == " ".join(want) + " "


def test_word_bpe_random():
    rng = random.Random(1)
    letters = "aeinrst'é!?.,日本語のテキストßẠ̀́eᅡᄀ가각　  1９Σσς İாக"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 300)))
        assert ids_of(text, rng.choice([3, 7, 64]), rng.choice([1, 5, 50])) == library().encode(text, add_special_tokens=False).ids
    run = "".join(rng.choice("abcdeinrstgo") for _ in range(200_000))
    assert ids_of(run) == library().encode(run, add_special_tokens=False).ids


def random_merges(rng, letters, n):
    tokens, merges = list(letters), []
    while len(merges) < n:
        u, v = rng.choice(tokens), rng.choice(tokens)
        if u + v not in tokens:
            merges.append((u, v))
            tokens.append(u + v)
    return merges


class _Merges(wordbpe.Model):
    def __init__(self, merges):
        self.end = "."
        self.rank = {m: r for r, m in enumerate(merges)}


def test_lookahead_is_sufficient():
    """On random merge lists: texts with a common prefix have common tokens up to the lookahead; often no shorter one would do."""
    rng = random.Random(2)
    tight = 0
    for _ in range(60):
        merges = random_merges(rng, "ab", rng.randint(1, 8))
        m, reach = _Merges(merges), wordbpe.sufficient_lookahead(merges)
        seen = 0
        for _ in range(200):
            prefix = [rng.choice("ab") for _ in range(reach + 8)]
            ends = []
            for _ in range(2):
                tokens = m.merged(prefix + [rng.choice("ab") for _ in range(rng.randint(0, 6))])
                ends.append(np.cumsum([len(t) for t in tokens]).tolist())
            a, b = ([e for e in x if e <= len(prefix)] for x in ends)
            common = max((x for i, x in enumerate(a) if a[:i + 1] == b[:i + 1]), default=0)
            if a != b or ends[0][len(a):] != ends[1][len(b):]:
                seen = max(seen, len(prefix) - common)
        assert seen <= reach + 0
        tight += seen == reach
    assert tight > 5
    assert wordbpe.sufficient_lookahead([]) == 0
    with pytest.raises(ValueError):
        wordbpe.sufficient_lookahead([("ab", "c"), ("a", "b")])


# ---- whitening ----------------------------------------------------------------------------

def white_want(vectors, k=8):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    d = n * x - s
    c = d.astype(float) / n
    v = c.T @ c / n
    values, axes = np.linalg.eigh(v)
    order = values.argsort()[::-1][:k]
    return n, (d * d).sum(axis=1), c @ axes[:, order] / np.sqrt(values[order]), values[order] / np.trace(v)


def compare(rows, ids, vectors, k=8):
    n, deviation, z, explained = white_want(vectors, k)
    got = defaultdict(dict)
    for r in rows:
        got[r.id][r.component] = r
    assert sorted(got) == sorted(ids) and len(rows) == len(ids) * k
    signs = None
    for i, vec in enumerate(ids):
        mine = np.array([got[vec][c].whitened for c in range(1, k + 1)])
        signs = np.sign(mine * z[i]) if signs is None else signs
        assert np.allclose(mine, signs * z[i], rtol=1e-6, atol=1e-7)
        for c in range(1, k + 1):
            r = got[vec][c]
            assert r.n == n and int(r.deviation) == deviation[i] and math.isclose(r.explained, explained[c - 1], rel_tol=1e-9)
            assert r.identity_error < 1e-9


def test_whitening_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.select("vec_id", "embedding").collect()
    for parts in (1, 5):
        compare(whitening.whiten(table.repartition(parts), "vec_id", "embedding").collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_whitening_edges(spark):
    """Nulls, non-finite and oversized entries, other lengths, repeated rows, clashing columns, few and equal vectors."""
    rng = np.random.default_rng(3)
    good = [[float(x) for x in rng.normal(size=5) * [9, 7, 4, 2, 1]] for _ in range(40)]
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [1.0, 2.0, float("-inf"), 1.0, 1.0], [1.0, 2.0], [1e300] * 5]
    rows = [(i, v, "x") for i, v in enumerate(good + [good[0]])] + [(100 + i, v, None) for i, v in enumerate(bad)]
    schema = "vec_id long, embedding array<double>, n string"
    table = spark.createDataFrame(rows, schema).select("*", *[F.lit(1).alias(c) for c in CLASHES if c != "n"])
    got = whitening.whiten(table.drop("id").repartition(3), "vec_id", "embedding").collect()
    compare(got, range(41), good + [good[0]], k=5)
    for few in ([], rows[:1], [rows[0], rows[0]], rows[41:43], rows[41:]):
        out = whitening.whiten(spark.createDataFrame(few, schema), "vec_id", "embedding")
        assert out.columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0  # nothing varies
    null_id = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0], ""), (1, [3.0, 7.0], "")], schema), "vec_id", "embedding").collect()
    assert {(r.id, r.component) for r in null_id} == {(None, 1), (1, 1)}


def test_whitening_large_entries(spark):
    """Sums and deviations stay exact beyond a long."""
    vectors = [[float(a), float(b)] for a, b in ((2 ** 50, 5), (3, 2 ** 49), (2 ** 50 + 1024, 7), (-2 ** 50, 0))]
    got = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "i long, v array<double>"), "i", "v").collect()
    n, deviation, _, _ = white_want(vectors, 2)
    assert {r.id: int(r.deviation) for r in got} == dict(enumerate(deviation)) and {r.n for r in got} == {n}


@pytest.mark.parametrize("values", [[5] * 10 + [1] * 30, [1e6, 1e6 - 1e-6] + [3] * 8 + [0] * 30, [0] * 40, [1] + [0] * 39,
                                    list(np.geomspace(1, 1e-14, 40)), [2, 2, 2, 1, 1, 1] + [1e-3] * 34, [7.0]])
def test_spectrum_slices(values):
    """Equal, close, zero and widely spread eigenvalues: values, orthogonal unit vectors, certified order."""
    q, _ = np.linalg.qr(np.random.default_rng(0).normal(size=(len(values), len(values))))
    v = (q * np.array(values, float)) @ q.T
    v = (v + v.T) / 2
    found = whitening.leading_components(v)
    want = [x for x in sorted(values, reverse=True)[:8] if x > 1e-13 * max(values)]
    assert np.allclose([c.value for c in found], want, rtol=1e-9)
    axes = np.array([c.vector for c in found]).reshape(-1, len(values))
    assert np.allclose(axes @ axes.T, np.eye(len(found)), atol=1e-12)
    assert np.allclose(axes @ v, axes * np.array(want)[:, None], atol=1e-9 * max(values) + 1e-300)


def test_inertia_counts():
    rng = np.random.default_rng(4)
    for _ in range(200):
        d = int(rng.integers(1, 12))
        a = rng.normal(size=(d, d)) * rng.choice([0, 1, 1e-3], size=(d, d))
        a = a + a.T
        a[np.diag_indices(d)] *= rng.choice([0, 1])
        e = np.linalg.eigvalsh(a)
        if np.abs(e).min() > 1e-9:
            assert whitening.positive_pivots(a) == (e > 0).sum()
