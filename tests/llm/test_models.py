"""Context mixing, quantised embeddings, chat parsing and the pipeline."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from canopy.llm import chat, itq, mixing, stages
from canopy.llm.common import written
from llm_cases import CLASHES, SF, empty, tricky  # noqa: F401


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def unigram(rows):
    words = [(t or "").encode().lower().split() + [b"\n"] for _, t in rows]
    counts = Counter(w for (i, _), ws in zip(rows, words, strict=True) if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for ws in words]


def check_scores(rows, got):
    key = lambda r: (repr(r[0]), r[1], r[2], round(r[3], 6))
    want = sorted((key((i, a, b, base)) for (i, _), (a, b, _, base) in zip(rows, unigram(rows), strict=True)))
    have = sorted(key((r.id, r.n_tokens, r.n_known, r.base_score)) for r in got)
    assert [x[:3] for x in want] == [x[:3] for x in have]
    assert np.allclose([x[3] for x in want], [x[3] for x in have], rtol=1e-9)
    assert {r.train_tokens for r in got} == {unigram(rows)[0][2]}
    assert all(r.score < 0 and math.isfinite(r.score) and r.held_out == held(r.id) for r in got)


def test_scores_beat_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.scores(docs).collect()
    check_scores([(r.doc_id, r.text) for r in docs.collect()], got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_scores_edges(tricky, empty):
    rows = [(r.doc_id, r.text) for r in tricky.collect()]
    check_scores(rows, mixing.scores(tricky).collect())
    assert mixing.scores(empty).count() == 0


def test_no_learning_rows(spark):
    only = spark.createDataFrame([(i, "some text") for i in range(40) if held(i)], "doc_id long, text string")
    got = mixing.scores(only).collect()
    assert {r.train_tokens for r in got} == {0} and all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_model_is_a_probability():
    """Over all one- and two-letter words of a small alphabet and the end, the word model sums to at most one."""
    docs = [(b"ab ba a b ab", 1, 0), (b"ba ab bb", 1, 0), (b"a b ab", 2, 0)]
    block = mixing.Block.build(docs)
    code = mixing.Code.of(np.bincount(np.frombuffer(b"abbaab  \n", np.uint8), minlength=256))
    assert math.isclose(sum(2.0 ** -int(n) for n in code.length), 1.0)
    table = np.zeros(2 * mixing.SLOTS, np.int64)
    mixing.count_bits(block, code, table)
    every = [bytes([x]) for x in range(33, 256)]
    words = every + [bytes([x, y]) for x in (97, 98) for y in range(33, 256)]
    all_words = mixing.Block.build([(b" ".join(words), 0, 0)])
    bits = mixing.Mixer(code, mixing.quantised(table)).bits(all_words, np.arange(len(all_words.pair_word)))
    assert np.exp2(-bits).sum() <= 1.0 + 1e-3


def by_hand(docs):
    """Scores of documents (text, role, class) without Spark: all words in one bucket, counts of words and sequences by Counter."""
    block = mixing.Block.build(docs)
    pairs = np.argsort(block.pair_hashes())
    word, cls, none = block.pair_word[pairs], block.pair_class[pairs], np.zeros(0, np.int64)
    ends = np.cumsum(block.lens.astype(int))
    spelled = [block.text[e - n:e] for e, n in zip(ends, block.lens.astype(int), strict=True)]
    texts = [(t.split() + [b""], r, c) for t, r, c in docs]
    of = Counter((w, c, r) for ws, r, c in texts for w in ws)
    counted, taught = (np.array([of[spelled[w], c, r] for w, c in zip(word, cls.tolist(), strict=True)]) for r in (1, 2))
    everywhere = Counter(w for ws, r, _ in texts if r for w in ws)
    n = np.array([everywhere[spelled[w]] for w in word])
    words = mixing.Block(np.arange(len(pairs)), cls, counted, taught, none, none, b"".join(spelled[w] for w in word), block.lens[word], none, none)
    v = mixing.Vocabulary(block.pair_hashes()[pairs], words, n)
    by_class = Counter(c for ws, r, c in texts if r for _ in ws)
    corpus = mixing.Corpus(sum(everywhere.values()), len(everywhere), np.array([by_class[c] for c in range(mixing.CLASSES)]))
    code, table = mixing.Code.of(block.bytes_learned), np.zeros(2 * mixing.SLOTS, np.int64)
    mixing.count_bits(words, code, table)
    logits = mixing.quantised(table)
    lessons = mixing.Vocabulary.joined(pa.table([pa.array([d], pa.binary()) for d in v.row(np.flatnonzero(taught))], mixing._ROW)) if taught.any() else None
    mixer, learner = mixing.Mixer(code, logits), mixing.Mixer(code, logits)
    share = np.full(mixing.CLASSES, 0.5)
    if lessons:
        for some in mixing.batches_of(lessons.words):
            learner.bits(lessons.words, some)
        mixer.take_weights(learner.weights_table())
        for some in mixing.batches_of(lessons.words):
            mixer.bits(lessons.words, some, weigh=False)
        share = mixing.fitted(mixing.share_ratios(lessons, mixer, corpus), share)
    log_p, alone = (x[np.argsort(pairs)] for x in mixing.priced(v, mixer, corpus, share))
    both = np.stack(mixing.grams(block))
    tokens = [(i, w) for i, (ws, _, _) in enumerate(texts) for w in [None, None, *ws]]
    place = [k for k in range(2, len(tokens)) if tokens[k][1] is not None]
    keys = [[(2, *[tokens[k - j][1] for j in range(2)]) for k in place], [(3, *[tokens[k - j][1] for j in range(3)]) for k in place]]
    seen = Counter(key for some in keys for k, key in zip(place, some, strict=True) if texts[tokens[k][0]][1])
    times = {h: seen[key] for hs, some in zip(both.tolist(), keys, strict=True) for h, key in zip(hs, some, strict=True)}
    sequences = np.array([times[h] for h in np.unique(both).tolist()])
    n = n[np.argsort(pairs)]
    learns = np.repeat([r == 2 for _, r, _ in docs], block.doc_tokens.astype(int))
    e, weights = mixing.Evidence(block, n, alone, sequences, less=1), []
    loo = np.float32(e.log_p).astype(float)
    for own, gate, start in zip(e.own, e.gates, (mixing.START_OWN, mixing.START_CONTEXT, mixing.START_CONTEXT), strict=True):
        own = np.float32(own)
        weights.append(mixing.fitted(mixing.tally(gate[learns], (own - loo)[learns], mixing.GATES), start))
        loo = mixing.mixed_in(loo, own, weights[-1][gate])
    return mixing.Evidence(block, n, log_p, sequences).score(weights) - math.log10(mixing.CLASSES)


def scored(docs, texts):
    """Scores of ``texts`` beside learning documents ``docs`` (text, role), all in one block of one class."""
    return by_hand([(t, r, 0) for t, r in docs] + [(t, 0, 0) for t in texts])[len(docs):]


@pytest.fixture(scope="module")
def prose(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{x}{'abc'[x % 3] * (x % 5)}" for x in np.minimum(rng.geometric(0.01, rng.integers(0, 60)), 400))) for i in range(400)]
    return spark.createDataFrame([*rows, (400, None), (401, ""), (402, rows[7][1]), (402, rows[7][1])], "doc_id long, text string")


def test_scores_equal_those_without_spark(spark, prose):
    rows = sorted((r.id, r.role, bytes(r.text)) for r in prose.select(F.col("doc_id").alias("id"), mixing._roles("doc_id").alias("role"),
                                                                      F.coalesce("text", F.lit("")).cast("binary").alias("text")).collect())
    centres = mixing.centres(np.array(sorted((mixing.pair_profile(t) for _, r, t in rows if r), key=bytes)))
    want = by_hand([(t, r, int(np.argmax(centres @ mixing.pair_profile(t)))) for _, r, t in rows])
    got = sorted((r.id, r.score) for r in mixing.scores(prose).collect())
    assert [i for i, _ in got] == [i for i, _, _ in rows]
    assert np.allclose([s for _, s in got], want, rtol=1e-6)


def test_scores_do_not_depend_on_partitions_or_blocks(spark, prose, monkeypatch):
    want = sorted((r.id, r.score) for r in mixing.scores(prose.repartition(1)).collect())
    assert sorted((r.id, r.score) for r in mixing.scores(prose.repartition(4)).collect()) == want
    monkeypatch.setattr(mixing, "BLOCK_DOCUMENTS", 9)
    assert sorted((r.id, r.score) for r in mixing.scores(prose.repartition(7)).collect()) == want


def test_weights_of_buckets_are_averaged_by_the_bits_they_saw():
    code = mixing.Code.of(np.ones(256, np.int64))
    a, b, both = (mixing.Mixer(code, np.zeros(mixing.SLOTS, np.int8)) for _ in range(3))
    a.weights[:], b.weights[:] = 0.02, -0.04
    a.seen[3, 0], b.seen[3, 1] = 30, 10
    both.take_weights(a.weights_table() + b.weights_table())
    assert np.allclose(both.weights[:, 3], 0.005, atol=1e-5) and np.allclose(np.delete(both.weights, 3, axis=1), mixing.FIRST_WEIGHT)


def test_fitted_weights_are_the_likeliest():
    """Against a fine grid: the fitted weight of a mixture has the least cost over tokens and prior."""
    rng = np.random.default_rng(2)
    p, q = rng.random(3000) * 0.2, np.where(rng.random(3000) < 0.4, 0.0, rng.random(3000) * 0.5)
    got = mixing.fitted(mixing.tally(np.zeros(3000, int), mixing._log(q) - np.log(p), 1), np.array([0.3]))[0]
    grid = np.linspace(0.01, 0.98, 971)
    gain = [np.log(w * q + (1 - w) * p).sum() + mixing.WEIGHT_TOKENS * (0.3 * math.log(w) + 0.7 * math.log(1 - w)) for w in grid]
    assert abs(grid[int(np.argmax(gain))] - got) < 0.005


def test_long_words_cost_what_they_are_long():
    """A word without white space has no least probability: twice as long costs about twice as much."""
    rng = np.random.default_rng(1)
    word = bytes(rng.integers(97, 123, 40_000).astype(np.uint8))
    a, b = scored([(b"the cat sat on the mat", 1)] * 8 + [(b"the cat", 2)], [word[:20_000], word])
    assert a < -10_000 and 1.8 < b / a < 2.2


def test_word_order_counts(spark):
    """Held-out texts in the order of the learning texts score far above the same words backwards."""
    rng = np.random.default_rng(4)
    phrases = [" ".join(f"w{x}" for x in rng.integers(0, 200, 8)) for _ in range(40)]
    rows = [(i, " ".join(phrases[x] for x in rng.integers(0, 40, 6))) for i in range(600)]
    out = [(i, t) for i, t in rows if held(i)]
    rows += [(i, " ".join(reversed(t.split()))) for (_, t), i in zip(out, (i for i in range(1000, 9000) if held(i)), strict=False)]
    got = {r.id: r.score for r in mixing.scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    forth, back = (sum(s for i, s in got.items() if held(i) and (i >= 1000) == b) for b in (False, True))
    assert len([i for i in got if i >= 1000]) == len(out) and forth > 0.5 * back


def test_words_in_context_are_a_probability():
    """Over every word that can follow, the mixed shares of a context sum to one."""
    seen, p = np.array([5, 3, 0, 2, 0, 0]), np.array([0.1, 0.2, 0.3, 0.1, 0.2, 0.1])
    for weight in mixing.START_CONTEXT[mixing.sizes(np.full(6, seen.sum()))], np.full(6, 0.3):
        got = mixing.mixed_in(np.log(p), mixing._log(seen / seen.sum()), weight)
        assert math.isclose(np.exp(got).sum(), 1.0)


def test_nothing_is_learned_from_scored_texts():
    """A text's score is the same whatever held-out texts share its block."""
    docs = [(b"the cat sat on the mat", 1), (b"a dog sat there", 1), (b"the dog and the cat sat", 2)] * 4
    alone = scored(docs, [b"the cat and a dog"])
    assert np.isclose(scored(docs, [b"the cat and a dog", b"dog dog mat mat mat dog sat sat sat " * 30])[0], alone[0], rtol=1e-9)


def test_blocks_keep_every_token():
    texts = [b"the cat sat on the mat", b"", b" \n ", b"the", b"a" * 5000, b"caf\xc3\xa9 the cat"]
    block = mixing.Block.build([(t, 1, k % 3) for k, t in enumerate(texts)])
    ends = np.cumsum(block.lens.astype(int))
    spelled = [block.text[e - n:e] for e, n in zip(ends, block.lens.astype(int), strict=True)]
    seq = [spelled[w] for w in block.pair_word[block.sequence]]
    at = 0
    for t, n in zip(texts, block.doc_tokens, strict=True):
        assert seq[at:at + n] == t.split() + [b""]
        at += n
    assert block.bytes_learned[ord("t")] == b" ".join(texts).count(b"t") and block.class_learned.sum() == len(block.sequence)
    assert len(set(block.word_hashes().tolist())) == len(block.lens)
    again = mixing.Block.load(block.dump())
    assert (again.sequence == block.sequence).all() and again.text == block.text


# ---------------------------------------------------------------- embeddings

def brute_links(rows, threshold=0.98):
    good = [(k, i, label, np.array(v, float)) for k, (i, v, label) in enumerate(rows)
            if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = defaultdict(set)
    for a, _, la, va in good:
        for b, _, lb, vb in good:
            if a < b and la == lb and len(va) == len(vb) and va @ vb / np.linalg.norm(va) / np.linalg.norm(vb) >= threshold:
                near[a].add(b)
                near[b].add(a)
    comp = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in near:
            m = min(comp[b] for b in near[a] | {a})
            changed, comp[a] = changed or m != comp[a], m
    least = defaultdict(list)
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[comp[k]].append(i)
    return [(i, len(near[k]), min(least[comp[k]]) if least[comp[k]] else None) for k, (i, _, _) in enumerate(rows)]


def test_embedding_edges(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=8)
    rows = [(k, list(map(float, base + rng.normal(scale=0.03, size=8))), k % 2) for k in range(12)]
    rows += [(20, None, 1), (21, [], 1), (22, [0.0] * 8, 1), (23, [float("nan")] * 8, 1), (24, [1.0, None] + [0.0] * 6, 1), (25, [float("inf")] + [0.0] * 7, 1),
             (26, rows[0][1], None), (27, [2 * x for x in rows[0][1]], 0), (28, rows[1][1], 1), (28, rows[1][1], 1), (None, rows[1][1], 1), (29, [1.0, 2.0], 1), (30, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select("*", *[F.lit(1).alias(c) for c in CLASHES])
    got = itq.near_duplicates(df).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(brute_links(rows), key=repr)
    assert itq.near_duplicates(df.where("false")).count() == 0


def test_embedding_recall(spark):
    """Planted groups with cosines on both sides of the threshold: all links found are right, and at least nine in ten are found."""
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for g in range(60):
        c = rng.normal(size=64)
        for _ in range(rng.integers(1, 14)):
            rows.append((n, [float(x) for x in (c + rng.normal(scale=rng.uniform(0.05, 0.16), size=64))], int(g % 3)))
            n += 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.id: r.n_links for r in itq.near_duplicates(df).collect()}
    want = {i: k for i, k, _ in brute_links(rows)}
    assert sum(want.values()) > 200 and all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.9 * sum(want.values())


def test_large_bucket_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(itq, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(1)
    c = rng.normal(size=16)
    rows = [(k, [float(x) for x in c + rng.normal(scale=0.01, size=16)], 0) for k in range(100)]
    got = itq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(99, 0)}


# ---------------------------------------------------------------------- chat

def test_chat_roles_on_held_out_conversations(spark):
    from canopy.llm.queries import op8_chat_format
    got = op8_chat_format(spark, "/root/testdata/sf0.01").where("held_out and n_right is not null").agg(F.sum("n_right"), F.sum("n_lines")).first()
    assert got[0] / got[1] > 0.9


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    k = len(chat.STATES)
    model = chat.Model(np.log(rng.dirichlet(np.ones(k))), np.log(rng.dirichlet(np.ones(k), k)), [{chat.OTHER: np.log(rng.dirichlet(np.ones(k))), "user": np.log(rng.dirichlet(np.ones(k)))}
                                                                                              if j == 0 else {chat.OTHER: np.zeros(k)} for j in range(5)])
    text = "User: hello\nx\nuser: y\nz"
    e = model.emissions(chat._described(text))

    def value(path):
        return model.start[path[0]] + sum(model.move[a, b] for a, b in zip(path, path[1:], strict=False)) + sum(e[t, s] for t, s in enumerate(path))
    import itertools
    best = max(itertools.product(range(k), repeat=4), key=value)
    assert math.isclose(value(model.decode(text)), value(best))


@pytest.mark.parametrize("line", ["User: hi", "[user] hi", "**User:** hi", "<|user|> hi", "### user: hi"])
def test_markers(line):
    assert chat.marker(line) == ("user", "hi")


def test_chat_edges(spark):
    rows = [(1, 0, "user", "hello?"), (1, 0, "user", "hello?"), (1, 1, "assistant", None), (1, None, "user", "late"), (1, 0, "user", "other text"), (None, 0, "user", "a"), (None, 0, "user", "b"),
            (2, 0, None, "no role"), (2, 1, "robot", ""), (3, 0, "assistant", "x\n" * 3000), (4, 700, "user", "far turn")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(9)).withColumn("t", F.lit(1))
    table = chat.transcripts(turns)
    by = {(r.conv_id, r.part, r.extra is None): r for r in table.collect()}
    assert table.count() == 8 and by[1, 0, True].text.count("\n") == 1 and not by[2, 0, True].known
    out = chat.parse(table, chat.fit(table.where("known")), ["conv_id", "states"]).collect()
    assert all(len(r.roles) == len(r.states) == len(r.firsts) and r.firsts[0] and r.n_turns == r.rendered.count("<|end|>") for r in out)
    none = table.where("false")
    assert chat.parse(none, chat.fit(none), ["conv_id"]).count() == 0


# ------------------------------------------------------------------ pipeline

def test_stages_keep_the_columns(spark, tricky, empty):
    for docs in (tricky, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == stages.COLUMNS, name
            assert out.count() <= docs.count()
    left = {r.doc_id for r in stages.language_id(spark, tricky, SF).collect()}
    assert not left & {1, 2, 3, 8} and {4, 5, 6, 7, 9} <= left
    one = [r.doc_id for r in stages.simhash_near_dedup(spark, tricky.where("doc_id in (5, 6, 7, 9)"), SF).collect()]
    assert sorted(one) == [5, 9]


def test_pipeline_runs_stage_after_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
    by_hand = sorted((r.doc_id, r.start, bytes(r.ids)) for r in docs.collect())
    got = corpus_pipeline.run(spark, SF).collect()
    tokens = lambda rows: Counter({i: sum(len(x) for d, _, x in rows if d == i) for i in {d for d, _, _ in rows}})
    assert tokens(by_hand) == tokens([(r.doc_id, r.start, bytes(r.ids)) for r in got])
    for r in got:
        assert r.length * 4 == len(r.ids) and r.offset + r.length <= 2048


def test_every_learning_document_moves_the_classes(spark, monkeypatch):
    """With more learning documents than are points by themselves, each still counts, on any partitioning."""
    monkeypatch.setattr(mixing, "CLASS_POINTS", 8)
    texts = [f"{'der die das und ' if i % 3 else 'the of and to '}{chr(97 + i % 26) * 4} {i}" for i in range(60)]

    def classes(some, parts=2):
        rows = spark.createDataFrame([(i, 1, t.encode()) for i, t in enumerate(some)], "id long, role int, text binary").repartition(parts)
        return mixing.document_classes(rows)

    whole = classes(texts)
    assert whole.shape == (mixing.CLASSES, mixing.PAIR_SLOTS) and np.array_equal(whole, classes(texts, 5))
    for i in (3, 22, 41):
        assert not np.array_equal(whole, classes([*texts[:i], "xyzzy " * 9, *texts[i + 1:]]))


def test_each_learning_document_is_a_point_of_its_class(spark, monkeypatch):
    """More documents than are held on the driver: a centre is the mean of the documents that are nearest to it, not of groups of them."""
    monkeypatch.setattr(mixing, "CLASS_POINTS", 8)
    monkeypatch.setattr(mixing, "CLASS_BITS", 4)
    texts = [f"{['der die das und', 'the of and to', 'le la les des', 'el los las y'][i % 4]} {chr(97 + i % 7) * 5} {i % 3}".encode() for i in range(120)]
    rows = spark.createDataFrame([(i, 1, t) for i, t in enumerate(texts)], "id long, role int, text binary").repartition(3)
    found = mixing.document_classes(rows).astype(float)
    profiles = np.array([mixing.pair_profile(t) for t in texts]).astype(float)
    own = np.argmax(profiles @ found.T, axis=1)
    assert len(set(own)) > 4
    for k in set(own):
        mean = profiles[own == k].mean(axis=0)
        assert np.allclose(found[k], mean / np.linalg.norm(mean), atol=1e-4)


def test_nearest_centres_are_exact():
    """Near ties are told apart by whole numbers, in any batch."""
    rng = np.random.default_rng(3)
    c = rng.random((6, mixing.PAIR_SLOTS)).astype(np.float32)
    c /= np.linalg.norm(c, axis=1)[:, None]
    c[4], c[5] = c[1], c[0] + np.float32(1e-6)
    p = rng.random((90, mixing.PAIR_SLOTS))
    p = np.rint(p / np.linalg.norm(p, axis=1)[:, None] * mixing.PROFILE_STEPS).astype(np.float32)
    steps = [[int(x) for x in np.rint(row.astype(float) * mixing.CENTRE_STEPS)] for row in c]
    want = [max(range(6), key=lambda k: (sum(int(a) * b for a, b in zip(row, steps[k])), -k)) for row in p]
    assert mixing.nearest(p, c).tolist() == want
    assert [int(mixing.nearest(p[i:i + 1], c)[0]) for i in range(90)] == want
