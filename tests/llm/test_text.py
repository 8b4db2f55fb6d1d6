"""BPE, packing, PII, line templates and language ID against brute force."""

import hashlib
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from canopy.llm import bpe, langid, latin, linededup, packing, pii
from canopy.llm.queries import MULTI_RANKS, PACK_RANKS
from llm_cases import empty, tricky  # noqa: F401

RANKS, PATTERN = public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN


def bpe_want(rows):
    enc = bpe.encoding(RANKS, PATTERN)
    out = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("chunk", "overlap"), [(bpe.CHUNK, bpe.OVERLAP), (50, 16), (7, 5)])
def test_bpe_round_trip(spark, tricky, chunk, overlap):
    """Whatever the chunks, the ids are those of the whole text; also with runs longer than the overlap."""
    more = [(100, "a" * 300), (101, " " * 90 + "x" + "\n" * 40), (102, "can't won't 'll 're" * 20), (103, "日本語のテキスト、" * 30), (104, "1234567890" * 30), (105, "!?" * 100)]
    texts = tricky.select("doc_id", F.when(F.length("text") > 5000, F.substring("text", 1, 5000 if chunk < 100 else 500_000)).otherwise(F.col("text")).alias("text"))
    docs = texts.union(spark.createDataFrame(more, "doc_id long, text string"))
    rows = [tuple(r) for r in docs.collect()]
    got = bpe.digests(bpe.encode(docs, RANKS, PATTERN, chunk=chunk, overlap=overlap), RANKS, PATTERN).collect()
    assert sorted((tuple(r) for r in got), key=repr) == bpe_want(rows)


def test_bpe_empty(empty):
    assert bpe.digests(bpe.encode(empty, RANKS, PATTERN), RANKS, PATTERN).count() == 0


def latin_texts():
    """Every character up to U+02FF beside the others' kinds, then random texts of those that decide where words start."""
    every = [f"a{c}b {c}{c} 1{c}  {c}\n{c} '{c}s" for c in map(chr, range(0x300))] + [chr(c) for c in range(0x300)]
    rng = random.Random(3)
    return [*every, "", "", "can't we'll they've I'm he'd you're 'second ''s a''t", *("".join(rng.choices("'" * 3 + " \n\t\x85\xa0\0stmdrevlaéß12½².,-\x1c", k=rng.randrange(60))) for _ in range(5000))]


def test_latin_words_are_the_patterns():
    assert latin.PATTERN == PATTERN
    for text in latin_texts():
        raw = np.frombuffer(text.encode() + bytes([latin.STOP]) + bytes(16), np.uint8)
        at, blank = latin.words(raw)
        found = [m.group() for m in bpe._compiled(PATTERN).finditer(text)]
        assert [raw[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)] == found
        assert blank.tolist() == [*(w.isspace() and not w.strip("\t\n\v\f\r \x85\xa0") for w in found), True]


@pytest.mark.parametrize("bits", [latin.BITS, 4])
def test_latin_encoder_gives_the_encodings_ids(monkeypatch, bits):
    """Also when words push each other out of the table, and for texts that go to the encoding whole."""
    monkeypatch.setattr(latin, "BITS", bits)
    monkeypatch.setattr(latin, "LONG", 3000)
    texts = [*latin_texts(), "日本語 a b", "x" * 4000, "many of " * 200, "ab" * 40 + " antidisestablishmentarianism " + "é" * 30, "\n" * 50 + " " * 50, "z\u0300"]
    ranks = public_tokenizers.path(PACK_RANKS)
    got = list(latin.Encoder(ranks, PATTERN, 1).encode(t.encode() for t in texts))
    want = [[*bpe.encode_ids(t, ranks, PATTERN).tolist(), 1] for t in texts]
    assert [g.tolist() for g in got] == want
    assert [g.tolist() for g in latin.Encoder(ranks, r"\w+|\W", 1).encode([b"it's 2 of them"])] == [[*bpe.encode_ids("it's 2 of them", ranks, r"\w+|\W").tolist(), 1]]


def test_latin_encoder_remembers_words(monkeypatch):
    """Only words that are new go to the encoding, however many texts hold them."""
    sent = []
    new = latin.Encoder._new
    monkeypatch.setattr(latin.Encoder, "_new", lambda self, buffer, at, *rest: (sent.append(len(at)), new(self, buffer, at, *rest))[1])
    encoder = latin.Encoder(public_tokenizers.path(PACK_RANKS), PATTERN, 1)
    for k in range(3):
        assert len(list(encoder.encode([b"the house and the garden of the house"] * 100 + [b"word%d" % k]))) == 101
    assert sent[1:] == [1, 1]  # the number alone


def check_pieces(pieces, rows, window):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    want = Counter((i, array("I", [*tok.encode(t or "", add_special_tokens=False).ids, 1]).tobytes()) for i, t in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert r.length * 4 == len(r.ids)
        by_doc[r.id, r.doc_tokens].append(r)
        by_sequence[r.sequence_id].append(r)
    if len({i for i, _ in rows}) == len(rows):
        got = Counter((k[0], b"".join(bytes(r.ids) for r in sorted(v, key=lambda r: r.start))) for k, v in by_doc.items())
        assert got == want
        for (_, n), v in by_doc.items():
            v.sort(key=lambda r: r.start)
            assert [r.start for r in v] == list(np.cumsum([0, *[r.length for r in v]])[:-1]) and sum(r.length for r in v) == n
    assert sum(r.length for r in pieces) == sum(len(ids) // 4 * n for (_, ids), n in want.items())
    for v in by_sequence.values():
        v.sort(key=lambda r: r.offset)
        assert [r.offset for r in v] == list(np.cumsum([0, *[r.length for r in v]])[:-1])
        total = sum(r.length for r in v)
        assert total <= window and total & (total - 1) == 0  # no padding at all
    return by_sequence


def test_packing_edges(tricky, empty):
    rows = [(r.doc_id, r.text) for r in tricky.select("doc_id", "text").collect()]
    check_pieces(packing.pack(tricky, public_tokenizers.path(PACK_RANKS), PATTERN).collect(), rows, 2048)
    assert packing.pack(empty, public_tokenizers.path(PACK_RANKS), PATTERN).count() == 0


def test_packing_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sequences = check_pieces(packing.pack(docs, public_tokenizers.path(PACK_RANKS), PATTERN, window=512, shard_documents=64).collect(), rows, 512)
    assert np.mean([sum(r.length for r in v) == 512 for v in sequences.values()]) > 0.9


def test_retrieval_puts_related_documents_together():
    """Two topics, dealt alternately: a seed's window takes its own topic first."""
    ids = {w: k for k, w in enumerate(["cat", "dog", "fur", "paw", "tax", "law", "fee", "due"])}
    opens = np.ones(10, bool)
    topics = [["cat", "dog", "fur", "paw"], ["tax", "law", "fee", "due"]]
    docs = [np.array([ids[w] for w in topics[i % 2]] * 4) for i in range(8)]
    df = np.full(packing.DF_SLOTS, 4)
    index = packing.Index(docs, opens, df, 100, 16.0)
    order = packing.order_by_retrieval(np.array([16] * 8), index, 64)
    assert sorted(order) == list(range(8)) and order[:4] == [0, 2, 4, 6]
    by_hand = index.scores(0)
    assert (by_hand[[2, 4, 6]] > 0).all() and (by_hand[[1, 3, 5, 7]] == 0).all()


@pytest.mark.parametrize("n", [200, 2000])
def test_related_documents_share_a_shard(spark, n):
    """Pairs with a few words of their own are dealt to one shard, however many shards there are."""
    rows = [(2 * k + j, f"the house of {k} is here and there " + " ".join(f"topic{k}x{x}" for x in range(4)) + f" only{2 * k + j}") for k in range(n // 2) for j in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    shard = {r.id: r.sequence_id >> 32 for r in packing.pack(docs, public_tokenizers.path(PACK_RANKS), PATTERN, window=128, shard_documents=20).collect()}
    assert len(set(shard.values())) > n // 40 and np.mean([shard[2 * k] == shard[2 * k + 1] for k in range(n // 2)]) > 0.9


def test_large_keys_get_shards_of_their_own(spark):
    """Many copies do not overfill a shard."""
    rows = [(i, "one text that is the same in every row" if i % 2 else f"own text {i}") for i in range(1000)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path(PACK_RANKS), PATTERN, window=128, shard_documents=50).collect()
    check_pieces(pieces, rows, 128)
    copies = Counter(r.sequence_id >> 32 for r in pieces if r.id % 2 and r.start == 0)
    assert len(copies) >= 10 and max(copies.values()) <= 100


def test_cuts():
    assert packing.cuts(5000, 2048) == [2048, 2048, 512, 256, 128, 8] and packing.cuts(0, 8) == []


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def base_want(text):
    found = sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if good(kind, m[0]))
    return ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in found)


PII_TEXTS = [
    "mail a@b.c. and a@b.c_d@e.f then x@y then .@a.b, 😀 u.v%+w-@h-i.j.k.l", "1.2.3.4.5.6.7.8 300.1.1.1 255.255.255.255 0256.1.1.1 00255.1.2.3 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 5 4 3", "+1 (777) 555-4324 +12 +1 2 3 +49.30.1234567- +1234567890123456",
    "+1 +2 (777) 555-43240 a@b.co+1 777 555 4324", "1" * 400, "a" * 5000 + "@", ("x" * 50 + ".") * 100 + "@q.r", "1 2 3 " * 500, "a." * 3000 + "@" + "b." * 3000 + "c",
    "é@a.b ü1.2.3.4é +1é 12345678901", "no data here", "192.168.0.1:8080 v1.2.3.4-5", "12 34 56 78 90 12 34 52 9",
]


def test_pii_base(spark, tricky, empty):
    more = spark.createDataFrame(list(enumerate(PII_TEXTS, 100)), "doc_id long, text string")
    docs = tricky.select("doc_id", "text").union(more)
    for r in pii.find(docs, keep=["text"]).select("text", pii.joined(F.col("base")).alias("b"), pii.joined(F.col("spans")).alias("s")).collect():
        assert r.b == base_want(r.text)
        assert set(filter(None, r.b.split(","))) <= set(r.s.split(","))
    assert pii.find(empty, keep=["doc_id"]).count() == 0


def test_pii_bootstrap_finds_unseen(spark):
    """Seeds behind one phrase teach it; what the base pattern misses behind it is found, the same form elsewhere is not."""
    rows = [(i, f"notes {i} please call me on +1 (2{i:02d}) 555-{1000 + i} today") for i in range(12)]
    rows += [(50, "please call me on 555-0199 or so"), (51, "version 555-0188 was built"), (52, "size 10 of 20 and 555-0177 items")]
    got = {r.doc_id: r.s for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), keep=["doc_id"]).select("doc_id", pii.joined(F.col("spans")).alias("s")).collect()}
    assert got[50] == "phone:18:26" and got[51] == "" and got[52] == ""
    assert all(got[i].startswith("phone:") and "," not in got[i] for i in range(12))


def test_pii_redaction(spark):
    docs = spark.createDataFrame([(1, "😀 a@b.c and 1.2.3.4!"), (2, None), (3, "none")], "doc_id long, text string")
    got = pii.find(docs, keep=["doc_id", "text"]).select("doc_id", pii.redacted(F.col("text"), F.col("spans"))).collect()
    assert {tuple(r) for r in got} == {(1, "😀 <email> and <ip>!"), (2, None), (3, "none")}


def line_want(rows, similarity=linededup.SIMILARITY, evidence=linededup.EVIDENCE):
    """The templates' rule, in plain loops."""
    def mask(x):
        return re.sub(r"(?<!\S)\S*[0-9]\S*", "<*>", x).strip(" ")
    docs = defaultdict(list)
    for i, t in rows:
        for m in {mask(x) for x in (t or "").split("\n")} - {""}:
            docs[m].append(i)
    enough = lambda n, c: n > 1 and (n - 1) * (c - linededup.DEPTH) >= evidence
    const = lambda m: sum(t != "<*>" for t in m.split(" "))
    first = {m: min(d) for m, d in docs.items() if enough(len(d), const(m))}
    leaves = defaultdict(list)
    for m in docs:
        leaves[len(m.split(" ")), tuple(m.split(" ")[:linededup.DEPTH])].append(m)
    for ms in leaves.values():
        if len(ms) < linededup.MIN_VARIANTS or not enough(sum(len(docs[m]) for m in ms), max(map(const, ms))):
            continue
        template = []
        for pos in range(len(ms[0].split(" "))):
            c = Counter()
            for m in ms:
                c[m.split(" ")[pos]] += len(docs[m])
            template.append(max(c.items(), key=lambda x: (x[1], x[0]))[0])
        held = {m: sum(a == b for a, b in zip(m.split(" "), template, strict=True)) for m in ms}
        inst = [m for m in ms if held[m] >= similarity * len(template)]
        ids = [i for m in inst for i in docs[m]]
        if len(inst) > 1 and min(ids) < max(ids) and enough(len(ids), min(min(held[m], const(m)) for m in inst)):
            for m in inst:
                first[m] = min(first.get(m, 1 << 60), min(ids))
    return [(i, t if t is None else "\n".join(x for x in t.split("\n") if first.get(mask(x), i) == i)) for i, t in rows]


def test_line_templates(spark):
    passage = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    names = ["anna", "bert", "carl", "dora", "emil"]
    rows = [(i, f"own line alpha{'x' * i} beta\nPosted by {names[i % 5]} on the board at 1{i}:00 in the morning of this long and quiet day\nOf.\n\nLast updated on 2024-01-{i:02d}") for i in range(20)]
    rows += [(30, passage), (31, f"before\n{passage}\nafter"), (32, None), (33, ""), (34, "\n\n"), (35, "a unique line of its own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = linededup.drop_recurring(docs)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted(line_want(rows))
    out = {r.doc_id: r for r in got.collect()}
    assert out[31].text == "before\nafter" and out[30].text == passage and out[31].n_dropped == 1 and out[32].n_lines == 0
    assert "Posted" in out[0].text and not any("Posted" in out[i].text for i in range(1, 20))
    assert all("Of." in out[i].text and "own line" in out[i].text for i in range(20))


def test_short_lines_and_lines_without_spaces(spark):
    """Exact repeats count by their characters: menu words, tab-separated lines and a passage without spaces, with a digit too."""
    passage = "これは空白のない長い段落であり、多くの文書に同じ形で現れる。" * 4
    rows = [(i, f"Read more\nAdvertisement\na\tb\tc\td\te\tf\tg\th\nown{'x' * i}") for i in range(20)]
    rows += [(i, f"{passage}\n{passage}3{passage}\nno{'y' * i}") for i in (30, 31)] + [(40, f"{passage}4"), (41, "No")]
    got = {r.doc_id: r.text for r in linededup.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == f"own{'x' * i}" for i in range(1, 20)) and got[0] == rows[0][1] and got[30] == rows[20][1]
    assert got[31] == f"no{'y' * 31}" and got[40] == f"{passage}4" and got[41] == "No"


def test_line_edges(tricky, empty):
    out = linededup.drop_recurring(tricky)
    assert out.columns == [*tricky.columns, "n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((r.doc_id, r.text) for r in tricky.collect())
    assert linededup.drop_recurring(empty).count() == 0


def test_language_id(spark, tricky, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs, keep=["lang"]).collect()
    held = {r.doc_id for r in docs.select("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang == r.lang_pred for r in got if r.id in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    odd = langid.identify(tricky, keep=["text"]).collect()
    assert len(odd) == tricky.count()
    for r in odd:
        assert (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or "")) and 0 <= r.score <= 1
    assert langid.identify(empty).count() == 0
    unlabelled = tricky.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_language_features_cover_every_gram():
    text = "abc" * 700 + "é"
    whole = np.concatenate(list(langid.ngram_slots(text)))
    span, langid.SPAN = langid.SPAN, 100
    try:
        parts = np.concatenate(list(langid.ngram_slots(text)))
    finally:
        langid.SPAN = span
    assert sorted(whole) == sorted(parts) and len(whole) == 3 * (len(text) + 2) - 3
