"""Packing documents into fixed windows by lexical retrieval.

Documents are encoded once; every window a document fills by itself is cut
off its front where it is read and takes no part in any shuffle.  What remains
(less than one window per document) is dealt to shards of about ``shard_documents`` rows by a lexical key: the heaviest term
that another remainder has among its heaviest too.  Each shard keeps a BM25 inverted
index of its remainders, with document frequencies and lengths taken over the
whole corpus.  A seed document opens a window; the index ranks the unused
documents of the shard by their BM25 score for the seed's heaviest terms, and
they fill the window greedily.  The document that crosses the window's end is
cut there and its rest is the next seed, so windows have no gaps.  A shard's
last tokens go into sequences of power-of-two length, which need no padding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm.bpe import encoding
from canopy.llm.common import text_or_empty, workers_ready, written, written_at
from canopy.llm.latin import encoder
from canopy.llm.tables import counted
from canopy.session import drop_scratch

WINDOW = 2048
#: Remainders in one shard of the index, on average.
SHARD_DOCUMENTS = 1024
#: Slots of the corpus-wide table of document frequencies (hashed terms; 1 MB as 32-bit counts).
DF_SLOTS = 1 << 18
#: Terms of a seed that query the index: those that weigh most.
QUERY_TERMS = 16
#: Heaviest terms of a remainder that may become its key.
KEY_TERMS = 8
K1, B = 1.2, 0.75


@lru_cache(maxsize=2)
def _word_starts(ranks: str, pattern: str) -> np.ndarray:
    """Which ids open a new word (their bytes begin with white space); the end id, and any beyond the vocabulary, do too."""
    enc = encoding(ranks, pattern)
    return np.array([i >= enc.n_vocab or enc.decode_single_token_bytes(i)[:1].isspace() for i in range(1 << 16)])


#: Ids hashed at a time: the powers below reach so far.
SPAN = 1 << 16
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a random number per id, powers of the base, powers of its inverse), modulo 2^64."""
    numbers = np.random.default_rng(1).integers(0, 1 << 63, SPAN, np.uint64) * np.uint64(2) + np.uint64(1)
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.append(np.uint64(1), np.full(SPAN - 1, base % (1 << 64), np.uint64))) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
    return numbers, up, down


def terms(ids: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word of ``ids`` (unsigned 16-bit): a word is the run of ids up to the next one that opens a word.

    A word's hash is a polynomial of its ids: the powers go by place in the
    text, and the inverse power of the word's start takes the place out again.
    """
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64)
    if n > SPAN:  # cut at a word's start; a word longer than this counts as several
        starts = np.flatnonzero(opens[ids[1:SPAN]])
        cut = int(starts[-1]) + 1 if len(starts) else SPAN
        return np.concatenate([terms(ids[:cut], opens), terms(ids[cut:], opens)])
    numbers, up, down = _powers()
    at = np.flatnonzero(opens[ids])
    if not len(at) or at[0]:
        at = np.concatenate([[0], at])
    h = np.add.reduceat(numbers[ids] * up[:n], at) * down[at]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(30))


def slots(term: np.ndarray) -> np.ndarray:
    """Places of hashed terms in the table of document frequencies (its size is a power of two)."""
    return (term & np.uint64(DF_SLOTS - 1)).view(np.int64)


def distinct(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct terms in order, how often each stands) of a document."""
    found = np.sort(found)
    at = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, np.int64)
    return found[at], np.diff(np.append(at, len(found)))


def weights(term: np.ndarray, tf: np.ndarray, length: np.ndarray | float, df: np.ndarray, n_docs: int, mean_terms: float) -> np.ndarray:
    """BM25 weight of terms that stand ``tf`` times in documents of ``length`` terms."""
    seen = np.maximum(df[slots(term)], 1)
    idf = np.log1p(np.maximum(n_docs - seen + 0.5, 0.0) / (seen + 0.5))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(mean_terms, 1e-9)))


class Index:
    """BM25 inverted index of one shard."""

    def __init__(self, docs: list[np.ndarray], opens: np.ndarray, df: np.ndarray, n_docs: int, mean_terms: float) -> None:
        found = [np.sort(terms(d, opens)) for d in docs]
        length = np.array([len(t) for t in found], np.float64)
        owner = np.repeat(np.arange(len(docs)), length.astype(np.int64))
        flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
        new = np.ones(len(flat), bool)
        new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        tf = np.diff(np.append(at, len(flat)))
        self.term, self.doc = flat[at], owner[at]
        self.weight = weights(self.term, tf, length[self.doc], df, n_docs, mean_terms)
        self.begin = np.searchsorted(self.doc, np.arange(len(docs) + 1))
        by_term = np.argsort(self.term)  # a document stands once under a term, so the order among equals does not matter
        self.post_doc, self.post_weight = self.doc[by_term], self.weight[by_term]
        term = self.term[by_term]
        self.first = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
        self.slot = term[self.first]
        self.first = np.append(self.first, len(by_term))
        self.n = len(docs)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 score of every document of the shard for the seed's heaviest terms."""
        a, b = self.begin[seed], self.begin[seed + 1]
        mine = np.arange(a, b)
        if b - a > QUERY_TERMS:
            mine = mine[np.argpartition(-self.weight[a:b], QUERY_TERMS - 1)[:QUERY_TERMS]]
        slots = np.searchsorted(self.slot, self.term[mine])
        spans = [slice(self.first[s], self.first[s + 1]) for s in slots]
        if not spans:
            return np.zeros(self.n)
        docs = np.concatenate([self.post_doc[s] for s in spans])
        return np.bincount(docs, np.concatenate([self.post_weight[s] for s in spans]), self.n)


def order_by_retrieval(lengths: np.ndarray, index: Index, window: int) -> list[int]:
    """The order in which a shard's documents are laid out: each seed is followed by its best unused neighbours until its window is full."""
    unused = np.ones(len(lengths), bool)
    out: list[int] = []
    seed, fill = -1, 0
    while unused.any():
        if seed < 0:
            seed = int(np.argmax(unused))
            unused[seed] = False
            out.append(seed)
            fill += int(lengths[seed])
        left = np.flatnonzero(unused)
        ranked = left[np.argsort(-index.scores(seed)[left], kind="stable")]
        taken = min(int(np.searchsorted(np.cumsum(lengths[ranked]), window - fill)) + 1, len(ranked)) if fill < window else 0
        out += ranked[:taken].tolist()
        unused[ranked[:taken]] = False
        fill += int(lengths[ranked[:taken]].sum())
        # the document that crosses the end goes on as the next seed
        seed, fill = (out[-1], fill - window) if fill > window else (-1, 0)
    return out


def cuts(total: int, window: int) -> list[int]:
    """Lengths of the sequences that ``total`` tokens fill: whole windows, then powers of two."""
    out = [window] * (total // window)
    rest = total % window
    return out + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _encoded(rows: DataFrame, ranks: str, pattern: str, end_id: int) -> DataFrame:
    """(row, id, ids): ids as little-endian unsigned 16-bit integers, the end id included."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, pattern, end_id).encode
        for b in batches:
            ids = pa.array([i.tobytes() for i in encode(t.as_py() for t in b["text"].cast(pa.binary()))], pa.binary())
            yield pa.RecordBatch.from_arrays([b["row"], b["id"], ids], ["row", "id", "ids"])

    return rows.mapInArrow(run, f"row bigint, id {kind}, ids binary")


def dealt(rests: DataFrame, heaviest: Callable[[], Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]], shard_documents: int) -> DataFrame:
    """(row, shard) of the remainders ``rests`` (row, ids): those with the same key share a shard.

    ``heaviest`` makes, in a task, the function that gives a remainder's heaviest terms and their weights.  A key
    is counted exactly; only one with more than ``shard_documents`` rows is
    dealt to shards of its own, by the hash of the row.  Rows without a key
    (no term that another row proposes) go by the hash of the row as well.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed = heaviest()
        for b in batches:
            found = [keyed(np.frombuffer(i.as_py(), "<u2")) for i in b["ids"]]
            row = np.repeat(b["row"].to_numpy(), [len(t) for t, _ in found])
            term, weight = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(term.view(np.int64)), pa.array(weight)], ["row", "term", "weight"])

    proposed, path = written_at(rests.select("row", "ids").mapInArrow(run, "row bigint, term bigint, weight double"), "proposed")
    shared = proposed.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("term")
    keys = proposed.join(shared, "term").groupBy("row").agg(F.max_by("term", F.struct("weight", "term")).alias("key"))
    keys = written(rests.select("row").join(keys, "row", "left"), "keys")
    drop_scratch(rests.sparkSession, path)
    shards = max(1, -(-keys.count() // shard_documents))
    large, first = [], shards
    # at most one key in shard_documents rows
    for r in keys.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_documents).orderBy("key").toLocalIterator():
        parts = -(-r.n // shard_documents)
        large.append((r.key, first, parts))
        first += parts
    own = rests.sparkSession.createDataFrame(large, "key bigint, first bigint, parts bigint")
    among = F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(shards)))
    shard = F.when(F.col("first").isNotNull(), F.col("first") + among).when(F.col("key").isNull(), among).otherwise(F.pmod(F.xxhash64("key"), F.lit(shards)))
    return keys.join(F.broadcast(own), "key", "left").select("row", shard.cast("bigint").alias("shard"))


def _pieces(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    """Rows (id, start, length, ids, doc_tokens, sequence_id, offset) as a batch."""
    cols = list(zip(*rows, strict=True))
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in cols[0]], id_type), *[pa.array(c, t) for c, t in zip(cols[1:], types, strict=True)]],
                                      ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def pack(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
         window: int = WINDOW, shard_documents: int = SHARD_DOCUMENTS) -> DataFrame:
    """Pieces: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Every id of every document (its text's ids, then ``end_id``) lies in
    exactly one piece.  Null text is the empty text: one token, the end id.
    Repeated rows and ties are separate documents, ordered by their row;
    ``window`` must be a power of two and the vocabulary at most 65536 ids.
    """
    spark = docs.sparkSession
    workers_ready(spark)
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    encoded = written(_encoded(rows, ranks, pattern, end_id), "ids")
    n_docs = encoded.count()

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        """Document frequencies of hashed terms; the slots after them: all terms."""
        opens = _word_starts(ranks, pattern)
        table = np.zeros(DF_SLOTS + 1, np.int64)
        for b in batches:
            for x in b["ids"]:
                found = terms(np.frombuffer(x.as_py(), "<u2"), opens)
                table[-1] += len(found)
                table[slots(found)] += 1  # a slot named twice counts once
        return table

    table = counted(encoded.select("ids"), count, DF_SLOTS + 1)
    mean_terms = table[-1] / max(n_docs, 1)
    df = spark.sparkContext.broadcast(table[:-1].astype(np.float32))

    def heaviest(ids: np.ndarray, opens: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = terms(ids, opens)
        term, tf = distinct(found)
        weight = weights(term, tf, len(found), table, n_docs, mean_terms)
        if len(term) > KEY_TERMS:
            some = weight >= np.partition(weight, -KEY_TERMS)[-KEY_TERMS]
            term, weight = term[some], weight[some]
        top = np.lexsort((term, -weight))[:KEY_TERMS]
        return term[top], weight[top]

    whole = F.floor(F.length("ids") / (2 * window)).cast("int") * window  # tokens in windows of their own
    rests = encoded.withColumn("start", whole).select("row", "id", "start", F.col("ids").substr(2 * F.col("start") + 1, F.length("ids")).alias("ids")).where(F.length("ids") > 0)
    shard_of = dealt(rests, lambda: partial(heaviest, opens=_word_starts(ranks, pattern), table=df.value), shard_documents)
    rows = (rests.join(shard_of.hint("shuffle_hash"), "row")
            .repartition("shard").sortWithinPartitions("shard", "row").select("shard", "id", "start", "ids"))
    kind = encoded.schema["id"].dataType.simpleString()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows that documents fill by themselves, numbered downwards from -1 in each partition's range."""
        count = 0
        for b in batches:
            out: list[tuple] = []
            for part, doc, raw in zip(b["part"].to_pylist(), b["id"], b["ids"], strict=True):
                ids = np.frombuffer(raw.as_py(), "<u2")
                for at in range(0, len(ids) // window * window, window):
                    out.append((doc, at, window, ids[at:at + window].astype("<u4").tobytes(), len(ids), -1 - (part << 40) - count, 0))
                    count += 1
                    if len(out) >= 4096:
                        yield _pieces(out, b["id"].type)
                        out = []
            if out:
                yield _pieces(out, b["id"].type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opens = _word_starts(ranks, pattern)
        id_type, shard, count = None, None, 0
        rests: list[tuple[pa.Scalar, np.ndarray, int]] = []
        out: list[tuple] = []

        def close() -> None:
            """Lays out the remainders of the shard that ended."""
            nonlocal count
            docs = [r for _, r, _ in rests]
            lengths = np.array([len(r) for r in docs], np.int64)
            index = Index(docs, opens, df.value, n_docs, mean_terms)
            sizes = iter(cuts(int(lengths.sum()), window))
            size, offset = next(sizes, 0), 0
            for k in order_by_retrieval(lengths, index, window):
                doc, ids, start = rests[k]
                at = 0
                while at < len(ids):
                    n = min(len(ids) - at, size - offset)
                    out.append((doc, start + at, n, ids[at:at + n].astype("<u4").tobytes(), start + len(ids), (shard << 32) + count, offset))
                    at, offset = at + n, offset + n
                    if offset == size:
                        size, offset, count = next(sizes, 0), 0, count + 1
            rests.clear()

        for b in batches:
            id_type = b["id"].type
            for s, doc, start, raw in zip(b["shard"].to_pylist(), b["id"], b["start"].to_pylist(), b["ids"], strict=True):
                if s != shard:
                    if rests:
                        close()
                    shard, count = s, 0
                rests.append((doc, np.frombuffer(raw.as_py(), "<u2"), start))
                if len(out) >= 4096:
                    yield _pieces(out, id_type)
                    out.clear()
        if rests:
            close()
        if out:
            yield _pieces(out, id_type)

    columns = f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    long = encoded.where(F.length("ids") >= 2 * window).select("id", F.spark_partition_id().cast("long").alias("part"), "ids")
    return long.mapInArrow(windows, columns).union(rows.mapInArrow(run, columns))
