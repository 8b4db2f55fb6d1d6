"""Spelling variants of a corpus vocabulary, found with a bit-sliced position index.

Two words are near if they differ by one inserted, deleted or replaced code
point.  Let the shorter have m code points.  One error leaves either the
front half of its free part or the back half as it is, so near words share a
key: m, and the fixed front or back.  A key with more words than a block
takes is divided again the same way (the rest of its free part has the error,
so half of that is fixed as well), until the block is small or one code point
is free, which the alphabet bounds.  No pair is lost and no word meets more
than a bounded number of others.

Inside a task the rows of whole keys form blocks of words of m and m + 1 code
points.  For each position and letter a bitset over the block says which words
hold that letter there.  All words of m code points are looked up together:
three bitsets each, words without an error so far, words with one replaced code
point, and words with one more (read one position further), take one step per
code point, 64 words at a time.  A missing code point is the same link seen
from the other word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import text_or_empty, workers_ready, written

RUN = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_LENGTH = 5
MIN_COUNT = 3
#: One run in this many loses a code point (by hash), as its contract says; 0: none.
DELETE_ONE_IN = 97
#: Words in a block, and code points in a block (fewer words where they are long).
BLOCK_ROWS = 1024
BLOCK_CHARS = 1 << 22


def typed(doc: Column, run: Column, one_in: int) -> Column:
    """``run`` as it enters the vocabulary: one in ``one_in`` by crc32 of '<doc>:<run>' without one of its code points."""
    if not one_in:
        return run
    h = F.crc32(F.concat(doc, F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = DELETE_ONE_IN,
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points that occur at least ``min_count`` times.

    Counts are combined in every task before they are shuffled, so a frequent
    word is one row per task.
    """
    runs = F.regexp_extract_all(text_or_empty(text_col), F.lit(f"({RUN})"), F.lit(1))
    each = docs.select(text_or_empty(F.col(id_col).cast("string")).alias("doc"), F.explode(runs).alias("run"))
    each = each.where(F.length("run") >= min_length)
    each = each.select("doc", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    words = each.select(typed(F.col("doc"), F.col("run"), one_in).alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _halves(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, front, back) with the front half, or the back half, of their free part fixed too."""
    free = F.col("m") - F.col("front") - F.col("back")
    half = F.floor(free / 2).cast("int")
    kinds = F.array(F.struct((F.col("front") + half).alias("front"), F.col("back").alias("back")),
                    F.struct(F.col("front").alias("front"), (F.col("back") + free - half).alias("back")))
    return rows.select("word", "n", "m", F.explode(kinds).alias("k")).select("word", "n", "m", "k.front", "k.back")


def _keyed(rows: DataFrame) -> DataFrame:
    ends = [F.col("word").substr(F.lit(1), F.col("front")), F.col("word").substr(F.length("word") - F.col("back") + 1, F.col("back"))]
    return rows.withColumn("key", F.xxhash64("m", "front", "back", *ends))


def _limit(block_rows: int) -> Column:
    return F.greatest(F.lit(2), F.least(F.lit(block_rows), F.floor(F.lit(BLOCK_CHARS) / (F.col("m") + 1)))).cast("long")


def keyed_rows(words: DataFrame, block_rows: int = BLOCK_ROWS) -> Iterator[DataFrame]:
    """Tables (word, n, m, key) whose keys can hold a pair and are small enough; each divides the too large keys of the one before."""
    size = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).withColumns({"front": F.lit(0), "back": F.lit(0)})
    while True:
        rows = written(_keyed(_halves(rows)), "keys")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.length("word") == F.col("m")).alias("short"))
        sized = rows.join(sizes.where("short > 0 and rows > 1"), "key")
        large = (F.col("rows") > _limit(block_rows)) & (F.col("m") - F.col("front") - F.col("back") > 1)
        yield sized.where(~large).select("word", "n", "m", "key")
        rows = written(sized.where(large).select("word", "n", "m", "front", "back"), "large")
        if rows.isEmpty():
            return


def letter_sets(codes: np.ndarray, letters: int) -> np.ndarray:
    """[letter, word / 64] bitsets of one position: which words hold a letter there (codes: one per word, -1 after its end)."""
    hold = np.zeros((letters, -(-len(codes) // 64) * 64), bool)
    at = np.flatnonzero(codes >= 0)
    hold[codes[at], at] = True
    return np.packbits(hold, axis=1, bitorder="little").view(np.uint64)


def block_links(words: list[str], m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(short, other, longer): links of a block's words of ``m`` code points with its words of m or m + 1.

    A link of two words of m code points is found from either; ``longer`` marks the others.
    """
    sizes = np.array([len(w) for w in words])
    codes = np.full((len(words), m + 1), -1, np.int32)
    for i, w in enumerate(words):
        codes[i, :len(w)] = np.frombuffer(w.encode("utf-32-le"), np.uint32)
    held = codes >= 0
    letters, flat = np.unique(codes[held], return_inverse=True)
    codes[held] = flat
    short = np.flatnonzero(sizes == m)
    asked = codes[short]
    after = letter_sets(codes[:, 0], len(letters))
    none = np.full((len(short), after.shape[1]), ~np.uint64(0))  # words without an error so far
    changed = np.zeros_like(none)                                # words with one replaced code point
    more = np.zeros_like(none)                                   # words with one more, read one position further
    for i in range(m):
        at, after = after, letter_sets(codes[:, i + 1], len(letters))
        here, next_ = at[asked[:, i]], after[asked[:, i]]
        more = (more | none) & next_
        changed = (changed & here) | (none & ~here)
        none &= here
    more |= none
    size = np.zeros(after.shape[1] * 64, bool)
    size[:len(words)] = sizes == m
    same = np.packbits(size, bitorder="little").view(np.uint64)
    size[:len(words)] = sizes == m + 1
    longer = np.packbits(size, bitorder="little").view(np.uint64)
    out = []
    for found, mark in ((changed & same, False), (more & longer, True)):
        a, b = _set_bits(found)
        out.append((short[a], b, np.full(len(a), mark)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _set_bits(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bit) of every set bit."""
    row, word = np.nonzero(rows)
    bits = np.unpackbits(rows[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return row[at], word[at] * 64 + bit


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.Table]:
    """Rows sorted by (m, key) as tables of whole keys of one m, each of about ``block_rows`` rows or one key."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        m, key = held["m"].to_numpy(), held["key"].to_numpy()
        ends = [*(np.flatnonzero((m[1:] != m[:-1]) | (key[1:] != key[:-1])) + 1)]
        begin = last = 0
        for e in ends:
            if last > begin and (m[e - 1] != m[begin] or e - begin > block_rows):
                yield held.slice(begin, last - begin)
                begin = last
            last = e
        if last > begin:
            yield held.slice(begin, last - begin)
        held = held.slice(last)
    if held is not None and held.num_rows:
        yield held


def links(words: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(word, other, other_n): every ordered pair of near words of ``words`` (word, n; words distinct)."""
    workers_ready(words.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches, block_rows):
            text, n, key = t["word"].to_pylist(), t["n"].to_numpy(), t["key"].to_numpy()
            a, b, longer = block_links(text, t["m"][0].as_py())
            ok = key[a] == key[b]
            a, b, longer = a[ok], b[ok], longer[ok]
            a, b = np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])
            if len(a):
                names = pa.array(text)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b)), pa.array(n[b])], ["word", "other", "other_n"])

    found = None
    for rows in keyed_rows(words, block_rows):
        part = written(rows.repartition("m", "key").sortWithinPartitions("m", "key")
                       .mapInArrow(run, "word string, other string, other_n bigint"), "links")
        found = part if found is None else found.union(part)
    # a pair may share its front half and its back half, where one code point repeats
    return found.repartition("word").dropDuplicates(["word", "other"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the last word that forms lead to, in rounds that each double the steps.

    Forms must not run in circles.
    """
    step = written(forms.select("word", F.coalesce("form", "word").alias("root"), F.lit(True).alias("moved")), "root")
    while not step.where("moved").isEmpty():
        to = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(step.select("word", "root").join(to, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "root")
    return step.select("word", "root")


def group_variants(words: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of ``words`` (word, n; other columns are not read).

    ``form`` is the near word of the largest n (ties: the smallest in code
    point order) if that is at least twice the word's own n.  An empty table gives an empty result.
    """
    words = written(words.where("word is not null").select("word", F.col("n").cast("long").alias("n")), "words")
    best = links(words, block_rows).groupBy("word").agg(
        F.count(F.lit(1)).alias("near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    twice = -F.col("best.less") >= 2 * F.col("n")
    forms = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("near", F.lit(0).cast("long")).alias("n_near"),
        F.when(twice, F.col("best.other")).alias("form"), F.when(twice, -F.col("best.less")).alias("form_n")), "forms")
    return forms.join(roots(forms), "word")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = DELETE_ONE_IN,
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """The variants of the vocabulary of ``docs``.

    A null text has no words; a null id reads as the empty text.  Repeated
    rows count each.  Other columns of ``docs`` are not read, so their names cannot clash.
    """
    return group_variants(vocabulary(docs, id_col, text_col, one_in, min_length, min_count))
