"""The registered queries of this subpackage, with their production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm import bpe, chat, exact_dedup, itq, langid, linededup, mixing, packing, pii, simhash, variants, whitening, wordbpe
from canopy.llm.common import crc_mod, documents

MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
#: The same vocabulary as byte_bpe_50k.json, as ranks.
PACK_RANKS = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def _hex(c: str, digits: int) -> Column:
    return F.lower(F.lpad(F.hex(c), digits, "0"))


def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document under the model learned from those not held out."""
    return mixing.scores(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    docs = documents(spark, sf_dir)
    return simhash.near_duplicates(docs, shingle=3, max_bits=2).select(
        F.col("id").alias("doc_id"), _hex("fp", 16).alias("fingerprint"), "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence of at most 2048 tokens."""
    docs = documents(spark, sf_dir)
    pieces = packing.pack(docs, public_tokenizers.path(PACK_RANKS), public_tokenizers.PATTERN, end_id=1, window=2048)
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    found = pii.find(documents(spark, sf_dir), keep=["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the bytes they decode to, as digests."""
    ranks, pattern = public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN
    encoded = bpe.encode(documents(spark, sf_dir), ranks, pattern)
    return bpe.digests(encoded, ranks, pattern).withColumnRenamed("id", "doc_id")


def op6_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate component of every vector."""
    found = itq.near_duplicates(documents(spark, sf_dir, "embeddings"), threshold=0.98)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose template recurs in an earlier one."""
    return linededup.drop_recurring(documents(spark, sf_dir).select("doc_id", "text"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transcript of the conversations with the roles recovered and the turns rendered.

    The roles of conversations whose crc32(conv_id as text) mod 5 is 1 are not learned from.
    """
    table = chat.transcripts(documents(spark, sf_dir, "conversations")).withColumn("held_out", crc_mod("conv_id", 5) == 1)
    model = chat.fit(table.where("known and not held_out"))
    parsed = chat.parse(table, model, ["conv_id", "part", "extra", "held_out", "known", "states"])
    truth = F.transform("states", lambda s: F.get(F.array(*[F.lit(r) for r, _ in chat.STATES]), s))
    right = F.aggregate(F.zip_with("roles", truth, lambda a, b: (a == b).cast("long")), F.lit(0).cast("long"), lambda acc, x: acc + x)
    return parsed.select("conv_id", "part", "extra", "held_out", F.size("roles").cast("long").alias("n_lines"),
                         F.when(F.col("known"), right).alias("n_right"), "n_turns", "rendered")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language and calibrated probability of every document."""
    docs = documents(spark, sf_dir).withColumn("held_out", langid.held_out())
    return langid.identify(docs, keep=["held_out"]).withColumnRenamed("id", "doc_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of equal texts stays."""
    return exact_dedup.exact_groups(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the eight leading components, whitened.

    deviation is null where it is beyond a long (the operator's own is decimal).
    """
    white = whitening.whiten(documents(spark, sf_dir, "embeddings"), "vec_id", "embedding", components=8)
    return white.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text they decode to, as digests."""
    return wordbpe.round_trip_digests(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE)).withColumnRenamed("id", "doc_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the vocabulary with its near words, form and root."""
    return variants.spelling_variants(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_context_mixing": op1_context_mixing,
    "op2_simhash": op2_simhash,
    "op3_packing": op3_packing,
    "op4_pii": op4_pii,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_itq": op6_itq,
    "op7_line_dedup": op7_line_dedup,
    "op8_chat_format": op8_chat_format,
    "op9_language_id": op9_language_id,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_whitening": op11_whitening,
    "op12_word_bpe": op12_word_bpe,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL = {
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op13_spelling_variants": """
        WITH RECURSIVE steps AS (
            SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
                lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc_of),
        runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
            WHERE length(run) >= 5 GROUP BY ALL),
        hashed AS (
            SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
                string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
                lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END))),
                lambda c, b: xor(c // 256, crc_of[xor(c, b) % 256 + 1]))) AS h
            FROM runs, steps),
        words AS (
            SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word,
                   sum(times)::BIGINT AS n
            FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND n >= 3),
        shorter AS (
            SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest
            FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
        ranked AS (
            SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
                   row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near),
        forms AS (
            SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= 2 * w.n THEN r.other END AS form,
                   CASE WHEN r.other_n >= 2 * w.n THEN r.other_n END AS form_n
            FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1),
        walk AS (
            SELECT word, form AS at FROM forms WHERE form IS NOT NULL
            UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON walk.at = f.word WHERE f.form IS NOT NULL),
        ends AS (SELECT walk.word, walk.at FROM walk JOIN forms f ON walk.at = f.word WHERE f.form IS NULL)
        SELECT f.word, f.form, coalesce(e.at, f.word) AS root, f.n, f.n_near, f.form_n FROM forms f LEFT JOIN ends e USING (word)""",
}
