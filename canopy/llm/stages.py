"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir), with the columns of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm import langid, linededup, simhash
from canopy.llm import packing as packing_op
from canopy.llm import pii as pii_op
from canopy.llm.common import text_or_empty
from canopy.llm.queries import PACK_RANKS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: A document is rejected below this calibrated probability of its likeliest language.
MIN_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognisable language stay; null, empty and letterless texts go.

    Learns from the labelled documents that are not held out.  Without any
    label no language can be told, and every text with a letter stays.
    """
    learn = docs.where(~langid.held_out()).select(F.col("doc_id").alias("id"), text_or_empty("text").alias("text"), "lang")
    model = langid.fit(learn)
    if not model.languages:
        return docs.select(COLUMNS).where(text_or_empty("text").rlike(r"\p{L}"))
    return langid.predict(docs, model, keep=COLUMNS).where(F.col("score") >= MIN_LANGUAGE_SCORE).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go, but for the first document that holds them; n_chars follows the text.

    Every row stays, also one whose lines all go (an empty text); null text stays null.
    """
    out = linededup.drop_recurring(docs.select(COLUMNS))
    return out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: the one with the smallest doc_id.

    Repeated rows of that document become one row.  Rows without a doc_id
    cannot be told apart by it and stay.
    """
    groups = simhash.near_duplicates(docs, shingle=3, max_bits=2)
    stay = groups.where("id = component_id").select(F.col("id").alias("doc_id")).distinct()
    named = docs.select(COLUMNS).where("doc_id is not null").join(stay, "doc_id", "left_semi")
    return named.dropDuplicates(["doc_id"]).select(COLUMNS).union(docs.select(COLUMNS).where("doc_id is null"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in angle brackets; n_chars follows the text.

    Every row stays; null, empty and clean texts are unchanged, and equal texts have equal results.
    """
    found = pii_op.find(docs, keep=COLUMNS)
    clean = pii_op.redacted(F.col("text"), F.col("spans"))
    out = found.select("doc_id", clean.alias("text"), "lang", "source", "n_chars", F.size("spans").alias("n"))
    return out.select("doc_id", "text", "lang", "source", F.when(F.col("n") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences' pieces, with their token ids.

    Every row has a piece: null and empty texts are one token, the end id.
    Repeated rows and ties are packed each.  No document gives no pieces.
    """
    return packing_op.pack(docs, public_tokenizers.path(PACK_RANKS), public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")
