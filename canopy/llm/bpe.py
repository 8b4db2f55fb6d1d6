"""Byte-level BPE of whole texts by overlapping chunks, and its inverse.

A text longer than ``chunk`` characters is cut into chunks that overlap.
Every chunk is pre-tokenised on its own, in parallel; where the pre-token
boundaries of two neighbours meet again inside their overlap, both agree from
there on, so the text is cut at the first such place.  The pieces between
these places are then encoded independently and their ids concatenated.  A
text with a run of characters so long that two neighbours never meet is
encoded as one piece.  Shorter texts are one chunk and need no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopy.llm.common import text_or_empty, workers_ready, written

CHUNK = 1 << 16
OVERLAP = 1 << 10
#: Characters after a boundary that its finding may have looked at.
LOOK_AHEAD = 3


@lru_cache(maxsize=2)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file (one per worker)."""
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def encode_ids(text: str, ranks: str, pattern: str) -> np.ndarray:
    """Ids of ``text``; the encoding has no special tokens, so none is looked for."""
    return encoding(ranks, pattern).encode_to_numpy(text, disallowed_special=())


def encode_text(text: str, ranks: str, pattern: str) -> bytes:
    """Ids of ``text`` as little-endian unsigned 32-bit integers."""
    return encode_ids(text, ranks, pattern).astype("<u4").tobytes()


def boundaries(text: str, pattern: str) -> list[int]:
    """Starts of the pre-tokens of ``text``, without those that more text could move."""
    last = len(text) - LOOK_AHEAD
    return [m.start() for m in _compiled(pattern).finditer(text) if m.start() <= last]


@lru_cache(maxsize=4)
def _compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


class Encoded(NamedTuple):
    """Ids of whole texts, and of the pieces of long ones.

    whole: id, ids.  pieces: id, row, no, ids (row names the document, no the
    piece in order of the text).  ids are little-endian unsigned 32-bit.
    """

    whole: DataFrame
    pieces: DataFrame


def chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(id, row, no, start, text): the overlapping chunks of ``long`` (id, text)."""
    rows = long.withColumn("row", F.monotonically_increasing_id())
    each = rows.select("id", "row", "text", F.posexplode(F.sequence(F.lit(0), F.length("text") - 1, F.lit(chunk))).alias("no", "start"))
    return each.select("id", "row", "no", "start", F.col("text").substr(F.col("start") + 1, F.lit(chunk + overlap)).alias("text"))


def stitched(parts: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(id, row, no, text): pieces of the texts in ``parts`` (of chunks()) that can be encoded on their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, tails = [], []
            for t, start in zip(b["text"], b["start"].to_pylist(), strict=True):
                at = boundaries(t.as_py(), pattern)
                heads.append([start + x for x in at if x < overlap])
                tails.append([start + x for x in at if x >= chunk])
            yield pa.RecordBatch.from_arrays([b["row"], b["no"], pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                                             ["row", "no", "head", "tail"])

    cuts = parts.select("row", "no", "start", "text").mapInArrow(run, "row bigint, no int, head array<int>, tail array<int>")
    order = Window.partitionBy("row").orderBy("no")
    whole = Window.partitionBy("row")
    meet = F.array_min(F.array_intersect(F.lag("tail").over(order), F.col("head")))
    cuts = cuts.select("row", "no", meet.alias("from"), F.max("no").over(whole).alias("last"))
    cuts = cuts.select("row", "no", "last", F.lead("from").over(order).alias("to"), "from",
                       (F.count("from").over(whole) == F.col("last")).alias("meets"))
    both = parts.join(cuts, ["row", "no"])
    begin = F.coalesce(F.col("from"), F.lit(0)) - F.col("start")
    piece = both.where("meets").select("id", "row", "no", F.col("text").substr(
        begin + 1, F.coalesce(F.col("to") - F.col("start") - begin, F.length("text"))).alias("text"))
    # No common boundary somewhere: the chunks' own parts are joined to one text again.
    own = both.where("not meets").select("id", "row", F.struct("no", F.col("text").substr(1, chunk).alias("text")).alias("part"))
    one = own.groupBy("id", "row").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return piece.union(one.select("id", "row", F.lit(0), F.array_join(F.col("parts.text"), "")))


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> Encoded:
    """Encode every text of ``docs``; null is the empty text (no ids).  Repeated rows are encoded each."""
    workers_ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = pa.array([encode_text(t.as_py(), ranks, pattern) for t in b["text"]], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], ids], [*b.schema.names[:-1], "ids"])

    whole = rows.where(F.length("text") <= chunk).mapInArrow(run, f"id {kind}, ids binary")
    parts = written(chunks(rows.where(F.length("text") > chunk), chunk, overlap), "chunks")
    pieces = stitched(parts, pattern, chunk, overlap).mapInArrow(run, f"id {kind}, row bigint, no int, ids binary")
    return Encoded(whole, pieces)


def decode(ids: bytes, ranks: str, pattern: str) -> bytes:
    """The bytes of ids (little-endian unsigned 32-bit): the raw bytes of its tokens, concatenated."""
    return encoding(ranks, pattern).decode_bytes(array("I", ids))


def digests(encoded: Encoded, ranks: str, pattern: str) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per document of ``encoded``.

    The pieces of a long text are hashed as a stream in order of the text;
    no task holds the ids of a whole long document.
    """
    kind = encoded.whole.schema["id"].dataType

    def each(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        """rows: (key, id, ids), sorted by key; a result for each key."""
        for _, group in groupby(rows, key=lambda r: r[0]):
            n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
            for _, doc, ids in group:
                raw = ids.as_py()
                n += len(raw) // 4
                ids_sha.update(raw)
                text_sha.update(decode(raw, ranks, pattern))
            yield doc, n, ids_sha.hexdigest(), text_sha.hexdigest()

    def out(results: Iterator[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        some = list(results)
        if some:
            doc, n, a, b = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in doc], id_type), pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                                             ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def of_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from out(each(zip(range(b.num_rows), b["id"], b["ids"], strict=True)), b["id"].type)

    def of_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = []

        def rows() -> Iterator[tuple]:
            for b in batches:
                types.append(b["id"].type)
                yield from zip(b["row"].to_pylist(), b["id"], b["ids"], strict=True)

        for r in each(rows()):
            yield from out(iter([r]), types[-1])

    schema = f"id {kind.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    ordered = encoded.pieces.repartition("row").sortWithinPartitions("row", "no")
    return encoded.whole.mapInArrow(of_whole, schema).union(ordered.mapInArrow(of_pieces, schema))
