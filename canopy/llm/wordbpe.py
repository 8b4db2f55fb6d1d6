"""BPE with word ends as a streaming transducer of bounded lookahead, and its inverse.

A text is read in slices.  A slice ends after a white space or, in a long run
without one, where neither the normaliser nor the pre-tokeniser can look
across.  Their pieces go to the merge stage, which keeps a buffer of symbols:
the merge list has a sufficient lookahead, a number of symbols that what comes
later cannot reach back over, so tokens further left are stable and are emitted
at once.  Memory does not grow with a text, nor with a pre-token of any length.

Why the lookahead suffices: work through the merges by rank on two texts of
which one prefix is common.  They agree up to a boundary ``a``, at first the
prefix's end.  Only a merge u + v with v starting at ``a`` can move it, to the
start of u.  The token at ``a`` has u on its left spine from then on (as u or as
uv), so a later merge moves ``a`` further only if its v has that u on its left
spine.  The longest such chain by falling place in the text and rising rank
bounds the reach; it is computed once from the merge list.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from canopy.llm.common import text_or_empty, workers_ready

#: Characters of a slice, and symbols added to the buffer before stable tokens leave it.
SLICE = 1 << 14
BUFFER = 1 << 12
#: Ids of a part of a text, about.
PART = 1 << 16
#: Pre-tokens whose ids a worker remembers in each of two generations, each of at most this many symbols.
REMEMBERED, SHORT = 200_000, 64
BLANKS = " \n\t\r"
BEYOND = re.compile("[^\\x00-\u02ff]")


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols that a change to the right can reach back over (merges by rank).

    Every part of a merge must be a single symbol or the result of an earlier
    merge, and results must differ; then tokens have one derivation each.
    """
    made: dict[str, tuple[str, str]] = {}
    size: dict[str, int] = {}
    reach: dict[str, int] = {}
    results = {u + v for u, v in merges}
    for u, v in merges:
        if u + v in made or any(part in results and part not in made for part in (u, v)):
            raise ValueError(f"the merge of {u!r} and {v!r} is not in order")
        made[u + v] = (u, v)
        size[u + v] = size.get(u, 1) + size.get(v, 1)
        spine, chain = v, reach.get(v, 0)
        while spine in made:
            spine = made[spine][0]
            chain = max(chain, reach.get(spine, 0))
        reach[u] = max(reach.get(u, 0), size.get(u, 1) + chain)
    return max(reach.values(), default=0)


@lru_cache(maxsize=1)
def _joining() -> frozenset[str]:
    """Characters that may compose with the one before although they are no combining marks."""
    seconds = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(chr(int(parts[1], 16)))
    return frozenset(seconds)


def byte_symbols() -> dict[int, str]:
    """The character each byte is written as: itself where it is visible in Latin-1, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return dict(sorted(({b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}).items()))


class Model:
    """A vocabulary file: its normaliser and pre-tokeniser, its merges and ids."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        places = range(max([*self.ids.values(), *self.added.values()]) + 1)
        tokens = {i: t.encode() for t, i in (self.ids | self.added).items()}
        self.written = [tokens.get(i, b"") for i in places]
        self.decimal = [str(i) for i in places]
        self.rank = {tuple(m): r for r, m in enumerate(model["merges"])}
        self.symbol = list(byte_symbols().values())
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    def pieces(self, text: str) -> tuple[str, list[str]]:
        """The normal form of ``text`` and its pre-tokens."""
        if not BEYOND.search(text):  # nothing composes or depends on the Unicode version below U+0300
            normal = text.lower()
            return normal, self.split.findall(normal)
        normal = self.tokenizer.normalizer.normalize_str(text)
        return normal, [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def symbols(self, piece: str) -> list[str]:
        """A symbol for each byte."""
        return [self.symbol[b] for b in piece.encode()]

    def plain(self) -> list[bytes]:
        """The bytes each id stands for, with a space for a word's end."""
        byte_of = {s: bytes([b]) for b, s in byte_symbols().items()}
        out = list(self.written)
        for t, i in self.ids.items():
            word = t.removesuffix(self.end) if self.end else t
            out[i] = b"".join(byte_of[s] for s in word) + b" " * (word != t)
        return out

    def one_piece(self, two: str) -> bool:
        """Are two characters (of normal form) part of one pre-token?"""
        return [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(two)] == [(0, 2)]

    def merged(self, symbols: list[str]) -> list[str]:
        """``symbols`` with all merges done: lowest rank first, leftmost first."""
        return self._merged_short(symbols) if len(symbols) <= SHORT else self._merged_long(symbols)

    def _merged_short(self, symbols: list[str]) -> list[str]:
        rank, none = self.rank.get, len(self.rank)
        ranks = [rank(p, none) for p in pairwise(symbols)]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            symbols[i] += symbols.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), none)
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), none)
        return symbols

    def _merged_long(self, symbols: list[str]) -> list[str]:
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, p) for i, p in enumerate(pairwise(symbols)) if (r := self.rank.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, (u, v) = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != u or j >= n or symbols[j] != v:
                continue
            symbols[i], symbols[j] = u + v, ""
            after[i] = j = after[j]
            if j < n:
                before[j] = i
                if (r := self.rank.get((u + v, symbols[j]))) is not None:
                    heapq.heappush(heap, (r, i, (u + v, symbols[j])))
            k = before[i]
            if k >= 0 and (r := self.rank.get((symbols[k], u + v))) is not None:
                heapq.heappush(heap, (r, k, (symbols[k], u + v)))
        return [s for s in symbols if s]


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """The model of a vocabulary file (one per worker)."""
    return Model(path)


def _cut(text: str, begin: int, end: int) -> int:
    """The last place in (begin, end] that neither normaliser nor pre-tokeniser looks across; ``begin`` if there is none."""
    for at in range(end, begin, -1):
        c = text[at]
        apart = "'" not in text[max(0, at - 3):at + 1] or text[max(0, at - 2):at + 2] == "''''"
        if apart and not unicodedata.combining(c) and c not in _joining():
            return at
    return begin


def slices(text: str, size: int = SLICE) -> Iterator[tuple[str, bool]]:
    """(slice, closed): ``text`` in order, in slices of about ``size``; a closed slice ends with a white space or the text."""
    begin = 0
    while begin < len(text):
        end = begin + size
        if end >= len(text):
            yield text[begin:], True
            return
        blank = max(text.rfind(b, begin, end) for b in BLANKS)
        if blank >= 0:
            yield text[begin:blank + 1], True
            begin = blank + 1
            continue
        at = _cut(text, begin, end)
        while at == begin and end + size < len(text):  # only marks that belong together
            end += size
            at = _cut(text, begin, end)
        if at == begin:
            at = len(text)
        yield text[begin:at], at == len(text)
        begin = at


class Encoder:
    """Ids of a text from its pieces, with a buffer of bounded size."""

    def __init__(self, m: Model, lookahead: int, buffer: int = BUFFER):
        self.m, self.lookahead, self.buffer = m, lookahead, buffer
        self.known: dict[str, list[int]] = {}   # recent words
        self.before: dict[str, list[int]] = {}  # words of the time before

    def _tail(self, symbols: list[str]) -> list[int]:
        """Ids of the rest of a pre-token."""
        symbols[-1] += self.m.end
        return [self.m.ids[t] for t in self.m.merged(symbols)]

    def _word(self, piece: str) -> list[int]:
        """Ids of a whole pre-token."""
        ids = self.before.get(piece)
        if ids is None:
            ids, held = self._stable([], self.m.symbols(piece)) if len(piece) > self.buffer else ([], self.m.symbols(piece))
            ids = ids + self._tail(held)
        if len(piece) <= SHORT:
            if len(self.known) >= REMEMBERED:
                self.known, self.before = {}, self.known
            self.known[piece] = ids
        return ids

    def _stable(self, held: list[str], more: list[str]) -> tuple[list[int], list[str]]:
        """(ids, rest) of an unfinished pre-token: tokens that nothing to come can change, and the symbols after them."""
        ids: list[int] = []
        for at in range(0, len(more), self.buffer):
            held = held + more[at:at + self.buffer]
            # the last symbol may yet become a word's end, so it belongs to what is to come
            limit, done = len(held) - 1 - self.lookahead, 0
            for t in self.m.merged(held[:-1]) if limit > 0 else []:
                if done + len(t) > limit:
                    break
                ids.append(self.m.ids[t])
                done += len(t)
            held = held[done:]
        return ids, held

    def encode(self, text: str, size: int = SLICE) -> Iterator[list[int]]:
        """Ids of ``text`` in order, in lists."""
        held: list[str] = []  # symbols of a pre-token that the slices so far have not ended
        last = ""
        for part, closed in slices(text, size):
            normal, pieces = self.m.pieces(part)
            out: list[int] = []
            if held and not self.m.one_piece(last + normal[:1]):
                out += self._tail(held)
                held = []
            whole = pieces if closed else pieces[:-1]
            if held and whole:
                ids, held = self._stable(held, self.m.symbols(whole[0]))
                out += ids + self._tail(held)
                held, whole = [], whole[1:]
            known = self.known
            for piece in whole:
                ids = known.get(piece)
                if ids is None:
                    ids = self._word(piece)
                    known = self.known
                out += ids
            if not closed and pieces:
                ids, held = self._stable(held, self.m.symbols(pieces[-1]))
                out += ids
            last = normal[-1:]
            yield out
        if held:
            yield self._tail(held)


@lru_cache(maxsize=2)
def encoder(path: str, lookahead: int, buffer: int) -> Encoder:
    """The encoder of a worker, which its tasks share: what it remembers changes no result."""
    return Encoder(model(path), lookahead, buffer)


class TextMachine:
    """Text of ids, given in parts: bytes of an unfinished character wait for the rest.

    As the vocabulary file decodes (it names no decoder): the tokens as they
    are written, with spaces between.  ``plain``: the bytes that tokens stand for,
    with a space for every word's end.
    """

    def __init__(self, m: Model, plain: bool = False):
        self.between = b"" if plain else b" "
        self.bytes_of = m.plain() if plain else m.written
        self.unfinished = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, ids: list[int]) -> str:
        raw = self.between.join([self.bytes_of[i] for i in ids])
        if self.begun and ids:
            raw = self.between + raw
        self.begun |= bool(ids)
        return self.unfinished.decode(raw)

    def end(self) -> str:
        self.begun = False
        return self.unfinished.decode(b"", True)


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _out(ids: pa.Array, rows: Iterator[tuple[int, tuple]], names: list[str], types: list[pa.DataType], most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Batches of rows (place of the id, values), each of about ``most`` bytes of the last value at most."""
    held, weight = [], 0

    def batch() -> pa.RecordBatch:
        at, values = zip(*held, strict=True)
        columns = [pa.array(c, t) for c, t in zip(zip(*values, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(at)), *columns], ["id", *names])

    for row in rows:
        held.append(row)
        weight += len(row[1][-1])
        if weight >= most:
            yield batch()
            held, weight = [], 0
    if held:
        yield batch()


def _encoding(path: str, added_as_text: bool, size: int, buffer: int, part: int) -> Step:
    """(id, text) -> (id, last, ids)."""
    lookahead = sufficient_lookahead(list(model(path).rank))

    def lists(text: str, enc: Encoder, added: re.Pattern | None) -> Iterator[list[int]]:
        for i, piece in enumerate(added.split(text) if added else [text]):
            if i % 2:
                yield [enc.m.added[piece]]
            else:
                yield from enc.encode(piece, size)

    def parts(text: str, enc: Encoder, added: re.Pattern | None) -> Iterator[tuple[bool, bytes]]:
        held: list[int] = []
        for ids in lists(text, enc, added):
            if len(held) >= part:
                yield False, np.array(held, "<u4").tobytes()
                held = []
            held += ids
        yield True, np.array(held, "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, lookahead, buffer)
        added = None if added_as_text or not enc.m.added else re.compile("(" + "|".join(map(re.escape, enc.m.added)) + ")")
        for b in batches:
            yield from _out(b["id"], ((at, p) for at, t in enumerate(b["text"]) for p in parts(t.as_py(), enc, added)), ["last", "ids"],
                            [pa.bool_(), pa.binary()])

    return run


def _decoding(path: str, plain: bool) -> Step:
    """(id, last, ids) -> (id, last, ids, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = TextMachine(model(path), plain)
        for b in batches:
            texts = []
            for ids, last in zip(b["ids"], b["last"].to_pylist(), strict=True):
                text = machine.feed(np.frombuffer(ids.as_py(), "<u4").tolist())
                texts.append(text + machine.end() if last else text)
            yield pa.RecordBatch.from_arrays([b["id"], b["last"], b["ids"], pa.array(texts, pa.string())], ["id", "last", "ids", "text"])

    return run


def _digesting(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(id, last, ids, text) -> (id, n_tokens, ids_sha256, decoded_sha256)."""
    n, ids_sha, text_sha, decimal = 0, hashlib.sha256(), hashlib.sha256(), model(path).decimal
    for b in batches:
        out = []
        for at, (last, raw, text) in enumerate(zip(b["last"].to_pylist(), b["ids"], b["text"], strict=True)):
            ids = np.frombuffer(raw.as_py(), "<u4").tolist()
            ids_sha.update(((" " if n and ids else "") + " ".join([decimal[i] for i in ids])).encode())
            text_sha.update(text.as_py().encode())
            n += len(ids)
            if last:
                out.append((at, (n, ids_sha.hexdigest(), text_sha.hexdigest())))
                n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
        yield from _out(b["id"], iter(out), ["n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.string(), pa.string()])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    workers_ready(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))


def _mapped(rows: DataFrame, step: Step, columns: str) -> DataFrame:
    return rows.mapInArrow(step, f"id {rows.schema['id'].dataType.simpleString()}, {columns}")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", added_as_text: bool = True,
           size: int = SLICE, buffer: int = BUFFER, part: int = PART) -> DataFrame:
    """(id, last, ids): the ids of every text of ``docs``, in parts of about ``part`` ids.

    ids are little-endian unsigned 32-bit.  The parts of a document follow
    each other in its partition and ``last`` marks its last one, so narrow
    steps read a document's parts in order.  A null text is empty: one part without
    ids.  Repeated rows are encoded each; other columns are not read.  Added
    tokens' strings are ordinary text unless ``added_as_text`` is false.
    """
    return _mapped(_rows(docs, id_col, text_col), _encoding(path, added_as_text, size, buffer, part), "last boolean, ids binary")


def decode(encoded: DataFrame, path: str, plain: bool = False) -> DataFrame:
    """(id, last, ids, text): the parts of encode() with the text each adds (``plain``: see TextMachine)."""
    workers_ready(encoded.sparkSession)
    return _mapped(encoded.select("id", "last", "ids"), _decoding(path, plain), "last boolean, ids binary, text string")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                       size: int = SLICE, buffer: int = BUFFER, part: int = PART) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode() and decode() of every text in one pass, hashed part by part.

    Hashed are the decimal ids joined by spaces, and the decoded text.  The three steps share a worker.
    """
    code, back = _encoding(path, True, size, buffer, part), _decoding(path, False)
    return _mapped(_rows(docs, id_col, text_col), lambda batches: _digesting(back(code(batches)), path),
                   "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
