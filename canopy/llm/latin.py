"""Byte-level BPE of many texts at once, for one pre-tokenisation pattern.

Texts within U+0000 to U+02FF are cut into words with numpy, and words of up
to 15 bytes are looked up in a table of recent words: their bytes are the key,
so a word found is the word meant.  Words that are not in the table, and whole
texts of other alphabets, patterns or great length, go to the encoding itself.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

from canopy.llm.bpe import encode_ids, encoding

#: The pattern whose words ``words`` finds.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of characters beyond U+02FF.
BEYOND = re.compile(rb"[\xcc-\xff]")
#: A longer text (bytes) is encoded as a whole, shorter ones together up to about ``SPAN`` bytes.
LONG, SPAN = 1 << 20, 1 << 17
#: log2 of the words remembered (32 MB in a worker); the most bytes and ids of such a word.
BITS, SHORT, MOST = 20, 15, 7
#: Ends a text; in no UTF-8.
STOP = 0xFF
#: Kinds of characters; those that a blank before them joins come first.
LETTER, NUMBER, OTHER, SPACE, END = range(5)


@lru_cache(maxsize=1)
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Kinds of the code points up to U+02FF, and of bytes that stand alone."""
    kind = np.array([{"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x300)], np.uint8)
    kind[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = SPACE
    alone = np.full(256, END, np.uint8)
    alone[:128] = kind[:128]
    return kind, alone


def words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``raw`` where words start, and whether they are white space or a stop.

    ``raw`` holds UTF-8 texts up to U+02FF, each with ``STOP`` behind it (a word of its own), then 16 bytes of zeros.
    """
    points, alone = _kinds()
    n = len(raw) - 16
    kind = alone[raw[:n]]
    two = np.flatnonzero((raw[:n] >= 0xC0) & (raw[:n] != STOP))
    kind[two] = kind[two + 1] = points[(raw[two].astype(np.int64) & 31) << 6 | raw[two + 1] & 63]
    start = np.ones(n + 16, bool)
    start[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == END)
    # the last character of white space goes with what follows if it is a blank, else it is a word
    behind = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] < SPACE)) + 1
    last = raw[behind - 1]
    start[behind] = last != 0x20
    start[behind - np.where(last < 0x80, 1, 2)] = True
    # 's 't 'm 'd 're 've 'll
    quote = np.flatnonzero(raw[:n] == ord("'"))
    quote = quote[start[quote]]
    a, b = raw[quote + 1], raw[quote + 2]
    one = (a == ord("s")) | (a == ord("t")) | (a == ord("m")) | (a == ord("d"))
    more = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    start[quote[one | more] + 1] = False
    start[quote[one] + 2] = True
    start[quote[more] + 3] = True
    at = np.flatnonzero(start[:n])
    return at, kind[np.append(at[1:], n) - 1] >= SPACE


class Encoder:
    """Encodes texts, each with ``end_id`` behind it, and remembers the ids of recent words."""

    def __init__(self, ranks: str, pattern: str, end_id: int) -> None:
        self.ranks, self.pattern, self.end_id = ranks, pattern, end_id
        #: A row is a word: its bytes and length, then its ids and how many they are.
        self.table = np.zeros((1 << BITS, 4), np.uint64)
        # which bits of a word's first and second eight bytes belong to it, by its length
        self.inside = np.array([[(1 << 8 * min(max(n - skip, 0), 8)) - 1 for n in range(SHORT + 1)] for skip in (0, 8)], np.uint64)
        enc = encoding(ranks, pattern)
        self.size = np.array([len(x) for x in map(enc.decode_single_token_bytes, range(enc.n_vocab))])

    def encode(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """Ids (unsigned 16-bit) of every text (UTF-8), in order."""
        some: list[bytes] = []
        size = 0
        for t in texts:
            plain = self.pattern == PATTERN and len(t) <= LONG and (t.isascii() or not BEYOND.search(t))
            if plain:
                some.append(t)
                size += len(t)
            if some and (not plain or size >= SPAN):
                yield from self._together(some)
                some, size = [], 0
            if not plain:
                yield np.append(encode_ids(t.decode(), self.ranks, self.pattern), self.end_id).astype("<u2")
        if some:
            yield from self._together(some)

    def _together(self, texts: list[bytes]) -> list[np.ndarray]:
        buffer = bytes([STOP]).join([*texts, bytes(16)])
        raw = np.frombuffer(buffer, np.uint8)
        at, blank = words(raw)
        length = np.diff(np.append(at, len(raw) - 16))
        eight = np.ndarray(len(raw) - 7, "<u8", buffer, strides=(1,))  # the eight bytes from each place on
        short = np.minimum(length, SHORT)
        low = eight[at] & self.inside[0][short]
        high = eight[at + 8] & self.inside[1][short] | short.astype(np.uint64) << np.uint64(56)
        mixed = (low * np.uint64(0x9E3779B97F4A7C15) ^ high) * np.uint64(0xD6E8FEB86659FD93)
        slot = ((mixed ^ mixed >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).view(np.int64)
        rows = self.table[slot]
        known = (rows[:, 0] == low) & (rows[:, 1] == high) & (length <= SHORT)
        ids = rows[:, 2:].copy().view("<u2")
        new = np.flatnonzero(~known)
        flat, many = self._new(buffer, at[new], length[new], blank[new])
        count = ids[:, MOST].astype(np.int64)
        count[new] = many
        out = np.empty(int(count.sum()), "<u2")
        remembered = np.repeat(known, count)
        out[remembered] = ids[known][np.arange(MOST + 1) < count[known][:, None]]
        out[~remembered] = flat
        keep = (many <= MOST) & (length[new] <= SHORT)
        place, some = np.arange(MOST + 1), new[keep]
        row = np.zeros((len(some), MOST + 1), "<u2")
        row[place < many[keep][:, None]] = flat[np.repeat(keep, many)]
        row[:, MOST] = many[keep]
        self.table[slot[some]] = np.column_stack([low[some], high[some], row.view("<u8")])
        return np.split(out, np.cumsum(count)[raw[at] == STOP][:-1])

    def _new(self, buffer: bytes, at: np.ndarray, length: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at ``at``, one after the other, and how many each has.

        They are encoded as one text; a line feed, one id, parts a word from the one
        before unless a blank does.  White space and stops are encoded on their own.
        """
        enc = encoding(self.ranks, self.pattern)
        texts = [buffer[a:b] for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
        lone = {k: [self.end_id] if texts[k][0] == STOP else enc.encode_ordinary(texts[k].decode()) for k in np.flatnonzero(blank).tolist()}
        parted = [w if w[0] == 0x20 else b"\n" + w for k, w in enumerate(texts) if k not in lone]
        ids = enc.encode_to_numpy(b"".join(parted).decode(), disallowed_special=()).astype(np.int64)
        ends = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum([len(w) for w in parted])) + 1 if parted else np.zeros(0, np.int64)
        feeds = np.array([w[0] == 0x0A for w in parted], bool)
        some = np.diff(ends, prepend=0)
        ids = np.delete(ids, (ends - some)[feeds])
        many = np.empty(len(texts), np.int64)
        many[~blank] = some - feeds
        many[blank] = [len(x) for x in lone.values()]
        flat = np.empty(int(many.sum()), "<u2")
        of_lone = np.repeat(blank, many)
        flat[~of_lone] = ids
        flat[of_lone] = [i for x in lone.values() for i in x]
        return flat, many


@lru_cache(maxsize=2)
def encoder(ranks: str, pattern: str, end_id: int) -> Encoder:
    """The encoder of a worker, which its tasks share: what it remembers changes no result."""
    return Encoder(ranks, pattern, end_id)
