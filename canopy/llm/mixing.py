"""Language-model scoring by logistic context mixing over hashed contexts.

The model is a probability of a text's token sequence (words, then one end).
A word is coded bit by bit along a Huffman code of its bytes.  Several
predictors each look up a bit's counts in a hashed table, under their own
context: the word so far, the word so far with the document's class, and the
class with the last two and three bytes.  Their logits are added with
weights that the code's node selects (the gate), and a table of outcomes per
node and predicted level refines the sum.  Both adapt online, mini-batch by
mini-batch, to words of learning documents that the tables have not counted.
A word's probability so coded is mixed with its exact share of the class in
the corpus, with its share of the document so far, and with what follows the
word before and the two words before, from exact counts of all pairs and
triples of words in learning documents.  The weight of each is gated (by the
class, by the place in the document, by how often the context was seen) and
fitted on the documents that teach.  A document's class is the nearest of a
few centres of byte-pair frequencies; the score pays for naming it, so it
stays a probability.

All weights are learned once for the corpus: online in buckets of words that
their hashes fill and order, averaged, and otherwise from whole counts.  So a
text's score is the same on any partitioning.

Spark steps: each task turns its documents into blocks (distinct words, their
contexts, and each document's sequence of them) that are written once.  The
distinct (word, class) pairs of the blocks are merged in parts of the range of
their hashes; the merged parts are what bits are counted in, weights are
learned on and words are coded in, each word once.  Every block gets the
figures of its words, and likewise the counts of its pairs and triples of
words, back as sorted arrays, and is scored on its own in order of the text.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import crc_mod, text_or_empty, workers_ready, written, written_at
from canopy.llm.tables import counted
from canopy.session import drop_scratch

#: A block ends at this many documents or bytes (a longer document is a block by itself).
BLOCK_DOCUMENTS = 4096
BLOCK_BYTES = 4 << 20
#: Document classes, learned from all learning documents: on the driver up to so many, beyond in tasks, from starts among 2^CLASS_BITS groups of them.
CLASSES = 16
CLASS_POINTS, CLASS_BITS = 4000, 8
#: Rounds of k-means.
CLASS_ROUNDS = 12
#: Steps of a profile's entries where they are added up, and of a centre's where it is compared with them.
PROFILE_STEPS, CENTRE_STEPS = (1 << 16) - 1, 1 << 20
#: Profiles of one row of their table: their sums are exact as single floats.
PROFILE_ROWS = 128
#: How much nearer the nearest centre is, at least, where single floats (off by 1e-4 at most) tell it.
CLASS_MARGIN = 3e-4
#: Hashed byte pairs that describe a document for its class.
PAIR_SLOTS = 1024
#: Weight of the corpus share in a class's word share, as a number of tokens.
PRIOR_TOKENS = 200.0
#: Slots (as powers of two) of the predictors' tables: word so far, with class, class and last 2 and 3 bytes.
TABLE_BITS = (20, 20, 19, 20)
#: One of so many learning documents teaches the weights instead of the tables.
WEIGHT_SHARE = 8
#: Words are coded (and learned from) in batches of so many, fewer from so many bytes on.
BATCH, BATCH_BYTES = 4096, 1 << 17
#: The weights are learned in buckets of about so many distinct words of teaching documents, then averaged.
BUCKET_PAIRS = 1 << 17
#: Weights of logits in eighths, before they are learned, and their steps when they are averaged.
FIRST_WEIGHT, WEIGHT_STEPS = 1.2 / len(TABLE_BITS) / 8, 1 << 18
#: Steps of the summed logit: in a unit, and on either side of zero; the refining table has one level per unit and a half.
UNIT, REACH = 16, 192
COARSE = 24
SLICE = 1 << 20
#: Learning tokens for one part of the words', pairs' and triples' hashes.
PART_TOKENS = 1 << 19
#: Hashes of pairs and triples have so many bits more than the number of learning tokens.
SPARE_BITS = 17
#: A context's weight before it is fitted is n / (n + CONTEXT_PRIOR), counted as WEIGHT_TOKENS teaching tokens.
CONTEXT_PRIOR = 20.0
WEIGHT_TOKENS = 50.0
#: Gates of a fitted weight (powers of two of a count), and steps of likelihood ratios in its tally: eighths of a nat up to 60.
GATES = 65
RATIO_STEPS, RATIO_REACH = 8, 480
RATIOS = 2 * RATIO_REACH + 2

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_END_SYMBOL, _WORD_END = 0x0A, 0x20
_END_TOKEN = np.uint64(0x5851F42D4C957F2D) & ~np.uint64(CLASSES - 1)
_START = np.uint64(0x14057B7EF767814F)


def _random_bytes() -> np.ndarray:
    x = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return np.where(_SPACE, np.uint64(0), x)


_BYTE_HASH = _random_bytes()
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n - 1, 0), _PRIME))])


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def tokens(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, hash) of the words of a lower-cased UTF-8 text."""
    arr = np.frombuffer(data, np.uint8)
    space = np.concatenate([[True], _SPACE[arr], [True]])
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    lens = np.flatnonzero(~space[:-1] & space[1:]) - starts
    if not len(starts):
        return starts, lens, np.zeros(0, np.uint64)
    # the byte's place in its word; white space between words hashes to zero
    place = np.arange(starts[0], len(arr)) - np.repeat(starts, np.diff(np.append(starts, len(arr))))
    power = _powers(int(lens.max()) + 1)
    with np.errstate(over="ignore"):
        h = np.add.reduceat(_BYTE_HASH[arr[starts[0]:]] * power[np.minimum(place, len(power) - 1)], starts - starts[0])
    return starts, lens, _mixed(h) & ~np.uint64(CLASSES - 1)


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte: all lowest bytes first."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def _unplaned(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


@dataclass
class Block:
    """Documents as sequences of (word, document class) pairs; pairs are distinct in a block."""

    pair_word: np.ndarray  # index of the pair's word
    pair_class: np.ndarray
    counted: np.ndarray  # occurrences of each pair in documents the tables count
    taught: np.ndarray  # occurrences of each pair in documents that teach the weights
    sequence: np.ndarray  # pair of each token, document after document
    doc_tokens: np.ndarray
    text: bytes  # the distinct words' bytes
    lens: np.ndarray
    bytes_learned: np.ndarray  # occurrences of each byte (word ends and text ends included) in learning documents
    class_learned: np.ndarray  # tokens of each class in learning documents
    _hashes: np.ndarray | None = None

    PARTS = (("pair_word", "<u4"), ("pair_class", "u1"), ("counted", "<u4"), ("taught", "<u4"), ("sequence", "<u4"),
             ("doc_tokens", "<u4"), ("lens", "<u4"), ("bytes_learned", "<i8"), ("class_learned", "<i8"))
    #: What the counting of bits reads.
    COUNTING = ("pair_word", "pair_class", "counted", "lens", "text")

    @staticmethod
    def build(docs: list[tuple[bytes, int, int]]) -> Block:
        """docs: (lower-cased text, role, class); role 0 is only scored, 1 counted, 2 teaches the weights."""
        keys, doc_tokens, pieces, at = [], [], [], 0
        for some in _slices(docs):
            data = b" ".join(text for text, _, _ in some)
            starts, lens, h = tokens(data)
            bounds = np.cumsum([len(text) + 1 for text, _, _ in some])
            per_doc = np.diff(np.searchsorted(starts, bounds), prepend=0)
            # one end token after each document's words
            ends = np.cumsum(per_doc)
            h = np.insert(h, ends, _END_TOKEN)
            role, cls = (np.repeat(x, per_doc + 1) for x in np.array([d[1:] for d in some], np.uint8).T)
            keys.append((h, np.insert(starts + at, ends, 0).astype(np.uint32), np.insert(lens, ends, 0).astype(np.uint32), role, cls))
            doc_tokens.append(per_doc + 1)
            pieces.append(data)
            at += len(data)
        h, where, lens, role, cls = (np.concatenate(x) for x in zip(*keys, strict=True))
        del keys
        h |= cls
        pairs, at_pair, sequence = np.unique(h, return_index=True, return_inverse=True)
        # pairs that are frequent in learning documents get small numbers, which compress well
        del h, cls
        order = np.argsort(-np.bincount(sequence[role > 0], minlength=len(pairs)), kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        pairs, at_pair, sequence = pairs[order], at_pair[order], place[sequence]
        words, word_first, pair_word = np.unique(pairs & ~np.uint64(CLASSES - 1), return_index=True, return_inverse=True)
        source, text = at_pair[word_first], b"".join(pieces)
        spelled = b"".join([text[a:a + k] for a, k in zip(where[source].tolist(), lens[source].tolist(), strict=True)])
        times = [np.bincount(sequence[role == r], minlength=len(pairs)) for r in (1, 2)]
        pair_class = (pairs & np.uint64(CLASSES - 1)).astype(np.uint8)
        learned = np.bincount(pair_word, times[0] + times[1], len(words)).astype(np.int64)
        seen = np.bincount(np.frombuffer(spelled, np.uint8), np.repeat(learned, lens[source]), 256).astype(np.int64)
        seen[_END_SYMBOL] += learned[words == _END_TOKEN].sum()
        seen[_WORD_END] += learned[words != _END_TOKEN].sum()
        return Block(pair_word, pair_class, *times, sequence, np.concatenate(doc_tokens), spelled, lens[source],
                     seen, np.bincount(pair_class, times[0] + times[1], CLASSES).astype(np.int64))

    def dump(self) -> dict[str, bytes]:
        parts = {k: _planes(getattr(self, k).astype(t)) for k, t in self.PARTS} | {"text": self.text}
        return {k: zstandard.compress(v, 1) for k, v in parts.items()}

    def word_hashes(self) -> np.ndarray:
        """The hash of each distinct word (the end, spelled as nothing, has its own)."""
        if self._hashes is None:
            self._hashes = np.full(len(self.lens), _END_TOKEN)
            ends = np.cumsum(self.lens.astype(np.int64))
            pieces = [self.text[e - n:e] for e, n in zip(ends.tolist(), self.lens.tolist(), strict=True) if n]
            self._hashes[self.lens > 0] = tokens(b" ".join(pieces))[2]
        return self._hashes

    def pair_hashes(self) -> np.ndarray:
        """The hash of each pair: its word's, with the class in the lowest bits."""
        return self.word_hashes()[self.pair_word] | self.pair_class.astype(np.uint64)

    @staticmethod
    def load(parts: dict[str, bytes]) -> Block:
        """A block of ``parts``; those left out are empty."""
        raw = {k: zstandard.decompress(v) for k, v in parts.items()}
        return Block(text=raw.get("text", b""), **{k: _unplaned(raw.get(k, b""), t) for k, t in Block.PARTS})


_FIELDS = [k for k, _ in Block.PARTS] + ["text"]


def _slices(docs: list[tuple[bytes, int, int]]) -> Iterator[list[tuple[bytes, int, int]]]:
    some, size = [], 0
    for d in docs:
        some.append(d)
        size += len(d[0])
        if size >= SLICE:
            yield some
            some, size = [], 0
    if some:
        yield some


def pair_profile(text: bytes) -> np.ndarray:
    """Unit vector of the square roots of a text's hashed byte-pair frequencies."""
    arr = np.frombuffer(text, np.uint8).astype(np.uint32)
    n = np.bincount(((arr[:-1] * np.uint32(0x9E3779B1) + arr[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(22)).astype(np.int64), minlength=PAIR_SLOTS)
    return np.sqrt(n / max(n.sum(), 1)).astype(np.float32)


def centres(profiles: np.ndarray, rounds: int = CLASS_ROUNDS, weights: np.ndarray | None = None) -> np.ndarray:
    """At most CLASSES centres of unit vectors, each as often as its weight says, by k-means from far-apart starts."""
    if not len(profiles):
        return np.zeros((1, PAIR_SLOTS), np.float32)

    def mean(some: np.ndarray) -> np.ndarray:
        return profiles[some].mean(axis=0) if weights is None else np.average(profiles[some], axis=0, weights=weights[some]).astype(np.float32)

    times = np.ones(len(profiles)) if weights is None else weights
    chosen = [mean(np.ones(len(profiles), bool))]
    near = profiles @ chosen[0]
    while len(chosen) < CLASSES:
        # halfway down the list of the worst served, so that single odd texts do not become centres
        order = np.argsort(near, kind="stable")
        upto = np.cumsum(times[order])
        chosen.append(profiles[order[min(np.searchsorted(upto, upto[-1] / 20, side="right"), len(order) - 1)]])
        near = np.maximum(near, profiles @ chosen[-1])
    c = np.array(chosen)
    for _ in range(rounds):
        own = np.argmax(profiles @ c.T, axis=1)
        for k in range(len(c)):
            if (own == k).any():
                m = mean(own == k)
                c[k] = m / max(float(np.linalg.norm(m)), 1e-9)
    return c


@dataclass
class Code:
    """A Huffman code of bytes: per byte its length and, for each step, twice the node plus the bit."""

    length: np.ndarray
    steps: np.ndarray
    nodes: int

    @staticmethod
    def of(counts: np.ndarray) -> Code:
        heap = [(int(c) + 1, i, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        parent: dict[int, tuple[int, int]] = {}
        new = 256
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x], parent[y] = (new, 0), (new, 1)
            heapq.heappush(heap, (a + b, new, new))
            new += 1
        paths = []
        for s in range(256):
            path, at = [], s
            while at in parent:
                at, bit = parent[at]
                path.append((at - 256, bit))
            paths.append(path[::-1])
        depth = max(map(len, paths))
        steps = np.zeros((depth, 256), np.int16)
        for s, path in enumerate(paths):
            for level, (k, b) in enumerate(path):
                steps[level, s] = 2 * k + b
        return Code(np.array([len(p) for p in paths], np.int16), steps, 255)


OFFSETS = np.concatenate([[0], np.cumsum([1 << b for b in TABLE_BITS])])
SLOTS = int(OFFSETS[-1])


def symbols(block: Block, pairs: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(symbols, context hashes per predictor, first symbol of each pair) of some pairs of a block."""
    word = block.pair_word[pairs]
    lens = block.lens[word].astype(np.int64)
    n = lens + 1
    ends = np.cumsum(n)
    firsts = ends - n
    place = np.arange(ends[-1]) - np.repeat(firsts, n)
    begin = np.concatenate([[0], np.cumsum(block.lens.astype(np.int64))])[:-1]
    text = np.frombuffer(block.text + b"\0", np.uint8)
    source = np.minimum(np.repeat(begin[word], n) + place, len(text) - 1)
    last = np.zeros(len(place), bool)
    last[ends - 1] = True
    final = np.where(lens == 0, _END_SYMBOL, _WORD_END).astype(np.uint8)
    sym = np.where(last, np.repeat(final, n), text[source])
    power = _powers(int(n.max()))
    with np.errstate(over="ignore"):
        v = (_BYTE_HASH[sym] | np.uint64(1)) * power[place]
        run = np.cumsum(v) - v
        prefix = _mixed(run - np.repeat(run[firsts], n) + place.astype(np.uint64))
        wide = sym.astype(np.uint64) + np.uint64(1)
        back = []
        for k in (1, 2, 3):
            prior = np.zeros(len(sym), np.uint64)
            prior[k:] = wide[:-k]
            prior[place < k] = 0
            back.append(prior)
        cls = np.repeat(block.pair_class[pairs].astype(np.uint64) + np.uint64(1), n) * _PRIME
        two = _mixed(cls + back[0] + (back[1] << np.uint64(9)) + np.uint64(2 << 40))
        three = _mixed(cls + back[0] + (back[1] << np.uint64(9)) + (back[2] << np.uint64(18)) + np.uint64(3 << 40))
        classed = _mixed(prefix + cls)
    return sym, [(c >> np.uint64(32)).astype(np.uint32) for c in (prefix, classed, two, three)], firsts


def _node_hash(nodes: int) -> np.ndarray:
    return np.random.default_rng(5).integers(0, 1 << 32, nodes, dtype=np.uint64).astype(np.uint32)


def slots(contexts: list[np.ndarray], node_hash: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Each predictor's table slot for the nodes (by their hash) at symbols ``at``."""
    out = []
    for k, c in enumerate(contexts):
        with np.errstate(over="ignore"):
            h = (c[at] ^ node_hash) * np.uint32(0x9E3779B1)
        out.append((h >> np.uint32(32 - TABLE_BITS[k])).astype(np.int64) + int(OFFSETS[k]))
    return out


def _levels(code: Code, sym: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(symbols still open, their node, their bit), step by step along the code."""
    at, length = np.arange(len(sym)), code.length[sym]
    for level, steps in enumerate(code.steps):
        at = at[length[at] > level]
        if not len(at):
            return
        step = steps[sym[at]]
        yield at, step >> 1, step & 1


def count_bits(block: Block, code: Code, table: np.ndarray) -> None:
    """Adds a block's counted pairs to ``table`` (zeros in the first half, ones in the second)."""
    hashes = _node_hash(code.nodes)
    for pairs in batches_of(block, np.flatnonzero(block.counted)):
        sym, contexts, firsts = symbols(block, pairs)
        times = np.repeat(block.counted[pairs].astype(table.dtype), np.diff(np.append(firsts, len(sym))))
        for at, node, bit in _levels(code, sym):
            n, side = times[at], bit * np.int64(SLOTS)
            for s in slots(contexts, hashes[node], at):
                np.add.at(table, s + side, n)


def quantised(table: np.ndarray) -> np.ndarray:
    """The predictors' logits of a one, as eighths in a signed byte."""
    zeros, ones = table[:SLOTS], table[SLOTS:]
    return np.clip(np.rint(8 * np.log((ones + 0.3) / (zeros + 0.3))), -127, 127).astype(np.int8)


class Mixer:
    """Gated weights and the table that refines their sum; both adapt online to the words they are taught."""

    def __init__(self, code: Code, logits: np.ndarray, rate: float = 0.08) -> None:
        self.code, self.logits, self.rate = code, logits, rate
        self.hashes = _node_hash(code.nodes)
        k = len(TABLE_BITS)
        self.weights = np.full((k, code.nodes), FIRST_WEIGHT, np.float32)  # of logits in eighths
        self.squares = np.full((k, code.nodes), 1e-3)
        level = np.arange(2 * REACH + 1)
        self.p = (1 / (1 + np.exp((REACH - level) / UNIT))).astype(np.float32)
        self.coarse = level // COARSE
        self.hits = np.zeros((code.nodes, self.coarse[-1] + 1))
        self.seen = np.zeros_like(self.hits)

    def costs(self) -> np.ndarray:
        """Bits of a zero, then of a one, per node and level: the level's probability refined by what the level's bits were so far."""
        hits, seen = self.hits[:, self.coarse], self.seen[:, self.coarse]
        q = np.clip((self.p + (hits + 20 * self.p) / (seen + 20)) * 0.5, 1e-5, 1 - 1e-5)
        return -np.log2(np.stack([1 - q, q])).ravel()

    def bits(self, block: Block, pairs: np.ndarray, weigh: bool = True, refine: bool = True) -> np.ndarray:
        """Bits to code each pair's word in its context; the weights and the table learn from taught pairs after predicting."""
        sym, contexts, firsts = symbols(block, pairs)
        cost, costs = np.zeros(len(sym), np.float32), self.costs()
        taught = block.taught[pairs]
        times = np.repeat(taught, np.diff(np.append(firsts, len(sym)))) if (weigh or refine) and taught.any() else None
        levels, side = len(self.p), len(costs) // 2
        weights, coarse = self.weights.copy(), self.hits.shape[1]
        for at, node, bit in _levels(self.code, sym):
            votes = [self.logits[s] for s in slots(contexts, self.hashes[node], at)]
            dot = weights[0][node] * votes[0]
            for w, v in zip(weights[1:], votes[1:], strict=True):
                dot += w[node] * v
            level = np.clip(np.rint(dot * UNIT), -REACH, REACH).astype(np.int32) + REACH
            cost[at] += costs[node.astype(np.int32) * levels + level + bit * np.int32(side)]
            if times is not None:
                on = np.flatnonzero(times[at])
                t, nd, b = times[at[on]].astype(float), node[on], bit[on]
                if weigh:
                    err = (b - self.p[level[on]]) * t
                    for k, v in enumerate(votes):
                        g = np.bincount(nd, err * v[on], self.code.nodes) / 8
                        self.squares[k] += g * g
                        self.weights[k] += (self.rate / 8 * g / np.sqrt(self.squares[k])).astype(np.float32)
                if refine:
                    cell = nd.astype(np.int64) * coarse + level[on] // COARSE
                    self.seen += np.bincount(cell, t, self.seen.size).reshape(self.seen.shape)
                    self.hits += np.bincount(cell, t * b, self.hits.size).reshape(self.hits.shape)
        return np.add.reduceat(cost.astype(np.float64), firsts)

    @staticmethod
    def learned(code: Code, logits: np.ndarray, state: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Mixer:
        """A mixer that goes on from the weights, hits and seen bits of another."""
        out = Mixer(code, logits)
        out.weights, out.hits, out.seen = state
        return out

    def weights_table(self) -> np.ndarray:
        """The weights as whole numbers times the bits taught at their node, then those bits: tables of several learners add up."""
        mass = np.rint(self.seen.sum(axis=1)).astype(np.int64)
        steps = np.rint((np.clip(self.weights, -1, 1) + 1) * WEIGHT_STEPS).astype(np.int64)
        return np.concatenate([(steps * mass).ravel(), mass])

    def take_weights(self, table: np.ndarray) -> None:
        """The mean of the weights of a summed ``weights_table``, by the bits each learner saw at the node."""
        mass = table[-self.code.nodes:]
        mean = table[:-self.code.nodes].reshape(self.weights.shape) / np.maximum(mass, 1) / WEIGHT_STEPS - 1
        self.weights = np.where(mass > 0, mean, FIRST_WEIGHT).astype(np.float32)


def batches_of(block: Block, pairs: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Some pairs of a block (all) in batches of at most BATCH, fewer when their words are long."""
    pairs = np.arange(len(block.pair_word)) if pairs is None else pairs
    ends = np.cumsum(block.lens[block.pair_word[pairs]].astype(np.int64) + 1)
    a = 0
    while a < len(ends):
        full = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH_BYTES, side="right"))
        b = min(a + BATCH, max(full, a + 1), len(ends))
        yield pairs[a:b]
        a = b


def earlier(sequence: np.ndarray, doc_tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per token: how often its document held the same word before, and how many tokens."""
    firsts = np.concatenate([[0], np.cumsum(doc_tokens)])[:-1]
    place = np.arange(len(sequence)) - np.repeat(firsts, doc_tokens)
    doc = np.repeat(np.arange(len(doc_tokens)), doc_tokens)
    # place in the block, word and document as one number, where they fit
    low, high = len(sequence).bit_length(), int(sequence.max(initial=0)).bit_length()
    if low + high + len(doc_tokens).bit_length() < 64:
        key = np.sort((((doc << high) + sequence) << low) + np.arange(len(sequence)))
        order = key & ((1 << low) - 1)
        key >>= low
        same = key[1:] == key[:-1]
    else:
        order = np.argsort((doc << 32) + sequence, kind="stable")
        same = (sequence[order][1:] == sequence[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    run = np.arange(len(order))
    begin = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), run, 0))
    before = np.empty(len(order), np.int64)
    before[order] = run - begin
    return before, place


def grams(block: Block, width: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Per token, the hash (of ``width`` bits) of its pair with the word before and of its triple with the two before.

    A text's first word follows its start; its triple has no context.
    """
    word = block.word_hashes()[block.pair_word[block.sequence]]
    firsts = np.concatenate([[0], np.cumsum(block.doc_tokens.astype(np.int64))])[:-1]

    def before(x: np.ndarray) -> np.ndarray:
        out = np.roll(x, 1)
        out[firsts] = _START
        return out

    with np.errstate(over="ignore"):
        two = _mixed(before(word) * _PRIME + word)
        three = _mixed(before(two) * _PRIME + word + np.uint64(1))
    return two >> np.uint64(64 - width), three >> np.uint64(64 - width)


def gram_width(total: int) -> int:
    """Bits of the hashes of pairs and triples for ``total`` learning tokens."""
    return min(64, total.bit_length() + SPARE_BITS)


def _columns(x: np.ndarray) -> bytes:
    """64-bit numbers by their bytes, compressed."""
    return zstandard.compress(_planes(x.astype("<u8")), 1)


def _numbers(data: bytes) -> np.ndarray:
    return _unplaned(zstandard.decompress(data), "<u8")


def _by_part(h: np.ndarray, width: int, bits: int) -> list[tuple[int, slice]]:
    """The runs of sorted hashes of ``width`` bits that share their first ``bits`` bits."""
    part = (h >> np.uint64(width - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    return [(int(part[a]), slice(a, b)) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(h)], strict=True)]


def _sorted_hashes(h: np.ndarray) -> bytes:
    return _columns(np.diff(h, prepend=np.uint64(0)))


def _hashes(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data), dtype=np.uint64)


ENTRIES = ["hashes", "counted", "taught", "lens", "text"]


def _pieces(text: bytes, lens: np.ndarray, some: np.ndarray) -> bytes:
    ends = np.cumsum(lens.astype(np.int64))
    return b"".join([text[e - n:e] for e, n in zip(ends[some].tolist(), lens[some].tolist(), strict=True)])


def entries(made: DataFrame, bits: int) -> DataFrame:
    """(part, *ENTRIES): the distinct (word, class) pairs of each block with their counts and spelling, in order of their hashes."""
    def row(block: Block, pairs: np.ndarray) -> list[bytes]:
        word = block.pair_word[pairs]
        return [_columns(block.counted[pairs]), _columns(block.taught[pairs]), _columns(block.lens[word]),
                zstandard.compress(_pieces(block.text, block.lens, word), 1)]

    return _asked(made, bits, ["counted", "taught"], ENTRIES[1:], row).drop("block")


def _batch(block: int, rows: list[tuple[int, list[bytes]]], names: list[str]) -> pa.RecordBatch:
    """What a block sends to each part, as one batch."""
    return pa.RecordBatch.from_arrays([pa.array([part for part, _ in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()),
                                       *[pa.array([data[k] for _, data in rows], pa.binary()) for k in range(len(names))]], ["part", "block", *names])


def _asked(made: DataFrame, bits: int, read: list[str], names: list[str], row: Callable[[Block, np.ndarray], list[bytes]]) -> DataFrame:
    """(part, block, hashes, *names): the hashes of each block's pairs in order, and what ``row`` says of these pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                block = _load(b, i)
                h = block.pair_hashes()
                order = np.argsort(h)
                h = h[order]
                rows = [(part, [_sorted_hashes(h[some]), *row(block, order[some])]) for part, some in _by_part(h, 64, bits)]
                yield _batch(b["block"][i].as_py(), rows, ["hashes", *names])

    return made.select("block", "pair_word", "pair_class", "lens", "text", *read).mapInArrow(run, ", ".join(["part int, block bigint, hashes binary", *[f"{k} binary" for k in names]]))


@dataclass
class Vocabulary:
    """Distinct (word, class) pairs of the corpus in order of their hashes, spelled, with their counts; n counts the word in all classes."""

    hashes: np.ndarray
    words: Block
    n: np.ndarray

    @staticmethod
    def of(rows: pa.Table) -> Vocabulary:
        """The pairs of some rows of ENTRIES; of equal pairs one is kept, with their sums."""
        h = np.concatenate([_hashes(x.as_py()) for x in rows["hashes"]])
        counted, taught, lens = (np.concatenate([_numbers(x.as_py()) for x in rows[k]]).astype(np.int64) for k in ENTRIES[1:4])
        found, first, place = np.unique(h, return_index=True, return_inverse=True)
        text = _pieces(b"".join(zstandard.decompress(x.as_py()) for x in rows["text"]), lens, first)
        none = np.zeros(0, np.int64)
        words = Block(np.arange(len(found)), (found & np.uint64(CLASSES - 1)).astype(np.uint8), *(np.bincount(place, x, len(found)).astype(np.int64) for x in (counted, taught)),
                      none, none, text, lens[first], none, none)
        same = np.unique(found & ~np.uint64(CLASSES - 1), return_inverse=True)[1]
        return Vocabulary(found, words, np.bincount(same, words.counted + words.taught).astype(np.int64)[same] if len(found) else none)

    def row(self, some: np.ndarray) -> list[bytes]:
        """ENTRIES and n of some pairs."""
        w = self.words
        return [_sorted_hashes(self.hashes[some]), _columns(w.counted[some]), _columns(w.taught[some]), _columns(w.lens[some]),
                zstandard.compress(_pieces(w.text, w.lens, some), 1), _columns(self.n[some])]

    @staticmethod
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Vocabulary]:
        """Row by row, with the n that each row holds."""
        for b in batches:
            for i in range(b.num_rows):
                yield Vocabulary.joined(pa.Table.from_batches([b.slice(i, 1)]))

    @staticmethod
    def joined(rows: pa.Table) -> Vocabulary:
        """Rows of different pairs as one, with the n that they hold."""
        v, n = Vocabulary.of(rows), np.concatenate([_numbers(x.as_py()) for x in rows["n"]]).astype(np.int64)
        order = np.argsort(np.concatenate([_hashes(x.as_py()) for x in rows["hashes"]]))
        return Vocabulary(v.hashes, v.words, n[order])


_ROW = [*ENTRIES, "n"]
_ROW_SCHEMA = ", ".join(f"{k} binary" for k in _ROW)


def vocabulary(rows: DataFrame) -> DataFrame:
    """(part, *ENTRIES, n, distinct, lessons): the corpus sums of ``entries``, a row a part.

    distinct: words that learning documents hold; lessons: pairs that teach.
    """
    def merge(part: pa.Table) -> pa.Table:
        v = Vocabulary.of(part)
        distinct = len(np.unique(v.hashes[v.n > 0] & ~np.uint64(CLASSES - 1)))
        return pa.table([part["part"].slice(0, 1), *[pa.array([d], pa.binary()) for d in v.row(np.arange(len(v.n)))],
                         pa.array([distinct], pa.int64()), pa.array([int((v.words.taught > 0).sum())], pa.int64())], ["part", *_ROW, "distinct", "lessons"])

    return rows.groupBy("part").applyInArrow(merge, f"part int, {_ROW_SCHEMA}, distinct bigint, lessons bigint")


def lessons(words: DataFrame, buckets: int) -> DataFrame:
    """(bucket, *ENTRIES, n): the pairs of the vocabulary that teach, dealt to buckets by their hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for v in Vocabulary.rows(batches):
            bucket = (_mixed(v.hashes) % np.uint64(buckets)).astype(np.int64)
            for k in np.unique(bucket[v.words.taught > 0]).tolist():
                row = v.row(np.flatnonzero((v.words.taught > 0) & (bucket == k)))
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), *[pa.array([d], pa.binary()) for d in row]], ["bucket", *_ROW])

    return words.select(*_ROW).mapInArrow(run, f"bucket bigint, {_ROW_SCHEMA}")


def gram_counts(made: DataFrame, bits: int, width: int) -> DataFrame:
    """(block, part, totals): the corpus counts of the pairs and triples of each block, in order of their hashes.

    A part holds the hashes (of ``width`` bits) that share their first ``bits`` bits; counts are
    exact sums over the learning documents of all blocks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                block = Block.load({k: b[k][i].as_py() for k in b.schema.names if k not in ("block", "roles")})
                learned = np.repeat(np.array(b["roles"][i].as_py()) > 0, block.doc_tokens.astype(np.int64))
                found, place = np.unique(np.concatenate(grams(block, width)), return_inverse=True)
                n = np.bincount(place[np.tile(learned, 2)], minlength=len(found))
                del block, place, learned
                yield _batch(b["block"][i].as_py(), [(part, [_sorted_hashes(found[some]), _columns(n[some])]) for part, some in _by_part(found, width, bits)], ["hashes", "n"])

    def merge(part: pa.Table) -> pa.Table:
        hashes = [_hashes(x.as_py()) for x in part["hashes"]]
        n = np.concatenate([_numbers(x.as_py()) for x in part["n"]])
        found, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(place, n, len(found)).astype(np.int64)[place]
        ends = np.cumsum([len(h) for h in hashes])
        return pa.table([part["block"], part["part"], pa.array([_columns(t) for t in np.split(total, ends[:-1])], pa.binary())], ["block", "part", "totals"])

    rows = made.select("block", "roles", "pair_word", "sequence", "doc_tokens", "lens", "text").mapInArrow(run, "part int, block bigint, hashes binary, n binary")
    return rows.groupBy("part").applyInArrow(merge, "block bigint, part int, totals binary")


def _log(p: np.ndarray) -> np.ndarray:
    """Natural logarithms; of zero minus infinity."""
    with np.errstate(divide="ignore"):
        return np.log(p)


def tally(gate: np.ndarray, ratio: np.ndarray, gates: int, times: np.ndarray | None = None) -> np.ndarray:
    """Counts of (gate, step of the logarithm of how much likelier one model finds a token than the other)."""
    step = np.zeros(len(ratio), np.int64)
    some = np.isfinite(ratio)
    step[some] = np.clip(np.rint(ratio[some] * RATIO_STEPS), -RATIO_REACH, RATIO_REACH).astype(np.int64) + RATIO_REACH + 1
    return np.rint(np.bincount(gate.astype(np.int64) * RATIOS + step, times, gates * RATIOS)).astype(np.int64)


def fitted(tallied: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Per gate, the weight of the first of two models that suits the tallied tokens best, by expectation-maximisation.

    ``start`` counts as WEIGHT_TOKENS tokens; the sums are of the whole corpus, so any layout gives the same weights.
    """
    h = tallied.reshape(len(start), RATIOS)
    ratio = np.concatenate([[0.0], np.exp((np.arange(RATIOS - 1) - RATIO_REACH) / RATIO_STEPS)])
    weight = start
    for _ in range(30):
        part = (h * (weight[:, None] * ratio / (weight[:, None] * ratio + 1 - weight[:, None]))).sum(axis=1)
        weight = np.minimum((part + WEIGHT_TOKENS * start) / (h.sum(axis=1) + WEIGHT_TOKENS), 0.98)
    return weight


def mixed_in(log_p: np.ndarray, own: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logarithms of the mixture of two models, the second by ``weight`` (below one)."""
    with np.errstate(divide="ignore", over="ignore"):
        ratio = own - log_p
        near = np.log1p(weight * np.expm1(np.minimum(ratio, 700)))
        # beyond a float's range only the second model counts
        return log_p + np.where((ratio > 700) & (weight > 0), np.log(weight) + ratio, near)


def sizes(n: np.ndarray) -> np.ndarray:
    """The gate of a count: its power of two (zero for none)."""
    return np.frexp(n.astype(float))[1].astype(np.uint8)


#: Weights before they are fitted: of the document's own words, and of a context by its size.
_HALF = 2.0 ** np.arange(GATES - 1)
START_OWN = np.concatenate([[0.0], np.full(GATES - 1, 0.05)])
START_CONTEXT = np.concatenate([[0.0], np.minimum(_HALF / (_HALF + CONTEXT_PRIOR), 0.98)])


@dataclass
class Corpus:
    """What is known of the whole corpus: tokens, distinct words, tokens of each class."""

    total: int
    distinct: int
    class_totals: np.ndarray

    @property
    def size(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def shares(self, v: Vocabulary, pairs: np.ndarray, less: int) -> np.ndarray:
        """Each pair's word share of its class, smoothed by its share of the corpus; ``less`` occurrences left out."""
        n = np.maximum(v.n[pairs] - less, 0)
        k = np.maximum((v.words.counted + v.words.taught)[pairs] - less, 0)
        everywhere = np.where(n > 0, (n + 0.5) / self.size, 0.0)
        return (k + PRIOR_TOKENS * everywhere) / (self.class_totals[v.words.pair_class[pairs]] + PRIOR_TOKENS)


def priced(v: Vocabulary, mixer: Mixer, corpus: Corpus, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural logarithms of each pair's probability, and the same without the occurrence itself, as a held-out word finds it."""
    out = np.empty((2, len(v.n)))
    for pairs in batches_of(v.words):
        spelled = -mixer.bits(v.words, pairs, weigh=False, refine=False) * math.log(2)
        weight = share[v.words.pair_class[pairs]]
        for less in (0, 1):
            out[less, pairs] = mixed_in(spelled, _log(corpus.shares(v, pairs, less)), weight)
    return out[0], out[1]


def share_ratios(v: Vocabulary, mixer: Mixer, corpus: Corpus) -> np.ndarray:
    """The tally, by class, of exact shares against spelled words over the pairs that teach."""
    out = np.zeros(CLASSES * RATIOS, np.int64)
    for pairs in batches_of(v.words):
        spelled = -mixer.bits(v.words, pairs, weigh=False, refine=False) * math.log(2)
        out += tally(v.words.pair_class[pairs], _log(corpus.shares(v, pairs, 1)) - spelled, CLASSES, v.words.taught[pairs])
    return out


class Evidence:
    """What is known of each token of a block: its word's probability, and how often its document and its contexts held it."""

    def __init__(self, block: Block, n: np.ndarray, log_p: np.ndarray, sequences: np.ndarray, width: int = 64, less: int = 0) -> None:
        """n, log_p: of the block's pairs; sequences: counts of its pairs and triples of words, in order of their hashes of ``width`` bits.

        ``less``: 1 where each token is to be found as if it were held out.
        """
        doc_tokens = block.doc_tokens.astype(np.int64)
        self.firsts = np.concatenate([[0], np.cumsum(doc_tokens)])[:-1]
        self.n, self.log_p = n[block.sequence], log_p[block.sequence]
        before, place = earlier(block.sequence.astype(np.int64), doc_tokens)
        self.own, self.gates = [_log(before / (place + 1.0))], [sizes(place)]
        del before, place
        # the word before has its count, the start of a text that of the ends, and the two words before that of their pair
        two, three = np.split(sequences[np.unique(np.concatenate(grams(block, width)), return_inverse=True)[1]], 2)
        ends = int(n[block.lens[block.pair_word] == 0].max(initial=0))
        for seen, context, start in ((two, self.n, ends), (three, two, 0)):
            context = np.roll(context, 1)
            context[self.firsts] = start
            context = np.maximum(context - less, 0)
            self.own.append(_log(np.maximum(seen - less, 0) / np.maximum(context, 1)))
            self.gates.append(sizes(context))

    def score(self, weights: list[np.ndarray]) -> np.ndarray:
        """The log10 probability of each document's tokens, all evidence mixed in."""
        log_p = self.log_p
        for own, gate, weight in zip(self.own, self.gates, weights, strict=True):
            log_p = mixed_in(log_p, own, weight[gate])
        return np.add.reduceat(log_p / math.log(10), self.firsts)


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that nothing is learned from: crc32 of the id's text modulo 5 is 1."""
    return crc_mod(id_col, 5) == 1


def _roles(id_col: str) -> Column:
    teaches = F.pmod(F.xxhash64(F.col(id_col), F.lit("weights")), F.lit(WEIGHT_SHARE)) == 0
    return F.when(held_out(id_col), F.lit(0)).when(teaches, F.lit(2)).otherwise(F.lit(1))


def _profile_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, PROFILE_ROWS):
            some = np.array([pair_profile(t.as_py().lower()) for t in b["text"].slice(at, PROFILE_ROWS)]).astype(np.float64)
            data = zstandard.compress(np.rint(some * PROFILE_STEPS).astype("<u2").tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["profiles"])


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The profiles in whole steps, some documents' at a time."""
    for b in batches:
        for data in b["profiles"]:
            yield np.frombuffer(zstandard.decompress(data.as_py()), "<u2").reshape(-1, PAIR_SLOTS).astype(np.float32)


def nearest(profiles: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The centre nearest to each profile (in whole steps); of equally near ones the first, whatever the order of additions."""
    close = profiles @ c.T
    own = np.argmax(close, axis=1)
    if len(c) > 1:
        two = np.partition(close, -2, axis=1)[:, -2:]
        some = np.flatnonzero(two[:, 1] - two[:, 0] < CLASS_MARGIN * PROFILE_STEPS)
        # products of whole numbers that add up to less than 2^53
        own[some] = np.argmax(profiles[some].astype(np.float64) @ np.rint(c.astype(np.float64) * CENTRE_STEPS).T, axis=1)
    return own


def document_classes(rows: DataFrame) -> np.ndarray:
    """Centres of the classes, by k-means of all learning rows (id, role, text), each a point.

    Up to CLASS_POINTS rows it runs on the driver.  The profiles of more are
    written once.  For its starts they are put into groups by the sides of fixed
    planes through the mean of all on which they lie; the centres of the groups'
    sums are the starts.  Then in every round each row goes to its nearest
    centre, and the centres become the means of their rows.  All sums are of
    whole numbers, so the centres are the same on any partitioning.
    """
    taught = rows.where("role > 0").select("text")
    if taught.count() <= CLASS_POINTS:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([pair_profile(t.as_py().lower()).tobytes() for t in b["text"]], pa.binary())], ["profile"])

        points = taught.mapInArrow(run, "profile binary")
        return centres(np.array(sorted((np.frombuffer(r.profile, np.float32) for r in points.toLocalIterator()), key=bytes)))

    points, path = written_at(taught.mapInArrow(_profile_rows, "profiles binary"), "profiles", row_group_mb=16)
    groups = 1 << CLASS_BITS

    def total(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        table = np.zeros(PAIR_SLOTS + 1)
        for p in _profiles(batches):
            table[:-1] += p.sum(axis=0, dtype=np.float64)
            table[-1] += len(p)
        return table.astype(np.int64)

    all_ = counted(points, total, PAIR_SLOTS + 1)
    # whole numbers below 2^53, so the sides are exact
    planes = np.random.default_rng(57).choice([-1.0, 1.0], (CLASS_BITS, PAIR_SLOTS))
    level = planes @ np.rint(all_[:-1] / all_[-1])

    def grouped(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        table = np.zeros((groups, PAIR_SLOTS))
        for p in _profiles(batches):
            for group, row in zip((p.astype(np.float64) @ planes.T > level) @ (1 << np.arange(len(planes))), p, strict=True):
                table[group] += row
        return table.astype(np.int64).ravel()

    sums = counted(points, grouped, PAIR_SLOTS * groups).reshape(-1, PAIR_SLOTS).astype(np.float64)
    size = np.linalg.norm(sums, axis=1)
    some = size > 0
    c = centres((sums[some] / size[some, None]).astype(np.float32), weights=size[some] / PROFILE_STEPS)
    for _ in range(CLASS_ROUNDS):
        def near(batches: Iterator[pa.RecordBatch], c: np.ndarray = c) -> np.ndarray:
            table, each = np.zeros(c.shape), np.arange(len(c))[:, None]
            for p in _profiles(batches):
                table += (nearest(p, c) == each).astype(np.float32) @ p
            return table.astype(np.int64).ravel()

        sums = counted(points, near, c.size).reshape(c.shape).astype(np.float64)
        size = np.linalg.norm(sums, axis=1)[:, None]
        before, c = c, np.where(size > 0, sums / np.maximum(size, 1), c).astype(np.float32)
        if np.array_equal(before, c):
            break
    drop_scratch(rows.sparkSession, path)
    return c


def blocks(rows: DataFrame, classes: np.ndarray) -> DataFrame:
    """One row per block of ``rows`` (id, role, text): its documents' ids, roles and sizes, and the parts of Block.

    Documents that teach the weights have blocks of their own, of odd numbers.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, id_type = TaskContext.get().partitionId(), 0, None
        open_blocks: tuple[list, list] = ([], [])
        size = [0, 0]

        def row(teaches: int) -> pa.RecordBatch:
            nonlocal n
            ids, docs = zip(*open_blocks[teaches], strict=True)
            dumped = Block.build(list(docs)).dump()
            out = pa.RecordBatch.from_arrays(
                [pa.array([(part << 33) + 2 * n + teaches], pa.int64()), pa.array([[i.as_py() for i in ids]], pa.list_(id_type)), pa.array([[d[1] for d in docs]], pa.list_(pa.int32())),
                 pa.array([[len(d[0]) for d in docs]], pa.list_(pa.int64())), *[pa.array([dumped[k]], pa.binary()) for k in _FIELDS]],
                ["block", "ids", "roles", "sizes", *_FIELDS])
            n, size[teaches] = n + 1, 0
            open_blocks[teaches].clear()
            return out

        for b in batches:
            id_type = b["id"].type
            for i, r, t in zip(b["id"], b["role"].to_pylist(), b["text"], strict=True):
                text, k = t.as_py().lower(), int(r == 2)
                open_blocks[k].append((i, (text, r, int(np.argmax(classes @ pair_profile(text))))))
                size[k] += len(text)
                if len(open_blocks[k]) >= BLOCK_DOCUMENTS or size[k] >= BLOCK_BYTES:
                    yield row(k)
        for k in (0, 1):
            if open_blocks[k]:
                yield row(k)

    return rows.mapInArrow(run, f"block bigint, ids array<{kind}>, roles array<int>, sizes array<bigint>, " + ", ".join(f"{k} binary" for k in _FIELDS))


#: What scoring reads of a block.
_LOADED = ["pair_word", "pair_class", "sequence", "doc_tokens", "lens", "text"]


def _load(b: pa.RecordBatch, i: int) -> Block:
    return Block.load({k: b[k][i].as_py() for k in _FIELDS if k in b.schema.names})


def learned_weights(taught: DataFrame, code: Broadcast, logits: Broadcast, corpus: Corpus) -> tuple[Mixer, np.ndarray]:
    """The mixer and the classes' weights of exact shares, learned from the pairs that teach.

    The weights adapt online along each bucket's words in order of their
    hashes and are averaged by the bits each bucket saw; then the refining
    table, and then the shares, are whole sums over all buckets.
    """
    spark = taught.sparkSession
    mixer = Mixer(code.value, logits.value)

    def learn(rows: pa.Table) -> pa.Table:
        v, own = Vocabulary.joined(rows), Mixer(code.value, logits.value)
        for pairs in batches_of(v.words):
            own.bits(v.words, pairs)
        return pa.table([pa.array([own.weights_table().tobytes()], pa.binary())], ["state"])

    def add(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        table = np.zeros(mixer.weights_table().size, np.int64)
        for b in batches:
            for state in b["state"]:
                table += np.frombuffer(state.as_py(), np.int64)
        return table

    mixer.take_weights(counted(taught.groupBy("bucket").applyInArrow(learn, "state binary"), add, (len(TABLE_BITS) + 1) * code.value.nodes))
    weights, cells = mixer.weights, mixer.hits.size

    def refine(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        own = Mixer(code.value, logits.value)
        own.weights = weights
        for v in Vocabulary.rows(batches):
            for pairs in batches_of(v.words):
                own.bits(v.words, pairs, weigh=False)
        return np.rint(np.concatenate([own.hits.ravel(), own.seen.ravel()])).astype(np.int64)

    table = counted(taught.select(*_ROW), refine, 2 * cells).astype(float)
    mixer.hits, mixer.seen = table[:cells].reshape(mixer.hits.shape), table[cells:].reshape(mixer.hits.shape)
    state = spark.sparkContext.broadcast((weights, mixer.hits, mixer.seen))

    def ratios(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        own = Mixer.learned(code.value, logits.value, state.value)
        return sum((share_ratios(v, own, corpus) for v in Vocabulary.rows(batches)), np.zeros(CLASSES * RATIOS, np.int64))

    return mixer, fitted(counted(taught.select(*_ROW), ratios, CLASSES * RATIOS), np.full(CLASSES, 0.5))


def prices(made: DataFrame, bits: int, words: DataFrame, code: Broadcast, logits: Broadcast, mixer: Mixer, corpus: Corpus, share: np.ndarray) -> DataFrame:
    """(block, part, n, log_p, alone): for the pairs of each block, in order of their hashes, what the corpus says of them.

    alone: without the occurrence itself, for blocks that teach.  Both are sent as single floats.
    """
    state = made.sparkSession.sparkContext.broadcast((mixer.weights, mixer.hits, mixer.seen))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        v = Vocabulary.joined(right)
        log_p, alone = np.float32(priced(v, Mixer.learned(code.value, logits.value, state.value), corpus, share))
        out = []
        for block, data in zip(left["block"].to_pylist(), left["hashes"], strict=True):
            at = np.searchsorted(v.hashes, _hashes(data.as_py()))
            out.append((block, _columns(v.n[at]), zstandard.compress(_planes(log_p[at]), 1), zstandard.compress(_planes(alone[at]), 1) if block & 1 else None))
        n = len(out)
        return pa.table([pa.array([r[0] for r in out], pa.int64()), pa.array([left["part"][0].as_py()] * n if n else [], pa.int32()),
                         *[pa.array([r[k] for r in out], pa.binary()) for k in (1, 2, 3)]], ["block", "part", "n", "log_p", "alone"])

    return (_asked(made, bits, [], [], lambda block, pairs: []).groupBy("part").cogroup(words.select("part", *_ROW).groupBy("part"))
            .applyInArrow(run, "block bigint, part int, n binary, log_p binary, alone binary"))


def _answers(block: Block, right: pa.Table, price: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, logarithm of the probability, counts of pairs and triples) for a block, from the rows of all parts."""
    right = right.sort_by("part")
    of_words, of_grams = right.filter(pc.is_null(right["totals"])), right.filter(pc.is_valid(right["totals"]))
    order = np.argsort(block.pair_hashes())
    n, log_p = np.empty(len(order), np.int64), np.empty(len(order))
    n[order] = np.concatenate([_numbers(x.as_py()) for x in of_words["n"]])
    log_p[order] = np.concatenate([_unplaned(zstandard.decompress(x.as_py()), "<f4") for x in of_words[price]])
    return n, log_p, np.concatenate([_numbers(x.as_py()) for x in of_grams["totals"]]).astype(np.int64)


_EVIDENCE = ["log_p", "own_1", "own_2", "own_3", "gate_1", "gate_2", "gate_3"]


def evidence_weights(made: DataFrame, sums: DataFrame, width: int) -> list[np.ndarray]:
    """The weights, by gate, of a document's own words, of pairs and of triples, fitted one after the other on the documents that teach."""
    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for b in left.to_batches():
            for i in range(b.num_rows):
                block = _load(b, i)
                e = Evidence(block, *_answers(block, right, "alone"), width, less=1)
                out.append([zstandard.compress(x.tobytes(), 1) for x in [np.float32(x) for x in (e.log_p, *e.own)] + e.gates])
        return pa.table([pa.array([r[k] for r in out], pa.binary()) for k in range(len(_EVIDENCE))], _EVIDENCE)

    odd = F.col("block").bitwiseAND(1) == 1
    rows, path = written_at(made.select("block", *_LOADED).where(odd).groupBy("block").cogroup(sums.where(odd).groupBy("block"))
                            .applyInArrow(gather, ", ".join(f"{k} binary" for k in _EVIDENCE)), "evidence", row_group_mb=16)
    weights: list[np.ndarray] = []
    for start in (START_OWN, START_CONTEXT, START_CONTEXT):
        def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            table, k = np.zeros(GATES * RATIOS, np.int64), len(weights)
            for b in batches:
                for i in range(b.num_rows):
                    x = {c: np.frombuffer(zstandard.decompress(b[c][i].as_py()), np.uint8 if c.startswith("gate") else np.float32) for c in _EVIDENCE}
                    log_p = x["log_p"].astype(float)
                    for j, w in enumerate(weights):
                        log_p = mixed_in(log_p, x[f"own_{j + 1}"], w[x[f"gate_{j + 1}"]])
                    table += tally(x[f"gate_{k + 1}"], x[f"own_{k + 1}"] - log_p, GATES)
            return table

        weights.append(fitted(counted(rows, count, GATES * RATIOS), start))
    drop_scratch(made.sparkSession, path)
    return weights


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) per row of ``docs``.

    Learns from the rows that are not held out; scores all.  Null text is the
    empty text: one token, the end.  base_score is the smoothed unigram score;
    score is the model's log10 probability of the text's tokens; bits_per_byte
    divides the same in bits by the UTF-8 length of the text plus one for its
    end.  Words are told apart by 60-bit hashes.  With no learning row every
    probability is the model's prior.  Repeated rows are scored each.
    """
    spark = docs.sparkSession
    workers_ready(spark)
    rows = docs.select(F.col(id_col).alias("id"), _roles(id_col).alias("role"), text_or_empty(text_col).cast("binary").alias("text"))
    made = written(blocks(rows, document_classes(rows)), "blocks", row_group_mb=16)

    def count_learned(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        table = np.zeros(256 + CLASSES, np.int64)
        for b in batches:
            for i in range(b.num_rows):
                block = _load(b, i)
                table += np.concatenate([block.bytes_learned, block.class_learned])
        return table

    learned = counted(made.select("bytes_learned", "class_learned"), count_learned, 256 + CLASSES)
    total = int(learned[256:].sum())
    bits, width = (total // PART_TOKENS).bit_length(), gram_width(total)
    # first, as it shuffles most: while only the blocks are kept
    sequences = written(gram_counts(made, bits, width), "sequences", row_group_mb=16)
    code = spark.sparkContext.broadcast(Code.of(learned[:256]))
    words, words_path = written_at(vocabulary(entries(made, bits)), "vocabulary", row_group_mb=16)
    facts = words.agg(F.sum("distinct").alias("distinct"), F.sum("lessons").alias("lessons")).first()
    corpus = Corpus(total, facts.distinct or 0, learned[256:])

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        table = np.zeros(2 * SLOTS, np.int64)
        for v in Vocabulary.rows(batches):
            count_bits(v.words, code.value, table)
        return table

    logits = spark.sparkContext.broadcast(quantised(counted(words.select(*_ROW), count, 2 * SLOTS)))
    taught, taught_path = written_at(lessons(words, 1 + (facts.lessons or 0) // BUCKET_PAIRS), "lessons", row_group_mb=16)
    mixer, share = learned_weights(taught, code, logits, corpus)
    priced_words = written(prices(made, bits, words, code, logits, mixer, corpus, share), "prices", row_group_mb=16)
    for path in (words_path, taught_path):
        drop_scratch(spark, path)
    sums = priced_words.unionByName(sequences, allowMissingColumns=True)
    weights = evidence_weights(made, sums, width)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for b in left.to_batches():
            for i in range(b.num_rows):
                block = _load(b, i)
                e = Evidence(block, *_answers(block, right, "log_p"), width)
                known = np.add.reduceat((e.n > 0).astype(np.int64), e.firsts)
                base = np.add.reduceat(np.log10((e.n + 0.5) / corpus.size), e.firsts)
                score = e.score(weights) - math.log10(CLASSES)  # the class is named as well
                out.append(pa.table([b["ids"][i].values, pa.array(np.array(b["roles"][i].as_py()) == 0), pa.array(block.doc_tokens.astype(np.int64)), pa.array(known),
                                     pa.array(np.full(len(known), total)), pa.array(base), pa.array(score), pa.array(-score * math.log2(10) / (np.array(b["sizes"][i].as_py()) + 1))],
                                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]))
        return pa.concat_tables(out)

    state = made.select("block", "ids", "roles", "sizes", *_LOADED)
    return state.groupBy("block").cogroup(sums.drop("alone").groupBy("block")).applyInArrow(run, schema)
