"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character 1- to 3-grams of the whole
text.  The weights are learned by follow-the-regularised-leader (FTRL
proximal) with an elastic-net penalty on a bounded sample of labelled rows;
a part of the sample sets the temperature that calibrates the probabilities.
Document frequencies cover all learning rows, and every row is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import crc_mod, text_or_empty, workers_ready
from canopy.llm.tables import counted

#: Slots of hashed n-grams.
SLOTS = 1 << 16
#: Expected learning rows per language (the bound of the sample; hashed ids decide).
PER_LANGUAGE = 800
#: Characters that are turned into features at a time.
SPAN = 1 << 20
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


def _char_map() -> np.ndarray:
    """ASCII characters: letters stay, everything else becomes a space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(128)], np.uint32)


_ASCII = _char_map()


def ngram_slots(text: str) -> Iterator[np.ndarray]:
    """Slots of all 1- to 3-grams of ``text``, lower-cased, with a space at both ends; span by span."""
    for at in range(0, max(len(text), 1), SPAN):
        # a span begins with the two characters before it, so that every n-gram is in exactly one span
        part = text[max(at - 2, 0):at + SPAN].lower()
        if at == 0:
            part = " " + part
        if at + SPAN >= len(text):
            part += " "
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        c = np.where(c < 128, _ASCII[np.minimum(c, 127)], c).astype(np.uint32)
        with np.errstate(over="ignore"):
            a, b, d = (c * m for m in _MULTIPLIERS)
            fresh = 0 if at == 0 else 2
            grams = [a[fresh:] ^ np.uint32(1), a[max(fresh - 1, 0):-1] ^ b[max(fresh, 1):] ^ np.uint32(2), a[:-2] ^ b[1:-1] ^ d[2:] ^ np.uint32(3)]
            h = np.concatenate(grams)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        yield ((h ^ (h >> np.uint32(12))) % np.uint32(SLOTS)).astype(np.int64)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(slots, relative frequencies) of the n-grams of ``text``."""
    total = np.zeros(SLOTS, np.int64)
    for s in ngram_slots(text):
        total += np.bincount(s, minlength=SLOTS)
    at = np.flatnonzero(total)
    return at, total[at] / max(total.sum(), 1)


@dataclass
class Model:
    """Weights on TF-IDF features: score of a language = frequencies @ (idf * weights)."""

    languages: list[str]
    weights: np.ndarray  # SLOTS x languages, idf folded in
    temperature: float

    def predict(self, text: str) -> tuple[str, float]:
        """(language, calibrated probability); ('und', 0.0) for a text without letters."""
        if not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        score, n = np.zeros(len(self.languages)), 0
        for s in ngram_slots(text):
            score += self.weights[s].sum(axis=0, dtype=np.float64)
            n += len(s)
        p = _softmax(score / n / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(samples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, alpha: float = 0.5, beta: float = 1.0,
         l1: float = 1e-3, l2: float = 1e-3, epochs: int = 3) -> np.ndarray:
    """FTRL-proximal weights (SLOTS x classes) of a multinomial logistic regression with penalties l1 and l2."""
    z, n = np.zeros((SLOTS, classes)), np.zeros((SLOTS, classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    for _ in range(epochs):
        for at, x, y in samples:
            w = weights(z[at], n[at])
            p = _softmax(x @ w)
            p[y] -= 1.0
            g = x[:, None] * p[None, :]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(z, n)


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on held-back rows (golden-section search on its logarithm)."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(scores / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    a, b, r = -5.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(50):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(rows: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from ``rows`` (id, text, lang); rows with a null language only count in document frequencies.

    The sample takes a row if the hash of its id falls below its language's
    share, so that every language has about ``per_language`` rows (all, if it
    has fewer); of an id that many rows share, all or none are candidates, and
    the sample is cut at twice the expected size.
    """
    spark = rows.sparkSession
    workers_ready(spark)
    found = sorted((r.lang, r.n) for r in rows.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect())
    languages = [name for name, _ in found]
    if not languages:
        return Model([], np.zeros((SLOTS, 0), np.float32), 1.0)

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        df = np.zeros(SLOTS + 1, np.int64)
        for b in batches:
            for t in b["text"]:
                seen = np.zeros(SLOTS, bool)
                for s in ngram_slots(t.as_py()):
                    seen[s] = True
                df[:-1] += seen
                df[-1] += 1
        return df

    df = counted(rows.select("text"), count, SLOTS + 1)
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    scale = 1 << 20
    share = F.create_map(*[F.lit(x) for name, n in found for x in (name, int(scale * min(1.0, per_language / n)))])
    picked = rows.where("lang is not null").where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(scale)) < share[F.col("lang")])
    picked = picked.select("lang", "text").limit(2 * per_language * len(languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [features(t.as_py()) for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["lang"], pa.array([at.astype("<i4").tobytes() for at, _ in made], pa.binary()),
                                              pa.array([x.astype("<f4").tobytes() for _, x in made], pa.binary())], ["lang", "slot", "x"])

    number = {name: i for i, name in enumerate(languages)}
    samples = []
    for r in picked.mapInArrow(run, "lang string, slot binary, x binary").toLocalIterator():
        at = np.frombuffer(r.slot, "<i4")
        x = np.frombuffer(r.x, "<f4") * idf[at]
        samples.append((at, x / max(float(np.linalg.norm(x)), 1e-12), number[r.lang], float(np.linalg.norm(x))))
    order = np.random.default_rng(7).permutation(len(samples))
    kept = [samples[i] for i in order if i % 5]
    back = [samples[i] for i in order if not i % 5]
    w = ftrl([s[:3] for s in kept], len(languages))
    # prediction leaves the length norm out; the mean norm and the temperature restore the scale
    scores = np.array([(s[1] * s[3]) @ w[s[0]] for s in back]).reshape(-1, len(languages))
    t = temperature(scores, np.array([s[2] for s in back], np.int64))
    return Model(languages, (w * idf[:, None]).astype(np.float32), t)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, *keep, lang_pred, score) per row of ``docs``; null and letterless texts are 'und' with score 0."""
    spark = docs.sparkSession
    workers_ready(spark)
    shared = spark.sparkContext.broadcast(model)
    keep = keep or []
    rows = docs.select(F.col(id_col).alias("id"), *keep, text_or_empty(text_col).alias("_text"))
    names = ["id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [shared.value.predict(t.as_py()) for t in b["_text"]]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
                                             [*names, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(names).schema)
    return rows.mapInArrow(run, f"{fields}, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id's text modulo 4 is 2."""
    return crc_mod(id_col, 4) == 2


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """Learn from the rows that are not held out, then predict all: (id, *keep, lang_pred, score).

    Without any labelled row every prediction is 'und' with score 0.
    """
    learn = docs.where(~held_out(id_col)).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return predict(docs, fit(learn), id_col, text_col, keep)
