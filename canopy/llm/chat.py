"""Chat formatting: roles of transcript lines by a hidden Markov model, then one rendering.

The states are the roles, each as a turn's first line or a later one.  A line
is observed through its speaker marker and a few line features.  Starting,
transition and emission probabilities are smoothed counts over transcripts
whose lines are labelled; Viterbi decoding recovers the states of any
transcript, and the turns they form are rendered canonically.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import text_or_empty, workers_ready

ROLES = ["assistant", "system", "user"]
STATES = [(r, first) for r in ROLES for first in (True, False)]
#: Markers that fewer learning lines have are one class; at most so many markers have their own.
MIN_MARKER = 20
MAX_MARKERS = 512

_MARKER = regex.compile(r"\s*(?:[<\[(#*|]+\s*)?(\p{L}{1,20}(?: \p{L}{1,20})?)\**\s*(?:[:>\])]|\|>)+\**\s*")


def marker(line: str) -> tuple[str, str]:
    """(marker, rest) of a line: a word or two with a speaker's punctuation, or no marker."""
    m = _MARKER.match(line, 0, 64)
    return (m[1].lower(), line[m.end():]) if m else ("", line)


def line_features(line: str, first: bool, before: str) -> tuple[str, ...]:
    """What the model sees of a line: marker, length class, last character, whether it opens the transcript, the end of the line before."""
    name, rest = marker(line)
    last = rest[-1:] if rest[-1:] in ("?", ".", ":", "!", "") else "x"
    prior = before[-1:] if before[-1:] in ("?", ".", ":", "!", "") else "x"
    return name, str(min(len(rest).bit_length(), 12)), last, "first" if first else "", prior


def _described(text: str) -> list[tuple[str, ...]]:
    lines = text.split("\n")
    return [line_features(x, i == 0, lines[i - 1] if i else "") for i, x in enumerate(lines)]


@dataclass
class Model:
    """Log probabilities: start (states), move (states x states), and per feature its values' rows; the row '' of 'other' stands for unseen values."""

    start: np.ndarray
    move: np.ndarray
    emit: list[dict[str, np.ndarray]]

    def emissions(self, seen: list[tuple[str, ...]]) -> np.ndarray:
        return np.array([sum(e.get(v, e[OTHER]) for e, v in zip(self.emit, values, strict=True)) for values in seen])

    def decode(self, text: str) -> list[int]:
        """The most likely state of every line (Viterbi)."""
        scores = self.emissions(_described(text))
        back = np.zeros(scores.shape, np.int8)
        best = self.start + scores[0]
        for t in range(1, len(scores)):
            reach = best[:, None] + self.move
            back[t] = np.argmax(reach, axis=0)
            best = reach[back[t], np.arange(len(best))] + scores[t]
        state = int(np.argmax(best))
        path = [state]
        for t in range(len(scores) - 1, 0, -1):
            state = int(back[t, state])
            path.append(state)
        return path[::-1]


OTHER = "\0other"


def counts(transcripts: DataFrame) -> DataFrame:
    """(part, value, state, n) over labelled ``transcripts`` (text, states): starts, moves and each feature's values."""
    workers_ready(transcripts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[tuple[str, str, int], int] = {}
            for text, states in zip(b["text"].to_pylist(), b["states"].to_pylist(), strict=True):
                for t, values in enumerate(_described(text)):
                    keys = [("start", "", states[t]) if t == 0 else ("move", str(states[t - 1]), states[t])]
                    keys += [(str(k), v, states[t]) for k, v in enumerate(values)]
                    for key in keys:
                        found[key] = found.get(key, 0) + 1
            if found:
                part, value, state = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(value), pa.array(state, pa.int32()), pa.array(list(found.values()), pa.int64())],
                                                 ["part", "value", "state", "n"])

    each = transcripts.select("text", "states").mapInArrow(run, "part string, value string, state int, n bigint")
    return each.groupBy("part", "value", "state").agg(F.sum("n").alias("n"))


def fit(transcripts: DataFrame) -> Model:
    """The model of labelled ``transcripts`` (text, states: a state number per line).

    The driver gets the counts of states and of at most MAX_MARKERS markers.
    """
    table = counts(transcripts)
    names = table.where("part = '0'").groupBy("value").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_MARKER)
    kept = {r.value for r in names.orderBy(F.desc("n"), "value").limit(MAX_MARKERS).collect()}
    some = table.withColumn("value", F.when((F.col("part") != "0") | F.col("value").isin(sorted(kept)), F.col("value")).otherwise(F.lit(OTHER)))
    k = len(STATES)
    start, move = np.full(k, 0.5), np.full((k, k), 0.5)
    # a turn's later line belongs to the turn before: another role cannot have it
    for i, (a, _) in enumerate(STATES):
        for j, (b, first) in enumerate(STATES):
            if not first and a != b:
                move[i, j] = 1e-6
    for j, (_, first) in enumerate(STATES):
        if not first:
            start[j] = 1e-6
    emit: list[dict[str, np.ndarray]] = [{OTHER: np.full(k, 0.5)} for _ in range(5)]
    for r in some.groupBy("part", "value", "state").agg(F.sum("n").alias("n")).collect():
        if r.part == "start":
            start[r.state] += r.n
        elif r.part == "move":
            move[int(r.value), r.state] += r.n
        else:
            emit[int(r.part)].setdefault(r.value, np.full(k, 0.5))[r.state] += r.n
    emit = [{v: np.log(x / sum(e.values())) for v, x in e.items()} for e in emit]
    return Model(np.log(start / start.sum()), np.log(move / move.sum(axis=1, keepdims=True)), emit)


def parse(transcripts: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """(*keep, roles, firsts, rendered, n_turns) per row of ``transcripts`` (*keep, text).

    roles and firsts hold each line's role and whether it opens a turn.
    rendered: every turn as <|role|>, its lines without the speaker marker of
    its first one, and <|end|>.  Null and empty texts have one empty line.
    """
    spark = transcripts.sparkSession
    workers_ready(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = transcripts.select(*keep, text_or_empty("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles, firsts, rendered, turns = [], [], [], []
            for text in b["text"].to_pylist():
                states = [STATES[s] for s in shared.value.decode(text)]
                out: list[str] = []
                for line, (role, first) in zip(text.split("\n"), states, strict=True):
                    if first or not out:
                        out += ["<|end|>"] * bool(out) + [f"<|{role}|>", marker(line)[1]]
                    else:
                        out.append(line)
                roles.append([r for r, _ in states])
                firsts.append([f or i == 0 for i, (_, f) in enumerate(states)])
                rendered.append("\n".join([*out, "<|end|>"]))
                turns.append(sum(firsts[-1]))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(roles, pa.list_(pa.string())), pa.array(firsts, pa.list_(pa.bool_())),
                                              pa.array(rendered, pa.string()), pa.array(turns, pa.int64())], [*keep, "roles", "firsts", "rendered", "n_turns"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(run, f"{fields}, roles array<string>, firsts array<boolean>, rendered string, n_turns bigint")


# ---- transcripts made of a table of turns -------------------------------------------------------------

#: Turns of one conversation that form one transcript.
TURNS = 256
#: Speaker markers of the styles that transcripts are written in (fixed values).
STYLES = {
    "user": ["User: ", "Human: ", "Q: ", "[user] ", "**Customer:** "],
    "assistant": ["Assistant: ", "AI: ", "A: ", "[assistant] ", "**Agent:** "],
    "system": ["System: ", "Instructions: ", "Note: ", "[system] ", "**Setup:** "],
}


def written_as(role: Column, style: Column, unmarked: Column) -> Column:
    """The speaker marker of a turn: of its transcript's style, or none."""
    named = F.lit("")
    for r, marks in STYLES.items():
        named = F.when(role == r, F.element_at(F.array(*[F.lit(m) for m in marks]), style + 1)).otherwise(named)
    return F.when(unmarked, F.lit("")).otherwise(named)


def transcripts(turns: DataFrame) -> DataFrame:
    """(conv_id, part, extra, text, states, known) per transcript of ``turns`` (conv_id, turn, role, text).

    A transcript holds up to TURNS turn numbers in order, each turn behind a
    marker of the conversation's style; one turn in ten, by its hash, has
    none.  Identical rows are one turn.  Turns without a conversation, and a
    turn number's texts beyond one, are transcripts of their own (``extra``
    is then a hash of the turn), so none grows without bound.  ``states`` are the labelled states per line; ``known``: every turn
    has a role of ROLES, so the transcript can be learned from.
    """
    t = turns.select("conv_id", "turn", "role", text_or_empty("text").alias("text")).distinct()
    style = F.pmod(F.xxhash64("conv_id", F.lit("style")), F.lit(5)).cast("int")
    bare = F.pmod(F.xxhash64("conv_id", "turn", "text"), F.lit(10)) == 0
    line = F.concat(written_as(F.col("role"), style, bare), F.col("text"))
    number = F.lit(-1)
    for i, (r, first) in enumerate(STATES):
        if first:
            number = F.when(F.col("role") == r, F.lit(i)).otherwise(number)
    states = F.concat(F.array(number), F.array_repeat(F.when(number < 0, number).otherwise(number + 1), F.size(F.split(line, "\n")) - 1))
    part = F.floor(F.coalesce("turn", F.lit(-1)) / TURNS)
    rows = t.select("conv_id", part.alias("part"), "turn", line.alias("line"), states.alias("states"))
    # a turn number with several texts: the smallest text is the conversation's turn, each other one a transcript of its own
    first = rows.groupBy("conv_id", "turn").agg(F.min(F.struct("line", "states")).alias("least"))
    rows = rows.join(first.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "least"),
                     F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")))
    extra = F.col("conv_id").isNull() | (F.struct("line", "states") != F.col("least"))
    rows = rows.select("conv_id", "part", F.when(extra, F.xxhash64("turn", "line")).alias("extra"), F.struct("turn", "line", "states").alias("t"))
    one = rows.groupBy("conv_id", "part", "extra").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return one.select("conv_id", "part", "extra", F.concat_ws("\n", F.transform("ts", lambda x: x["line"])).alias("text"),
                      F.flatten(F.transform("ts", lambda x: x["states"])).alias("states"),
                      F.forall("ts", lambda x: F.element_at(x["states"], 1) >= 0).alias("known"))
