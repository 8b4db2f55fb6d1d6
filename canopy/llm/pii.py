"""Personal data by patterns and by bootstrapped contextual extraction, in DataFrame operations only.

Four base patterns find e-mail addresses, IP addresses, card and phone
numbers.  They seed the bootstrap: every identifier-like token (with a digit
or an at sign) is an instance, the one and the two words before it are its
patterns, and the graph of patterns and instances is scored in rounds.  A
pattern is as reliable for a kind as the share of its distinct instances that
are of the kind; an instance is of the kind if reliable patterns lead to it
and its form allows the kind.  Reliable patterns so find identifiers that the
base patterns miss; what they find counts in the next round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import text_or_empty, written

# ---- fixed values: kinds in their order, and their patterns as runs that cannot be scanned twice ----
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What must be in a text for its pattern to be tried.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# ------------------------------------------------------------------------------------------------------
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Characters before a candidate in which its one or two words are looked for.
CONTEXT = 80
#: A pattern needs this many distinct instances of the kind, and this share of all its instances.
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.8
ROUNDS = 3


def _luhn(digits: Column) -> Column:
    def term(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + term(i)) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """Does a match of the kind's pattern pass its check?"""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda x: x.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def matches(text: Column, pattern: str, tried: Column) -> Column:
    """All matches of ``pattern``; none where ``tried`` is false."""
    return F.when(tried, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def located(text: Column, found: Column, pattern: str) -> Column:
    """The matches ``found`` of ``pattern`` in ``text`` as array<struct<start,end,value,before>>, in code points.

    Matches and the pieces between them alternate, so running lengths give
    the offsets; ``before`` is the end of the piece in front of a match.
    """
    empty = F.array().cast("array<struct<start:int,end:int,value:string,before:string>>")
    parts = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found, lambda p, x: F.struct(p.alias("p"), x.alias("x")))

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["p"])
        end = start + F.length(m["x"])
        one = F.struct(start.alias("start"), end.alias("end"), m["x"].alias("value"), F.substring(m["p"], -CONTEXT, CONTEXT).alias("before"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    run = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return F.when(F.size(found) > 0, run).otherwise(empty)


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("int")


def _sorted_spans(spans: Column) -> Column:
    """Spans (kind, start, end) by start, then kind as listed, then end."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), _order(s["kind"]).alias("o"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def base_spans(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, *keep, base, candidates) per row of ``docs``.

    base: array<struct<kind,start,end>>, sorted.  candidates: identifier-like
    tokens with their offsets, the lower-cased words before them and the kind
    and text of the base span that begins in them (kind null: none does).
    """
    keep = keep or []
    t = F.col("_text")
    digit = t.rlike("[0-9]")
    hints = {k: t.contains(h) if h else digit for k, h in HINTS.items()}
    hints["ip"] = hints["ip"] & digit
    step = docs.select(*keep, text_or_empty(text_col).alias("_text"))
    step = step.select("*", *[matches(t, PATTERNS[k], hints[k]).alias(f"_m_{k}") for k in KINDS],
                       matches(t, CANDIDATE, digit | t.contains("@")).alias("_m_token"))
    step = step.select(*keep, *[located(t, F.col(f"_m_{k}"), PATTERNS[k]).alias(f"_l_{k}") for k in KINDS],
                       located(t, F.col("_m_token"), CANDIDATE).alias("_l_token"))

    def spans(kind: str) -> Column:
        good = F.filter(F.col(f"_l_{kind}"), lambda m: valid(kind, m["value"]))
        return F.transform(good, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))

    step = step.select(*keep, F.concat(*[spans(k) for k in KINDS]).alias("_found"), F.col("_l_token").alias("_tokens"))
    step = step.select(*keep, _sorted_spans(F.col("_found")).alias("base"), "_found", "_tokens")

    def candidate(m: Column) -> Column:
        words = F.split(F.trim(F.lower(F.regexp_replace(m["before"], r"\s+", " "))), " ")
        # a span that begins inside the token names its kind; one that covers the token's start makes it no candidate
        inside = F.get(F.filter(F.col("_found"), lambda s: (s["start"] >= m["start"]) & (s["start"] < m["end"])), F.lit(0))
        covered = F.exists(F.col("base"), lambda s: (s["start"] < m["start"]) & (s["end"] > m["start"]))
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lower(F.coalesce(inside["value"], m["value"])).alias("value"),
                        F.element_at(words, -1).alias("one"), F.array_join(F.slice(words, -F.least(F.size(words), F.lit(2)), 2), " ").alias("two"),
                        inside["kind"].alias("kind"), covered.alias("covered"))

    return step.select(F.monotonically_increasing_id().alias("row"), *keep, "base",
                       F.filter(F.transform("_tokens", candidate), lambda c: ~c["covered"]).alias("candidates"))


def form_allows(kind: Column, value: Column) -> Column:
    """Can a token of this form be of the kind, though its base pattern misses it?"""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return (F.when(kind == "email", value.contains("@"))
            .when(kind == "ip", value.rlike(r"^[0-9a-f]{0,4}(?::[0-9a-f]{0,4}){3,7}$|^[0-9]{1,3}(?:[.,-][0-9]{1,3}){3}$"))
            .when(kind == "card", digits.between(12, 19) & value.rlike(r"^[0-9x*/.-]+$"))
            .otherwise(digits.between(6, 15) & value.rlike(r"^[+(]?[0-9][0-9()/.-]*$")))


def bootstrap(found: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(value, kind) of the instances that reliable patterns find beyond the seeds.

    found: candidates (value, one, two, kind).  Patterns and instances are
    aggregated to distinct pairs before they are joined, so that a very
    frequent word or value weighs one row per partner.
    """
    pairs = written(found.select("value", F.explode(F.array(F.concat(F.lit("1 "), "one"), F.concat(F.lit("2 "), "two"))).alias("pattern"))
                    .where("pattern <> '1 ' and pattern <> '2 '").distinct(), "pairs")
    seeds = found.where("kind is not null").select("value", "kind").distinct().withColumn("confidence", F.lit(1.0))
    known = seeds = written(seeds, "seeds")
    totals = written(pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= min_seeds), "totals")
    extra = seeds.where("false")
    for _ in range(rounds):
        hits = (pairs.join(known, "value").groupBy("pattern", "kind")
                .agg(F.sum("confidence").alias("sure"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_seeds))
        patterns = written(hits.join(totals, "pattern").select("pattern", "kind", (F.col("sure") / F.col("total")).alias("reliable"))
                           .where(F.col("reliable") >= min_confidence), "patterns")
        if patterns.isEmpty():
            break
        led = (pairs.join(patterns, "pattern").where(form_allows(F.col("kind"), F.col("value")))
               .groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("reliable"), F.lit(1e-6)))))).alias("confidence"))
               .where(F.col("confidence") >= min_confidence)
               .join(seeds.select("value").distinct(), "value", "left_anti"))
        best = written(led.groupBy("value").agg(F.max_by(F.struct("kind", "confidence"), F.struct("confidence", "kind")).alias("b"))
                       .select("value", "b.kind", "b.confidence"), "instances")
        same = best.count() == extra.count() and best.join(extra, ["value", "kind"], "left_anti").isEmpty()
        extra = best
        if same:
            break
        known = seeds.union(extra)
    return extra.select("value", "kind")


def find(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(*keep, base, spans) per row of ``docs``: the base spans, and those with what the bootstrap adds.

    Spans are array<struct<kind,start,end>> in code points, end exclusive,
    sorted by start, then kind.  Null text is the empty text (no spans).
    Repeated rows have equal results.
    """
    keep = keep or []
    rows = written(base_spans(docs, text_col, keep), "spans")
    found = rows.select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    new = bootstrap(found.select("value", "one", "two", "kind"))
    added = (found.where("kind is null").select("row", "value", "start", "end").join(new, "value")
             .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added")))
    added = written(added, "added")
    both = rows.join(added, "row", "left")
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return both.select(*keep, "base", _sorted_spans(F.concat("base", F.coalesce("added", empty))).alias("spans"))


def joined(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets; of spans that overlap the first names the whole."""
    def step(acc: Column, s: Column) -> Column:
        clear = s["start"] >= acc["at"]
        out = F.when(clear, F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">")))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    end = F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, end).otherwise(text)
