"""Line deduplication by a fixed-depth log-template tree, in DataFrame operations only.

A line's tokens are what spaces separate; those with a digit become wildcards.  Its place in the tree is
given by the number of tokens and the leading tokens; a leaf holds all lines
of one place.  In a leaf of several distinct lines, the most frequent token of
each position forms the leaf's template; lines that agree with it in most
positions are instances of it, all others are templates of their own.  A
template recurs if it stands in two documents or more and what it repeats
there, beyond the leading tokens that name its place, adds up to enough
constant tokens; its lines are dropped from every document but the first.
So are lines that recur exactly and repeat enough characters in all, however
few their tokens are (texts without spaces are one token).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import small, text_or_empty, written, written_at
from canopy.session import drop_scratch

#: Tokens after the count that lead to a leaf.
DEPTH = 2
#: Share of positions in which an instance agrees with its leaf's template.
SIMILARITY = 0.7
#: Distinct lines that a leaf needs for a template beyond its own lines.
MIN_VARIANTS = 3
#: A template recurs if (documents - 1) x (constant tokens beyond the leading ones) reaches this.
EVIDENCE = 20
#: An exact line recurs as well if (documents - 1) x (its characters) reaches this.
CHARACTERS = 100
WILDCARD = "<*>"
_VARIABLE = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"


def masked_lines(text: Column) -> Column:
    """The lines of a text with wildcards for tokens that hold a digit, without spaces at their ends."""
    whole = F.when(text.rlike("[0-9]"), F.regexp_replace(text, _VARIABLE, WILDCARD)).otherwise(text)
    return F.transform(F.split(whole, "\n"), F.trim)


def _size(mask: Column) -> Column:
    return F.octet_length(mask) - F.octet_length(F.replace(mask, F.lit(" "), F.lit(""))) + 1


def leaf(mask: Column) -> Column:
    """The hash of a masked line's place in the tree: its number of tokens and the leading ones."""
    return F.xxhash64(_size(mask), F.substring_index(mask, " ", DEPTH))


def constants(mask: Column) -> Column:
    """Number of tokens that are no wildcard."""
    wild = (F.octet_length(mask) - F.octet_length(F.replace(mask, F.lit(WILDCARD), F.lit("")))) / len(WILDCARD)
    return _size(mask) - wild.cast("int")


def line_table(rows: DataFrame) -> DataFrame:
    """(id, text_hash, lines) of ``rows`` (id, text): per line its hash, leaf and constant tokens, and its exact hash and characters; a blank line has none."""
    def one(mask: Column, exact: Column) -> Column:
        return F.when(mask != "", F.struct(F.xxhash64(mask).alias("line"), leaf(mask).alias("leaf"), constants(mask).alias("constants"),
                                           F.xxhash64(exact).alias("exact"), F.length(exact).alias("characters")))

    raw = F.transform(F.split("text", "\n"), F.trim)
    return rows.select("id", F.xxhash64("text").alias("text_hash"), F.zip_with(masked_lines(F.col("text")), raw, one).alias("lines"))


def _kept(df: DataFrame, kind: str, paths: list[str]) -> DataFrame:
    """``df`` written, its path added to ``paths``."""
    table, path = written_at(df, kind)
    paths.append(path)
    return table


def templates(rows: DataFrame, table: DataFrame, similarity: float = SIMILARITY, evidence: int = EVIDENCE, paths: list[str] | None = None) -> DataFrame:
    """(line, first): hashes of the masked lines in ``rows`` (id, text) whose template recurs, and the smallest id with it.

    ``table`` is the line table of ``rows``.  The paths of what the result reads are added to ``paths``.
    """
    paths = [] if paths is None else paths
    masked = F.transform("lines", lambda x: F.when(x.isNotNull(), F.struct(x["line"], x["leaf"], x["constants"])))
    lines = table.select("id", F.explode(F.array_distinct(masked)).alias("l")).where("l is not null").select("id", "l.*")
    counts = _kept(lines.groupBy("leaf", "line", "constants")
                   .agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("first"), F.max("id").alias("last")), "lines", paths)
    enough = (F.col("docs") - 1) * (F.col("constants") - DEPTH) >= evidence
    several = F.col("docs") > 1
    own = counts.where(several & enough).select("line", "first")

    # leaves of several distinct lines: the most frequent token of each position
    wide = (counts.groupBy("leaf").agg(F.count(F.lit(1)).alias("variants"), F.sum("docs").alias("docs"), F.max("constants").alias("constants"))
            .where((F.col("variants") >= MIN_VARIANTS) & enough).select("leaf"))
    wide = _kept(wide, "leaves", paths)
    spelled = rows.select(F.explode(F.array_distinct(masked_lines(F.col("text")))).alias("mask")).where("mask <> ''")
    spelled = spelled.select(leaf(F.col("mask")).alias("leaf"), "mask")
    members = spelled.join(small(wide, wide.count()), "leaf", "left_semi").groupBy("leaf", "mask").agg(F.count(F.lit(1)).alias("docs"))
    members = _kept(members, "members", paths)
    tokens = members.select("leaf", "docs", F.posexplode(F.split("mask", " ")).alias("pos", "token"))
    heavy = tokens.groupBy("leaf", "pos", "token").agg(F.sum("docs").alias("docs"))
    best = heavy.groupBy("leaf", "pos").agg(F.max_by("token", F.struct("docs", "token")).alias("token"))
    template = best.groupBy("leaf").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("template"))
    template = _kept(template, "template", paths)
    same = F.zip_with(F.split("mask", " "), "template", lambda a, b: (a == b).cast("int"))
    held = F.aggregate(same, F.lit(0), lambda acc, x: acc + x)
    instance = (members.join(template, "leaf").withColumn("held", held)
                .where(F.col("held") >= similarity * F.size("template"))
                .select("leaf", F.xxhash64("mask").alias("line"), "held"))
    instance = _kept(instance, "instances", paths)
    joined = instance.join(counts.select("leaf", "line", "docs", "constants", "first", "last"), ["leaf", "line"])
    general = (joined.groupBy("leaf").agg(F.sum("docs").alias("docs"), F.min(F.least("held", "constants")).alias("constants"),
                                          F.min("first").alias("first"), F.max("last").alias("last"), F.count(F.lit(1)).alias("lines"))
               .where((F.col("lines") > 1) & (F.col("first") < F.col("last")) & enough).select("leaf", "first"))
    of_general = instance.join(general, "leaf").select("line", "first")
    return own.union(of_general).groupBy("line").agg(F.min("first").alias("first"))


def exact_repeats(table: DataFrame, characters: int = CHARACTERS) -> DataFrame:
    """(exact, first): hashes of the lines of a line table that recur as they are, and the smallest id with each."""
    pairs = F.transform("lines", lambda x: F.when(x.isNotNull(), F.struct(x["exact"], x["characters"])))
    lines = table.select("id", F.explode(F.array_distinct(pairs)).alias("l")).where("l is not null").select("id", "l.*")
    counts = lines.groupBy("exact", "characters").agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("first"))
    return counts.where((F.col("docs") > 1) & ((F.col("docs") - 1) * F.col("characters") >= characters)).select("exact", "first")


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                   evidence: int = EVIDENCE, characters: int = CHARACTERS) -> DataFrame:
    """``docs`` with recurring lines dropped from ``text_col``, plus n_lines and n_dropped (existing columns of these names are replaced).

    A line stays in the document with the smallest id among those that hold
    its template, or the very line if only that recurs; rows that share that id keep it all.  Lines are dropped
    whole, the others stay unchanged, blank ones too.  Null text stays null,
    with zero lines.  Rows with a null id count as documents, but no template
    is kept for them unless all its ids are null.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    table, table_path = written_at(line_table(rows), "table")
    paths: list[str] = []
    recurring, recurring_path = written_at(templates(rows, table, similarity, evidence, paths), "recurring")
    for path in paths:
        drop_scratch(docs.sparkSession, path)
    # the places of the lines to drop in each document; equal texts under one id share a row
    held = table.select("id", "text_hash", F.posexplode("lines").alias("place", "l")).select("id", "text_hash", "place", "l.line", "l.exact")
    later = ~F.col("id").eqNullSafe(F.col("first"))
    hits = held.join(recurring, "line").where(later).select("id", "text_hash", "place")
    repeats, repeats_path = written_at(exact_repeats(table, characters), "repeats")
    hits = hits.union(held.join(repeats, "exact").where(later).select("id", "text_hash", "place"))
    drops = written(hits.groupBy("id", "text_hash").agg(F.collect_set("place").alias("places")), "drops")
    # the texts are moved next, while only the places are kept
    for path in (table_path, recurring_path, repeats_path):
        drop_scratch(docs.sparkSession, path)
    rows = docs.select(F.struct("*").alias("row")).select("row", F.col(f"row.{id_col}").alias("id"),
                                                          F.xxhash64(text_or_empty(F.col(f"row.{text_col}"))).alias("text_hash"))
    right = drops.select(F.col("id").alias("drop_id"), F.col("text_hash").alias("drop_hash"), "places").hint("merge")
    both = rows.join(right, F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("text_hash") == F.col("drop_hash")), "left")
    old = F.col(f"row.{text_col}")
    lines = F.split(old, "\n")
    left = F.filter(lines, lambda x, i: ~F.array_contains(F.col("places"), i))
    new = F.when(F.col("places").isNull(), old).otherwise(F.array_join(left, "\n"))
    count = F.octet_length(old) - F.octet_length(F.replace(old, F.lit("\n"), F.lit(""))) + 1
    out = both.select("row", new.alias("new"), F.when(old.isNull(), 0).otherwise(count).alias("n"), F.coalesce(F.size("places"), F.lit(0)).alias("dropped"))
    columns = [F.col("new").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*columns, F.col("n").cast("long").alias("n_lines"), F.greatest("dropped", F.lit(0)).cast("long").alias("n_dropped"))
