"""Text lines -> labelled feature rows.

Input files are headerless, comma-separated numbers.  Every field becomes a
DOUBLE column; one field is the label.  Parsing is plain Column work
(``split`` + ``try_cast``) so it stays inside whole-stage codegen and scales
with the number of input splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions.columns import parse_double

MODES = ("FAILFAST", "PERMISSIVE", "DROPMALFORMED")
CORRUPT = "_corrupt_record"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line (file, folder or glob), column ``value``."""
    return spark.read.text(path)


def _fields(line: Column) -> Column:
    # Split on ',' keeping trailing empty fields, so a trailing comma is
    # a width error instead of a silent label shift.
    return F.split(line, ",", -1)


def parse_points(lines: DataFrame, names: Sequence[str], label: str | int | None = None,
                 mode: str = "FAILFAST", text_col: str = "value",
                 leak_label: bool = False) -> DataFrame:
    """S2 + P1/P2: parse comma-separated lines into ``label`` + feature columns.

    ``names`` names every field in file order.  ``label`` is a field name, a
    field index or None (= last field, P1).  Output: ``label`` then the
    features in file order, all DOUBLE.

    Malformed lines (wrong field count, a field that is not a number, blank
    lines) follow ``mode``: FAILFAST raises, DROPMALFORMED drops them,
    PERMISSIVE keeps them with NULL values and the raw line in
    ``_corrupt_record``.

    ``leak_label=True`` reproduces the old label-at-index behaviour: the
    features are the first n-1 fields whatever the label index is.
    """
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    names = list(names)
    width = len(names)
    if label is None:
        li = width - 1
    elif isinstance(label, int):
        li = label
    else:
        li = names.index(label)
    if not 0 <= li < width:
        raise ValueError(f"label index {li} outside 0..{width - 1}")
    if leak_label:
        feat_idx = list(range(width - 1))
    else:
        feat_idx = [i for i in range(width) if i != li]

    line = F.col(text_col)
    fields = _fields(line)
    parsed = [parse_double(F.get(fields, i)) for i in range(width)]  # NULL when short
    ok = F.size(fields) == F.lit(width)
    for p in parsed:
        ok = ok & p.isNotNull()

    label_out = parsed[li].alias("label")
    feats_out = [parsed[i].alias(names[i]) for i in feat_idx]

    if mode == "FAILFAST":
        guard = F.when(~ok, F.raise_error(F.concat(F.lit("malformed line: "), line)))
        return lines.select(F.coalesce(guard.cast("double"), parsed[li]).alias("label"), *feats_out)
    if mode == "DROPMALFORMED":
        return lines.where(ok).select(label_out, *feats_out)
    return lines.select(
        F.when(ok, parsed[li]).alias("label"),
        *[F.when(ok, parsed[i]).alias(names[i]) for i in feat_idx],
        F.when(~ok, line).alias(CORRUPT),
    )


def read_points(spark: SparkSession, path: str, names: Sequence[str],
                label: str | int | None = None, mode: str = "FAILFAST") -> DataFrame:
    """S1 + S2: read a headerless numeric CSV as labelled rows."""
    return parse_points(read_lines(spark, path), names, label, mode)


def label_at(df: DataFrame, cols: Sequence[str], index: int = -1, leak_label: bool = False) -> DataFrame:
    """Column ``index`` of ``cols`` (default: the last) is the label; the rest the features.

    With ``leak_label`` the features are the first n-1 columns, whatever the
    index (old behaviour, label may stay among the features).
    """
    cols = list(cols)
    index %= len(cols)
    feats = cols[:-1] if leak_label else [c for i, c in enumerate(cols) if i != index]
    return df.select(F.col(cols[index]).cast("double").alias("label"),
                     *[F.col(c).cast("double").alias(c) for c in feats])


def assemble(df: DataFrame, cols: Sequence[str], output: str = "features") -> DataFrame:
    """Feature columns -> one dense vector column.

    ``handleInvalid='keep'`` lets NaN through (as the text parser does);
    NULL becomes NaN inside the vector.
    """
    return VectorAssembler(inputCols=list(cols), outputCol=output,
                           handleInvalid="keep").transform(df)


def features_of(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), output: str = "features") -> DataFrame:
    """``keep`` and the feature vector of ``cols``, nothing else."""
    return assemble(df, cols, output).select(*keep, output)
