"""Column-level helpers shared by several operators (all JVM-side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hash buckets: 1000 buckets from the first 32 bits of an md5 of the key
# columns joined by '|'.  md5 is used (not xxhash64) because the same bucket
# must come out of any SQL engine that has md5, so splits are reproducible
# outside Spark and do not depend on partitioning or task order.
HASH_BUCKETS = 1000


def key_string(cols: Sequence[str | Column]) -> Column:
    """'|'-joined string form of the key columns (nulls skipped)."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.concat_ws("|", *parts)


def hash_bucket(cols: Sequence[str | Column], salt: str = "", method: str = "md5") -> Column:
    """Deterministic bucket in [0, 1000) from the key columns.

    ``md5`` (default) can be reproduced by any SQL engine with md5;
    ``xxhash64`` is several times cheaper per row when only Spark has to
    reproduce the split.
    """
    if method == "xxhash64":
        parts = [F.lit(salt)] + [F.col(c) if isinstance(c, str) else c for c in cols]
        return F.pmod(F.xxhash64(*parts), F.lit(HASH_BUCKETS)).cast("int")
    key = key_string(cols)
    if salt:
        key = F.concat_ws("|", F.lit(salt), key)
    hex8 = F.substring(F.md5(key), 1, 8)
    return (F.conv(hex8, 16, 10).cast("bigint") % HASH_BUCKETS).cast("int")


def hash_unit(cols: Sequence[str | Column], salt: str = "") -> Column:
    """Deterministic uniform double in [0, 1) from the key columns (xxhash64).

    Used where no outside engine has to reproduce the draw (bootstrap
    weights); xxhash64 is far cheaper than md5 per row.
    """
    key = [F.lit(salt)] + [F.col(c) if isinstance(c, str) else c for c in cols]
    h = F.xxhash64(*key)
    # top 53 bits as a fraction: uniform on [0, 1)
    return F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)


def md5_unit(cols: Sequence[str | Column], salt: str, slot: int) -> Column:
    """Uniform double in [0, 1) from 32 bits (``slot`` 0..3) of
    md5('<salt>|<key>').  Four draws share one md5, and any SQL engine with
    md5 gives the same numbers."""
    return hex_unit(md5_hex(cols, salt), slot)


def md5_hex(cols: Sequence[str | Column], salt: str) -> Column:
    """md5('<salt>|<key>') as text: the source of four uniform draws."""
    return F.md5(F.concat_ws("|", F.lit(salt), key_string(cols)))


def hex_unit(digest: Column, slot: int) -> Column:
    """The uniform double of ``slot`` (0..3) of an md5's text."""
    if not 0 <= slot < 4:
        raise ValueError("slot must be 0..3")
    return F.conv(F.substring(digest, 8 * slot + 1, 8), 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)


def parse_double(field: Column) -> Column:
    """String field -> double; NULL when the text is not a number.

    Accepts surrounding blanks, NaN and Infinity like Double.parseDouble.
    """
    return F.trim(field).try_cast("double")
