"""Sums of doubles that do not depend on the order of the rows.

A finite double is a whole number of at most 53 bits times a power of two; cut
at the multiples of 2^32 it is three whole numbers of at most 32 bits, without
error.  Whole numbers add up exactly: a task adds the pieces of its rows per
place (Arrow batches, a few array operations for all sums together) and sends
one row per sum and place it met, some dozens however many rows it read.
Spark adds those as decimals, and a step over one row per group puts them
together as a rational number, which is rounded once.  So a figure is the same
to the last bit on any partitioning, and as near to the true one as a double can be.

Values that are not finite are added apart (NaN or an infinity, whatever the order).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from fractions import Fraction
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.session import ship_package

#: A sum: its name and the values to add, one per row; masked ones (numpy.ma) add nothing.
Term = tuple[str, np.ndarray]
#: Places: the multiples of 2^32 from 2^-1152 on.
_PLACES, _FIRST = 72, 36
#: Veltkamp's constant: separates the upper 26 bits of a double.
_SPLIT = 134217729.0
_MASK = np.int64(0xFFFFFFFF)


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(upper, lower): x = upper + lower, each of at most 26 bits, so that products of halves are exact."""
    with np.errstate(over="ignore", invalid="ignore"):
        big = x * _SPLIT
        upper = big - (big - x)
        return upper, x - upper


def products(name: str, a: np.ndarray, b: np.ndarray) -> list[Term]:
    """Terms whose total is exactly that of a * b, for values of size 2^-450 to 2^500."""
    if a is b:
        ah, al = halves(a)
        return [(name, ah * ah), (name, 2 * ah * al), (name, al * al)]
    (ah, al), (bh, bl) = halves(a), halves(b)
    return [(name, ah * bh), (name, ah * bl), (name, al * bh), (name, al * bl)]


def places(values: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """[group, place] whole numbers: the sum of finite ``values`` of each group, in units of the places (at most 2^20 values)."""
    m, e = np.frexp(values)
    whole = (m * 9007199254740992.0).astype(np.int64)  # 53 bits
    e = e.astype(np.int64) - 53
    place, shift = e >> 5, e & 31
    low, high = (whole & _MASK) << shift, (whole >> 32) << shift
    at = group * _PLACES + place + _FIRST
    total = np.zeros(groups * _PLACES + 2)
    for up, part in ((0, low & _MASK), (1, (low >> 32) + (high & _MASK)), (2, high >> 32)):
        total += np.bincount(at + up, weights=part, minlength=len(total))  # whole numbers below 2^53
    return total[:-2].reshape(groups, _PLACES).astype(np.int64)


def _groups(keys: list[pa.Array]) -> tuple[np.ndarray, list[tuple]]:
    """(group of every row, the groups' keys): equal keys are one group, NULL like NaN."""
    codes = [k.dictionary_encode("encode") if k.type != pa.null() else k.cast(pa.int32()).dictionary_encode("encode") for k in keys]
    frame = pd.DataFrame({i: c.indices.to_numpy(zero_copy_only=False) for i, c in enumerate(codes)})
    group = frame.groupby(list(frame.columns), sort=False).ngroup().to_numpy()
    values = [c.dictionary.to_pylist() for c in codes]
    merged: dict[tuple, int] = {}
    rows = [tuple(None if pd.isna(x := v[i]) else x for v, i in zip(values, r)) for r in frame.drop_duplicates().itertuples(index=False)]
    number = np.array([merged.setdefault(r, len(merged)) for r in rows])
    return number[group], list(merged)


def exact_totals(df: DataFrame, keys: Sequence[str], inputs: Sequence[str], terms: Callable[..., list[Term]]) -> DataFrame:
    """(keys, totals): per group the exact parts of every sum, for ``exact_values``.

    ``terms`` gets the double columns ``inputs`` of a batch as arrays (NaN for
    NULL) and, as its last argument, their NULL masks; it returns the values to
    add per row, masked where a row takes no part.  Terms of one name are one sum.
    """
    ship_package(df.sparkSession)
    kinds = {f.name: f.dataType for f in df.select(*keys).schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        odd: dict[tuple, float] = {}
        arrow = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 1 << 16):
                b = batch.slice(begin, 1 << 16)
                arrow = {k: b[k].type for k in keys}
                if keys:
                    group, names = _groups([b[k] for k in keys])
                else:
                    group, names = np.zeros(b.num_rows, np.int64), [()]
                columns = [b[c].to_numpy(zero_copy_only=False) for c in inputs]
                missing = [b[c].is_null().to_numpy(zero_copy_only=False) for c in inputs]
                for name, values in terms(*columns, missing):
                    kept = ~np.ma.getmaskarray(values)
                    x, g = np.ma.getdata(values)[kept], group[kept]
                    finite = np.isfinite(x)
                    if not finite.all():
                        for k in np.unique(g[~finite]):
                            odd[name, names[k]] = odd.get((name, names[k]), 0.0) + float(x[~finite & (g == k)].sum())
                        x, g = x[finite], g[finite]
                    for k, row in enumerate(places(x, g, len(names))):
                        held[name, names[k]] = held.get((name, names[k]), 0) + row
        rows = [(*key, name, int(at) - _FIRST, int(v[at]), None) for (name, key), v in held.items() for at in (np.flatnonzero(v) if v.any() else [_FIRST])]
        rows += [(*key, name, None, None, x) for (name, key), x in odd.items()]
        if rows:
            types = [*arrow.values(), pa.string(), pa.int32(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [*keys, "name", "place", "total", "odd"])

    ddl = ", ".join([*[f"`{k}` {t.simpleString()}" for k, t in kinds.items()], "name string, place int, total bigint, odd double"])
    some = df.select(*keys, *[c for c in inputs if c not in keys]).mapInArrow(run, ddl)
    whole = some.groupBy(*keys, "name", "place").agg(F.sum(F.col("total").cast("decimal(20,0)")).cast("string").alias("total"), F.sum("odd").alias("odd"))
    return whole.groupBy(*keys).agg(F.collect_list(F.struct("name", "place", "total", "odd")).alias("totals"))


def exact_values(totals: list[dict]) -> dict[str, Fraction | float]:
    """Name -> the exact sum, or a double that is not finite."""
    out: dict[str, Fraction | float] = {}
    for t in totals:
        value = t["odd"] if t["place"] is None else int(t["total"]) * Fraction(2) ** (32 * t["place"])
        held = out.get(t["name"], Fraction(0))
        if isinstance(value, float) or isinstance(held, float):
            out[t["name"]] = (value if isinstance(value, float) else 0.0) + (held if isinstance(held, float) else 0.0)
        else:
            out[t["name"]] = held + value
    return out


def root(x: Fraction) -> float:
    """Square root of a rational number, right to the last bits: from the whole root of it scaled up by a power of four."""
    if x <= 0:
        return 0.0
    shift = max(0, 160 - (x.numerator.bit_length() - x.denominator.bit_length()))
    shift += shift % 2
    return float(Fraction(isqrt((x.numerator << shift) // x.denominator), 1 << (shift // 2)))


def finished(totals: DataFrame, columns: str, finish: Callable[[dict], tuple]) -> DataFrame:
    """``totals`` (of exact_totals) with ``finish``'s values (DDL ``columns``) in place of the totals: one row per group, a small step."""
    kept = [f for f in totals.schema.fields if f.name != "totals"]
    names = [c.split()[0] for c in columns.split(", ")]
    types = {"long": pa.int64(), "double": pa.float64()}
    arrow = [types[c.split()[1]] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [finish(exact_values(t)) for t in b["totals"].to_pylist()]
            values = [pa.array([r[i] for r in rows], t) for i, t in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays([*[b[f.name] for f in kept], *values], [*[f.name for f in kept], *names])

    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], columns])
    return totals.mapInArrow(run, ddl)


def with_one_group(totals: DataFrame) -> DataFrame:
    """``totals`` without keys, with a row for no rows too."""
    none = totals.sparkSession.range(1).select(F.array().cast(totals.schema["totals"].dataType).alias("totals"))
    return totals.unionByName(none).agg(F.flatten(F.collect_list("totals")).alias("totals"))
