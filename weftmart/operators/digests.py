"""Differences of large tables by digests of key ranges.

The span of the key is cut into ``fan ** levels`` leaves of equal width. A digest of a range is its row count and two
order-independent checksums (exclusive or, and exact sum, of two 64-bit row hashes), so it needs no sorting and combines in
each task. Both sides are digested coarsely; ranges that differ are digested again ``fan`` times finer, and only rows of
leaves that still differ are shuffled and compared one by one. Equal ranges cost a scan and a handful of numbers. A
stored side can keep its digest (``digest``), which saves the scan of all but its differing leaves.

Leaves follow the first key column where it is a number, a date or a time, so that changes to neighbouring keys, such as
the newest ones, stay in few leaves; any other key is dealt by its hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftmart.operators.diff import SAME, keyed_diff
from weftmart.operators.project import named
from weftmart.session import materialise, write_table

_LEAF, _RANGE = "__leaf", "__range"


@dataclass(frozen=True)
class Digest:
    """Digests of a table's leaves, and where these lie."""

    rows: DataFrame
    low: float
    high: float
    fan: int
    levels: int


def _place(df: DataFrame, keys: Sequence[str]) -> Column:
    kind = df.schema[keys[0]].dataType
    key = named(keys[0])
    if isinstance(kind, T.NumericType):
        return key.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(key.cast("timestamp")).cast("double")
    return F.xxhash64(*[named(k) for k in keys]).cast("double")


def _bounds(df: DataFrame, keys: Sequence[str]) -> tuple[float, float]:
    """The span of the keys; rows outside of it, on the other side, have leaves of their own at the ends."""
    low, high = df.agg(F.min(_place(df, keys)), F.max(_place(df, keys))).first()
    if low is None or low != low or high != high:
        low, high = 0.0, 1.0
    return low, high if high > low else low + 1.0


def _leaf(df: DataFrame, keys: Sequence[str], low: float, high: float, leaves: int) -> Column:
    # a key without a place, null or no number, has the first leaf
    return F.coalesce(F.width_bucket(_place(df, keys), F.lit(low), F.lit(high), F.lit(leaves)), F.lit(0)).cast("bigint")


def _digested(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Digests by a range column."""
    parts = [p for c in columns for p in (named(c), named(c).isNull())]
    rows = df.select(by, F.xxhash64(F.lit(1), *parts).alias("x"), F.xxhash64(F.lit(2), *parts).cast("decimal(20,0)").alias("s"))
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"))


def _summed(leaves: DataFrame, by: Column) -> DataFrame:
    """Digests of coarser ranges from those of leaves."""
    return leaves.groupBy(by.alias(_RANGE)).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").cast("decimal(30,0)").alias("s"))


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    b = b.select(F.col(_RANGE).alias("__r"), F.struct("n", "x", "s").alias("theirs"))
    met = a.select(_RANGE, F.struct("n", "x", "s").alias("ours")).join(b, F.col(_RANGE) == F.col("__r"), "full_outer")
    return met.where(~F.col("ours").eqNullSafe(F.col("theirs"))).select(F.coalesce(_RANGE, "__r").alias(_RANGE))


def digest(df: DataFrame, keys: Sequence[str], columns: Sequence[str], path: str, fan: int = 64, levels: int = 2) -> Digest:
    """The digest of a stored table, written beside it; ``columns`` are those that are compared."""
    low, high = _bounds(df, keys)
    rows = _digested(df.withColumn(_LEAF, _leaf(df, keys, low, high, fan**levels)), [*keys, *columns], _LEAF)
    return Digest(write_table(rows, path), low, high, fan, levels)


def differing_rows(
    new: DataFrame, old: DataFrame, keys: Sequence[str], columns: Sequence[str] = (), fan: int = 64, levels: int = 2, stored: Digest | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that lie in leaves whose keys or ``columns`` differ.

    ``stored`` is the digest of the old side over the same columns. The lists of differing ranges have at most
    ``fan ** levels`` rows and two, which is what bounds their broadcast.
    """
    compared = [*keys, *columns]
    if stored is not None:
        low, high, fan, levels = stored.low, stored.high, stored.fan, stored.levels
    else:
        low, high = _bounds(old, keys)
    leaves = fan**levels
    sides = [df.withColumn(_LEAF, _leaf(old, keys, low, high, leaves)) for df in (new, old)]
    found: DataFrame | None = None

    def inside(df: DataFrame, width: int, ranges: DataFrame | None) -> DataFrame:
        if ranges is None:
            return df
        wide = df.withColumn(_RANGE, F.floor(F.col(_LEAF) / width))
        return wide.join(F.broadcast(ranges), _RANGE, "left_semi").drop(_RANGE)

    width = leaves
    for level in range(1, levels + 1):
        coarse, width = width, leaves // fan**level
        by = F.floor(F.col(_LEAF) / width)
        mine = _digested(inside(sides[0], coarse, found).withColumn(_RANGE, by), compared, _RANGE)
        if stored is None:
            theirs = _digested(inside(sides[1], coarse, found).withColumn(_RANGE, by), compared, _RANGE)
        else:
            theirs = _summed(inside(stored.rows, coarse, found), by)
        found = materialise(_differing(mine, theirs), "ranges")
    return tuple(inside(side, 1, found).drop(_LEAF) for side in sides)


def changed_rows(new: DataFrame, old: DataFrame, keys: Sequence[str], label: str = "change", **how) -> DataFrame:
    """Inserted, updated and deleted keys with their rows, as ``keyed_diff`` labels them; equal rows are left out."""
    columns = [c for c in new.columns if c not in keys]
    here, there = differing_rows(new, old, keys, columns, **how)
    return keyed_diff(here, there, keys, label).where(F.col(label) != SAME)


def deleted_keys_by_range(warehouse: DataFrame, live: DataFrame, keys: Sequence[str], allow_empty: bool = False, **how) -> DataFrame:
    """Stored keys that the source no longer has; keys of equal ranges are not shuffled.

    An empty source would delete everything and is refused unless asked for.
    """
    if not allow_empty and live.isEmpty():
        raise ValueError("the source extract has no rows; pass allow_empty=True to delete everything")
    only = [named(k) for k in keys]
    here, there = differing_rows(live.select(*only), warehouse.select(*only), keys, **how)
    return there.join(here.distinct(), list(keys), "left_anti")
