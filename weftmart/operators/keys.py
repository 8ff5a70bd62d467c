"""Numbering at scale, surrogate keys, key text and checksums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftmart.functions.canonical import composite_key, row_hash
from weftmart.operators.project import KEY_TEXT, named
from weftmart.session import materialise

SOURCE_HASH = "Source_Hash_Value"
CHANGE_HASH = "HashValue"

_PART, _POS = "__part", "__pos"
_POSITION_BITS = 33


def ranged(df: DataFrame, order: Sequence[str | Column], label: str) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with their partition and position in it.

    The result is written once, so later passes see the same partitions even if a task is recomputed.
    Without an order the rows stay where they are.
    """
    columns = [named(c) if isinstance(c, str) else c for c in order]
    placed = df.repartitionByRange(*columns).sortWithinPartitions(*columns) if columns else df
    # the id holds the partition number above 33 bits of running position
    placed = placed.withColumn("__id", F.monotonically_increasing_id())
    stored = materialise(placed, label)
    return stored.withColumns(
        {_PART: F.shiftright("__id", _POSITION_BITS), _POS: F.col("__id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))}
    ).drop("__id")


def global_number(df: DataFrame, order: Sequence[str | Column], alias: str, start: Column | None = None) -> DataFrame:
    """Dense numbers 1..n in the order of unique columns, without sorting in one task.

    Only per-partition counts are brought together: one row per partition, which is also what bounds the
    broadcast.
    """
    placed = ranged(df, order, f"number-{alias}")
    counts = placed.groupBy(_PART).agg(F.count("*").alias("__n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    number = F.col("__offset") + F.col(_POS) + 1
    if start is not None:
        number = number + start
    numbered = placed.join(F.broadcast(offsets), _PART)
    return numbered.select(*[named(c) for c in df.columns], number.cast("bigint").alias(alias))


def running_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], alias: str) -> DataFrame:
    """Row number per key in the order of columns that are unique within a key.

    A window would put all rows of a key in one task. Here rows are range-partitioned by key and order,
    so a hot key spans partitions; counts per (partition, key) give each piece its offset.
    """
    placed = ranged(df, [*keys, *order], f"running-{alias}")
    pieces = placed.groupBy(_PART, *[named(k) for k in keys]).agg(F.count("*").alias("__n"), F.min(_POS).alias("__first"))
    # a key has at most one piece per partition
    before = Window.partitionBy(*[named(k) for k in keys]).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        F.col(_PART).alias("__p"),
        *[named(k).alias(f"__k_{i}") for i, k in enumerate(keys)],
        "__first",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
    )
    same_piece = F.col(_PART) == F.col("__p")
    for i, k in enumerate(keys):
        # rows without a key are numbered as a group of their own
        same_piece = same_piece & named(k).eqNullSafe(F.col(f"__k_{i}"))
    numbered = placed.join(pieces, same_piece)
    number = F.col("__offset") + F.col(_POS) - F.col("__first") + 1
    return numbered.select(*[named(c) for c in df.columns], number.cast("bigint").alias(alias))


def new_surrogate_keys(
    incoming: DataFrame,
    existing: DataFrame | None,
    keys: Sequence[str],
    name: str,
    retired: DataFrame | None = None,
    unique: bool = False,
    greatest: int = 0,
) -> DataFrame:
    """Keys the target does not have yet, numbered in key order from its greatest surrogate key on.

    Surrogate keys of ``retired`` (deleted) rows, and those up to ``greatest``, are not given out again. ``unique``
    tells that incoming keys do not repeat, which saves a shuffle.
    """
    fresh = incoming.select(*[named(k) for k in keys])
    if not unique:
        fresh = fresh.distinct()
    tables = [t.select(named(name)) for t in (existing, retired) if t is not None]
    start = F.lit(greatest)
    for table in tables:
        start = F.greatest(start, table.agg(F.coalesce(F.max(named(name)), F.lit(0))).scalar())
    if existing is not None:
        fresh = fresh.join(existing.select(*[named(k) for k in keys]), list(keys), "left_anti")
    return global_number(fresh, keys, name, start=start if tables or greatest else None)


def surrogate_keys(incoming: DataFrame, existing: DataFrame | None, keys: Sequence[str], name: str) -> DataFrame:
    """Add the surrogate key column: known keys keep theirs, new ones are numbered. Cleanse keys first."""
    assigned = new_surrogate_keys(incoming, existing, keys, name)
    if existing is not None:
        assigned = existing.select(*[named(k) for k in keys], named(name).cast("bigint").alias(name)).unionByName(assigned)
    return incoming.join(assigned, list(keys), "left_outer")


def with_key_text(df: DataFrame, keys: Sequence[str], declared: Mapping | None = None) -> DataFrame:
    return df.withColumn(KEY_TEXT, composite_key(df, keys, declared))


def with_source_hash(df: DataFrame, columns: Sequence[str], declared: Mapping | None = None) -> DataFrame:
    return df.withColumn(SOURCE_HASH, row_hash(df, columns, declared))


def with_change_hash(df: DataFrame, columns: Sequence[str], declared: Mapping | None = None) -> DataFrame:
    return df.withColumn(CHANGE_HASH, row_hash(df, columns, declared))
