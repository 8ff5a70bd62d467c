"""Unions, ordering and limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from weftmart.operators.keys import global_number
from weftmart.operators.project import named

# Rows that may meet in one task; larger limits give the same rows by another plan.
ONE_TASK_LIMIT = 10_000


def union_padded(parts: Sequence[tuple[DataFrame, Mapping[str, object]]]) -> DataFrame:
    """UNION ALL of row sets after padding each with its constant columns."""
    padded = [df.withColumns({c: F.lit(v) for c, v in constants.items()}) if constants else df for df, constants in parts]
    return reduce(lambda a, b: a.unionByName(b), padded)


def union_common(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL over the columns all row sets have; an empty row set still has its columns."""
    common = [c for c in parts[0].columns if all(c in p.columns for p in parts)]
    return reduce(lambda a, b: a.unionByName(b), [p.select(*[named(c) for c in common]) for p in parts])


def union_distinct(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def ordered(df: DataFrame, keys: Sequence[str], fallback: str = "Company_Id") -> DataFrame:
    """Rows in key order, or by the tenant column when a table has no key."""
    return df.orderBy(*[named(k) for k in keys or [fallback]])


def first_rows(df: DataFrame, count: int, order: Sequence[str] = (), descending: Sequence[str] = ()) -> DataFrame:
    """Row limit; only ordered limits name the rows they keep.

    Rows that tie on the order columns are ordered by the other columns, so the same rows are kept on every run, and
    the result is in that order. Spark brings the rows of a limit together in one task; a large limit is taken by row
    number over range partitions instead, with the same result.
    """
    columns = [named(c).desc() if c in descending else named(c).asc() for c in order]
    if not columns:
        return df.limit(count) if count <= ONE_TASK_LIMIT else _numbered_up_to(df, [], count)
    columns += [named(c).asc() for c in df.columns if c not in order and _orderable(df.schema[c].dataType)]
    if count > ONE_TASK_LIMIT:
        return _numbered_up_to(df, columns, count).orderBy(*columns)
    return df.orderBy(*columns).limit(count)


def _numbered_up_to(df: DataFrame, columns: list, count: int) -> DataFrame:
    return global_number(df, columns, "__number").where(F.col("__number") <= count).drop("__number")


def _orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))
