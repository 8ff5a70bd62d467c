"""Coercion to declared types and replacement of missing values."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftmart.functions.scalars import literal
from weftmart.functions.types import DEFAULT_DATE_FORMAT, RECOERCED_TYPES, ZERO_DATE, default_value, parse_type, spark_type
from weftmart.operators.project import named


def coerced(column: Column, source: T.DataType, declared: str, pattern: str | None = None, strict: bool = False) -> Column:
    """A value as its declared type. A value that does not convert gives null, or fails when strict."""
    target = spark_type(declared)
    if source == target:
        return column
    if isinstance(source, T.StringType) and isinstance(target, (T.DateType, T.TimestampNTZType)):
        if pattern is None and isinstance(target, T.DateType):
            pattern = DEFAULT_DATE_FORMAT
        if pattern:
            parsed = F.to_timestamp(column, pattern) if strict else F.try_to_timestamp(column, F.lit(pattern))
            return parsed.cast(target)
    if isinstance(source, T.StringType):
        column = F.trim(column)
    return column.cast(target) if strict else column.try_cast(target)


def coerce(
    df: DataFrame, declared: Mapping[str, str], formats: Mapping[str, str] | None = None, strict: bool = False
) -> DataFrame:
    """Bring the named columns to their declared types; the others pass."""
    formats = formats or {}
    changed = {
        c: coerced(named(c), df.schema[c].dataType, t, formats.get(c), strict) for c, t in declared.items() if c in df.columns
    }
    return df.withColumns(changed) if changed else df


def recoerce(df: DataFrame, declared: Mapping[str, str], skip: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """After joins: declared precision and scale for numbers, the date pattern for dated types."""
    chosen = {}
    for column, text in declared.items():
        kind = parse_type(text)
        if column in skip or column not in df.columns:
            continue
        if kind.is_dated or kind.base in RECOERCED_TYPES or not kind.is_string:
            chosen[column] = text
    return coerce(df, chosen, strict=strict)


def missing(column: Column, kind: T.DataType, blank: bool = True) -> Column:
    """Null, or for texts also blank."""
    if blank and isinstance(kind, T.StringType):
        return column.isNull() | (F.trim(column) == "")
    return column.isNull()


def replace_missing(
    df: DataFrame,
    declared: Mapping[str, str],
    keys: Sequence[str] = (),
    defaults: Mapping[str, Any] | None = None,
    key_defaults: Mapping[str, Any] | None = None,
    blank: bool = True,
    date_default: dt.date = ZERO_DATE,
) -> DataFrame:
    """Replace missing values by the default of the column's type; key columns have their own table.

    ``defaults`` and ``key_defaults`` override the built-in table by type name.
    """
    changed = {}
    for column, text in declared.items():
        if column not in df.columns:
            continue
        is_key = column in keys
        table = (key_defaults if is_key else defaults) or {}
        base = parse_type(text).base
        value = table[base] if base in table else default_value(text, is_key, date_default)
        if value is None:
            continue
        kind = df.schema[column].dataType
        changed[column] = F.when(missing(named(column), kind, blank), literal(value).cast(kind)).otherwise(named(column))
    return df.withColumns(changed) if changed else df


def trim_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.trim(named(f.name)) for f in df.schema if isinstance(f.dataType, T.StringType)})


def fold_case(df: DataFrame, columns: Sequence[str], case_sensitive: bool = True) -> DataFrame:
    """Columns as they compare: unchanged, or lower case when keys ignore case."""
    if case_sensitive:
        return df
    return df.withColumns({c: F.lower(named(c)) for c in columns if isinstance(df.schema[c].dataType, T.StringType)})
