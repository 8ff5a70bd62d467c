"""Canonical text of values, and the key and checksum columns built from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Separators of the key string and the checksum text.
KEY_SEPARATOR = "_"
HASH_SEPARATOR = "\u0001"
NULL_MARKER = "\u0002"

DATE_TEXT = "yyyy-MM-dd"
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def canonical(column: Column, kind: T.DataType, declared: T.DataType | str | None = None) -> Column:
    """Text that does not depend on how an engine prints numbers or times.

    ``declared`` gives a decimal type for doubles, or a date pattern for dates and times. A double
    without it is printed with Spark's shortest exact form.
    """
    if isinstance(declared, T.DecimalType):
        return column.cast(declared).cast("string")
    if isinstance(kind, T.DateType):
        return F.date_format(column, declared or DATE_TEXT)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, declared or TIMESTAMP_TEXT)
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(column))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    return column.cast("string")


def canonical_columns(
    df: DataFrame, columns: Sequence[str], declared: Mapping[str, T.DataType | str] | None = None
) -> list[Column]:
    declared = declared or {}
    return [canonical(F.col(f"`{c}`"), df.schema[c].dataType, declared.get(c)) for c in columns]


def composite_key(df: DataFrame, columns: Sequence[str], declared: Mapping | None = None) -> Column:
    """Key columns joined by an underscore; cleanse keys first, a null would be skipped."""
    return F.concat_ws(KEY_SEPARATOR, *canonical_columns(df, columns, declared))


def row_hash(df: DataFrame, columns: Sequence[str], declared: Mapping | None = None) -> Column:
    """MD5 over the columns in the given order; a null differs from an empty text."""
    parts = [F.coalesce(c, F.lit(NULL_MARKER)) for c in canonical_columns(df, columns, declared)]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))
