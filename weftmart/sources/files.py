"""Landed files and in-flow SQL sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weftmart.functions.scalars import literal
from weftmart.operators.project import UPDATED_DATE, select_columns

CORRUPT = "_corrupt_record"
FORMATS = ("csv", "json", "parquet", "orc", "text")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def select_source(df: DataFrame, columns: Mapping[str, str], condition: str | None = None) -> DataFrame:
    """An aliased column list with an optional condition over source names, both pushed to the scan."""
    return select_columns(df.where(condition) if condition else df, columns)


def file_source(spark: SparkSession, path: str, kind: str, schema: T.StructType | None = None, **options: str) -> DataFrame:
    """Files landed by any fetcher, always read with a declared schema where the format has none."""
    if kind not in FORMATS:
        raise ValueError(f"unknown file format {kind!r}")
    if kind in ("csv", "json") and schema is None:
        raise ValueError(f"{kind} files need a declared schema")
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def csv_source(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False, **options: str) -> DataFrame:
    """Delimited files with a header. Unreadable lines are kept in their own column, or fail the read."""
    settings = {"header": "true", "mode": "PERMISSIVE" if keep_corrupt else "FAILFAST", **options}
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        settings["columnNameOfCorruptRecord"] = CORRUPT
    return file_source(spark, path, "csv", schema, **settings)


def sql_source(df: DataFrame, text: str, **row_sets: DataFrame) -> DataFrame:
    """SQL over the row set ``{source}``, and over others given by name, without global views."""
    return df.sparkSession.sql(text, source=df, **row_sets)


def staging_source(df: DataFrame, columns: list[str], write_mode: str, start=None) -> DataFrame:
    """Re-read of a staging table; only upserts are limited to rows changed since ``start``."""
    if write_mode != "overwrite" and start is not None:
        df = df.where(F.col(UPDATED_DATE) >= literal(start))
    return df.select(*[f"`{c}`" for c in columns])
