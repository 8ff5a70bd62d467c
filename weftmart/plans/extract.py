"""Source extraction of a warehouse table under its load settings."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftmart.operators.project import map_columns, with_tenant
from weftmart.session import read_if_there
from weftmart.sources.windows import Period, high_watermark, load_window
from weftmart.spec import LoadSettings, WarehouseSpec


def extract(
    source: DataFrame,
    spec: WarehouseSpec,
    settings: LoadSettings,
    company: str,
    watermark: Any = None,
    as_of: Any = None,
    period: Period | None = None,
    order: Sequence[str] = (),
    descending: Sequence[str] = (),
) -> DataFrame:
    """Tenant column and mapped columns of the rows in the load window. The window uses source names."""
    rows = load_window(source, settings, watermark, as_of, period, order, descending)
    mapped = [c for c in spec.columns if not c.is_constant and c.tag != "SK"]
    return with_tenant(map_columns(rows, mapped), company)


def next_watermark(source: DataFrame, settings: LoadSettings) -> Any:
    """The greatest value of the incremental column, to be stored for the next run."""
    if not settings.incremental_column:
        return None
    return high_watermark(source, settings.incremental_column, settings.incremental_kind or "date").first()[0]


def store_watermark(source: DataFrame, settings: LoadSettings, name: str, path: str) -> None:
    """Append this run's watermark of a source to the watermark table. It is kept as text."""
    kind = settings.incremental_kind or "date"
    value = high_watermark(source, settings.incremental_column, kind).toDF("watermark")
    row = value.select(F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.col("watermark").cast("string"))
    row.where("watermark is not null").write.mode("append").parquet(path)


def stored_watermark(spark: SparkSession, name: str, path: str) -> Any:
    """The greatest stored watermark of a source, typed by its kind; ``None`` before the first run."""
    rows = read_if_there(spark, path, "name string, kind string, watermark string").where(F.col("name") == name)
    by_id = F.max(F.when(F.col("kind") == "id", F.col("watermark").try_cast("bigint")))
    by_date = F.max(F.when(F.col("kind") == "date", F.col("watermark").try_cast("timestamp_ntz")))
    found = rows.agg(by_id, by_date).first()
    return found[0] if found[0] is not None else found[1]
