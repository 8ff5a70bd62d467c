"""Load windows: which source rows one run extracts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from weftmart.functions.scalars import literal, months_before
from weftmart.operators.project import UPDATED_DATE, named
from weftmart.operators.sets import first_rows
from weftmart.spec import LoadSettings


@dataclass(frozen=True)
class Period:
    start: Any
    end: Any


def trailing_months(column: str, months: int, as_of: Any = None) -> Column:
    """Rows of the last months before a time, by default now."""
    return named(column) >= months_before(F.localtimestamp() if as_of is None else literal(as_of), months)


def historical(column: str, period: Period) -> Column:
    """Both ends belong to the period."""
    return named(column).between(literal(period.start), literal(period.end))


def since(column: str, watermark: Any) -> Column:
    """Rows at or after the watermark; it is inclusive, so the sink must be keyed."""
    return named(column) >= literal(watermark)


def changed_after(df: DataFrame, watermark: Any, column: str = UPDATED_DATE) -> DataFrame:
    """In-flow form: strictly after; without a watermark all rows pass."""
    return df if watermark is None else df.where(named(column) > literal(watermark))


def high_watermark(df: DataFrame, column: str, kind: str) -> DataFrame:
    """The value the next run starts from."""
    alias = {"date": "Incremental_Date", "id": "Incremental_Id"}[kind]
    return df.agg(F.max(named(column)).alias(alias))


def window_condition(
    settings: LoadSettings, watermark: Any = None, as_of: Any = None, period: Period | None = None
) -> Column | None:
    """The rows of this run.

    A period asked for wins. Otherwise an incremental setting wins over the trailing months, and its
    first run, without a watermark, is a full load. The custom filter narrows each of them.
    """
    condition = None
    if period is not None and settings.historical_column:
        condition = historical(settings.historical_column, period)
    elif settings.incremental_column:
        condition = since(settings.incremental_column, watermark) if watermark is not None else None
    elif settings.date_column and settings.trailing_months is not None:
        condition = trailing_months(settings.date_column, settings.trailing_months, as_of)
    if settings.custom_filter:
        custom = F.expr(settings.custom_filter)
        condition = custom if condition is None else condition & custom
    return condition


def load_window(
    df: DataFrame,
    settings: LoadSettings,
    watermark: Any = None,
    as_of: Any = None,
    period: Period | None = None,
    order: Sequence[str] = (),
    descending: Sequence[str] = (),
) -> DataFrame:
    condition = window_condition(settings, watermark, as_of, period)
    if condition is not None:
        df = df.where(condition)
    if settings.limit is None:
        return df
    if settings.incremental_column and period is None and not order:
        return limited_increment(df, settings.incremental_column, settings.limit, watermark)
    return first_rows(df, settings.limit, order, descending)


def limited_increment(df: DataFrame, column: str, limit: int, watermark: Any = None) -> DataFrame:
    """The next rows in the order of the incremental column, at least ``limit`` new ones where there are as many.

    The run ends on a value of the column, with all rows of that value, so the next run can go on from it. Rows at
    the watermark itself are read again and do not count. Rows without a value belong to the first run.
    """
    later = df.where(named(column).isNotNull() if watermark is None else named(column) > literal(watermark))
    last = first_rows(later.select(named(column)), limit, [column]).agg(F.max(named(column))).first()[0]
    if last is None:
        return df
    kept = named(column) <= literal(last)
    return df.where(kept | named(column).isNull() if watermark is None else kept)


def source_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys the source has now, whatever the window."""
    return df.select(*[named(k) for k in keys]).distinct()
