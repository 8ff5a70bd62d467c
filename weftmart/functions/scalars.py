"""Scalar helpers over built-in functions, named for what specifications ask for."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, functions as F


def literal(value: Any) -> Column:
    """A literal; a time without a zone stays one, whatever the zones of driver and session.

    Comparing a zone-less column with a zoned literal would cast the column and keep the filter from
    reaching the scan.
    """
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def render_in_zone(ts: Column, zone: str, source_zone: str = "UTC") -> Column:
    """The wall-clock time of ``zone`` for a wall-clock time of ``source_zone``."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), ts)


def months_before(reference: Column, months: int) -> Column:
    """The same time of day, whole months earlier."""
    return reference - F.make_ym_interval(F.lit(0), F.lit(months))


def list_size(text: Column, separator: str = ",") -> Column:
    """Number of separators in a delimited list; an empty tail still counts."""
    return F.length(text) - F.length(F.replace(text, F.lit(separator), F.lit("")))


def list_items(text: Column, separator: str = ",") -> Column:
    """Items of a delimited list, empty tail kept."""
    return F.split(text, "\\Q" + separator + "\\E", -1)
