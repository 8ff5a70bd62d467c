"""Projection, constants, renaming and name cleaning."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftmart.functions.types import spark_type
from weftmart.spec import ColumnMap, Derived

# Helper columns of the load plans.
UNDERSCORE_FIELD = "underscore_field"
KEY_TEXT = "PKValue"
DELETE_INDICATOR = "DeleteIndicator"
UPDATED_DATE = "Updated_Date"
HELPERS = (UNDERSCORE_FIELD, KEY_TEXT, UPDATED_DATE, DELETE_INDICATOR)

# Characters that a name keeps whatever the rules say.
KEPT_CHARACTERS = ("_", "-", "/", "|")


def named(column: str) -> Column:
    return F.col(f"`{column}`")


def select_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Read exactly the listed columns under their aliases."""
    return df.select(*[named(c).alias(a) for c, a in columns.items()])


def map_columns(df: DataFrame, columns: Sequence[ColumnMap]) -> DataFrame:
    """Target columns from their sources; an unmapped source gives the empty text."""

    def value(c: ColumnMap) -> Column:
        if c.is_constant:
            return F.lit(c.constant).cast(spark_type(c.type))
        if c.source is None or c.source.strip().upper() in ("", "NULL"):
            return F.lit("")
        return named(c.source)

    return df.select(*[value(c).alias(c.target) for c in columns])


def add_constants(
    df: DataFrame, constants: Mapping[str, tuple[object, str]], positions: Mapping[str, int] | None = None
) -> DataFrame:
    """Typed constant columns, appended or put at the given positions (counted from 0)."""
    added = df.withColumns({name: F.lit(v).cast(spark_type(t)) for name, (v, t) in constants.items()})
    if not positions:
        return added
    order = [c for c in added.columns if c not in positions]
    for name, position in sorted(positions.items(), key=lambda item: item[1]):
        order.insert(position, name)
    return added.select(*[named(c) for c in order])


def with_tenant(df: DataFrame, company: str, name: str = "Company_Id") -> DataFrame:
    """Put the tenant column in front of the source columns."""
    return df.select(F.lit(company).alias(name), "*")


def drop_helpers_of(df: DataFrame, derived: Sequence[Derived]) -> DataFrame:
    """Drop derived columns that have no alias."""
    return df.drop(*[d.name for d in derived if not d.alias])


def rename_derived(df: DataFrame, derived: Sequence[Derived]) -> DataFrame:
    return df.withColumnsRenamed({d.name: d.alias for d in derived if d.alias and d.alias != d.name})


def retain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[named(c) for c in columns])


def emit(df: DataFrame, helpers: Sequence[str] = HELPERS) -> DataFrame:
    """Strip helper fields before a sink."""
    return df.drop(*helpers)


def clean_name(name: str, rules: Sequence[tuple[str, str]] = ()) -> str:
    """Apply replacement rules in order; a stored blank stands for a comma. Blanks become underscores."""
    for stored, replacement in rules:
        character = "," if stored == " " else stored
        if character in KEPT_CHARACTERS:
            continue
        name = re.sub(re.escape(character), lambda _: replacement, name)
    return name.replace(" ", "_")


def clean_columns(df: DataFrame, rules: Sequence[tuple[str, str]] = ()) -> DataFrame:
    cleaned = [clean_name(c, rules) for c in df.columns]
    repeated = {c for c in cleaned if cleaned.count(c) > 1}
    if repeated:
        raise ValueError(f"cleaned column names collide: {sorted(repeated)}")
    return df.toDF(*cleaned)
