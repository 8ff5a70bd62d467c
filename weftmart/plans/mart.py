"""Mart build: joins, coercion, cleansing, grouping, derivation and the keyed load, in a fixed order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from weftmart.operators.aggregate import filter_group
from weftmart.operators.cleanse import recoerce, replace_missing
from weftmart.operators.derive import derive
from weftmart.operators.joins import join_chain, read_table
from weftmart.operators.project import clean_columns, drop_helpers_of, rename_derived, retain
from weftmart.operators.sinks import Stamp, load
from weftmart.spec import MartSpec


def build_mart(spec: MartSpec, sources: Mapping[str, DataFrame]) -> DataFrame:
    """The mart's rows as one declarative plan; nothing runs here.

    The steps keep their order: sources, joins, coercion, cleansing, filter/group on joined columns,
    derivation by level, filter/group on derived columns, removal of helpers, renaming, retained columns,
    cleaning of the column names.
    """
    rows = filter_group(ungrouped(spec, sources), spec.derived_step)
    return finished(spec, rows)


def ungrouped(spec: MartSpec, sources: Mapping[str, DataFrame]) -> DataFrame:
    """The rows before the last filter/group step."""
    spec.validate()
    tables = {t.alias: read_table(sources[t.name], t) for t in spec.tables}
    grouped = {t.alias for t in spec.tables if t.step is not None and t.step.columns}
    rows = join_chain(tables, spec.driving.alias, spec.joins, grouped)
    # columns that only serve a join keep their values, an unmatched row its null; derived ones come later
    untouched = {right for join in spec.joins for _, right in join.pairs} | {d.alias for d in spec.derived}
    declared = {c: t for c, t in spec.types.items() if c not in untouched}
    rows = recoerce(rows, declared, strict=spec.strict)
    rows = replace_missing(rows, declared, spec.keys, spec.cleansing, spec.cleansing)
    rows = filter_group(rows, spec.joined_step)
    return derive(rows, spec.derived)


def finished(spec: MartSpec, rows: DataFrame) -> DataFrame:
    """The steps after the last grouping."""
    rows = rename_derived(drop_helpers_of(rows, spec.derived), spec.derived)
    rows = retain(rows, spec.retain) if spec.retain else rows
    return clean_columns(rows, spec.name_rules) if spec.name_rules else rows


def load_mart(
    spec: MartSpec, sources: Mapping[str, DataFrame], target: DataFrame | None, path: str, write_mode: str, stamp: Stamp | None = None
) -> DataFrame:
    """Build the mart and write its next version."""
    return load(target, build_mart(spec, sources), spec.keys, path, write_mode, stamp)
