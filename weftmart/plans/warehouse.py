"""Dimensional warehouse loads: source to staging, staging to warehouse, key tables and deletes.

Each plan returns the next state of one table. The caller writes it (``write_table``) before the next
plan reads it, which also cuts lineage between the steps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from weftmart.functions.canonical import row_hash
from weftmart.operators.cleanse import coerce, replace_missing
from weftmart.operators.diff import as_target, target_schema
from weftmart.operators.joins import deleted_keys, resolve_foreign_keys
from weftmart.operators.keys import CHANGE_HASH, SOURCE_HASH, new_surrogate_keys, with_change_hash, with_key_text
from weftmart.operators.project import KEY_TEXT, UPDATED_DATE, map_columns, named
from weftmart.operators.sinks import Stamp, audit_deletes, delete_rows, stamped, upsert
from weftmart.session import materialise
from weftmart.sources.files import staging_source
from weftmart.sources.windows import changed_after
from weftmart.spec import FK, SK, WarehouseSpec


def source_rows(source: DataFrame, spec: WarehouseSpec) -> DataFrame:
    """Mapped and constant columns of a source."""
    return map_columns(source, [c for c in spec.columns if c.tag not in (SK, FK) or c.source])


def _next_state(target: DataFrame | None, rows: DataFrame, keys: Sequence[str], stamp: Stamp, **options) -> DataFrame:
    return stamped(rows, stamp) if target is None else upsert(target, rows, keys, stamp, **options)


def _cleansed(rows: DataFrame, spec: WarehouseSpec, skip: Sequence[str] = ()) -> DataFrame:
    declared = {c: t for c, t in spec.types.items() if c in rows.columns and c != spec.surrogate and c not in skip}
    return replace_missing(rows, declared, spec.keys, spec.defaults, spec.key_defaults)


def dimension_staging(
    source: DataFrame, spec: WarehouseSpec, staging: DataFrame | None, stamp: Stamp, formats: Mapping[str, str] | None = None,
    strategy: str = "bulk",
) -> DataFrame:
    """Source to staging of a dimension.

    Constants, checksum, coercion and cleansing, then an upsert on the key that leaves unchanged rows
    alone. The checksum covers the coerced and cleansed values, so it does not depend on how a source
    formats them.
    """
    rows = _cleansed(coerce(source_rows(source, spec), spec.types, formats), spec)
    hashed = rows.withColumn(SOURCE_HASH, row_hash(rows, [c for c in spec.mapped if c in rows.columns]))
    return _next_state(staging, hashed, spec.keys, stamp, hash_column=SOURCE_HASH, strategy=strategy)


def dimension_warehouse(
    staging: DataFrame,
    spec: WarehouseSpec,
    warehouse: DataFrame | None,
    stamp: Stamp,
    write_mode: str = "upsert",
    start: Any = None,
    strategy: str = "bulk",
    retired: DataFrame | None = None,
    greatest: int = 0,
) -> DataFrame:
    """Staging to warehouse of a dimension: new keys get the next surrogate keys, changed rows merge.

    ``retired`` holds deleted rows whose surrogate keys stay taken, ``greatest`` is the greatest one ever given. An
    overwritten warehouse starts anew but for the surrogate keys, which known keys keep.
    """
    columns = [c for c in spec.mapped if c in staging.columns] + [SOURCE_HASH]
    rows = _cleansed(staging_source(staging, columns, write_mode, start), spec)
    numbers = new_surrogate_keys(rows, warehouse, spec.keys, spec.surrogate, retired, unique=True, greatest=greatest)
    if write_mode == "overwrite" and warehouse is not None:
        known = warehouse.select(*[named(k) for k in spec.keys], named(spec.surrogate).cast("bigint").alias(spec.surrogate))
        numbers = numbers.unionByName(known)
    keyed = rows.join(numbers, spec.keys, "left_outer")
    if warehouse is None or write_mode == "overwrite":
        return as_target(stamped(keyed, stamp), target_schema(spec))
    return upsert(
        warehouse, keyed, spec.keys, stamp, hash_column=SOURCE_HASH, strategy=strategy, insert_only=(spec.surrogate,)
    )


def transaction_staging(
    source: DataFrame, spec: WarehouseSpec, staging: DataFrame | None, stamp: Stamp, formats: Mapping[str, str] | None = None,
    strategy: str = "bulk",
) -> DataFrame:
    """Source to staging of a transaction table: constants and coercion, an upsert without checksum."""
    rows = coerce(source_rows(source, spec), spec.types, formats)
    rows = replace_missing(rows, {k: spec.types[k] for k in spec.keys}, spec.keys, spec.defaults, spec.key_defaults)
    return _next_state(staging, rows, spec.keys, stamp, date_only=True, strategy=strategy)


def transaction_keys(
    staging: DataFrame,
    spec: WarehouseSpec,
    key_table: DataFrame | None,
    stamp: Stamp,
    write_mode: str = "upsert",
    start: Any = None,
    declared: Mapping[str, Any] | None = None,
    strategy: str = "bulk",
) -> DataFrame:
    """Staging to the key table: key text and the checksum over the incremental columns.

    ``declared`` gives decimal types and date patterns that the texts are made with.
    """
    read = [*spec.keys, *spec.change_columns]
    rows = with_key_text(staging_source(staging, read, write_mode, start), spec.keys, declared)
    rows = with_change_hash(rows, spec.change_columns, declared).select(*spec.keys, KEY_TEXT, CHANGE_HASH)
    # different keys may share a key text, so the rows are matched on the keys themselves
    return _next_state(key_table, rows, spec.keys, stamp, hash_column=CHANGE_HASH, date_only=True, strategy=strategy)


def transaction_warehouse(
    staging: DataFrame,
    spec: WarehouseSpec,
    key_table: DataFrame,
    dimensions: Mapping[str, DataFrame],
    warehouse: DataFrame | None,
    stamp: Stamp,
    watermark: Any = None,
    salt: int = 1,
    start: Any = None,
    strategy: str = "bulk",
) -> DataFrame:
    """Staging to warehouse of a transaction table.

    Only rows staged since ``start`` are read, if given. The key table tells when a key last changed and its checksum; only keys changed after the watermark
    pass. Foreign keys become surrogate keys of their dimensions. The key table is matched on the key
    columns themselves: different keys may share a key text, and the upsert at the end needs rows
    partitioned by the same columns.
    """
    foreign = {c.target for c in spec.foreign}
    columns = [c for c in spec.mapped if c in staging.columns and c not in foreign]
    carried = [a for c in spec.foreign for a, _ in c.join if a in staging.columns and a not in columns]
    # keys are cleansed before the joins, so that their partitioning lasts
    staged = staging_source(staging, [*columns, *dict.fromkeys(carried)], "upsert", start)
    rows = _cleansed(staged, spec)
    changes = key_table.select(*spec.keys, UPDATED_DATE, named(CHANGE_HASH).alias(SOURCE_HASH))
    recent = changed_after(changes, watermark).drop(UPDATED_DATE)
    rows = rows.join(recent, spec.keys, "left_outer" if watermark is None else "inner")
    rows = resolve_foreign_keys(rows, spec.foreign, dimensions, salt)
    rows = _cleansed(rows, spec, skip=columns)
    if warehouse is None:
        return as_target(stamped(rows, stamp), target_schema(spec))
    return upsert(warehouse, rows, spec.keys, stamp, hash_column=SOURCE_HASH, date_only=True, strategy=strategy)


def audit_rows(warehouse: DataFrame, gone: DataFrame, spec: WarehouseSpec, stamp: Stamp, zone: str = "UTC") -> DataFrame:
    """Warehouse rows of the deleted keys in the columns of the audit table."""
    rows = audit_deletes(warehouse.join(gone, spec.keys, "left_semi"), stamp, zone)
    return rows.select(*[named(f.name) for f in target_schema(spec, "deletes") if f.name in rows.columns])


@dataclass(frozen=True)
class Deleted:
    """Next states after deletes; ``audit`` holds the rows to append to the audit table."""

    warehouse: DataFrame
    staging: DataFrame
    audit: DataFrame
    key_table: DataFrame | None = None


def propagate_deletes(
    source_keys: DataFrame,
    spec: WarehouseSpec,
    warehouse: DataFrame,
    staging: DataFrame,
    stamp: Stamp,
    zone: str = "UTC",
    key_table: DataFrame | None = None,
    allow_empty: bool = False,
) -> Deleted:
    """Remove keys the source no longer has from warehouse, staging and (transactions) the key table.

    The deleted keys are found once, over key columns only, and written. The tables then meet that
    written set, which Catalyst broadcasts when its files are small.
    """
    gone = materialise(deleted_keys(warehouse, source_keys, spec.keys, allow_empty), "deleted")
    return Deleted(
        warehouse=delete_rows(warehouse, gone, spec.keys),
        staging=delete_rows(staging, gone, spec.keys),
        audit=audit_rows(warehouse, gone, spec, stamp, zone),
        key_table=None if key_table is None else delete_rows(key_table, gone, spec.keys),
    )
