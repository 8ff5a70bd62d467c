"""One run of a warehouse table: window, staging, keys, warehouse, deletes, in the order of its kind.

Every step is written under the run's folder before the next one reads it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftmart.operators.aggregate import last_row
from weftmart.operators.cleanse import coerce, replace_missing
from weftmart.operators.diff import key_violations
from weftmart.operators.joins import deleted_keys
from weftmart.operators.project import named
from weftmart.operators.sinks import Stamp, delete_rows
from weftmart.plans.extract import next_watermark
from weftmart.plans.warehouse import (
    audit_rows, dimension_staging, dimension_warehouse, source_rows, transaction_keys, transaction_staging, transaction_warehouse,
)
from weftmart.session import materialise, read_if_there, write_table
from weftmart.sources.windows import Period, load_window
from weftmart.spec import DIMENSION, ColumnMap, LoadSettings, WarehouseSpec


@dataclass(frozen=True)
class TableState:
    """The tables of one target after a run, and where its next run starts."""

    staging: DataFrame | None = None
    warehouse: DataFrame | None = None
    key_table: DataFrame | None = None
    deletes: DataFrame | None = None
    watermark: Any = None
    #: the greatest surrogate key ever given out
    greatest: int = 0


TABLES = {"staging": "staging", "warehouse": "warehouse", "key_table": "keys", "deletes": "deletes"}
_MANIFEST = "name string, kind string, value string"


def save_state(spark: SparkSession, state: TableState, path: str) -> None:
    """Note a finished run under its folder; written last, so a run without it is unfinished."""
    rows = [(name, "table", f"{path}/{folder}") for name, folder in TABLES.items() if getattr(state, name) is not None]
    rows.append(("greatest", "id", str(state.greatest)))
    if state.watermark is not None:
        kind = "id" if isinstance(state.watermark, int) else "date"
        rows.append(("watermark", kind, str(state.watermark)))
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/state")


def open_state(spark: SparkSession, path: str | None) -> TableState:
    """The state that a finished run left under its folder, for a run in another session."""
    rows = read_if_there(spark, f"{path}/state", _MANIFEST).collect() if path else []  # a handful of rows
    found: dict[str, Any] = {}
    for r in rows:
        if r.kind == "table":
            found[r.name] = spark.read.parquet(r.value)
        else:
            found[r.name] = int(r.value) if r.kind == "id" else dt.datetime.fromisoformat(r.value)
    return TableState(**found)


def run_table(
    source: DataFrame,
    spec: WarehouseSpec,
    settings: LoadSettings,
    state: TableState,
    stamp: Stamp,
    path: str,
    dimensions: Mapping[str, DataFrame] | None = None,
    as_of: Any = None,
    period: Period | None = None,
    zone: str = "UTC",
    formats: Mapping[str, str] | None = None,
    strategy: str = "bulk",
    newest_by: Sequence[str] = (),
    salt: int = 1,
) -> TableState:
    """Load one target from its source and return its next state, which is also stored under ``path``.

    Write mode ``overwrite`` starts the tables anew, but for the surrogate keys: known keys keep theirs and no number
    is given out twice. ``upsert`` merges. With the delete flag rows the source no longer has are removed everywhere
    and added to the audit table. The window's rows are written once; key check, staging and the next watermark all
    read them, so a row that arrives meanwhile is left to the next run.

    Of several source rows whose cleansed keys are equal the newest by the ``newest_by`` columns of the source is
    loaded. Without them a repeated key is refused before any table is written.
    """
    overwrite = settings.write_mode == "overwrite"
    old = replace(state, staging=None, key_table=None, watermark=None) if overwrite else state
    rows = window_rows(source, spec, settings, old.watermark, as_of, period, formats, newest_by)
    first = old.warehouse is None
    start = None if first or overwrite else stamp[0]
    gone, deletes = None, old.deletes
    if settings.delete_flag and not first:
        gone = materialise(deleted_keys(old.warehouse, key_rows(source, spec, formats), spec.keys), "deleted")
        audit = audit_rows(old.warehouse, gone, spec, stamp, zone)
        deletes = write_table(audit if deletes is None else deletes.unionByName(audit), f"{path}/deletes")
    elif deletes is not None:
        deletes = write_table(deletes, f"{path}/deletes")

    def store(table: DataFrame, name: str) -> DataFrame:
        return write_table(table if gone is None or overwrite else delete_rows(table, gone, spec.keys), f"{path}/{name}")

    if spec.kind == DIMENSION:
        staging = store(dimension_staging(rows, spec, old.staging, stamp, formats, strategy), "staging")
        key_table = None
        loaded = dimension_warehouse(
            staging, spec, old.warehouse, stamp, settings.write_mode, start, strategy, old.deletes, old.greatest
        )
    else:
        staging = store(transaction_staging(rows, spec, old.staging, stamp, formats, strategy), "staging")
        key_table = store(transaction_keys(staging, spec, old.key_table, stamp, "upsert", start, strategy=strategy), "keys")
        since = None if first or overwrite else just_before(stamp)
        loaded = transaction_warehouse(
            staging, spec, key_table, dimensions or {}, None if overwrite else old.warehouse, stamp, since, salt, start, strategy
        )
    warehouse = store(loaded, "warehouse")
    greatest = old.greatest
    if spec.kind == DIMENSION and spec.surrogate:
        greatest = max(greatest, warehouse.agg(F.max(named(spec.surrogate))).first()[0] or 0)
    seen = next_watermark(rows, settings)
    state = TableState(staging, warehouse, key_table, deletes, old.watermark if seen is None else seen, greatest)
    save_state(source.sparkSession, state, path)
    return state


_ROW = "__row"


def window_rows(
    source: DataFrame,
    spec: WarehouseSpec,
    settings: LoadSettings,
    watermark: Any,
    as_of: Any,
    period: Period | None,
    formats: Mapping[str, str] | None,
    newest_by: Sequence[str],
) -> DataFrame:
    """The rows of a run's window, written once, one per cleansed key."""
    window = load_window(source, settings, watermark, as_of, period)
    needed = {c.source for c in spec.columns if c.source} | set(newest_by) | {settings.incremental_column}
    if needed - {None} <= set(window.columns):
        window = window.select(*[named(c) for c in window.columns if c in needed])
    rows = materialise(window.withColumn(_ROW, F.monotonically_increasing_id()), "window")
    if newest_by:
        rows = _newest_rows(rows, spec, formats, newest_by)
    elif not key_violations(key_rows(rows, spec, formats), spec.keys).isEmpty():
        raise ValueError(f"{spec.name}: source keys repeat; name the columns that tell the newest row")
    return rows.drop(_ROW)


def key_rows(source: DataFrame, spec: WarehouseSpec, formats: Mapping[str, str] | None, *extra: ColumnMap) -> DataFrame:
    """Source keys as the target stores them: mapped, coerced, cleansed; and further columns as they are."""
    rows = source_rows(source, replace(spec, columns=spec.columns + extra)).select(*spec.keys, *[c.target for c in extra])
    types = {k: spec.types[k] for k in spec.keys}
    return replace_missing(coerce(rows, types, formats), types, spec.keys, spec.defaults, spec.key_defaults)


def _newest_rows(rows: DataFrame, spec: WarehouseSpec, formats: Mapping[str, str] | None, newest_by: Sequence[str]) -> DataFrame:
    """Of the rows whose cleansed keys are equal the newest one."""
    order = [ColumnMap(f"__newest_{i}", "string", c) for i, c in enumerate(newest_by)]
    keyed = key_rows(rows, spec, formats, *order, ColumnMap(_ROW, "bigint", _ROW))
    newest = last_row(keyed, spec.keys, [*[c.target for c in order], _ROW]).select(_ROW)
    return rows.join(newest, _ROW, "left_semi")


def just_before(stamp: Stamp) -> Any:
    """A watermark that lets exactly the rows stamped by this run pass a strict comparison."""
    return stamp[0] - dt.timedelta(microseconds=1)
