"""Change of a target's mapping: what changed, and all tables of the target brought to the new columns."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from weftmart.operators.cleanse import replace_missing
from weftmart.operators.diff import SAME, evolve, key_rules, key_violations, keyed_diff, rekey
from weftmart.operators.keys import SOURCE_HASH
from weftmart.operators.project import KEY_TEXT
from weftmart.operators.sinks import AUDIT, replace_by_key
from weftmart.plans.jobs import TableState
from weftmart.session import write_table
from weftmart.spec import FK, SK, WarehouseSpec

MAPPING_KEY = ("IL_Table_Name", "IL_Column_Name")


def mapping_changes(saved: DataFrame, live: DataFrame) -> DataFrame:
    """Columns added to (I), changed in (U) and dropped from (D) the mapping, by table and column."""
    return keyed_diff(saved, live, MAPPING_KEY).where(F.col("change") != SAME)


def promote_mapping(saved: DataFrame, live: DataFrame) -> DataFrame:
    """The live mapping with all columns of each saved table in place of the old ones."""
    return replace_by_key(live, saved, MAPPING_KEY[:1])


def _columns(table: DataFrame, spec: WarehouseSpec, skip: tuple[str, ...]) -> dict[str, str]:
    """New mapped columns first, then the system columns the table has, in their own types."""
    mapped = {c.target: "bigint" if c.tag == SK else c.type for c in spec.columns if c.tag not in skip}
    system = {c: "datetime" if c.endswith("Date") else "varchar(50)" for c in (SOURCE_HASH, *AUDIT) if c in table.columns}
    if "Mismatch_Flag" in table.columns:
        system["Mismatch_Flag"] = "tinyint"
    return {**mapped, **system}


def _evolved(table: DataFrame, spec: WarehouseSpec, skip: tuple[str, ...] = ()) -> DataFrame:
    rows = evolve(table, _columns(table, spec, skip))
    return replace_missing(rows, {k: spec.types[k] for k in spec.keys}, spec.keys)


def evolve_target(old: WarehouseSpec, new: WarehouseSpec, state: TableState, path: str) -> TableState:
    """Bring warehouse, staging, key table and delete audit to the new mapping, and write them.

    New columns are null, dropped ones go, types change; a column that became a key gets its default for
    missing values. A new key set that repeats in the warehouse is refused. A checksum stays as it is, so
    the next load updates the rows that a new column changes.
    """
    warehouse = _evolved(state.warehouse, new)
    if key_rules(new.keys, old.keys)["changed"] and not key_violations(warehouse, new.keys).isEmpty():
        raise ValueError(f"{new.name}: the rows are not unique on {new.keys}")
    # foreign keys are resolved on the way to the warehouse, so staging does not hold them
    staging = _evolved(state.staging, new, (SK, FK))
    key_table = state.key_table
    if key_table is not None and old.keys != new.keys:
        others = [c for c in key_table.columns if c not in (*old.keys, KEY_TEXT)]
        texts = key_table.join(staging.select(*dict.fromkeys([*old.keys, *new.keys])), old.keys, "inner")
        key_table = rekey(texts, new.keys, new.types)[0].select(*new.keys, KEY_TEXT, *others)
    return replace(
        state,
        warehouse=write_table(warehouse, f"{path}/warehouse"),
        staging=write_table(staging, f"{path}/staging"),
        key_table=None if key_table is None else write_table(key_table, f"{path}/keys"),
        deletes=None if state.deletes is None else write_table(_evolved(state.deletes, new), f"{path}/deletes"),
    )
