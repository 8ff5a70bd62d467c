"""Job specifications: what to read, map, join, filter, group, derive, key and load.

Specifications are plain dataclasses. They load from JSON or from control tables, whose size is that
of the metadata (rows per mapped column), never that of the data.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark.sql import DataFrame, functions as F

from weftmart.functions.types import parse_type

PK, SK, FK = "PK", "SK", "FK"
DIMENSION, TRANSACTION = "D", "T"


@dataclass(frozen=True)
class ColumnMap:
    """One target column of a warehouse table."""

    target: str
    type: str
    source: str | None = None
    tag: str = ""
    constant: Any = None
    is_constant: bool = False
    dimension: str | None = None
    dimension_key: str | None = None
    join: tuple[tuple[str, str], ...] = ()
    incremental: bool = False
    #: columns of the dimension by which the first of several matching rows is taken
    order: tuple[str, ...] = ()


@dataclass(frozen=True)
class WarehouseSpec:
    name: str
    kind: str
    columns: tuple[ColumnMap, ...]
    #: replacements of missing values by type name, instead of the built-in ones
    defaults: Mapping[str, Any] = field(default_factory=dict)
    key_defaults: Mapping[str, Any] = field(default_factory=dict)

    @property
    def mapped(self) -> list[str]:
        return [c.target for c in self.columns if c.tag != SK]

    @property
    def keys(self) -> list[str]:
        return [c.target for c in self.columns if c.tag == PK]

    @property
    def surrogate(self) -> str | None:
        return next((c.target for c in self.columns if c.tag == SK), None)

    @property
    def foreign(self) -> list[ColumnMap]:
        return [c for c in self.columns if c.tag == FK]

    @property
    def change_columns(self) -> list[str]:
        return [c.target for c in self.columns if c.incremental and c.tag not in (PK, SK)]

    @property
    def types(self) -> dict[str, str]:
        return {c.target: c.type for c in self.columns}


@dataclass(frozen=True)
class GroupColumn:
    """A column of a grouping step; ``aggregate`` of ``GroupBy`` marks a key."""

    column: str
    aggregate: str = "GroupBy"
    alias: str | None = None
    order_by: tuple[str, ...] = ()

    @property
    def is_key(self) -> bool:
        return self.aggregate == "GroupBy"

    @property
    def name(self) -> str:
        return self.alias or self.column


@dataclass(frozen=True)
class FilterGroup:
    """A filter and/or grouping step; flow F filters first, flow G groups first."""

    condition: str | None = None
    columns: tuple[GroupColumn, ...] = ()
    flow: str = "F"


@dataclass(frozen=True)
class TableSpec:
    name: str
    alias: str
    columns: Mapping[str, str]
    role: str = "lookup"
    step: FilterGroup | None = None


@dataclass(frozen=True)
class JoinSpec:
    """One left-outer step; ``pairs`` holds (left column, right column). ``salt`` spreads hot keys."""

    level: int
    right: str
    pairs: tuple[tuple[str, str], ...]
    left: str = ""
    salt: int = 1


@dataclass(frozen=True)
class Derived:
    """A derived column; an empty alias marks a helper that is dropped at the end."""

    name: str
    expression: str
    level: int = 1
    kind: str = "SQL"
    alias: str = ""
    arguments: Mapping[str, str] = field(default_factory=dict)
    type: str | None = None


@dataclass(frozen=True)
class MartSpec:
    name: str
    tables: tuple[TableSpec, ...]
    joins: tuple[JoinSpec, ...] = ()
    types: Mapping[str, str] = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    joined_step: FilterGroup | None = None
    derived: tuple[Derived, ...] = ()
    derived_step: FilterGroup | None = None
    retain: tuple[str, ...] = ()
    cleansing: Mapping[str, Any] = field(default_factory=dict)
    strict: bool = False
    #: replacement rules for the names of the finished columns, in order
    name_rules: tuple[tuple[str, str], ...] = ()

    @property
    def driving(self) -> TableSpec:
        return next(t for t in self.tables if t.role == "driving")

    def validate(self) -> MartSpec:
        if sum(t.role == "driving" for t in self.tables) != 1:
            raise ValueError(f"{self.name}: exactly one driving table is needed")
        aliases = [t.alias for t in self.tables]
        if len(set(aliases)) != len(aliases):
            raise ValueError(f"{self.name}: table aliases repeat")
        unknown = {j.right for j in self.joins} - set(aliases)
        if unknown:
            raise ValueError(f"{self.name}: joins name unknown tables {sorted(unknown)}")
        names = [alias for t in self.tables for alias in t.columns.values()]
        repeated = {n for n in names if names.count(n) > 1}
        if repeated:
            raise ValueError(f"{self.name}: column aliases repeat {sorted(repeated)}")
        return self


@dataclass(frozen=True)
class LoadSettings:
    """How a source is extracted and loaded."""

    write_mode: str = "overwrite"
    custom_filter: str | None = None
    date_column: str | None = None
    trailing_months: int | None = None
    limit: int | None = None
    historical_column: str | None = None
    incremental_kind: str | None = None
    incremental_column: str | None = None
    delete_flag: bool = False

    @staticmethod
    def from_json(text: str) -> LoadSettings:
        """Read the stored settings text; every part is optional and independent of the others."""
        root = json.loads(text)
        props = root.get("dataloadproperties", root)
        conditional = props.get("conditional") or {}
        incremental = props.get("incremental") or {}
        months, limit = conditional.get("trailing_months"), props.get("limit")
        return LoadSettings(
            write_mode=props.get("write_mode") or "overwrite",
            custom_filter=props.get("custom_filter") or None,
            date_column=conditional.get("conditional_date_param") or None,
            trailing_months=int(months) if months not in (None, "") else None,
            limit=int(limit) if limit not in (None, "") else None,
            historical_column=(props.get("historical") or {}).get("historical_date_param") or None,
            incremental_kind=(incremental.get("incremental_refresh_column_type") or "").lower() or None,
            incremental_column=incremental.get("incremental_refresh_column_name") or None,
            delete_flag=str(props.get("delete_flag", "")).lower() in ("true", "1", "y"),
        )


def _build(kind, raw: Mapping[str, Any] | None):
    return None if raw is None else kind(**{f.name: raw[f.name] for f in fields(kind) if f.name in raw})


def _filter_group(raw: Mapping[str, Any] | None) -> FilterGroup | None:
    if not raw:
        return None
    columns = tuple(
        GroupColumn(c["column"], c.get("aggregate", "GroupBy"), c.get("alias"), tuple(c.get("order_by", ())))
        for c in raw.get("columns", ())
    )
    return FilterGroup(raw.get("condition"), columns, raw.get("flow", "F"))


def mart_from_json(text: str) -> MartSpec:
    raw = json.loads(text)
    return MartSpec(
        name=raw["name"],
        tables=tuple(
            TableSpec(t["name"], t.get("alias", t["name"]), t["columns"], t.get("role", "lookup"), _filter_group(t.get("step")))
            for t in raw["tables"]
        ),
        joins=tuple(
            JoinSpec(j["level"], j["right"], tuple(map(tuple, j["pairs"])), j.get("left", ""), j.get("salt", 1))
            for j in raw.get("joins", ())
        ),
        types=raw.get("types", {}),
        keys=tuple(raw.get("keys", ())),
        joined_step=_filter_group(raw.get("joined_step")),
        derived=tuple(_build(Derived, d) for d in raw.get("derived", ())),
        derived_step=_filter_group(raw.get("derived_step")),
        retain=tuple(raw.get("retain", ())),
        cleansing=raw.get("cleansing", {}),
        strict=raw.get("strict", False),
        name_rules=tuple(map(tuple, raw.get("name_rules", ()))),
    ).validate()


def warehouse_from_json(text: str) -> WarehouseSpec:
    raw = json.loads(text)
    columns = []
    for c in raw["columns"]:
        column = _build(ColumnMap, c)
        columns.append(ColumnMap(**{**column.__dict__, "join": tuple(map(tuple, c.get("join", ()))), "order": tuple(c.get("order", ()))}))
    return WarehouseSpec(raw["name"], raw["kind"], tuple(columns))


def _rows(df: DataFrame | None, only: Mapping[str, Any] | None = None) -> list[dict[str, Any]]:
    """Rows of a control table, one per mapped column; their texts may come padded.

    ``only`` holds the ids of the wanted rows (one, or a list). They are filtered before anything is collected; a
    column the table lacks does not count, and one whose id is not given must not hold several.
    """
    if df is None:
        return []
    for column, wanted in (only or {}).items():
        if column not in df.columns:
            continue
        if wanted is None:
            if df.select(column).distinct().limit(2).count() > 1:
                raise ValueError(f"the control tables hold several {column}; say which one is wanted")
            continue
        values = wanted if isinstance(wanted, (list, set, tuple)) else [wanted]
        df = df.where(F.trim(F.col(f"`{column}`").cast("string")).isin([str(v) for v in values]))
    return [{k: v.strip() if isinstance(v, str) else v for k, v in r.asDict().items()} for r in df.collect()]


def mart_from_control(
    name: str,
    control: Mapping[str, DataFrame],
    keys_only: tuple[str, ...] = ("PK", "SK"),
    mart_id: Any = None,
    job_id: Any = None,
) -> MartSpec:
    """Build a mart from its control tables (mapping, driving, lookup, joins, filter/group, derived).

    Column names are those of the control tables, see the fixtures document. Tables that hold several marts or jobs
    need ``mart_id`` and ``job_id``.
    """
    only = {"DL_Id": mart_id, "Job_Id": job_id}
    driving, lookup = _rows(control.get("mart_driving_column"), only), _rows(control.get("mart_lookup_column"), only)
    steps = _rows(control.get("mart_filter_group"), only)
    groups: dict[Any, list[dict]] = {}
    for row in _rows(control.get("mart_group_column"), {"Group_By_Id": {r["Group_By_Id"] for r in steps}}):
        groups.setdefault(row["Group_By_Id"], []).append(row)
    wanted = {r["Filter_Id"] for r in steps}
    filters = {r["Filter_Id"]: r["Filter_Condition"] for r in _rows(control.get("mart_filter"), {"Filter_Id": wanted})}

    def step(row: Mapping[str, Any] | None) -> FilterGroup | None:
        if row is None:
            return None
        columns = tuple(
            GroupColumn(
                g["Column_Name"],
                "GroupBy" if int(g["Flag"]) == 0 else g["Aggregation"],
                g["Column_Name_Alias"] or g["Column_Name"],
            )
            for g in groups.get(row["Group_By_Id"], ())
        )
        return FilterGroup(filters.get(row["Filter_Id"]), columns, row["Flow"] or "F")

    by_table = {r["Table_Name_Alias"]: r for r in steps if r["Settings_Position"] in ("Driving_Table", "Lookup_Table")}
    by_position = {r["Settings_Position"]: r for r in steps if r["Settings_Position"] in ("Join_Columns", "Derived_Columns")}

    tables: dict[str, dict[str, Any]] = {}
    for role, rows in (("driving", driving), ("lookup", lookup)):
        for row in rows:
            entry = tables.setdefault(
                row["Table_Name_Alias"], {"name": row["Table_Name"], "role": role, "columns": {}}
            )
            entry["columns"][row["Column_Name"]] = row["Column_Name_Alias"]

    joins: dict[tuple, list[tuple[str, str]]] = {}
    for row in sorted(_rows(control.get("mart_join"), only), key=lambda r: int(r["Join_Level"])):
        key = (int(row["Join_Level"]), row["Table_Name_Alias"], row["Join_Table_Alias"])
        joins.setdefault(key, []).append((row["Column_Name_Alias"], row["Join_Column_Alias"]))

    derived = _rows(control.get("mart_derived"), only)
    declared = {r["Column_Name_Alias"]: r["Data_Type"] for r in [*driving, *lookup]}
    declared |= {r["Column_Name"]: r["Data_Type"] for r in derived}
    mapping = _rows(control.get("mart_mapping"), only)
    join_only = {pair[1] for pairs in joins.values() for pair in pairs}
    return MartSpec(
        name=name,
        tables=tuple(
            TableSpec(t["name"], alias, t["columns"], t["role"], step(by_table.get(alias))) for alias, t in tables.items()
        ),
        joins=tuple(JoinSpec(level, right, tuple(pairs), left) for (level, left, right), pairs in joins.items()),
        types={m["DL_Column_Names"]: m["DL_Data_Types"] for m in mapping},
        keys=tuple(m["DL_Column_Names"] for m in mapping if (m["Constraints"] or "").upper() in keys_only),
        joined_step=step(by_position.get("Join_Columns")),
        derived=tuple(
            Derived(
                d["Column_Name"],
                d["Column_Expression"],
                int(d["Level"]),
                d["Expression_Type"],
                d["Column_Alias_Name"] or "",
                {a: declared[a] for a in _names(d["Column_Arguments"])},
                d["Data_Type"],
            )
            for d in derived
        ),
        derived_step=step(by_position.get("Derived_Columns")),
        retain=tuple(m["DL_Column_Names"] for m in mapping if m["DL_Column_Names"] not in join_only),
    ).validate()


def warehouse_from_control(name: str, mapping: DataFrame, connection: Any = None, schema: str | None = None) -> WarehouseSpec:
    """Build a warehouse table from its rows of the mapping control table.

    Where several connections or schemas map a table of that name, ``connection`` and ``schema`` choose one.
    """
    own = mapping.where(F.trim("IL_Table_Name") == name)
    rows = _rows(own, {"Connection_Id": connection, "Table_Schema": schema})
    if not rows:
        raise ValueError(f"no mapping rows for {name}")
    return WarehouseSpec(
        name,
        rows[0]["Dimension_Transaction"],
        tuple(
            ColumnMap(
                target=r["IL_Column_Name"],
                type=r["IL_Data_Type"],
                source=r["Source_Column_Name"],
                tag=(r["Constraints"] or "").upper(),
                constant=r["Constant_Insert_Value"],
                is_constant=(r["Constant_Insert_Column"] or "").upper() == "Y",
                dimension=r["Dimension_Name"],
                dimension_key=r["Dimension_Key"],
                join=tuple(zip(_names(r["LHS_Join_Condition"]), _names(r["RHS_Join_Condition"]), strict=True)),
                incremental=(r["Incremental_Column"] or "").upper() == "Y",
            )
            for r in rows
        ),
    )


def cleansing_from_control(type_conversion: DataFrame) -> tuple[dict[str, str], dict[str, str]]:
    """Replacements of missing values by type name, for other and for key columns, from the type-conversion table."""
    plain, keys = {}, {}
    for row in _rows(type_conversion):
        name = parse_type(row["IL_Data_Type"]).base
        if row["Cleansing_Value"] is not None:
            plain[name] = row["Cleansing_Value"]
        if row["PK_Cleansing_Value"] is not None:
            keys[name] = row["PK_Cleansing_Value"]
    return plain, keys


def _names(text: str | None) -> list[str]:
    return [part.strip() for part in (text or "").split(",") if part.strip()]
