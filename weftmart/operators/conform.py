"""Conforming data to declared types, and checking tagged keys on the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from weftmart.functions.types import normalise_source_type, parse_type, spark_type
from weftmart.operators.diff import key_violations
from weftmart.operators.joins import exclude, keep_matching
from weftmart.operators.project import named
from weftmart.spec import FK, PK, SK, TRANSACTION, ColumnMap, WarehouseSpec


def conform_source(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Columns in the Spark type of their normalised source type."""
    types = {c: spark_type(normalise_source_type(t)) for c, t in declared.items()}
    return df.select(*[named(c).try_cast(t).alias(c) for c, t in types.items()])


def conform_target(df: DataFrame, declared: Mapping[str, str], allow_losses: bool = False) -> DataFrame:
    """Columns in their target type.

    Texts longer than declared and values that do not fit are refused, by one scan that counts them. With
    ``allow_losses`` texts are cut and such values become null; ``conform_losses`` tells how many.
    """
    if not allow_losses:
        bad = conform_losses(df, declared).where("cut > 0 OR lost > 0").collect()  # one row per column
        if bad:
            raise ValueError("values do not fit: " + ", ".join(f"{r.column_name} ({r.cut} cut, {r.lost} lost)" for r in bad))

    def value(name: str, text: str):
        kind = parse_type(text)
        if kind.is_string:
            column = named(name).cast("string")
            return F.left(column, F.lit(kind.precision)) if kind.precision else column
        return named(name).try_cast(spark_type(text))

    return df.select(*[value(c, t).alias(c) for c, t in declared.items()])


def conform_losses(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Per column: values that were cut, and values that did not fit their type. One scan, no shuffle of rows."""
    counts = []
    for i, (name, text) in enumerate(declared.items()):
        kind, column = parse_type(text), named(name)
        if kind.is_string:
            cut = F.count_if(F.length(column) > kind.precision) if kind.precision else F.lit(0)
            lost = F.lit(0)
        else:
            cut = F.lit(0)
            lost = F.count_if(column.isNotNull() & column.try_cast(spark_type(text)).isNull())
        counts.append(
            F.struct(F.lit(name).alias("column_name"), cut.cast("bigint").alias("cut"), lost.cast("bigint").alias("lost"))
        )
    return df.agg(F.array(*counts).alias("__all")).select(F.inline("__all"))


def key_report(df: DataFrame, keys: Sequence[str], parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Check tagged keys on the data: repeated or null primary keys, uncovered foreign keys.

    ``parents`` maps a column to (parent rows, parent column). One row per check.
    """
    bad = key_violations(df, keys)
    checks = [
        bad.agg(
            F.lit("primary key " + ",".join(keys)).alias("check_name"),
            F.count("*").alias("bad_keys"),
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("bad_rows"),
        )
    ]
    for column, (parent, parent_column) in parents.items():
        # group first: a hot key then counts once in the join
        per_key = df.where(named(column).isNotNull()).groupBy(named(column)).agg(F.count("*").alias("n"))
        orphans = exclude(per_key, parent, {column: parent_column})
        checks.append(
            orphans.agg(
                F.lit("foreign key " + column).alias("check_name"),
                F.count("*").alias("bad_keys"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("bad_rows"),
            )
        )
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report


def with_system_columns(spec: WarehouseSpec, data_source: str, company: str) -> WarehouseSpec:
    """Every target gets its source, tenant and surrogate key columns."""
    present = {c.target for c in spec.columns}
    system = (
        ColumnMap("DataSource_Id", "varchar(50)", tag=PK, constant=data_source, is_constant=True),
        ColumnMap("Company_Id", "varchar(50)", tag=PK, constant=company, is_constant=True),
        ColumnMap(f"{spec.name}_Key", "bigint", tag=SK),
    )
    return replace(spec, columns=spec.columns + tuple(c for c in system if c.target not in present))


def _has_source(column: ColumnMap) -> bool:
    return column.tag not in (PK, SK) and (column.tag != FK or bool(column.source))


def tag_incremental(spec: WarehouseSpec, previous_kind: str | None = None) -> WarehouseSpec:
    """Mark the columns that enter the change checksum: those of transactions, also of a table that became one.

    A foreign key without a source column is resolved on the way to the warehouse, so it is not marked.
    """
    tracked = spec.kind == TRANSACTION or previous_kind == TRANSACTION
    return replace(spec, columns=tuple(replace(c, incremental=tracked and _has_source(c)) for c in spec.columns))


def purge_orphans(df: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose parent key still exists."""
    return keep_matching(df, parent, on)
