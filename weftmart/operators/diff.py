"""Keyed differences and the evolution of targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weftmart.functions.types import default_value, spark_type
from weftmart.operators.aggregate import latest_time
from weftmart.operators.cleanse import replace_missing
from weftmart.operators.keys import SOURCE_HASH, with_key_text
from weftmart.operators.project import named
from weftmart.operators.sinks import AUDIT
from weftmart.spec import PK, SK, WarehouseSpec

INSERTED, UPDATED, DELETED, SAME = "I", "U", "D", "="
MISMATCH_FLAG = "Mismatch_Flag"


def keyed_diff(new: DataFrame, old: DataFrame, keys: Sequence[str], label: str = "change") -> DataFrame:
    """Every key of either side with its label and its row: the new one, or the old one if deleted.

    Rows are compared by value, null equal to null, so no checksum collision can hide a change.
    """
    keys = list(keys)
    columns = [c for c in new.columns if c not in keys]
    here = F.lit(True).alias("__here")
    packed_new = new.select(*[named(k) for k in keys], F.struct(here, *[named(c) for c in columns]).alias("__new"))
    packed_old = old.select(*[named(k) for k in keys], F.struct(here, *[named(c) for c in columns]).alias("__old"))
    a, b = F.col("__new"), F.col("__old")
    change = (
        F.when(b["__here"].isNull(), INSERTED)
        .when(a["__here"].isNull(), DELETED)
        .when(a.eqNullSafe(b), SAME)
        .otherwise(UPDATED)
    )
    row = F.when(a["__here"].isNull(), b).otherwise(a)
    joined = packed_new.join(packed_old, keys, "full_outer").withColumns({label: change, "__row": row})
    return joined.select(*[named(k) for k in keys], label, *[F.col("__row")[c].alias(c) for c in columns])


def apply_diff(old: DataFrame, changes: DataFrame, keys: Sequence[str], label: str = "change") -> DataFrame:
    """The old rows after the labelled changes: what ``keyed_diff`` compared them with."""
    gone = changes.where(F.col(label).isin(DELETED, UPDATED)).select(*[named(k) for k in keys])
    added = changes.where(F.col(label).isin(INSERTED, UPDATED)).select(*[named(c) for c in old.columns])
    return old.join(gone, list(keys), "left_anti").unionByName(added)


def evolve(df: DataFrame, columns: Mapping[str, str], allow_losses: bool = False) -> DataFrame:
    """Rewrite rows to a new column list: new columns are null, left-out ones go, types change.

    A value that does not fit its new type is refused, by one scan of the columns whose type changes; with
    ``allow_losses`` it becomes null.
    """
    changed = {c: spark_type(t) for c, t in columns.items() if c in df.columns and df.schema[c].dataType != spark_type(t)}
    if changed and not allow_losses:
        lost = [F.count_if(named(c).isNotNull() & named(c).try_cast(t).isNull()).alias(c) for c, t in changed.items()]
        counts = df.agg(*lost).first().asDict()
        if any(counts.values()):
            raise ValueError(f"values do not fit their new types: { {c: n for c, n in counts.items() if n} }")
    return df.select(
        *[
            (named(c).try_cast(spark_type(t)) if c in df.columns else F.lit(None).cast(spark_type(t))).alias(c)
            for c, t in columns.items()
        ]
    )


def key_rules(saved: Sequence[str], live: Sequence[str]) -> dict[str, list[str]]:
    """What a change of the key set asks for: columns that become required, and that stop being so."""
    return {
        "not_null": [c for c in saved if c not in live],
        "nullable": [c for c in live if c not in saved],
        "changed": [] if list(saved) == list(live) else list(saved),
    }


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat or hold a null, with their row count. Counts combine in each task first."""
    counted = df.groupBy(*[named(k) for k in keys]).agg(F.count("*").alias("row_count"))
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | named(k).isNull()
    issue = F.when(has_null, "null").when(F.col("row_count") > 1, "duplicate")
    return counted.withColumn("issue", issue).where("issue is not null")


def rekey(df: DataFrame, keys: Sequence[str], types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows under a new key set: keys cleansed, key text rebuilt; and the keys that do not qualify."""
    rows = replace_missing(df, {k: types[k] for k in keys}, keys)
    return with_key_text(rows, keys), key_violations(df, keys)


def target_schema(spec: WarehouseSpec, variant: str = "warehouse") -> T.StructType:
    """Columns of a target: mapped ones, then checksum, mismatch and audit columns.

    Variants: ``staging`` (same), ``warehouse``, ``deletes`` (no checksum or mismatch column). A primary
    key is not nullable and carries its default in the field's metadata.
    """
    schema = T.StructType()
    for c in spec.columns:
        metadata = {"type": c.type, "tag": c.tag}
        if c.tag == PK:
            metadata["default"] = str(default_value(c.type, key=True))
        schema.add(T.StructField(c.target, T.LongType() if c.tag == SK else spark_type(c.type), c.tag != PK, metadata))
    if variant != "deletes":
        schema.add(SOURCE_HASH, T.StringType()).add(MISMATCH_FLAG, T.ByteType())
    for c in AUDIT:
        schema.add(c, T.TimestampNTZType() if c.endswith("Date") else T.StringType())
    return schema


def as_target(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the target's columns and types; columns the rows lack are null."""
    present = set(df.columns)
    return df.select(
        *[(named(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def create_if_missing(spark: SparkSession, table: str, schema: T.StructType) -> bool:
    """Create an empty catalogue table unless it exists; tells whether it was created."""
    if spark.catalog.tableExists(table):
        return False
    nullable = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])
    spark.createDataFrame([], nullable).write.saveAsTable(table, format="parquet")
    return True


def needs_refresh(updated: DataFrame, built: DataFrame, keys: Sequence[str], time_column: str) -> DataFrame:
    """Keys updated after their last build, or never built."""
    last_update = latest_time(updated, keys, time_column, "last_update")
    last_build = latest_time(built, keys, time_column, "last_build")
    joined = last_update.join(last_build, list(keys), "left_outer")
    return joined.where("last_build is null or last_update > last_build")
