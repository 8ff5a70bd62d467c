"""Load modes of a target: overwrite, upsert, deletes, replacement and full synchronisation.

The functions return the target's next state as a DataFrame; ``write_table`` stores it under a new path,
so a table is never overwritten while it is read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weftmart.functions.scalars import literal, render_in_zone
from weftmart.operators.joins import exclude, flag_matches
from weftmart.operators.project import DELETE_INDICATOR, named
from weftmart.session import materialise, write_table

# Audit columns of every warehouse table.
ADDED_DATE, ADDED_USER = "Added_Date", "Added_User"
UPDATED_DATE, UPDATED_USER = "Updated_Date", "Updated_User"
AUDIT = (ADDED_DATE, ADDED_USER, UPDATED_DATE, UPDATED_USER)

Stamp = tuple[dt.datetime, str]


def _stamp_columns(stamp: Stamp) -> dict[str, Column]:
    when, user = literal(stamp[0]), F.lit(stamp[1])
    return {ADDED_DATE: when, ADDED_USER: user, UPDATED_DATE: when, UPDATED_USER: user}


def stamped(df: DataFrame, stamp: Stamp) -> DataFrame:
    """Rows as first inserted: all four audit columns set."""
    return df.withColumns(_stamp_columns(stamp))


def _packed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], alias: str) -> DataFrame:
    here = F.lit(True).alias("__here")
    return df.select(*[named(k) for k in keys], F.struct(here, *[named(c) for c in columns]).alias(alias))


def _merged(
    pairs: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    given: Sequence[str],
    stamp: Stamp | None,
    hash_column: str | None,
    date_only: bool,
    insert_only: Sequence[str] = (),
) -> DataFrame:
    """Target columns from rows that hold the old and the new version side by side."""
    old, new = F.col("__old"), F.col("__new")
    inserted = old["__here"].isNull()
    changed = new["__here"].isNotNull()
    if hash_column:
        changed = changed & (inserted | ~old[hash_column].eqNullSafe(new[hash_column]))
    audit = _stamp_columns(stamp) if stamp else {}
    outputs = []
    for c in target.columns:
        kind = target.schema[c].dataType
        if c in keys:
            value = named(c)
        elif c in (ADDED_DATE, ADDED_USER) and stamp:
            value = F.when(inserted, audit[c]).otherwise(old[c])
        elif c == UPDATED_USER and stamp and date_only:
            value = F.when(inserted, audit[c]).otherwise(old[c])
        elif c in (UPDATED_DATE, UPDATED_USER) and stamp:
            value = F.when(changed, audit[c]).otherwise(old[c])
        elif c in insert_only:
            value = F.when(inserted, new[c].cast(kind)).otherwise(old[c])
        elif c in given:
            value = F.when(changed, new[c].cast(kind)).otherwise(old[c])
        else:
            value = old[c]
        outputs.append(value.alias(c))
    return pairs.select(*outputs)


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    stamp: Stamp | None = None,
    hash_column: str | None = None,
    date_only: bool = False,
    strategy: str = "bulk",
    insert_only: Sequence[str] = (),
) -> DataFrame:
    """The target after merging incoming rows by key; both sides must be unique on the key.

    With ``hash_column`` a row whose checksum did not change stays as it is, its update time included.
    Columns the incoming rows lack keep their old value, and so do ``insert_only`` columns of known keys.
    ``date_only`` stamps only the update time of changed rows.

    ``bulk`` shuffles each side once (full outer join). ``delta`` is for incoming sets much smaller than
    the target: all its joins have the incoming side on the right, so Catalyst broadcasts it when its
    known size is under the threshold and the target is not shuffled at all.
    """
    keys = list(keys)
    columns = [c for c in target.columns if c not in keys]
    given = [c for c in incoming.columns if c in columns]
    old = _packed(target, keys, columns, "__old")
    new = _packed(incoming, keys, given, "__new")
    rest = (target, keys, given, stamp, hash_column, date_only, insert_only)
    if strategy == "bulk":
        return _merged(old.join(new, keys, "full_outer"), *rest)
    if strategy != "delta":
        raise ValueError(f"unknown upsert strategy {strategy!r}")
    stored = _merged(old.join(new, keys, "left_outer"), *rest)
    key_columns = [named(k) for k in keys]
    seen = target.select(*key_columns).join(incoming.select(*key_columns), keys, "left_semi")
    fresh = new.join(seen, keys, "left_anti").withColumn("__old", F.lit(None).cast(old.schema["__old"].dataType))
    return stored.unionByName(_merged(fresh, *rest))


def full_sync(
    target: DataFrame, live: DataFrame, keys: Sequence[str], stamp: Stamp | None = None, hash_column: str | None = None
) -> DataFrame:
    """The target made equal to the live rows: rows the source lacks go, the others merge."""
    keys = list(keys)
    columns = [c for c in target.columns if c not in keys]
    given = [c for c in live.columns if c in columns]
    pairs = _packed(live, keys, given, "__new").join(_packed(target, keys, columns, "__old"), keys, "left_outer")
    return _merged(pairs, target, keys, given, stamp, hash_column, False)


def load(
    target: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    path: str,
    write_mode: str = "overwrite",
    stamp: Stamp | None = None,
    **options,
) -> DataFrame:
    """Write the next version of a target under ``path`` and return it."""
    if write_mode not in ("overwrite", "upsert"):
        raise ValueError(f"unknown write mode {write_mode!r}")
    if write_mode == "overwrite" or target is None:
        state = stamped(incoming, stamp) if stamp else incoming
    else:
        state = upsert(target, incoming, keys, stamp, **options)
    return write_table(state, path)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    partition_column: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    **options,
) -> DataFrame:
    """Upsert into a partitioned table, reading and rewriting only the partitions incoming rows touch.

    A key that would change its partition is refused, by a scan of the stored keys. Columns that incoming rows lack
    keep their values. The merged partitions are written aside first and then replace their old versions, as Spark's
    dynamic partition overwrite does it. ``merge`` replaces the upsert by another function of (stored rows, incoming
    rows).
    """
    stored = spark.read.parquet(path).schema
    # the files' own columns, and the partition in the type of the incoming rows instead of one guessed from folder names
    schema = T.StructType([*(f for f in stored if f.name != partition_column), incoming.schema[partition_column]])
    target = spark.read.schema(schema).parquet(path)
    incoming = materialise(incoming, "incoming")
    places = incoming.select(*[named(k) for k in keys], named(partition_column).alias("__new"))
    moved = target.select(*[named(k) for k in keys], named(partition_column).alias("__old")).join(places, list(keys))
    if partition_column not in keys and not moved.where(~F.col("__old").eqNullSafe(F.col("__new"))).isEmpty():
        raise ValueError(f"incoming keys lie in another {partition_column} than the stored ones")
    touched = incoming.select(named(partition_column)).distinct()
    affected = target.join(touched.where(named(partition_column).isNotNull()), partition_column, "left_semi")
    if not touched.where(named(partition_column).isNull()).isEmpty():
        affected = affected.unionByName(target.where(named(partition_column).isNull()))
    affected = affected.select(*[named(f.name) for f in schema])
    state = merge(affected, incoming) if merge else upsert(affected, incoming, keys, **options)
    sized = materialise(state, "partitions").hint("rebalance", named(partition_column))
    sized.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_column).parquet(path)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(schema).parquet(path)


def save_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a target as a catalogue table bucketed and sorted by its key, and return it.

    An upsert into it, or a delete from it, then shuffles only the incoming side. One task writes one
    bucket, so choose the count for buckets of a few hundred megabytes.
    """
    placed = df.repartition(buckets, *[named(k) for k in keys])
    placed.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def merge_into(table: str, incoming: DataFrame, keys: Sequence[str], hash_column: str | None = None) -> None:
    """Upsert into a catalogue table whose connector supports row-level operations."""
    source = incoming.alias("source")
    matching = " AND ".join(f"{table}.`{k}` = source.`{k}`" for k in keys)
    merge = source.mergeInto(table, F.expr(matching))
    if hash_column:
        merge = merge.whenMatched(F.expr(f"NOT ({table}.`{hash_column}` <=> source.`{hash_column}`)")).updateAll()
    else:
        merge = merge.whenMatched().updateAll()
    merge.whenNotMatched().insertAll().merge()


def delete_rows(target: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target without the rows flagged for deletion."""
    flagged = deletes.where(F.col(DELETE_INDICATOR)) if DELETE_INDICATOR in deletes.columns else deletes
    return target.join(flagged.select(*[named(k) for k in keys]), list(keys), "left_anti")


def audit_deletes(deletes: DataFrame, stamp: Stamp, zone: str = "UTC") -> DataFrame:
    """Deleted rows for the audit table, stamped in the tenant's time zone."""
    rows = stamped(deletes.drop(DELETE_INDICATOR), stamp)
    return rows.withColumns({c: render_in_zone(F.col(c), zone) for c in (ADDED_DATE, UPDATED_DATE)})


def replace_by_key(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete every row of the incoming keys, then insert the incoming rows: a repeatable reload."""
    return exclude(target, incoming, {k: k for k in keys}).unionByName(incoming)


def deactivate_and_insert(target: DataFrame, incoming: DataFrame, keys: Sequence[str], flag: str = "Active_flag") -> DataFrame:
    """Keep old versions as inactive rows and add the incoming ones as active."""
    kind = target.schema[flag].dataType
    history = flag_matches(target, incoming, keys, "__renewed")
    state = F.when(F.col("__renewed"), F.lit(0)).otherwise(named(flag)).cast(kind)
    return history.withColumn(flag, state).drop("__renewed").unionByName(incoming.withColumn(flag, F.lit(1).cast(kind)))
