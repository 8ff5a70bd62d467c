"""Key versions with validity intervals, and lookups of the version that was valid at a time.

A lookup by time does not join on ranges. Versions and facts are laid in one order of key and time, range-partitioned, and
the last version is carried forward through each partition; what is carried into a partition from the ones before it
is one row per partition. So a key with any number of versions or facts spans tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftmart.functions.scalars import literal
from weftmart.operators.diff import INSERTED, SAME, UPDATED, DELETED, keyed_diff
from weftmart.operators.keys import ranged
from weftmart.operators.project import named

VALID_FROM, VALID_TO, ACTIVE = "Valid_From", "Valid_To", "Active_flag"


def track_history(history: DataFrame | None, current: DataFrame, keys: Sequence[str], at: dt.datetime, complete: bool = True) -> DataFrame:
    """The history after ``current`` rows were seen at a time.

    A key whose row changed gets its open version closed at that time and a new one opened; a key that is not among
    complete ``current`` rows is closed. Closed versions are never touched, and equal rows open none.
    """
    now = literal(at)
    opened = {VALID_FROM: now, VALID_TO: F.lit(None).cast(current.sparkSession.range(0).select(now.alias("x")).schema["x"].dataType), ACTIVE: F.lit(1)}
    if history is None:
        return current.withColumns(opened)
    columns = [*keys, *[c for c in current.columns if c not in keys]]
    alive, closed = history.where(F.col(ACTIVE) == 1), history.where(F.col(ACTIVE) == 0)
    changes = keyed_diff(current.select(*[named(c) for c in columns]), alive.select(*[named(c) for c in columns]), keys, "__change")
    ending = [UPDATED, DELETED] if complete else [UPDATED]
    ended = changes.where(F.col("__change").isin(ending)).select(*[named(k).alias(f"__k_{i}") for i, k in enumerate(keys)], F.lit(True).alias("__ended"))
    alike = F.lit(True)
    for i, k in enumerate(keys):
        alike = alike & named(k).eqNullSafe(F.col(f"__k_{i}"))
    ends = F.col("__ended").isNotNull()
    kept = alive.join(ended, alike, "left_outer").withColumns(
        {VALID_TO: F.when(ends, now).otherwise(F.col(VALID_TO)), ACTIVE: F.when(ends, F.lit(0)).otherwise(F.col(ACTIVE))}
    )
    kinds = dict(history.dtypes)
    fresh = changes.where(F.col("__change").isin(INSERTED, UPDATED)).select(*[named(c) for c in columns]).withColumns(opened)
    fresh = fresh.select(*[named(c).cast(kinds[c]).alias(c) for c in history.columns])
    return closed.unionByName(kept.select(*[named(c) for c in history.columns])).unionByName(fresh)


def intervals(versions: DataFrame, keys: Sequence[str], start: str, end: str = VALID_TO) -> DataFrame:
    """Versions with the time at which the next one of their key starts; the last one has none.

    The order is reversed and the start of the version met before is carried on, so no task holds a hot key.
    """
    order = [*[named(k) for k in keys], named(start).desc()]
    return _carried(versions, order, keys, F.struct(named(start).alias("v")), F.lit(True), "__next").withColumn(end, F.col("__next.v")).drop("__next")


def valid_at(
    facts: DataFrame,
    versions: DataFrame,
    on: Mapping[str, str],
    fact_time: str,
    start: str,
    fetch: Mapping[str, str],
    end: str | None = None,
) -> DataFrame:
    """Fetch columns of the version of a key that was valid at the fact's time: the last one that started by then.

    ``on`` maps fact columns to version columns, ``fetch`` version columns to new ones. With ``end`` a version that
    ended by then gives nothing. Facts before the first version, without a match, a key or a time get nulls.
    """
    keys = [f"__k_{i}" for i in range(len(on))]
    row = [named(c).alias(a) for c, a in fetch.items()] + ([named(end).alias("__end")] if end else [])
    known = versions.select(*[named(b).alias(k) for k, b in zip(keys, on.values(), strict=True)], named(start).alias("__at"), F.lit(0).alias("__kind"), F.struct(*row).alias("__version"))
    known = known.where(F.col("__at").isNotNull())
    asked = facts.select(*[named(a).alias(k) for k, a in zip(keys, on, strict=True)], named(fact_time).alias("__at"), F.lit(1).alias("__kind"), F.struct(*[named(c) for c in facts.columns]).alias("__fact"))
    both = known.unionByName(asked, allowMissingColumns=True)
    # a version that starts at the fact's own time is valid
    order = [*[F.col(k) for k in keys], F.col("__at"), F.col("__kind")]
    met = _carried(both, order, keys, F.col("__version"), F.col("__kind") == 0, "__met", own=True).where("__kind = 1")
    usable = F.col("__at").isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    if end:
        usable = usable & (F.col("__met.__end").isNull() | (F.col("__met.__end") > F.col("__at")))
    fetched = [F.when(usable, F.col("__met")[a]).alias(a) for a in fetch.values()]
    return met.select(*[F.col("__fact")[c].alias(c) for c in facts.columns], *fetched)


def _carried(df: DataFrame, order: Sequence[Column], keys: Sequence[str], value: Column, gives: Column, alias: str, own: bool = False) -> DataFrame:
    """For every row the ``value`` of the last row of its key before it (``own``: or itself) where ``gives`` holds."""
    placed = ranged(df, order, "carried")
    columns = [c for c in placed.columns if c not in ("__part", "__pos")]
    given = F.when(gives, F.struct(*[named(k) for k in keys], value.alias("__value")))
    rows = placed.withColumn("__given", given)
    # one row per partition: what it hands on
    last = rows.where("__given IS NOT NULL").groupBy("__part").agg(F.max_by("__given", "__pos").alias("__last"))
    parts = rows.select("__part").distinct().join(last, "__part", "left_outer")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    handed = parts.select("__part", F.last("__last", ignorenulls=True).over(before).alias("__handed"))
    upto = Window.partitionBy("__part").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    carried = rows.withColumn("__here", F.last("__given", ignorenulls=True).over(upto)).join(F.broadcast(handed), "__part")
    found = F.coalesce("__here", "__handed")
    alike = F.lit(True)
    for k in keys:
        alike = alike & found[k].eqNullSafe(named(k))
    return carried.select(*[named(c) for c in columns], F.when(alike, found["__value"]).alias(alias))
