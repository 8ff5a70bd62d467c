"""Newest row per key of a stream, kept in the state store and written as change sets.

The state store remembers of each key only the order values of its newest row. A batch gives out the rows that replace
these, one per key; repeated and late rows end there, so the target is never read, and a batch writes as much as it
changes. Batches are steps of the target's journal: one that is tried again after a failure adds nothing twice.

With a time column and a delay, rows that come later than the delay are dropped, and the state of a key that is silent
for so long is given up: whatever then comes for it is newer. Without them the state holds every key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftmart.operators.changesets import ChangeSets
from weftmart.operators.project import named

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rank(values: Sequence[Any]) -> tuple:
    """Order values that compare; a missing one is the oldest."""
    return tuple((False, 0) if v is None or pd.isna(v) else (True, v) for v in values)


class NewestRow(StatefulProcessor):
    """Gives out a key's newest row of a batch if it is newer than all before."""

    def __init__(self, order: Sequence[str], kept: T.StructType, columns: Sequence[str], time: str | None, delay_ms: int | None):
        self.order, self.kept, self.columns, self.time, self.delay_ms = list(order), kept, list(columns), time, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.kept)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        best, chosen = None, None
        if self.newest.exists():
            best = _rank(self.newest.get())
        for part in rows:
            for i, values in enumerate(part[self.order].astype(object).itertuples(index=False, name=None)):
                rank = _rank(values)
                if best is None or rank > best:
                    best, chosen = rank, part.iloc[[i]]
        if chosen is None:
            return
        values = chosen[self.order].astype(object).iloc[0].tolist()
        self.newest.update(tuple(None if v is None or pd.isna(v) else v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in values))
        at = chosen[self.time].iloc[0] if self.time else None
        if at is not None and not pd.isna(at):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            # times come in the session's zone, which is UTC
            self.handle.registerTimer((pd.Timestamp(at) - pd.Timestamp(0)) // pd.Timedelta(milliseconds=1) + self.delay_ms)
        yield chosen[self.columns]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.newest.clear()
        yield pd.DataFrame({c: pd.Series(dtype=object) for c in self.columns})

    def close(self) -> None:
        pass


def newest_rows(stream: DataFrame, keys: Sequence[str], order: Sequence[str], time: str | None = None, delay: str | None = None) -> DataFrame:
    """The stream of rows that are newer, by the ``order`` columns, than all rows of their key before."""
    columns = stream.columns
    kept = T.StructType([stream.schema[c] for c in order])
    if (time is None) != (delay is None):
        raise ValueError("a time column and a delay go together")
    delay_ms = None
    if time is not None:
        # the watermark needs a time with a zone, which is the session's
        stream = stream.withColumn("__at", named(time).cast("timestamp")).withWatermark("__at", delay)
        later = F.expr(f"unix_millis(timestamp_millis(0) + interval {delay})")
        delay_ms = stream.sparkSession.range(1).select(later).first()[0]
    return stream.groupBy(*[named(k) for k in keys]).transformWithStateInPandas(
        NewestRow(order, kept, columns, time, delay_ms),
        outputStructType=T.StructType([stream.schema[c] for c in columns]),
        outputMode="Update",
        timeMode="EventTime" if time is not None else "None",
    )


def merge_newest(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    table: ChangeSets,
    order: Sequence[str],
    checkpoint: str,
    files_per_batch: int = 1000,
    time: str | None = None,
    delay: str | None = None,
) -> ChangeSets:
    """Take all files not yet seen into a table of change sets, by its keys, and stop."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landed)
        newest = newest_rows(stream, table.keys, order, time, delay)

        def take(batch: DataFrame, number: int) -> None:
            table.commit(f"batch {number}", lambda: batch)

        writer = newest.writeStream.foreachBatch(take).outputMode("update").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(_STORE, before)
    return table
