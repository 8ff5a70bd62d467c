"""Incremental load of a landed folder: the batch merge of each new file set, once per batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weftmart.operators.aggregate import last_row
from weftmart.operators.sinks import upsert_partitions
from weftmart.session import read_if_there, write_table

Prepare = Callable[[DataFrame], DataFrame]


def _take_in(
    spark: SparkSession, landed: str, schema: T.StructType, checkpoint: str, files_per_batch: int, merge: Callable[[DataFrame, int], None]
) -> None:
    """Run ``merge`` on all files not yet seen, a set of files at a time, and stop."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landed)
    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def merge_stream(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
    state_path: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    prepare: Prepare = lambda df: df,
) -> DataFrame:
    """Take in new files and return the merged table.

    Batch n reads version n-1 and writes version n, so a repeated batch writes the same table again. A
    finished version is noted in a small table of its own. Within a batch the newest row of a key wins; a
    late row only replaces an older one.
    """

    def version(number: int) -> str:
        return f"{state_path}/version={number}"

    def merge(batch: DataFrame, number: int) -> None:
        state = last_row(prepare(batch), keys, order)
        if number > 0:
            stored = spark.read.schema(state.schema).parquet(version(number - 1))
            state = last_row(stored.unionByName(state), keys, order)
        write_table(state, version(number))
        spark.range(1).select(F.lit(number).alias("number")).write.mode("append").parquet(f"{state_path}/finished")

    _take_in(spark, landed, schema, checkpoint, files_per_batch, merge)
    newest = read_if_there(spark, f"{state_path}/finished", "number int").agg(F.max("number")).first()[0]
    # before the first file the table is empty
    return spark.read.parquet(version(newest)) if newest is not None else prepare(spark.createDataFrame([], schema))


def merge_stream_partitions(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
    partition_column: str,
    state_path: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    prepare: Prepare = lambda df: df,
) -> DataFrame:
    """The same into a partitioned table, of which a batch rewrites only the partitions it touches.

    A key must never change its partition. Merging a batch twice gives the same rows, so a repeated batch
    does no harm.
    """

    def newest(stored: DataFrame, incoming: DataFrame) -> DataFrame:
        return last_row(stored.unionByName(incoming), keys, order)

    def merge(batch: DataFrame, number: int) -> None:
        incoming = last_row(prepare(batch), keys, order)
        if number == 0:
            write_table(incoming, state_path, [partition_column])
        else:
            upsert_partitions(spark, state_path, incoming, keys, partition_column, newest)

    _take_in(spark, landed, schema, checkpoint, files_per_batch, merge)
    return read_if_there(spark, state_path, prepare(spark.createDataFrame([], schema)).schema)
