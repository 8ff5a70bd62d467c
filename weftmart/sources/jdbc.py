"""Options of partitioned JDBC reads and batched JDBC writes.

Spark's JDBC source reads the blocks in parallel and pushes filters, aggregates and limits down; nothing
here numbers rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows per read block, rows per write batch of a mart or key table, and of other tables.
BLOCK_ROWS = 40_000
MART_BATCH_ROWS = 25_000
WAREHOUSE_BATCH_ROWS = 10_000


def block_count(rows: int, block_rows: int = BLOCK_ROWS) -> int:
    return max(1, math.ceil(rows / block_rows))


def key_range(df: DataFrame, key: str) -> tuple[int, int, int]:
    """(smallest key, greatest key, rows)."""
    low, high, rows = df.agg(F.min(key), F.max(key), F.count("*")).first()
    return low or 0, high or 0, rows


def partition_options(key: str, low: int, high: int, blocks: int) -> dict[str, str]:
    return {
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(max(1, min(blocks, high - low + 1))),
    }


def block_of(key: Column, low: int, high: int, blocks: int) -> Column:
    """The block a key falls in, counted from 1: equal strides, every key in exactly one."""
    stride = max(1, math.ceil((high - low + 1) / max(1, blocks)))
    return F.floor((key - F.lit(low)) / F.lit(stride)).cast("bigint") + 1


def read_options(url: str, table: str, **partitioning: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, **partitioning}


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def write_options(url: str, table: str, batch_rows: int = WAREHOUSE_BATCH_ROWS, connections: int = 8) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), "numPartitions": str(connections)}


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    df.write.format("jdbc").options(**options).mode(mode).save()
