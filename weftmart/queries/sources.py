"""Sources: column lists, partitioned reads, landed files, in-flow SQL, staging windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from weftmart.operators.aggregate import filter_group
from weftmart.queries.registry import Tables, doubles, query
from weftmart.session import scratch_path
from weftmart.sources.batched import FolderTarget, write_batched
from weftmart.sources.blocks import key_blocks, parquet_fetch, read_blocks
from weftmart.sources.files import csv_source, file_source, select_source, sql_source, staging_source
from weftmart.sources.jdbc import BLOCK_ROWS, block_count, block_of, key_range
from weftmart.spec import FilterGroup, GroupColumn


@query(
    "s1_select_source",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS price
       FROM orders WHERE o_totalprice > 100000""",
)
def select_aliased(t: Tables):
    columns = {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "price"}
    return select_source(t.orders, columns, "o_totalprice > 100000")


@query(
    "s2_partitioned_read",
    """WITH r AS (SELECT min(l_orderkey) AS low, max(l_orderkey) AS high, count(*) AS n FROM lineitem),
       b AS (SELECT low, CAST(ceil((high - low + 1) / greatest(1, ceil(n / 40000.0))) AS BIGINT) AS stride FROM r)
       SELECT CAST(floor((l_orderkey - low) / stride) AS BIGINT) + 1 AS block,
              count(*) AS row_count, min(l_orderkey) AS first_key, max(l_orderkey) AS last_key
       FROM lineitem, b GROUP BY 1""",
)
def partitioned_read(t: Tables):
    low, high, rows = key_range(t.lineitem, "l_orderkey")
    block = block_of(F.col("l_orderkey"), low, high, block_count(rows, BLOCK_ROWS)).alias("block")
    return t.lineitem.groupBy(block).agg(
        F.count("*").alias("row_count"), F.min("l_orderkey").alias("first_key"), F.max("l_orderkey").alias("last_key")
    )


@query(
    "s3_source_kind",
    """WITH g AS (SELECT l_returnflag, sum(l_quantity) AS quantity FROM lineitem
                  WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00' GROUP BY l_returnflag)
       SELECT 'db' AS kind, l_returnflag, quantity FROM g
       UNION ALL SELECT 'flow' AS kind, l_returnflag, quantity FROM g""",
)
def source_kind(t: Tables):
    """The same step run as a source query and in the flow."""
    condition = "l_shipdate >= timestamp_ntz'1997-01-01 00:00:00'"
    step = FilterGroup(condition, (GroupColumn("l_returnflag"), GroupColumn("l_quantity", "Sum", "quantity")))
    in_source = sql_source(
        t.lineitem,
        "SELECT l_returnflag, sum(l_quantity) AS quantity FROM {source} "
        f"WHERE {condition} GROUP BY l_returnflag",
    )
    in_flow = filter_group(t.lineitem, step)
    return in_source.select(F.lit("db").alias("kind"), "*").unionByName(in_flow.select(F.lit("flow").alias("kind"), "*"))


@query("s4_csv_source", "SELECT * FROM orders")
def csv_round_trip(t: Tables):
    path = scratch_path(t.spark, "csv")
    t.orders.write.option("header", True).csv(path)
    return csv_source(t.spark, path, t.orders.schema)


@query("s5_landed_files", "SELECT * FROM conversations")
def landed_json(t: Tables):
    path = scratch_path(t.spark, "json")
    t.conversations.write.json(path)
    return file_source(t.spark, path, "json", t.conversations.schema)


@query(
    "s6_sql_source",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total
       FROM orders GROUP BY 1, 2 HAVING count(*) > 10""",
)
def in_flow_sql(t: Tables):
    grouped = sql_source(
        t.orders,
        """SELECT o_orderstatus, o_orderpriority, count(*) AS orders, sum(cast(o_totalprice AS decimal(14,2))) AS total
           FROM {source} GROUP BY o_orderstatus, o_orderpriority HAVING count(*) > 10""",
    )
    return doubles(grouped, "total")


@query(
    "s7_staging_window",
    """SELECT 'upsert' AS write_mode, event_id, ts AS Updated_Date, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
       UNION ALL SELECT 'overwrite' AS write_mode, event_id, ts AS Updated_Date, user_id FROM events""",
)
def staging_window(t: Tables):
    staged = t.events.withColumnRenamed("ts", "Updated_Date")
    columns, start = ["event_id", "Updated_Date", "user_id"], dt.datetime(2024, 1, 15)
    parts = [
        staging_source(staged, columns, mode, start).select(F.lit(mode).alias("write_mode"), "*")
        for mode in ("upsert", "overwrite")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "s2_key_blocks",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_suppkey > 3 AND l_quantity < 24""",
)
def key_block_read(t: Tables):
    """Blocks by quantiles of a key with many rows a value, read from a landed copy that applies the conditions."""
    columns = ["l_suppkey", "l_orderkey", "l_linenumber", "l_quantity"]
    rows = t.lineitem.select(*columns)
    path = scratch_path(t.spark, "blocks")
    rows.write.parquet(path)
    landed = t.spark.read.parquet(path)
    blocks = key_blocks(landed, "l_suppkey", 8, "l_orderkey")
    wanted = [("l_suppkey", ">", 3), ("l_quantity", "<", 24.0)]
    return read_blocks(t.spark, "weftmart_key_blocks", landed.schema, blocks, parquet_fetch(path, columns), wanted)


@query("w5_batched_sink", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def batched_sink(t: Tables):
    """A run, one that takes its place, one beside it, and one of a name that was published before."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    target = FolderTarget(scratch_path(t.spark, "batched"))
    write_batched(rows, target, "first")
    write_batched(rows.where("o_orderstatus = 'O'"), target, "open", replace=True)
    write_batched(rows.where("o_orderstatus <> 'O' OR o_orderstatus IS NULL"), target, "others")
    write_batched(rows, target, "others")
    return target.rows(t.spark, rows.schema)
