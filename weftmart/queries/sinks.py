"""Load modes of targets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from weftmart.functions.scalars import render_in_zone
from weftmart.operators.keys import with_source_hash
from weftmart.operators.sinks import (
    audit_deletes, deactivate_and_insert, delete_rows, full_sync, load, replace_by_key, save_bucketed, stamped, upsert, upsert_partitions,
)
from weftmart.operators.joins import deleted_rows
from weftmart.queries.registry import Tables, query
from weftmart.queries.snapshots import (
    FIRST_LOAD, SECOND_LOAD, customer_after, customer_before, orders_after, orders_before, with_snapshots,
)
from weftmart.session import scratch_path, write_table
from weftmart.streaming.incremental import merge_stream, merge_stream_partitions

_UPSERTED = with_snapshots(
    """SELECT * FROM orders_after UNION ALL
       SELECT * FROM orders_before WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_after)"""
)


@query("w1_upsert", _UPSERTED)
def upserted(t: Tables):
    path = scratch_path(t.spark, "orders")
    first = load(None, orders_before(t), ["o_orderkey"], f"{path}/v1", "upsert")
    return load(first, orders_after(t), ["o_orderkey"], f"{path}/v2", "upsert")


@query("w1_upsert_delta", _UPSERTED)
def upserted_delta(t: Tables):
    return upsert(orders_before(t), orders_after(t), ["o_orderkey"], strategy="delta")


@query(
    "w1_upsert_partitions",
    with_snapshots(
        """SELECT *, strftime(o_orderdate, '%Y') AS order_year FROM (
             SELECT * FROM orders_after UNION ALL
             SELECT * FROM orders_before WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_after)) x"""
    ),
)
def upserted_by_partition(t: Tables):
    """Only the years that the incoming rows touch are read and rewritten."""
    year = F.date_format("o_orderdate", "yyyy")
    path = scratch_path(t.spark, "orders-by-year")
    write_table(orders_before(t).withColumn("order_year", year), path, ["order_year"])
    incoming = orders_after(t).withColumn("order_year", year)
    return upsert_partitions(t.spark, path, incoming, ["o_orderkey"], "order_year")


_YEAR_OR_NONE = "CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y') END"


@query(
    "w1_upsert_partitions_nulls",
    with_snapshots(
        f"""SELECT *, {_YEAR_OR_NONE} AS order_year FROM (
             SELECT * FROM orders_after UNION ALL
             SELECT * FROM orders_before WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_after)) x"""
    ),
)
def upserted_null_partition(t: Tables):
    """Pending orders have no year; their folder is merged like the others."""
    year = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy"))
    path = scratch_path(t.spark, "orders-by-year")
    write_table(orders_before(t).withColumn("order_year", year), path, ["order_year"])
    return upsert_partitions(t.spark, path, orders_after(t).withColumn("order_year", year), ["o_orderkey"], "order_year")


@query(
    "w1_upsert_partitions_missing_columns",
    with_snapshots(
        """SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, a.o_orderpriority, coalesce(b.o_totalprice, a.o_totalprice) AS o_totalprice,
                  strftime(coalesce(b.o_orderdate, a.o_orderdate), '%Y') AS order_year,
                  CASE WHEN a.o_orderkey IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS Added_Date,
                  CASE WHEN b.o_orderkey IS NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS Updated_Date
           FROM orders_before a FULL JOIN orders_after b ON a.o_orderkey = b.o_orderkey"""
    ),
)
def upserted_partitions_with_less(t: Tables):
    """Incoming rows without a column leave it as it is; audit columns stay and follow the stamp."""
    year, path = F.date_format("o_orderdate", "yyyy"), scratch_path(t.spark, "orders-by-year")
    first = orders_before(t).select("o_orderkey", "o_orderpriority", "o_totalprice", year.alias("order_year"))
    write_table(stamped(first, FIRST_LOAD), path, ["order_year"])
    incoming = orders_after(t).select("o_orderkey", "o_totalprice", year.alias("order_year"))
    return upsert_partitions(t.spark, path, incoming, ["o_orderkey"], "order_year", stamp=SECOND_LOAD).drop("Added_User", "Updated_User")


@query(
    "w2_write_modes",
    with_snapshots(
        """SELECT 'overwrite' AS write_mode, c_custkey, c_acctbal FROM customer_after
           UNION ALL SELECT 'upsert', c_custkey, c_acctbal FROM customer_after
           UNION ALL SELECT 'upsert', c_custkey, c_acctbal FROM customer_before WHERE c_custkey NOT IN (SELECT c_custkey FROM customer_after)"""
    ),
)
def write_modes(t: Tables):
    path = scratch_path(t.spark, "modes")
    result = None
    for mode in ("overwrite", "upsert"):
        state = load(customer_before(t), customer_after(t), ["c_custkey"], f"{path}/{mode}", mode)
        part = state.select(F.lit(mode).alias("write_mode"), "c_custkey", "c_acctbal")
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "w3_audit_constants",
    with_snapshots(
        """SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, coalesce(a.c_acctbal, b.c_acctbal) AS c_acctbal,
                  CASE WHEN b.c_custkey IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS Added_Date, 'loader' AS Added_User,
                  CASE WHEN a.c_custkey IS NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS Updated_Date,
                  'loader' AS Updated_User
           FROM customer_before b FULL JOIN customer_after a ON a.c_custkey = b.c_custkey"""
    ),
)
def audited(t: Tables):
    columns = ["c_custkey", "c_acctbal"]
    first = stamped(customer_before(t).select(*columns), FIRST_LOAD)
    return upsert(first, customer_after(t).select(*columns), ["c_custkey"], SECOND_LOAD)


@query(
    "w4_skip_unchanged",
    with_snapshots(
        """SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, coalesce(a.c_acctbal, b.c_acctbal) AS c_acctbal,
                  CASE WHEN a.c_custkey IS NOT NULL AND (b.c_custkey IS NULL OR a.c_acctbal <> b.c_acctbal)
                       THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS Updated_Date
           FROM customer_before b FULL JOIN customer_after a ON a.c_custkey = b.c_custkey"""
    ),
)
def unchanged_skipped(t: Tables):
    first = stamped(with_source_hash(customer_before(t), t.customer.columns), FIRST_LOAD)
    incoming = with_source_hash(customer_after(t), t.customer.columns)
    state = upsert(first, incoming, ["c_custkey"], SECOND_LOAD, hash_column="Source_Hash_Value")
    return state.select("c_custkey", "c_acctbal", "Updated_Date")


@query(
    "w6_delete_by_flag",
    with_snapshots("SELECT * FROM customer_before WHERE c_custkey IN (SELECT c_custkey FROM customer_after)"),
)
def deleted(t: Tables):
    gone = deleted_rows(customer_before(t), customer_after(t), ["c_custkey"])
    return delete_rows(customer_before(t), gone, ["c_custkey"])


@query(
    "w7_delete_audit",
    with_snapshots(
        """SELECT *, TIMESTAMP '2024-02-01 05:30:00' AS Added_Date, 'loader' AS Added_User, TIMESTAMP '2024-02-01 05:30:00' AS Updated_Date, 'loader' AS Updated_User
           FROM customer_before WHERE c_custkey NOT IN (SELECT c_custkey FROM customer_after)"""
    ),
)
def delete_audit(t: Tables):
    gone = deleted_rows(customer_before(t), customer_after(t), ["c_custkey"])
    return audit_deletes(gone, SECOND_LOAD, "Asia/Kolkata")


@query(
    "w8_replace_by_key",
    """SELECT * FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
       UNION ALL SELECT c_custkey, upper(c_name), c_nationkey, c_acctbal, c_mktsegment FROM customer
         WHERE c_acctbal > 0 AND c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""",
)
def replaced_by_nation(t: Tables):
    """Reload whole nations: those with a rich supplier."""
    nations = t.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey"))
    reload = t.customer.where("c_acctbal > 0").join(nations, "c_nationkey", "left_semi").withColumn("c_name", F.upper("c_name"))
    return replace_by_key(t.customer, reload.select(*t.customer.columns), ["c_nationkey"])


@query(
    "w9_deactivate_and_insert",
    """SELECT p_partkey, p_retailprice, CASE WHEN p_brand = 'Brand#7' THEN 0 ELSE 1 END AS Active_flag FROM part
       UNION ALL SELECT p_partkey, p_retailprice + 100, 1 FROM part WHERE p_brand = 'Brand#7'""",
)
def price_versions(t: Tables):
    history = t.part.select("p_partkey", "p_retailprice", F.lit(1).alias("Active_flag"))
    renewed = t.part.where("p_brand = 'Brand#7'").select("p_partkey", (F.col("p_retailprice") + 100).alias("p_retailprice"))
    return deactivate_and_insert(history, renewed, ["p_partkey"])


@query(
    "w10_full_sync",
    with_snapshots(
        """SELECT a.*, CASE WHEN b.c_custkey IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS Added_Date,
                  TIMESTAMP '2024-02-01 00:00:00' AS Updated_Date
           FROM customer_after a LEFT JOIN customer_before b ON a.c_custkey = b.c_custkey"""
    ),
)
def synchronised(t: Tables):
    state = full_sync(stamped(customer_before(t), FIRST_LOAD), customer_after(t), ["c_custkey"], SECOND_LOAD)
    return state.drop("Added_User", "Updated_User")


@query("w11_zone_times", "SELECT event_id, ts + INTERVAL 330 MINUTE AS Added_Date FROM events")
def zone_times(t: Tables):
    return t.events.select("event_id", render_in_zone(F.col("ts"), "Asia/Kolkata").alias("Added_Date"))


@query(
    "x1_stream_merge",
    """SELECT user_id, event_id, ts AS Updated_Date, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
         WHERE ts > TIMESTAMP '2024-01-05 00:00:00') x WHERE rn = 1""",
)
def streamed(t: Tables):
    """Landed files merged into a table of the newest event per user."""
    from weftmart.sources.windows import changed_after

    path = scratch_path(t.spark, "stream")
    # land the events as several files
    t.events.withColumnRenamed("ts", "Updated_Date").drop("props").repartition(4, "event_id").write.parquet(f"{path}/landed")
    landed = t.spark.read.parquet(f"{path}/landed")
    return merge_stream(
        t.spark,
        f"{path}/landed",
        landed.schema,
        ["user_id"],
        ["Updated_Date", "event_id"],
        f"{path}/state",
        f"{path}/checkpoint",
        files_per_batch=2,
        prepare=lambda rows: changed_after(rows, dt.datetime(2024, 1, 5)),
    ).select("user_id", "event_id", "Updated_Date", "event_type", "value")


@query(
    "x1_stream_merge_partitions",
    """SELECT event_id, user_id, event_type, CASE WHEN event_type = 'purchase' THEN value + 1 ELSE value END AS value,
              CASE WHEN event_type = 'purchase' THEN ts + INTERVAL 1 DAY ELSE ts END AS Updated_Date, CAST(ts AS DATE) AS event_day FROM events""",
)
def streamed_by_day(t: Tables):
    """Events and their later corrections, merged day by day."""
    path = scratch_path(t.spark, "stream-by-day")
    columns = ["event_id", "user_id", "event_type", "value", F.col("ts").alias("Updated_Date"), F.col("ts").cast("date").alias("event_day")]
    events = t.events.select(*columns)
    later = F.col("Updated_Date") + F.make_dt_interval(F.lit(1))
    corrections = events.where("event_type = 'purchase'").withColumns({"value": F.col("value") + 1, "Updated_Date": later})
    corrections.unionByName(events).repartition(4, "event_type").write.parquet(f"{path}/landed")
    return merge_stream_partitions(
        t.spark, f"{path}/landed", events.schema, ["event_id"], ["Updated_Date"], "event_day", f"{path}/state", f"{path}/checkpoint", 1
    ).select("event_id", "user_id", "event_type", "value", "Updated_Date", "event_day")


@query("w1_upsert_bucketed", _UPSERTED)
def upserted_bucketed(t: Tables):
    """The target is stored bucketed by its key, so only the incoming rows are shuffled."""
    path = scratch_path(t.spark, "orders-bucketed")
    name = "orders_" + path.rsplit("-", 1)[-1]
    target = save_bucketed(orders_before(t), name, path, ["o_orderkey"], 8)
    return upsert(target, orders_after(t), ["o_orderkey"])
