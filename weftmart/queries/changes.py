"""Targets as change sets, marts kept up to date by aggregate states, digests of key ranges, and versions valid at a time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from weftmart.operators.changesets import ChangeSets, Journal
from weftmart.operators.digests import changed_rows, deleted_keys_by_range, digest
from weftmart.operators.history import VALID_FROM, VALID_TO, intervals, track_history, valid_at
from weftmart.operators.sinks import upsert
from weftmart.plans.changes import ChangeRuns
from weftmart.plans.mart_changes import MartStates
from weftmart.queries import joins  # noqa: F401  its SQL serves here too
from weftmart.queries.extraction import settings
from weftmart.queries.registry import REGISTRY, Tables, doubles, query
from weftmart.queries.snapshots import FIRST_LOAD, SECOND_LOAD, THIRD_LOAD, customer_after, customer_before, orders_after, orders_alive, orders_before, with_snapshots
from weftmart.queries.sinks import _UPSERTED
from weftmart.queries.warehouse import CUSTOMER, ORDERS, _labelled, _mart_sources, _printable, mart_spec
from weftmart.session import materialise, scratch_path
from weftmart.spec import mart_from_json
from weftmart.streaming.keyed import merge_newest


def _journal(t: Tables) -> Journal:
    return Journal(t.spark, scratch_path(t.spark, "journal"))


@query("w1_change_sets", _UPSERTED)
def merged_changes(t: Tables):
    """Base, and the overlapping extract as a change set: only rows that differ are written."""
    table = ChangeSets(_journal(t), "orders", ("o_orderkey",))
    table.commit("1", lambda: orders_before(t))
    table.compact("base")
    table.merge("2", orders_after(t), lambda old, new: upsert(old, new, ["o_orderkey"]))
    return table.rows()


@query("w1_change_sets_compacted", _UPSERTED)
def compacted_changes(t: Tables):
    """Several sets, one with deletes that a later one brings back, written as a new base."""
    table = ChangeSets(_journal(t), "orders", ("o_orderkey",))
    table.commit("1", lambda: orders_before(t))
    table.merge("2", orders_after(t), lambda old, new: upsert(old, new, ["o_orderkey"]))
    again = table.rows().where("o_orderstatus = 'F'")
    table.remove("3", again)
    table.commit("4", lambda: t.orders.where("o_orderstatus = 'F'").join(table.journal.found("3", "orders").select("o_orderkey"), "o_orderkey", "left_semi"))
    return table.compact("base")


@query("y3_dimension_changes", REGISTRY["y3_dimension_run"].sql)
def customer_changes(t: Tables):
    """The two runs of the dimension as change sets, deletes included."""
    runs, chosen = ChangeRuns(_journal(t), CUSTOMER), settings(write_mode="upsert", delete_flag=True)
    runs.run("1", customer_before(t), chosen, FIRST_LOAD, zone="Asia/Kolkata")
    runs.run("2", customer_after(t), chosen, SECOND_LOAD, zone="Asia/Kolkata")
    parts = {"warehouse": runs.warehouse.rows(), "deletes": runs.deletes()}
    return doubles(_labelled(parts, ["Customer_Id", "Name", "Balance", "Customer_Key", "Updated_Date"]), "Balance")


@query("y2_dimension_staging_changes", REGISTRY["y2_dimension_staging"].sql)
def customer_staging_changes(t: Tables):
    runs, chosen = ChangeRuns(_journal(t), CUSTOMER), settings(write_mode="upsert")
    runs.run("1", customer_before(t), chosen, FIRST_LOAD)
    runs.run("2", customer_after(t), chosen, SECOND_LOAD)
    runs.compact("base")
    return doubles(runs.staging.rows(), "Balance")


@query("y6_transaction_changes", REGISTRY["y6_transaction_run"].sql)
def order_changes(t: Tables):
    """The two runs of the transaction table as change sets; the second starts at an earlier date."""
    window = {"incremental_refresh_column_type": "date", "incremental_refresh_column_name": "o_orderdate"}
    runs, chosen = ChangeRuns(_journal(t), ORDERS), settings(write_mode="upsert", incremental=window)
    rich = t.customer.where("c_acctbal >= 0")
    customers = {"Customer": rich.select(F.col("c_custkey").alias("Customer_Id"), (F.col("c_custkey") + 1).alias("Customer_Key"))}
    runs.run("1", orders_before(t), chosen, FIRST_LOAD, customers)
    repriced = orders_after(t).unionByName(orders_before(t).where("o_orderdate < timestamp_ntz'1999-07-01 00:00:00'"))
    runs.run("2", repriced, chosen, SECOND_LOAD, customers, since=dt.datetime(1999, 7, 1))
    return doubles(runs.warehouse.rows().select("Order_Id", "Status", "Price", "Customer_Key", "Updated_Date"), "Price")


@query("y8_transaction_delete_changes", REGISTRY["y8_transaction_deletes"].sql)
def order_delete_changes(t: Tables):
    """Orders that the source archived leave all tables by a run whose window is empty."""
    runs, chosen = ChangeRuns(_journal(t), ORDERS), settings(write_mode="upsert")
    customers = {"Customer": t.customer.select(F.col("c_custkey").alias("Customer_Id"), (F.col("c_custkey") + 1).alias("Customer_Key"))}
    runs.run("1", orders_before(t), chosen, FIRST_LOAD, customers)
    runs.run("2", orders_after(t), chosen, SECOND_LOAD, customers)
    runs.run("3", orders_alive(t), settings(write_mode="upsert", delete_flag=True), THIRD_LOAD, customers)
    columns = ["Order_Id", "DataSource_Id", "Company_Id"]
    parts = {"warehouse": runs.warehouse.rows(columns), "staging": runs.staging.rows(columns), "keys": runs.key_table.rows(columns), "audit": runs.deletes()}
    return _labelled(parts, columns)


def _mart_windows(t: Tables) -> MartStates:
    """An early build, then windows: corrected and withdrawn lines, late lines, renamed nations."""
    sources, states = _mart_sources(t), MartStates(_journal(t), mart_spec())
    old_name = F.when(F.col("n_nationkey") < 5, F.concat(F.lit("OLD "), "n_name")).otherwise(F.col("n_name"))
    earlier = {**sources, "nation": t.nation.withColumn("n_name", old_name)}
    lines = t.lineitem.where("l_orderkey % 3 <> 0")
    wrong = F.when(F.col("l_orderkey") % 5 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    twice = lines.where("l_linenumber = 3")
    first = lines.withColumn("l_quantity", wrong).unionByName(twice)
    states.apply("1", None, {**earlier, "lineitem": first})
    fixed = lines.where("l_orderkey % 5 = 0")
    before = fixed.withColumn("l_quantity", F.col("l_quantity") + 1).unionByName(twice)
    states.apply("2", {**earlier, "lineitem": before}, {**earlier, "lineitem": fixed})
    states.apply("3", None, {**earlier, "lineitem": t.lineitem.where("l_orderkey % 3 = 0")})
    renamed = t.customer.where("c_nationkey < 5").select("c_custkey")
    affected = t.orders.join(renamed, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")
    touched = t.lineitem.join(affected, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    states.apply("4", {**earlier, "lineitem": touched}, {**sources, "lineitem": touched})
    return states


@query("y1_mart_incremental", REGISTRY["y1_mart_build"].sql)
def mart_by_windows(t: Tables):
    return _printable(_mart_windows(t).mart())


_EVERY_AGGREGATE = """
SELECT o_orderpriority AS priority, count(o_totalprice) AS n, CAST(sum(price) AS DOUBLE) AS total, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date,
       count(DISTINCT o_custkey) AS buyers, round(var_samp(price), 3) AS spread, round(stddev_pop(price), 6) AS deviation, round(avg(o_custkey), 6) AS middle
FROM (SELECT *, CAST(o_totalprice AS DECIMAL(14,2)) AS price FROM orders_after) x GROUP BY 1
"""


@query("a1_aggregate_states", with_snapshots(_EVERY_AGGREGATE))
def aggregate_states(t: Tables):
    """Groups of all orders, from which orders are then taken until only those of the later extract remain."""
    spec = mart_from_json(_STATES_JSON)
    states = MartStates(_journal(t), spec)
    states.apply("1", None, {"orders": orders_before(t)})
    states.apply("2", {"orders": orders_before(t)}, {"orders": orders_after(t)})
    states.compact("base")
    mart = doubles(states.mart(), "total")
    return mart.withColumns({"spread": F.round("spread", 3), "deviation": F.round("deviation", 6), "middle": F.round("middle", 6)})


_STATES_JSON = """
{"name": "priorities",
 "tables": [{"name": "orders", "alias": "o", "role": "driving",
   "columns": {"o_orderpriority": "priority", "o_totalprice": "price", "o_orderdate": "ordered", "o_custkey": "buyer"}}],
 "types": {"price": "decimal(14,2)"},
 "derived_step": {"columns": [
   {"column": "priority"}, {"column": "price", "aggregate": "Count", "alias": "n"}, {"column": "price", "aggregate": "Sum", "alias": "total"},
   {"column": "ordered", "aggregate": "Min", "alias": "first_date"}, {"column": "ordered", "aggregate": "Max", "alias": "last_date"},
   {"column": "buyer", "aggregate": "Distinct_Count", "alias": "buyers"}, {"column": "price", "aggregate": "Var_Samp", "alias": "spread"},
   {"column": "price", "aggregate": "Stddev_Pop", "alias": "deviation"}, {"column": "buyer", "aggregate": "Avg", "alias": "middle"}]}}
"""


@query("j5_delete_detection_by_range", REGISTRY["j5_delete_detection"].sql)
def deletes_by_range(t: Tables):
    """The stored side keeps its digest; only keys in ranges that differ are shuffled."""
    stored = customer_before(t)
    kept = digest(stored, ["c_custkey"], [], scratch_path(t.spark, "digest"))
    gone = deleted_keys_by_range(stored, customer_after(t), ["c_custkey"], stored=kept)
    return stored.join(gone, "c_custkey", "left_semi").withColumn("DeleteIndicator", F.lit(True))


_CHANGED_ORDERS = """
SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
       CASE WHEN a.o_orderkey IS NULL THEN 'I' WHEN b.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS change,
       coalesce(b.o_totalprice, a.o_totalprice) AS o_totalprice, coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus
FROM (SELECT * FROM orders WHERE o_orderkey > 500) a
FULL JOIN (SELECT * REPLACE (CASE WHEN o_orderkey % 1000 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
           FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) - 900 FROM orders)) b
ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_totalprice <> b.o_totalprice
"""


@query("m1_changed_rows_by_range", _CHANGED_ORDERS)
def changes_by_range(t: Tables):
    """New, repriced and vanished orders, found in the ranges whose digests differ."""
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    price = F.when(F.col("o_orderkey") % 1000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    newest = orders.agg(F.max("o_orderkey") - 900).scalar()
    return changed_rows(orders.where(F.col("o_orderkey") <= newest).withColumn("o_totalprice", price), orders.where("o_orderkey > 500"), ["o_orderkey"])


_EARLY, _LATE = dt.datetime(1997, 1, 1), dt.datetime(1999, 7, 1)
_HISTORY = """
h AS (
  SELECT a.c_custkey, a.c_acctbal, a.c_mktsegment, TIMESTAMP '1997-01-01 00:00:00' AS valid_from,
         CASE WHEN b.c_custkey IS NULL OR a.c_acctbal <> b.c_acctbal THEN TIMESTAMP '1999-07-01 00:00:00' END AS valid_to
  FROM customer_before a LEFT JOIN customer_after b ON a.c_custkey = b.c_custkey
  UNION ALL
  SELECT b.c_custkey, b.c_acctbal, b.c_mktsegment, TIMESTAMP '1999-07-01 00:00:00', NULL
  FROM customer_after b LEFT JOIN customer_before a ON a.c_custkey = b.c_custkey
  WHERE a.c_custkey IS NULL OR a.c_acctbal <> b.c_acctbal)
"""


def _customer_history(t: Tables):
    columns = ["c_custkey", "c_acctbal", "c_mktsegment"]
    first = materialise(track_history(None, customer_before(t).select(*columns), ["c_custkey"], _EARLY), "history")
    return materialise(track_history(first, customer_after(t).select(*columns), ["c_custkey"], _LATE), "history")


@query(
    "w9_history",
    with_snapshots("SELECT c_custkey, c_acctbal, c_mktsegment, valid_from AS Valid_From, valid_to AS Valid_To, CAST(valid_to IS NULL AS INTEGER) AS Active_flag FROM h", _HISTORY.strip()),
)
def customer_history(t: Tables):
    return _customer_history(t)


@query(
    "j3_valid_at",
    with_snapshots(
        """SELECT o_orderkey, o_orderdate, o_custkey, h.c_acctbal AS balance, h.c_mktsegment AS segment
           FROM orders LEFT JOIN h ON o_custkey = h.c_custkey AND valid_from <= o_orderdate AND (valid_to IS NULL OR valid_to > o_orderdate)""",
        _HISTORY.strip(),
    ),
)
def orders_with_version(t: Tables):
    """Each order with the version of its customer that was valid when it was placed."""
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_custkey")
    fetch = {"c_acctbal": "balance", "c_mktsegment": "segment"}
    return valid_at(orders, _customer_history(t), {"o_custkey": "c_custkey"}, "o_orderdate", VALID_FROM, fetch, VALID_TO)


@query(
    "w9_intervals",
    """SELECT event_id, user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS Valid_To
       FROM (SELECT user_id, ts, min(event_id) AS event_id FROM events GROUP BY user_id, ts) x""",
)
def event_intervals(t: Tables):
    """From each event of a user to the next one."""
    once = t.events.groupBy("user_id", "ts").agg(F.min("event_id").alias("event_id"))
    return intervals(once, ["user_id"], "ts")


@query(
    "x1_keyed_stream",
    """SELECT user_id, event_id, ts, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1""",
)
def newest_events(t: Tables):
    """The newest event per user, kept in the state store over batches, in two sittings; half of the rows come twice."""
    path = scratch_path(t.spark, "keyed-stream")
    events = t.events.drop("props")
    table = ChangeSets(_journal(t), "newest", ("user_id",))
    events.where("event_id % 3 <> 0").repartition(3, "event_id").write.parquet(f"{path}/landed")
    merge_newest(t.spark, f"{path}/landed", events.schema, table, ["ts", "event_id"], f"{path}/checkpoint", files_per_batch=2)
    events.where("event_id % 2 = 0 OR event_id % 3 = 0").repartition(2, "event_id").write.mode("append").parquet(f"{path}/landed")
    merge_newest(t.spark, f"{path}/landed", events.schema, table, ["ts", "event_id"], f"{path}/checkpoint", files_per_batch=2)
    return table.rows().select("user_id", "event_id", "ts", "event_type", "value")
