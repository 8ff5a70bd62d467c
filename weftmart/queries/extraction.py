"""Filters and load windows."""

from __future__ import annotations

import datetime as dt
import itertools
import json

from pyspark.sql import functions as F

from weftmart.functions.scalars import literal
from weftmart.operators.aggregate import filter_group
from weftmart.plans.extract import extract, next_watermark, store_watermark, stored_watermark
from weftmart.queries.registry import Tables, query
from weftmart.queries.snapshots import customer_after
from weftmart.session import scratch_path
from weftmart.sources.windows import Period, changed_after, high_watermark, load_window, source_keys
from weftmart.spec import ColumnMap, FilterGroup, GroupColumn, LoadSettings, WarehouseSpec

REFERENCE = dt.datetime(1998, 7, 15, 12, 0)
WATERMARK = dt.datetime(2024, 1, 20)

ORDER_SPEC = WarehouseSpec(
    "Orders",
    "T",
    (
        ColumnMap("Order_Id", "bigint", "o_orderkey", "PK"),
        ColumnMap("Status", "varchar(1)", "o_orderstatus"),
        ColumnMap("Price", "double", "o_totalprice"),
        ColumnMap("Note", "varchar(20)", None),
    ),
)


def settings(**props) -> LoadSettings:
    """Settings as they are stored: a JSON text."""
    return LoadSettings.from_json(json.dumps({"dataloadproperties": props}))


@query("f1_row_filter", "SELECT l_orderkey, l_linenumber, l_discount, l_quantity FROM lineitem WHERE l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24")
def row_filter(t: Tables):
    rows = filter_group(t.lineitem, FilterGroup("l_discount between 0.05D and 0.07D and l_quantity < 24"))
    return rows.select("l_orderkey", "l_linenumber", "l_discount", "l_quantity")


@query(
    "f2_having",
    """SELECT o_custkey, count(o_orderkey) AS orders, max(o_totalprice) AS o_totalprice FROM orders
       GROUP BY o_custkey HAVING max(o_totalprice) > 300000 AND count(o_orderkey) >= 3""",
)
def having(t: Tables):
    step = FilterGroup(
        "max(o_totalprice) > 300000 and count(o_orderkey) >= 3",
        (GroupColumn("o_custkey"), GroupColumn("o_orderkey", "Count", "orders"), GroupColumn("o_totalprice", "Max")),
        "G",
    )
    return filter_group(t.orders, step)


@query("f3_trailing_months", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-15 12:00:00' - INTERVAL 6 MONTH")
def trailing(t: Tables):
    chosen = settings(conditional={"conditional_date_param": "o_orderdate", "trailing_months": 6})
    return load_window(t.orders, chosen, as_of=REFERENCE).select("o_orderkey", "o_orderdate")


@query(
    "f5_custom_filter",
    """SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-07-15 12:00:00' - INTERVAL 12 MONTH AND (o_orderstatus = 'F' OR o_totalprice > 400000)""",
)
def custom(t: Tables):
    chosen = settings(
        custom_filter="o_orderstatus = 'F' or o_totalprice > 400000",
        conditional={"conditional_date_param": "o_orderdate", "trailing_months": 12},
    )
    return load_window(t.orders, chosen, as_of=REFERENCE).select("o_orderkey", "o_orderdate", "o_orderstatus")


@query(
    "f6_historical_range",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '1996-12-31 00:00:00'""",
)
def historical_range(t: Tables):
    chosen = settings(historical={"historical_date_param": "o_orderdate"})
    period = Period(dt.datetime(1996, 1, 1), dt.datetime(1996, 12, 31))
    return load_window(t.orders, chosen, period=period).select("o_orderkey", "o_orderdate")


@query("f7_incremental_date", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'")
def incremental_date(t: Tables):
    chosen = settings(incremental={"incremental_refresh_column_type": "date", "incremental_refresh_column_name": "ts"})
    return load_window(t.events, chosen, WATERMARK).select("event_id", "ts")


@query(
    "f8_incremental_id",
    """SELECT event_id, event_type FROM events
       WHERE event_id >= (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00')""",
)
def incremental_id(t: Tables):
    chosen = settings(incremental={"incremental_refresh_column_type": "id", "incremental_refresh_column_name": "event_id"})
    loaded_before = t.events.where(F.col("ts") < literal(WATERMARK))
    return load_window(t.events, chosen, next_watermark(loaded_before, chosen)).select("event_id", "event_type")


@query(
    "f9_high_watermark",
    """SELECT 'date' AS kind, CAST(max(ts) AS VARCHAR) AS watermark FROM events
       UNION ALL SELECT 'id' AS kind, CAST(max(event_id) AS VARCHAR) FROM events""",
)
def watermarks(t: Tables):
    by_date = high_watermark(t.events, "ts", "date").select(F.lit("date").alias("kind"), F.col("Incremental_Date").cast("string").alias("watermark"))
    by_id = high_watermark(t.events, "event_id", "id").select(F.lit("id").alias("kind"), F.col("Incremental_Id").cast("string").alias("watermark"))
    return by_date.unionByName(by_id)


@query(
    "f9_stored_watermark",
    """SELECT event_id, ts, event_type FROM events
       WHERE ts >= (SELECT max(ts) FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-20 00:00:00')""",
)
def from_stored_watermark(t: Tables):
    """Two runs: the first stores where it ended, the next starts there."""
    chosen = settings(incremental={"incremental_refresh_column_type": "date", "incremental_refresh_column_name": "ts"})
    path = scratch_path(t.spark, "watermarks")
    earlier = t.events.where((F.col("event_type") == "signup") & (F.col("ts") < literal(WATERMARK)))
    store_watermark(earlier, chosen, "events", path)
    return load_window(t.events, chosen, stored_watermark(t.spark, "events", path)).select("event_id", "ts", "event_type")


_LADDER = list(itertools.product((False, True), repeat=3))


def _ladder_sql() -> str:
    parts = []
    for incremental, conditional, custom_filter in _LADDER:
        conditions = ["1 = 1"]
        if incremental:
            conditions.append("ts >= TIMESTAMP '2024-01-20 00:00:00'")
        elif conditional:
            conditions.append("ts >= TIMESTAMP '2024-03-10 00:00:00' - INTERVAL 2 MONTH")
        if custom_filter:
            conditions.append("event_type = 'click'")
        parts.append(
            f"SELECT '{int(incremental)}{int(conditional)}{int(custom_filter)}' AS combination, count(*) AS row_count, "
            f"min(event_id) AS first_id, max(ts) AS last_time FROM events WHERE {' AND '.join(conditions)}"
        )
    return " UNION ALL ".join(parts)


@query("f10_window_precedence", _ladder_sql())
def ladder(t: Tables):
    """All combinations of incremental, trailing months and custom filter."""
    result = None
    for incremental, conditional, custom_filter in _LADDER:
        props = {}
        if incremental:
            props["incremental"] = {"incremental_refresh_column_type": "date", "incremental_refresh_column_name": "ts"}
        if conditional:
            props["conditional"] = {"conditional_date_param": "ts", "trailing_months": 2}
        if custom_filter:
            props["custom_filter"] = "event_type = 'click'"
        rows = load_window(t.events, settings(**props), WATERMARK, dt.datetime(2024, 3, 10))
        name = F.lit(f"{int(incremental)}{int(conditional)}{int(custom_filter)}").alias("combination")
        counted = rows.agg(F.count("*").alias("row_count"), F.min("event_id").alias("first_id"), F.max("ts").alias("last_time"))
        counted = counted.select(name, "*")
        result = counted if result is None else result.unionByName(counted)
    return result


@query(
    "f11_changed_after",
    """SELECT 'next' AS run, event_id FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'
       UNION ALL SELECT 'first' AS run, event_id FROM events""",
)
def changed(t: Tables):
    rows = t.events.withColumnRenamed("ts", "Updated_Date")
    later = changed_after(rows, WATERMARK).select(F.lit("next").alias("run"), "event_id")
    return later.unionByName(changed_after(rows, None).select(F.lit("first").alias("run"), "event_id"))


@query("f12_source_keys", "SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal >= -500")
def keys_now(t: Tables):
    return source_keys(customer_after(t), ["c_custkey"])


@query(
    "y9_extract_window",
    """SELECT 'acme' AS Company_Id, o_orderkey AS Order_Id, o_orderstatus AS Status, o_totalprice AS Price, '' AS Note
       FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-15 12:00:00' - INTERVAL 18 MONTH AND o_orderpriority <> '5-LOW'""",
)
def extracted(t: Tables):
    chosen = settings(
        write_mode="upsert",
        custom_filter="o_orderpriority <> '5-LOW'",
        conditional={"conditional_date_param": "o_orderdate", "trailing_months": 18},
    )
    return extract(t.orders, ORDER_SPEC, chosen, "acme", as_of=REFERENCE)
