"""Projection, constants, naming, unions, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftmart.operators.derive import derive
from weftmart.operators.keys import running_number
from weftmart.operators.project import (
    add_constants, clean_columns, drop_helpers_of, emit, map_columns, rename_derived, retain, select_columns, with_tenant,
)
from weftmart.operators.sets import first_rows, ordered, union_common, union_distinct, union_padded
from weftmart.queries.registry import Tables, doubles, query
from weftmart.spec import ColumnMap, Derived

_DERIVED = (
    Derived("net", "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))", 1, alias="net_price"),
    Derived("helper", "l_quantity * 2", 1),
    Derived("flagged", "helper > 50", 2, alias="is_large"),
)


@query(
    "p1_map_columns",
    """SELECT s_suppkey AS Supplier_Id, s_name AS Supplier_Name, '' AS Fax, '' AS Region,
              CAST(7 AS INTEGER) AS Batch FROM supplier""",
)
def mapped(t: Tables):
    return map_columns(
        t.supplier,
        [
            ColumnMap("Supplier_Id", "bigint", "s_suppkey"),
            ColumnMap("Supplier_Name", "varchar(50)", "s_name"),
            ColumnMap("Fax", "varchar(20)", None),
            ColumnMap("Region", "varchar(20)", "NULL"),
            ColumnMap("Batch", "int", constant=7, is_constant=True),
        ],
    )


@query(
    "p2_constants",
    """SELECT c_custkey, '_' AS underscore_field, c_name, 'crm' AS DataSource_Id, CAST(12 AS BIGINT) AS Company_Id,
              CAST('2024-01-01' AS DATE) AS loaded FROM customer""",
)
def constants(t: Tables):
    added = {
        "underscore_field": ("_", "varchar(1)"),
        "DataSource_Id": ("crm", "varchar(50)"),
        "Company_Id": (12, "bigint"),
        "loaded": ("2024-01-01", "date"),
    }
    return add_constants(t.customer.select("c_custkey", "c_name"), added, {"underscore_field": 1})


@query("p3_tenant", "SELECT 'acme' AS Company_Id, * FROM customer")
def tenant(t: Tables):
    return with_tenant(t.customer, "acme")


@query(
    "p4_drop_helpers",
    """SELECT l_orderkey, l_quantity, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net,
              l_quantity * 2 > 50 AS flagged FROM lineitem""",
)
def helpers_dropped(t: Tables):
    rows = derive(t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount"), _DERIVED)
    return doubles(drop_helpers_of(rows, _DERIVED).drop("l_extendedprice", "l_discount"), "net")


@query(
    "p5_rename_derived",
    """SELECT l_orderkey, l_partkey, l_quantity * 2 AS helper,
              CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net_price,
              l_quantity * 2 > 50 AS is_large FROM lineitem""",
)
def derived_renamed(t: Tables):
    rows = rename_derived(derive(t.lineitem, _DERIVED), _DERIVED)
    return doubles(rows.select("l_orderkey", "l_partkey", "helper", "net_price", "is_large"), "net_price")


@query("p6_retain", "SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders")
def retained(t: Tables):
    mapping, join_columns = t.orders.columns, ("o_custkey", "o_totalprice", "o_orderstatus")
    return retain(t.orders, [c for c in mapping if c not in join_columns])


@query("p7_emit", "SELECT c_custkey, c_name FROM customer")
def emitted(t: Tables):
    helpers = t.customer.select("c_custkey", "c_name").withColumns(
        {"underscore_field": F.lit("_"), "PKValue": F.col("c_custkey").cast("string"), "DeleteIndicator": F.lit(False)}
    )
    return emit(helpers)


@query(
    "p8_clean_names",
    """SELECT s_suppkey AS Supplier_Id, s_name AS Name_and_Title, s_nationkey AS NationKey, s_acctbal AS "Balance-EUR" FROM supplier""",
)
def names_cleaned(t: Tables):
    raw = t.supplier.toDF("Supplier Id", "Name & Title", "Nation(Key)", "Balance-EUR")
    return clean_columns(raw, [("&", "and"), ("(", ""), (")", ""), (" ", ""), ("-", "x")])


@query(
    "u1_union_padded",
    """SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nation, 'customer' AS kind, CAST(0 AS INTEGER) AS rating FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_nationkey, 'supplier', CAST(1 AS INTEGER) FROM supplier""",
)
def padded(t: Tables):
    customers = select_columns(t.customer, {"c_custkey": "party_id", "c_name": "name", "c_nationkey": "nation"})
    suppliers = select_columns(t.supplier, {"s_suppkey": "party_id", "s_name": "name", "s_nationkey": "nation"})
    return union_padded([(customers, {"kind": "customer", "rating": 0}), (suppliers, {"kind": "supplier", "rating": 1})])


@query(
    "u2_union_common",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
)
def common(t: Tables):
    customers = select_columns(t.customer, {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"})
    suppliers = select_columns(t.supplier, {"s_name": "name", "s_suppkey": "id", "s_acctbal": "balance", "s_nationkey": "nation"})
    return union_common([customers, suppliers])


@query("u3_union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation")
def distinct_union(t: Tables):
    return union_distinct(
        [
            select_columns(t.customer, {"c_nationkey": "nation"}),
            select_columns(t.supplier, {"s_nationkey": "nation"}),
            select_columns(t.nation, {"n_nationkey": "nation"}),
        ]
    )


@query("o1_ordered_source", "SELECT * FROM orders ORDER BY o_orderkey")
def ordered_source(t: Tables):
    return ordered(t.orders, ["o_orderkey"])


@query("o2_ordered_rows", "SELECT n_regionkey AS join_level, n_name FROM nation ORDER BY join_level, n_name")
def ordered_rows(t: Tables):
    return ordered(select_columns(t.nation, {"n_regionkey": "join_level", "n_name": "n_name"}), ["join_level", "n_name"])


@query(
    "o3_running_number",
    """SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS event_number FROM events""",
)
def numbered_events(t: Tables):
    return running_number(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], "event_number")


@query("f4_row_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def limited(t: Tables):
    return first_rows(t.orders.select("o_orderkey", "o_totalprice"), 100, ["o_totalprice", "o_orderkey"], ["o_totalprice"])


@query(
    "f4_row_limit_large",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem
       ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber LIMIT 40000""",
)
def row_limit_large(t: Tables):
    """A limit whose rows do not meet in one task; ties are broken by the other columns."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    return first_rows(lines, 40_000, ["l_extendedprice"], ["l_extendedprice"])
