"""The complete builds: a mart, and the loads of a dimension and a transaction table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from weftmart.operators.conform import tag_incremental, with_system_columns
from weftmart.plans.evolve import evolve_target
from weftmart.plans.jobs import TableState, open_state, run_table
from weftmart.plans.mart import build_mart, load_mart
from weftmart.plans.warehouse import (
    dimension_staging, dimension_warehouse, propagate_deletes, transaction_keys, transaction_staging, transaction_warehouse,
)
from weftmart.queries.extraction import settings
from weftmart.queries.registry import Tables, doubles, query
from weftmart.queries.snapshots import (
    FIRST_LOAD, SECOND_LOAD, THIRD_LOAD, customer_after, customer_before, orders_after, orders_alive, orders_before, with_snapshots,
)
from weftmart.session import scratch_path, write_table
from weftmart.spec import ColumnMap, MartSpec, WarehouseSpec, cleansing_from_control, mart_from_control, mart_from_json

MART_JSON = """
{
  "name": "nation_revenue",
  "tables": [
    {"name": "lineitem", "alias": "l", "role": "driving",
     "columns": {"l_orderkey": "l_orderkey", "l_extendedprice": "l_extendedprice", "l_discount": "l_discount", "l_quantity": "l_quantity"},
     "step": {"condition": "l_shipdate >= timestamp_ntz'1996-01-01 00:00:00'"}},
    {"name": "orders", "alias": "o", "columns": {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey"},
     "step": {"condition": "o_orderstatus <> 'P'"}},
    {"name": "customer", "alias": "c", "columns": {"c_custkey": "c_custkey", "c_nationkey": "c_nationkey"}},
    {"name": "nation", "alias": "n", "columns": {"n_nationkey": "n_nationkey", "n_name": "n_name"}}
  ],
  "joins": [
    {"level": 1, "left": "l", "right": "o", "pairs": [["l_orderkey", "o_orderkey"]]},
    {"level": 2, "left": "o", "right": "c", "pairs": [["o_custkey", "c_custkey"]]},
    {"level": 3, "left": "c", "right": "n", "pairs": [["c_nationkey", "n_nationkey"]]}
  ],
  "types": {"l_extendedprice": "decimal(12,2)", "l_discount": "decimal(4,2)", "l_quantity": "int", "n_name": "varchar(25)"},
  "keys": ["nation", "revenue_band"],
  "cleansing": {"varchar": "unknown"},
  "derived": [
    {"name": "revenue", "level": 1, "expression": "l_extendedprice * (1 - l_discount)"},
    {"name": "band", "level": 2, "alias": "revenue_band",
     "expression": "case when revenue > 50000 then 'high' when revenue > 20000 then 'middle' else 'low' end"},
    {"name": "nation", "level": 1, "alias": "nation", "expression": "n_name"}
  ],
  "derived_step": {
    "flow": "G", "condition": "count(l_quantity) >= 5",
    "columns": [
      {"column": "nation"}, {"column": "band"},
      {"column": "revenue", "aggregate": "Sum", "alias": "total_revenue"},
      {"column": "l_quantity", "aggregate": "Sum", "alias": "quantity"},
      {"column": "o_custkey", "aggregate": "Distinct_Count", "alias": "buyers"},
      {"column": "l_quantity", "aggregate": "Stddev_Samp", "alias": "quantity_spread"}
    ]},
  "retain": ["nation", "revenue_band", "total_revenue", "quantity", "buyers", "quantity_spread"]
}
"""


def mart_spec() -> MartSpec:
    return mart_from_json(MART_JSON)


def _mart_sources(t: Tables) -> dict[str, DataFrame]:
    return {name: getattr(t, name) for name in ("lineitem", "orders", "customer", "nation")}


def _printable(mart: DataFrame) -> DataFrame:
    return doubles(mart, "total_revenue").withColumn("quantity_spread", F.round("quantity_spread", 6))


_MART_SQL = """
SELECT coalesce(n_name, 'unknown') AS nation,
       CASE WHEN revenue > 50000 THEN 'high' WHEN revenue > 20000 THEN 'middle' ELSE 'low' END AS revenue_band,
       CAST(sum(revenue) AS DOUBLE) AS total_revenue, CAST(sum(qty) AS BIGINT) AS quantity, count(DISTINCT o_custkey) AS buyers,
       round(stddev_samp(qty), 6) AS quantity_spread
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS revenue, CAST(l_quantity AS INTEGER) AS qty
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00') l
LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2 HAVING count(qty) >= 5
"""


@query("y1_mart_build", _MART_SQL)
def mart(t: Tables):
    return _printable(build_mart(mart_spec(), _mart_sources(t)))


_OLD_NATIONS = "(SELECT n_nationkey, CASE WHEN n_nationkey < 5 THEN 'OLD ' || n_name ELSE n_name END AS n_name FROM nation) nation"


@query(
    "y1_mart_load",
    f"""WITH now AS ({_MART_SQL}), before AS ({_MART_SQL.replace("LEFT JOIN nation ON", f"LEFT JOIN {_OLD_NATIONS} ON")})
        SELECT * FROM now UNION ALL SELECT * FROM before b
        WHERE NOT EXISTS (SELECT 1 FROM now n WHERE n.nation = b.nation AND n.revenue_band = b.revenue_band)""",
)
def mart_loaded(t: Tables):
    """Built when some nations had another name, then upserted with today's build: groups it lacks stay."""
    path, spec, sources = scratch_path(t.spark, "mart"), mart_spec(), _mart_sources(t)
    old_name = F.when(F.col("n_nationkey") < 5, F.concat(F.lit("OLD "), "n_name")).otherwise(F.col("n_name"))
    first = load_mart(spec, {**sources, "nation": t.nation.withColumn("n_name", old_name)}, None, f"{path}/v1", "overwrite")
    return _printable(load_mart(spec, sources, first.select(*spec.retain), f"{path}/v2", "upsert"))


_COLUMN_SCHEMA = "Table_Name string, Table_Name_Alias string, Column_Name string, Column_Name_Alias string, Data_Type string"
_CONTROL = {
    "mart_driving_column": (
        _COLUMN_SCHEMA,
        [
            ("orders", "o", "o_custkey", "buyer", "bigint"),
            ("orders", "o", "o_totalprice", "price", "decimal(14,2)"),
            ("orders", "o", "o_orderkey", "order_id", "bigint"),
        ],
    ),
    "mart_lookup_column": (
        _COLUMN_SCHEMA,
        [
            ("customer", "c", "c_custkey", "customer_id", "bigint"),
            ("customer", "c", "c_mktsegment", "segment ", "varchar(20)"),
            ("customer", "c", "c_nationkey", "home", "int"),
            ("nation", "n", "n_nationkey", "nation_id", "int"),
            ("nation", "n", "n_name", "nation", "varchar(25)"),
        ],
    ),
    "mart_join": (
        "Table_Name_Alias string, Column_Name_Alias string, Join_Table_Alias string, Join_Column_Alias string, Join_Level int",
        [("c", "home", "n", "nation_id", 2), ("o", "buyer", "c", "customer_id", 1)],
    ),
    "mart_filter_group": (
        "Table_Name_Alias string, Settings_Position string, Group_By_Id int, Filter_Id int, Flow string",
        [("o", "Driving_Table", 0, 1, None), (None, "Derived_Columns", 7, 2, "G")],
    ),
    "mart_group_column": (
        "Group_By_Id int, Column_Name string, Column_Name_Alias string, Aggregation string, Flag int",
        [(7, "segment", "segment", "GroupBy", 0), (7, "nation", "nation", "GroupBy", 0), (7, "price", "price", "Sum", 1), (7, "size", "size", "Max", 1)],
    ),
    "mart_filter": ("Filter_Id int, Filter_Condition string", [(1, "o_orderstatus <> 'P'"), (2, "count(order_id) > 3")]),
    "mart_derived": (
        "Column_Name string, Column_Expression string, Level int, Expression_Type string, Column_Alias_Name string, Column_Arguments string, Data_Type string",
        [("size", "length(segment)", 1, "JAVA", "segment_length", "segment", "int")],
    ),
    "mart_mapping": (
        "DL_Column_Names string, Constraints string, DL_Data_Types string",
        [("segment", "PK", "varchar(20)"), ("nation", "PK", "varchar(25)"), ("price", None, "decimal(14,2)"), ("segment_length", None, "int"), ("customer_id", None, "bigint")],
    ),
}


# a second mart's rows in the same control tables
_OTHER_MART = {
    "mart_driving_column": ("orders", "o", "o_orderdate", "ordered", "datetime"),
    "mart_lookup_column": ("region", "r", "r_name", "region", "varchar(9)"),
    "mart_join": ("o", "ordered", "r", "region", 1),
    "mart_filter_group": ("c", "Lookup_Table", 7, 2, "F"),
    "mart_derived": ("ordered", "year(ordered)", 1, "SQL", "ordered_in", "ordered", "int"),
    "mart_mapping": ("region", "PK", "varchar(9)"),
}


@query(
    "y1_mart_from_control_tables",
    """SELECT c_mktsegment AS segment, n_name AS nation, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS price,
              CAST(length(c_mktsegment) AS INTEGER) AS segment_length
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
       WHERE o_orderstatus <> 'P' GROUP BY 1, 2 HAVING count(o_orderkey) > 3""",
)
def mart_from_tables(t: Tables):
    """The specification comes from control tables that hold another mart too; the rows from the data."""
    control = {}
    for name, (schema, rows) in _CONTROL.items():
        if name in _OTHER_MART:
            schema += ", DL_Id string, Job_Id string"
            rows = [(*r, "1", "7") for r in rows] + [(*_OTHER_MART[name], "2", "7")]
        control[name] = t.spark.createDataFrame(rows, schema)
    spec = mart_from_control("segment_revenue", control, mart_id=1, job_id=7)
    return doubles(build_mart(spec, {name: getattr(t, name) for name in ("orders", "customer", "nation")}), "price")


CUSTOMER = with_system_columns(
    WarehouseSpec(
        "Customer",
        "D",
        (
            ColumnMap("Customer_Id", "bigint", "c_custkey", "PK"),
            ColumnMap("Name", "varchar(50)", "c_name"),
            ColumnMap("Nation", "int", "c_nationkey"),
            ColumnMap("Balance", "decimal(12,2)", "c_acctbal"),
            ColumnMap("Segment", "varchar(20)", "c_mktsegment"),
        ),
    ),
    "crm",
    "acme",
)

_ORDERS = with_system_columns(
    tag_incremental(
        WarehouseSpec(
            "Orders",
            "T",
            (
                ColumnMap("Order_Id", "bigint", "o_orderkey", "PK"),
                ColumnMap("Buyer", "bigint", "o_custkey"),
                ColumnMap("Status", "char(1)", "o_orderstatus"),
                ColumnMap("Price", "decimal(14,2)", "o_totalprice"),
                ColumnMap("Ordered", "datetime", "o_orderdate"),
            ),
        )
    ),
    "shop",
    "acme",
)
ORDERS = WarehouseSpec(
    _ORDERS.name,
    _ORDERS.kind,
    tuple(c for c in _ORDERS.columns if c.tag != "SK")
    + (ColumnMap("Customer_Key", "bigint", tag="FK", dimension="Customer", dimension_key="Customer_Key", join=(("Buyer", "Customer_Id"),)),),
)

# SQL of the staged rows and their checksums
_CUSTOMER_HASH = (
    "md5(concat_ws(chr(1), CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), "
    "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR), c_mktsegment, 'crm', 'acme'))"
)
_ORDER_HASH = (
    "md5(concat_ws(chr(1), CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR), "
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f')))"
)
_STAGED = f"""
s1 AS (SELECT *, {_CUSTOMER_HASH} AS h FROM customer_before),
s2 AS (SELECT *, {_CUSTOMER_HASH} AS h FROM customer_after),
staged AS (
  SELECT coalesce(b.c_custkey, a.c_custkey) AS Customer_Id, coalesce(b.c_name, a.c_name) AS Name, coalesce(b.c_nationkey, a.c_nationkey) AS Nation,
         CAST(CAST(coalesce(b.c_acctbal, a.c_acctbal) AS DECIMAL(12,2)) AS DOUBLE) AS Balance, coalesce(b.c_mktsegment, a.c_mktsegment) AS Segment,
         'crm' AS DataSource_Id, 'acme' AS Company_Id, coalesce(b.h, a.h) AS Source_Hash_Value,
         CASE WHEN a.c_custkey IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS Added_Date, 'loader' AS Added_User,
         CASE WHEN b.c_custkey IS NULL OR a.h = b.h THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS Updated_Date,
         'loader' AS Updated_User
  FROM s1 a FULL JOIN s2 b ON a.c_custkey = b.c_custkey),
numbered AS (
  SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS Customer_Key FROM customer_before
  UNION ALL
  SELECT c_custkey, (SELECT count(*) FROM customer_before) + row_number() OVER (ORDER BY c_custkey) FROM customer_after
  WHERE c_custkey NOT IN (SELECT c_custkey FROM customer_before))
"""


@dataclass
class DimensionLoads:
    """Both loads of the customer dimension, written step by step."""

    staging: DataFrame
    warehouse: DataFrame


def load_customers(t: Tables, path: str) -> DimensionLoads:
    staging = write_table(dimension_staging(customer_before(t), CUSTOMER, None, FIRST_LOAD), f"{path}/staging-1")
    warehouse = write_table(dimension_warehouse(staging, CUSTOMER, None, FIRST_LOAD), f"{path}/warehouse-1")
    staging = write_table(dimension_staging(customer_after(t), CUSTOMER, staging, SECOND_LOAD), f"{path}/staging-2")
    changed = dimension_warehouse(staging, CUSTOMER, warehouse, SECOND_LOAD, start=SECOND_LOAD[0])
    return DimensionLoads(staging, write_table(changed, f"{path}/warehouse-2"))


@query("y2_dimension_staging", with_snapshots("SELECT * FROM staged", _STAGED.strip()))
def customer_staging(t: Tables):
    path = scratch_path(t.spark, "dimension")
    first = write_table(dimension_staging(customer_before(t), CUSTOMER, None, FIRST_LOAD), f"{path}/staging-1")
    return doubles(dimension_staging(customer_after(t), CUSTOMER, first, SECOND_LOAD), "Balance")


@query(
    "y3_dimension_warehouse",
    with_snapshots(
        "SELECT s.*, Customer_Key, CAST(NULL AS INTEGER) AS Mismatch_Flag FROM staged s JOIN numbered ON Customer_Id = c_custkey", _STAGED.strip()
    ),
)
def customer_warehouse(t: Tables):
    loads = load_customers(t, scratch_path(t.spark, "dimension"))
    return doubles(loads.warehouse, "Balance").withColumn("Mismatch_Flag", F.col("Mismatch_Flag").cast("int"))


@query(
    "y4_transaction_staging",
    with_snapshots(
        """SELECT coalesce(b.o_orderkey, a.o_orderkey) AS Order_Id, coalesce(b.o_custkey, a.o_custkey) AS Buyer, coalesce(b.o_orderstatus, a.o_orderstatus) AS Status,
                  CAST(CAST(coalesce(b.o_totalprice, a.o_totalprice) AS DECIMAL(14,2)) AS DOUBLE) AS Price, coalesce(b.o_orderdate, a.o_orderdate) AS Ordered,
                  'shop' AS DataSource_Id, 'acme' AS Company_Id,
                  CASE WHEN a.o_orderkey IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS Added_Date, 'loader' AS Added_User,
                  CASE WHEN b.o_orderkey IS NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS Updated_Date, 'loader' AS Updated_User
           FROM orders_before a FULL JOIN orders_after b ON a.o_orderkey = b.o_orderkey"""
    ),
)
def order_staging(t: Tables):
    first = write_table(transaction_staging(orders_before(t), ORDERS, None, FIRST_LOAD), scratch_path(t.spark, "orders-staging"))
    return doubles(transaction_staging(orders_after(t), ORDERS, first, SECOND_LOAD), "Price")


@dataclass
class TransactionLoads:
    staging: DataFrame
    key_table: DataFrame


def load_orders(t: Tables, path: str) -> TransactionLoads:
    staging = write_table(transaction_staging(orders_before(t), ORDERS, None, FIRST_LOAD), f"{path}/staging-1")
    key_table = write_table(transaction_keys(staging, ORDERS, None, FIRST_LOAD), f"{path}/keys-1")
    staging = write_table(transaction_staging(orders_after(t), ORDERS, staging, SECOND_LOAD), f"{path}/staging-2")
    key_table = transaction_keys(staging, ORDERS, key_table, SECOND_LOAD, start=SECOND_LOAD[0])
    return TransactionLoads(staging, write_table(key_table, f"{path}/keys-2"))


_KEYED = f"""
k1 AS (SELECT *, {_ORDER_HASH} AS h FROM orders_before),
k2 AS (SELECT *, {_ORDER_HASH} AS h FROM orders_after),
keyed AS (
  SELECT coalesce(b.o_orderkey, a.o_orderkey) AS Order_Id, 'shop' AS DataSource_Id, 'acme' AS Company_Id,
         CAST(coalesce(b.o_orderkey, a.o_orderkey) AS VARCHAR) || '_shop_acme' AS PKValue, coalesce(b.h, a.h) AS HashValue,
         CASE WHEN a.o_orderkey IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS Added_Date, 'loader' AS Added_User,
         CASE WHEN b.o_orderkey IS NULL OR a.h = b.h THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS Updated_Date,
         'loader' AS Updated_User
  FROM k1 a FULL JOIN k2 b ON a.o_orderkey = b.o_orderkey)
"""


@query("y5_transaction_keys", with_snapshots("SELECT * FROM keyed", _KEYED.strip()))
def order_keys(t: Tables):
    return load_orders(t, scratch_path(t.spark, "orders")).key_table


@query(
    "y6_transaction_warehouse",
    with_snapshots(
        """SELECT k.Order_Id, coalesce(b.o_custkey, a.o_custkey) AS Buyer, coalesce(b.o_orderstatus, a.o_orderstatus) AS Status,
                  CAST(CAST(coalesce(b.o_totalprice, a.o_totalprice) AS DECIMAL(14,2)) AS DOUBLE) AS Price, coalesce(b.o_orderdate, a.o_orderdate) AS Ordered,
                  k.DataSource_Id, k.Company_Id, coalesce(n.Customer_Key, 0) AS Customer_Key, k.HashValue AS Source_Hash_Value,
                  CAST(NULL AS INTEGER) AS Mismatch_Flag, k.Added_Date, k.Added_User, k.Updated_Date, k.Updated_User
           FROM keyed k LEFT JOIN orders_before a ON k.Order_Id = a.o_orderkey LEFT JOIN orders_after b ON k.Order_Id = b.o_orderkey
           LEFT JOIN numbered n ON n.c_custkey = coalesce(b.o_custkey, a.o_custkey)""",
        _STAGED.strip(),
        _KEYED.strip(),
    ),
)
def order_warehouse(t: Tables):
    """First load of the earlier orders, then the changed ones; an unknown customer gets key 0."""
    path = scratch_path(t.spark, "fact")
    customers = {"Customer": load_customers(t, f"{path}/customer").warehouse}
    staging = write_table(transaction_staging(orders_before(t), ORDERS, None, FIRST_LOAD), f"{path}/staging-1")
    key_table = write_table(transaction_keys(staging, ORDERS, None, FIRST_LOAD), f"{path}/keys-1")
    first = write_table(transaction_warehouse(staging, ORDERS, key_table, customers, None, FIRST_LOAD), f"{path}/warehouse-1")
    staging = write_table(transaction_staging(orders_after(t), ORDERS, staging, SECOND_LOAD), f"{path}/staging-2")
    key_table = write_table(transaction_keys(staging, ORDERS, key_table, SECOND_LOAD, start=SECOND_LOAD[0]), f"{path}/keys-2")
    state = transaction_warehouse(staging, ORDERS, key_table, customers, first, SECOND_LOAD, watermark=FIRST_LOAD[0], salt=4)
    return doubles(state, "Price").withColumn("Mismatch_Flag", F.col("Mismatch_Flag").cast("int"))


@query(
    "y7_dimension_deletes",
    with_snapshots(
        """SELECT t.table_name, Customer_Id, Name, Segment FROM staged
           JOIN (VALUES ('warehouse'), ('staging')) t(table_name) ON TRUE
           WHERE Customer_Id IN (SELECT c_custkey FROM customer_after)
           UNION ALL SELECT 'audit', Customer_Id, Name, Segment FROM staged WHERE Customer_Id NOT IN (SELECT c_custkey FROM customer_after)""",
        _STAGED.strip(),
    ),
)
def customer_deletes(t: Tables):
    loads = load_customers(t, scratch_path(t.spark, "dimension"))
    live = customer_after(t).select(F.col("c_custkey").alias("Customer_Id"), F.lit("crm").alias("DataSource_Id"), F.lit("acme").alias("Company_Id"))
    state = propagate_deletes(live, CUSTOMER, loads.warehouse, loads.staging, SECOND_LOAD, "Asia/Kolkata")
    parts = {"warehouse": state.warehouse, "staging": state.staging, "audit": state.audit}
    return _labelled(parts, ["Customer_Id", "Name", "Segment"])


@query(
    "y8_transaction_deletes",
    with_snapshots(
        """SELECT t.table_name, Order_Id, DataSource_Id, Company_Id FROM keyed
           JOIN (VALUES ('warehouse'), ('staging'), ('keys')) t(table_name) ON TRUE
           WHERE Order_Id IN (SELECT o_orderkey FROM orders_alive)
           UNION ALL SELECT 'audit', Order_Id, DataSource_Id, Company_Id FROM keyed WHERE Order_Id NOT IN (SELECT o_orderkey FROM orders_alive)""",
        _KEYED.strip(),
    ),
)
def order_deletes(t: Tables):
    path = scratch_path(t.spark, "fact")
    loads = load_orders(t, path)
    customers = {"Customer": t.customer.select(F.col("c_custkey").alias("Customer_Id"), (F.col("c_custkey") + 1).alias("Customer_Key"))}
    warehouse = write_table(transaction_warehouse(loads.staging, ORDERS, loads.key_table, customers, None, FIRST_LOAD), f"{path}/warehouse-1")
    live = orders_alive(t).select(F.col("o_orderkey").alias("Order_Id"), F.lit("shop").alias("DataSource_Id"), F.lit("acme").alias("Company_Id"))
    state = propagate_deletes(live, ORDERS, warehouse, loads.staging, SECOND_LOAD, key_table=loads.key_table)
    parts = {"warehouse": state.warehouse, "staging": state.staging, "keys": state.key_table, "audit": state.audit}
    return _labelled(parts, ["Order_Id", "DataSource_Id", "Company_Id"])


@query(
    "y3_dimension_run",
    with_snapshots(
        """SELECT 'warehouse' AS table_name, Customer_Id, Name, Balance, Customer_Key, Updated_Date FROM staged JOIN numbered ON Customer_Id = c_custkey
           WHERE Customer_Id IN (SELECT c_custkey FROM customer_after)
           UNION ALL SELECT 'deletes', Customer_Id, Name, Balance, Customer_Key, TIMESTAMP '2024-02-01 05:30:00' FROM staged JOIN numbered ON Customer_Id = c_custkey
           WHERE Customer_Id NOT IN (SELECT c_custkey FROM customer_after)""",
        _STAGED.strip(),
    ),
)
def customer_runs(t: Tables):
    """Two runs of the dimension under its settings: all tables, then changes and deletes."""
    path, chosen = scratch_path(t.spark, "runs"), settings(write_mode="upsert", delete_flag=True)
    state = run_table(customer_before(t), CUSTOMER, chosen, TableState(), FIRST_LOAD, f"{path}/1", zone="Asia/Kolkata")
    state = run_table(customer_after(t), CUSTOMER, chosen, state, SECOND_LOAD, f"{path}/2", zone="Asia/Kolkata")
    parts = {"warehouse": state.warehouse, "deletes": state.deletes}
    return doubles(_labelled(parts, ["Customer_Id", "Name", "Balance", "Customer_Key", "Updated_Date"]), "Balance")


@query(
    "y6_transaction_run",
    with_snapshots(
        """SELECT coalesce(b.o_orderkey, a.o_orderkey) AS Order_Id, coalesce(b.o_orderstatus, a.o_orderstatus) AS Status,
                  CAST(CAST(coalesce(b.o_totalprice, a.o_totalprice) AS DECIMAL(14,2)) AS DOUBLE) AS Price,
                  coalesce(c_custkey + 1, 0) AS Customer_Key, k.Updated_Date
           FROM orders_before a FULL JOIN orders_after b ON a.o_orderkey = b.o_orderkey
           JOIN keyed k ON k.Order_Id = coalesce(b.o_orderkey, a.o_orderkey)
           LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON c_custkey = coalesce(b.o_custkey, a.o_custkey)""",
        _KEYED.strip(),
    ),
)
def order_runs(t: Tables):
    """Two runs of the transaction table; the second starts at an incremental date."""
    path = scratch_path(t.spark, "runs")
    window = {"incremental_refresh_column_type": "date", "incremental_refresh_column_name": "o_orderdate"}
    chosen = settings(write_mode="upsert", incremental=window)
    rich = t.customer.where("c_acctbal >= 0")
    customers = {"Customer": rich.select(F.col("c_custkey").alias("Customer_Id"), (F.col("c_custkey") + 1).alias("Customer_Key"))}
    state = run_table(orders_before(t), ORDERS, chosen, TableState(), FIRST_LOAD, f"{path}/1", customers)
    # the source was repriced back to half a year before the watermark
    state = replace(state, watermark=dt.datetime(1999, 7, 1))
    repriced = orders_after(t).unionByName(orders_before(t).where("o_orderdate < timestamp_ntz'1999-07-01 00:00:00'"))
    state = run_table(repriced, ORDERS, chosen, state, SECOND_LOAD, f"{path}/2", customers)
    return doubles(state.warehouse.select("Order_Id", "Status", "Price", "Customer_Key", "Updated_Date"), "Price")


WIDER_CUSTOMER = replace(
    CUSTOMER,
    columns=tuple(replace(c, type="decimal(16,4)") if c.target == "Balance" else c for c in CUSTOMER.columns if c.target != "Nation")
    + (ColumnMap("Phone", "varchar(20)", "c_phone"),),
)


@query(
    "m2_evolve_all_tables",
    with_snapshots(
        """SELECT 'warehouse' AS table_name, Customer_Id, Name, Balance, Segment, CAST(NULL AS VARCHAR) AS Phone, Updated_Date FROM staged
             WHERE Customer_Id IN (SELECT c_custkey FROM customer_after)
           UNION ALL SELECT 'staging', Customer_Id, Name, Balance, Segment, NULL, Updated_Date FROM staged WHERE Customer_Id IN (SELECT c_custkey FROM customer_after)
           UNION ALL SELECT 'deletes', Customer_Id, Name, Balance, Segment, NULL, TIMESTAMP '2024-02-01 00:00:00' FROM staged
             WHERE Customer_Id NOT IN (SELECT c_custkey FROM customer_after)""",
        _STAGED.strip(),
    ),
)
def customer_evolved(t: Tables):
    """After two runs a column goes, one gets wider and one is new, in all tables of the target."""
    path, chosen = scratch_path(t.spark, "evolve"), settings(write_mode="upsert", delete_flag=True)
    state = run_table(customer_before(t), CUSTOMER, chosen, TableState(), FIRST_LOAD, f"{path}/1")
    state = run_table(customer_after(t), CUSTOMER, chosen, state, SECOND_LOAD, f"{path}/2")
    state = evolve_target(CUSTOMER, WIDER_CUSTOMER, state, f"{path}/3")
    parts = {"warehouse": state.warehouse, "staging": state.staging, "deletes": state.deletes}
    return doubles(_labelled(parts, ["Customer_Id", "Name", "Balance", "Segment", "Phone", "Updated_Date"]), "Balance")


def _labelled(parts: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    result = None
    for name, rows in parts.items():
        part = rows.select(F.lit(name).alias("table_name"), *columns)
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "y3_overwrite_keeps_keys",
    with_snapshots(
        """SELECT 'warehouse' AS table_name, n.c_custkey AS Customer_Id, Customer_Key FROM numbered n JOIN customer_after a ON a.c_custkey = n.c_custkey
           UNION ALL SELECT 'deletes', n.c_custkey, Customer_Key FROM numbered n
           WHERE n.c_custkey IN (SELECT c_custkey FROM customer_before) AND n.c_custkey NOT IN (SELECT c_custkey FROM customer_after)""",
        _STAGED.strip(),
    ),
)
def overwrite_keeps_keys(t: Tables):
    """Two complete loads: known customers keep their surrogate keys, vanished ones are audited."""
    path, chosen = scratch_path(t.spark, "runs"), settings(write_mode="overwrite", delete_flag=True)
    run_table(customer_before(t), CUSTOMER, chosen, TableState(), FIRST_LOAD, f"{path}/1")
    state = run_table(customer_after(t), CUSTOMER, chosen, open_state(t.spark, f"{path}/1"), SECOND_LOAD, f"{path}/2")
    return _labelled({"warehouse": state.warehouse, "deletes": state.deletes}, ["Customer_Id", "Customer_Key"])


_TEXT_KEY = "CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 50 = 1 THEN '' ELSE CAST(c_custkey AS {}) END"


@query(
    "y3_newest_after_cleansing",
    f"""SELECT Code, c_name AS Name FROM (
          SELECT coalesce({_TEXT_KEY.format("VARCHAR")}, '') AS Code, c_name,
                 row_number() OVER (PARTITION BY coalesce({_TEXT_KEY.format("VARCHAR")}, '') ORDER BY c_acctbal DESC, c_custkey DESC) AS rn
          FROM customer) x WHERE rn = 1""",
)
def newest_after_cleansing(t: Tables):
    """Missing and empty keys are one key once they are cleansed; the newest of their rows is loaded."""
    columns = (ColumnMap("Code", "varchar(20)", "code", "PK"), ColumnMap("Name", "varchar(50)", "c_name"))
    spec = with_system_columns(WarehouseSpec("Coded", "D", columns), "crm", "acme")
    source = t.customer.withColumn("code", F.expr(_TEXT_KEY.format("STRING")))
    path = scratch_path(t.spark, "runs")
    state = run_table(source, spec, settings(write_mode="upsert"), TableState(), FIRST_LOAD, path, newest_by=["c_acctbal", "c_custkey"])
    return state.warehouse.select("Code", "Name")


@query(
    "y5_colliding_keys",
    """SELECT n_name || '_A' AS First_Part, CAST(n_regionkey AS VARCHAR) AS Second_Part, CAST(n_nationkey AS BIGINT) AS Value FROM nation
       UNION ALL SELECT n_name, 'A_' || CAST(n_regionkey AS VARCHAR), CAST(n_nationkey + 100 AS BIGINT) FROM nation""",
)
def colliding_keys(t: Tables):
    """Different keys with the same key text stay apart over two runs."""
    region = F.col("n_regionkey").cast("string")
    source = t.nation.select(F.concat("n_name", F.lit("_A")).alias("a"), region.alias("b"), F.col("n_nationkey").cast("bigint").alias("v"))
    source = source.unionByName(t.nation.select(F.col("n_name").alias("a"), F.concat(F.lit("A_"), region).alias("b"), (F.col("n_nationkey") + 100).cast("bigint").alias("v")))
    columns = (ColumnMap("First_Part", "varchar(40)", "a", "PK"), ColumnMap("Second_Part", "varchar(40)", "b", "PK"), ColumnMap("Value", "bigint", "v"))
    spec, path = tag_incremental(WarehouseSpec("Pair", "T", columns)), scratch_path(t.spark, "runs")
    state = run_table(source, spec, settings(write_mode="upsert"), TableState(), FIRST_LOAD, f"{path}/1")
    state = run_table(source, spec, settings(write_mode="upsert"), state, SECOND_LOAD, f"{path}/2")
    return state.warehouse.select("First_Part", "Second_Part", "Value")


@query("f9_limited_increments", "SELECT o_orderkey AS Order_Id, o_orderstatus AS Status FROM orders ORDER BY o_orderkey LIMIT 18000")
def limited_increments(t: Tables):
    """Three runs of at most 6,000 new orders, each from where the one before ended, in a state read back from its path."""
    columns = (ColumnMap("Order_Id", "bigint", "o_orderkey", "PK"), ColumnMap("Status", "char(1)", "o_orderstatus"))
    spec, path = tag_incremental(WarehouseSpec("Part_Orders", "T", columns)), scratch_path(t.spark, "runs")
    window = {"incremental_refresh_column_type": "id", "incremental_refresh_column_name": "o_orderkey"}
    chosen, before = settings(write_mode="upsert", incremental=window, limit=6000), None
    for number, stamp in enumerate((FIRST_LOAD, SECOND_LOAD, THIRD_LOAD)):
        state = run_table(t.orders, spec, chosen, open_state(t.spark, before), stamp, f"{path}/{number}")
        before = f"{path}/{number}"
    return state.warehouse.select("Order_Id", "Status")


@query(
    "c6_from_conversion_table",
    """SELECT c_custkey AS Customer_Id, CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE c_name END AS Name, CASE WHEN c_acctbal < 0 THEN -1 ELSE c_nationkey END AS Nation
       FROM customer""",
)
def cleansed_from_table(t: Tables):
    """The type-conversion table tells what missing values of a dimension become."""
    rows = [("varchar(50)", "unknown", "none"), ("int", "-1", "0"), ("bigint", None, "0")]
    table = t.spark.createDataFrame(rows, "IL_Data_Type string, Cleansing_Value string, PK_Cleansing_Value string")
    defaults, key_defaults = cleansing_from_control(table)
    spec = replace(CUSTOMER, defaults=defaults, key_defaults=key_defaults)
    gap = F.col("c_acctbal") < 0
    source = t.customer.withColumns({c: F.when(~gap, F.col(c)) for c in ("c_name", "c_nationkey")})
    return dimension_staging(source, spec, None, FIRST_LOAD).select("Customer_Id", "Name", "Nation")


@query("p8_in_mart", f"SELECT nation, revenue_band, total_revenue, quantity, buyers, quantity_spread AS quantity_deviation FROM ({_MART_SQL}) x")
def mart_with_clean_names(t: Tables):
    """The build cleans its column names by the mart's rules."""
    rows = build_mart(replace(mart_spec(), name_rules=(("spread", "deviation"),)), _mart_sources(t))
    return doubles(rows, "total_revenue").withColumn("quantity_deviation", F.round("quantity_deviation", 6))
