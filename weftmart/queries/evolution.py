"""Keyed differences, schema changes, target creation, refresh checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftmart.operators.conform import with_system_columns
from weftmart.operators.diff import apply_diff, as_target, evolve, keyed_diff, needs_refresh, rekey, target_schema
from weftmart.operators.sinks import replace_by_key
from weftmart.plans.warehouse import source_rows
from weftmart.queries.registry import Tables, doubles, query
from weftmart.queries.snapshots import customer_after, customer_before, with_snapshots
from weftmart.spec import ColumnMap, WarehouseSpec


@query(
    "m1_keyed_diff",
    with_snapshots(
        """SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
                  CASE WHEN b.c_custkey IS NULL THEN 'I' WHEN a.c_custkey IS NULL THEN 'D' WHEN a.c_acctbal = b.c_acctbal THEN '=' ELSE 'U' END AS change,
                  coalesce(a.c_name, b.c_name) AS c_name, coalesce(a.c_nationkey, b.c_nationkey) AS c_nationkey,
                  coalesce(a.c_acctbal, b.c_acctbal) AS c_acctbal, coalesce(a.c_mktsegment, b.c_mktsegment) AS c_mktsegment
           FROM customer_before b FULL JOIN customer_after a ON a.c_custkey = b.c_custkey"""
    ),
)
def difference(t: Tables):
    return keyed_diff(customer_after(t), customer_before(t), ["c_custkey"])


@query("m1_apply_diff", with_snapshots("SELECT * FROM customer_after"))
def difference_applied(t: Tables):
    changes = keyed_diff(customer_after(t), customer_before(t), ["c_custkey"])
    return apply_diff(customer_before(t), changes, ["c_custkey"])


@query(
    "m2_evolve_target",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
              CAST(l_quantity > 25 AS INTEGER) AS is_large, CAST(NULL AS VARCHAR) AS comment, CAST(NULL AS DATE) AS checked FROM lineitem""",
)
def evolved(t: Tables):
    """Columns dropped, added as null, widened, and a flag turned into a small number."""
    old = t.lineitem.withColumn("is_large", F.col("l_quantity") > 25)
    columns = {
        "l_orderkey": "bigint", "l_linenumber": "bigint", "l_quantity": "int", "is_large": "tinyint", "comment": "varchar(20)", "checked": "date",
    }
    return evolve(old, columns).withColumn("is_large", F.col("is_large").cast("int"))


@query(
    "m3_key_change",
    """SELECT 'row' AS kind, CAST(o_custkey AS VARCHAR) || '_' || o_orderpriority AS PKValue, o_orderkey AS detail FROM orders
       UNION ALL SELECT 'duplicate', CAST(o_custkey AS VARCHAR) || '_' || o_orderpriority, count(*) FROM orders
         GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1""",
)
def key_changed(t: Tables):
    """Orders under another key: the rebuilt key text of every row, and the keys that repeat."""
    types = {"o_custkey": "bigint", "o_orderpriority": "varchar(20)"}
    rows, bad = rekey(t.orders, list(types), types)
    rows = rows.select(F.lit("row").alias("kind"), "PKValue", F.col("o_orderkey").alias("detail"))
    bad = bad.select(F.col("issue").alias("kind"), F.concat_ws("_", "o_custkey", "o_orderpriority").alias("PKValue"), F.col("row_count").alias("detail"))
    return rows.unionByName(bad)


@query(
    "m4_create_target",
    """SELECT p_partkey AS Part_Id, p_name AS Name, CAST(p_retailprice AS DOUBLE) AS Price, 'erp' AS DataSource_Id, 'acme' AS Company_Id,
              CAST(NULL AS BIGINT) AS Part_Key, CAST(NULL AS VARCHAR) AS Source_Hash_Value, CAST(NULL AS INTEGER) AS Mismatch_Flag,
              CAST(NULL AS TIMESTAMP) AS Added_Date, CAST(NULL AS VARCHAR) AS Added_User, CAST(NULL AS TIMESTAMP) AS Updated_Date,
              CAST(NULL AS VARCHAR) AS Updated_User FROM part""",
)
def created(t: Tables):
    """A target's columns from its mapping, holding the mapped rows."""
    base = WarehouseSpec(
        "Part",
        "D",
        (ColumnMap("Part_Id", "bigint", "p_partkey", "PK"), ColumnMap("Name", "varchar(50)", "p_name"), ColumnMap("Price", "decimal(12,2)", "p_retailprice")),
    )
    spec = with_system_columns(base, "erp", "acme")
    rows = as_target(source_rows(t.part, spec), target_schema(spec))
    return doubles(rows, "Price").withColumn("Mismatch_Flag", F.col("Mismatch_Flag").cast("int"))


@query(
    "m5_needs_refresh",
    """SELECT u.user_id, last_update, last_build FROM (SELECT user_id, max(ts) AS last_update FROM events GROUP BY 1) u
       LEFT JOIN (SELECT user_id, max(ts) AS last_build FROM events WHERE event_type = 'signup' GROUP BY 1) b ON u.user_id = b.user_id
       WHERE last_build IS NULL OR last_update > last_build""",
)
def stale(t: Tables):
    return needs_refresh(t.events, t.events.where("event_type = 'signup'"), ["user_id"], "ts")


@query(
    "m6_promote_mapping",
    with_snapshots(
        """SELECT c_mktsegment, c_custkey, c_acctbal FROM customer_after
           UNION ALL SELECT c_mktsegment, c_custkey, c_acctbal FROM customer_before WHERE c_mktsegment NOT IN (SELECT c_mktsegment FROM customer_after)"""
    ),
)
def promoted(t: Tables):
    """All rows of each saved id replace the live rows of that id."""
    columns = ["c_mktsegment", "c_custkey", "c_acctbal"]
    return replace_by_key(customer_before(t).select(*columns), customer_after(t).select(*columns), ["c_mktsegment"])
