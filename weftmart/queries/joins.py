"""Join chains, lookups, exclusions and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftmart.operators.joins import (
    deleted_rows, enrich_first_of, exclude, flag_matches, inner_chain, join_chain, lookup, match_split, not_in,
    read_table, resolve_foreign_keys,
)
from weftmart.operators.keys import with_change_hash, with_key_text
from weftmart.queries.registry import Tables, query
from weftmart.queries.snapshots import customer_after, customer_before, orders_after, orders_before, with_snapshots
from weftmart.spec import ColumnMap, JoinSpec, TableSpec

_TABLES = (
    TableSpec("lineitem", "l", {"l_orderkey": "line_order", "l_linenumber": "line", "l_quantity": "quantity"}, "driving"),
    TableSpec("orders", "o", {"o_orderkey": "order_id", "o_custkey": "buyer", "o_orderpriority": "priority"}),
    TableSpec("customer", "c", {"c_custkey": "customer_id", "c_nationkey": "home", "c_mktsegment": "segment"}),
    TableSpec("nation", "n", {"n_nationkey": "nation_id", "n_name": "nation"}),
)
_CHAIN = """
SELECT l_orderkey AS line_order, l_linenumber AS line, l_quantity AS quantity, o_orderkey AS order_id, o_custkey AS buyer,
       o_orderpriority AS priority, c_custkey AS customer_id, c_nationkey AS home, c_mktsegment AS segment,
       n_nationkey AS nation_id, n_name AS nation
FROM lineitem LEFT JOIN {orders} o ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
"""


def _chain(t: Tables, orders, salt: int = 1):
    sources = {"lineitem": t.lineitem, "orders": orders, "customer": t.customer, "nation": t.nation}
    tables = {s.alias: read_table(sources[s.name], s) for s in _TABLES}
    joins = (
        JoinSpec(2, "c", (("buyer", "customer_id"),), "o"),
        JoinSpec(1, "o", (("line_order", "order_id"),), "l", salt),
        JoinSpec(3, "n", (("home", "nation_id"),), "c"),
    )
    return join_chain(tables, "l", joins)


@query("j1_left_join_chain", _CHAIN.format(orders="(SELECT * FROM orders WHERE o_orderstatus <> 'P')"))
def chain(t: Tables):
    return _chain(t, t.orders.where("o_orderstatus <> 'P'"))


@query("j1_left_join_chain_salted", _CHAIN.format(orders="orders"))
def chain_salted(t: Tables):
    return _chain(t, t.orders, salt=8)


@query(
    "j1_multi_column_join",
    """SELECT a.conv_id, a.turn, a.role, b.role AS next_role FROM conversations a
       LEFT JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn""",
)
def multi_column(t: Tables):
    turns = t.conversations.select("conv_id", "turn", "role", (F.col("turn") + 1).alias("following"))
    return lookup(turns, t.conversations, {"conv_id": "conv_id", "following": "turn"}, {"role": "next_role"}).drop("following")


@query(
    "j2_lookup",
    """SELECT o_orderkey, o_custkey, c_name AS customer_name, c_acctbal AS balance
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey""",
)
def looked_up(t: Tables):
    fetch = {"c_name": "customer_name", "c_acctbal": "balance"}
    return lookup(t.orders.select("o_orderkey", "o_custkey"), t.customer.where("c_acctbal >= 0"), {"o_custkey": "c_custkey"}, fetch)


@query(
    "j2_lookup_first_row",
    """WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
                                FROM orders WHERE o_orderstatus = 'F') x WHERE rn = 1)
       SELECT c_custkey, o_orderkey AS first_order, o_totalprice AS first_price FROM customer LEFT JOIN f ON c_custkey = o_custkey""",
)
def looked_up_first(t: Tables):
    finished = t.orders.where("o_orderstatus = 'F'")
    fetch = {"o_orderkey": "first_order", "o_totalprice": "first_price"}
    return lookup(t.customer.select("c_custkey"), finished, {"c_custkey": "o_custkey"}, fetch, ["o_orderdate", "o_orderkey"])


@query(
    "j3_foreign_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_partkey * 10 AS Part_Key, s_suppkey + 1000 AS Supplier_Key
       FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey
       LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey""",
)
def foreign_keys(t: Tables):
    dimensions = {
        "Part": t.part.where("p_size > 10").select("p_partkey", (F.col("p_partkey") * 10).alias("Part_Key")),
        "Supplier": t.supplier.where("s_acctbal > 0").select("s_suppkey", (F.col("s_suppkey") + 1000).alias("Supplier_Key")),
    }
    foreign = [
        ColumnMap("Part_Key", "bigint", tag="FK", dimension="Part", dimension_key="Part_Key", join=(("l_partkey", "p_partkey"),)),
        ColumnMap("Supplier_Key", "bigint", tag="FK", dimension="Supplier", dimension_key="Supplier_Key", join=(("l_suppkey", "s_suppkey"),)),
    ]
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return resolve_foreign_keys(lines, foreign, dimensions, salt=4)


@query(
    "j3_repeated_dimension_keys",
    """SELECT c_custkey, o_orderkey AS First_Order FROM customer LEFT JOIN (
         SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) x
       ON c_custkey = o_custkey AND rn = 1""",
)
def repeated_dimension_keys(t: Tables):
    """A dimension with many rows per lookup key gives the first one in the declared order."""
    first = ColumnMap(
        "First_Order", "bigint", tag="FK", dimension="Orders", dimension_key="o_orderkey", join=(("c_custkey", "o_custkey"),),
        order=("o_orderdate", "o_orderkey"),
    )
    return resolve_foreign_keys(t.customer.select("c_custkey"), [first], {"Orders": t.orders})


@query(
    "j4_staging_keys_lookup",
    with_snapshots(
        """SELECT a.o_orderkey, CAST(a.o_orderkey AS VARCHAR) || '_' || CAST(a.o_custkey AS VARCHAR) AS PKValue,
                  b.o_orderdate AS Updated_Date,
                  CASE WHEN b.o_orderkey IS NULL THEN NULL ELSE md5(concat_ws(chr(1), b.o_orderstatus, CAST(CAST(b.o_totalprice AS DECIMAL(14,2)) AS VARCHAR))) END
                    AS Source_Hash_Value
           FROM orders_after a LEFT JOIN orders_before b ON a.o_orderkey = b.o_orderkey AND a.o_custkey = b.o_custkey"""
    ),
)
def staging_keys(t: Tables):
    exact = {"o_totalprice": F.col("o_totalprice").cast("decimal(14,2)")}
    key_table = with_key_text(with_change_hash(orders_before(t).withColumns(exact), ["o_orderstatus", "o_totalprice"]), ["o_orderkey", "o_custkey"])
    rows = with_key_text(orders_after(t), ["o_orderkey", "o_custkey"]).select("o_orderkey", "PKValue")
    fetch = {"o_orderdate": "Updated_Date", "HashValue": "Source_Hash_Value"}
    return lookup(rows, key_table, {"PKValue": "PKValue"}, fetch)


@query(
    "j5_delete_detection",
    with_snapshots(
        """SELECT *, TRUE AS DeleteIndicator FROM customer_before b
           WHERE NOT EXISTS (SELECT 1 FROM customer_after a WHERE a.c_custkey = b.c_custkey)"""
    ),
)
def detected_deletes(t: Tables):
    return deleted_rows(customer_before(t), customer_after(t).select("c_custkey"), ["c_custkey"])


@query(
    "j6_exclude",
    """SELECT p_partkey, p_name FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity >= 50) ON p_partkey = l_partkey
       WHERE l_partkey IS NULL""",
)
def excluded(t: Tables):
    return exclude(t.part.select("p_partkey", "p_name"), t.lineitem.where("l_quantity >= 50"), {"p_partkey": "l_partkey"})


_MULTI = """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem a WHERE NOT EXISTS (
  SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'R' AND b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber)
"""


@query("j7_not_exists", _MULTI)
def not_exists(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return exclude(lines, t.lineitem.where("l_returnflag = 'R'"), {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"})


@query("j8_not_in", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def not_in_plain(t: Tables):
    return not_in(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", t.customer.where("c_acctbal < 0"), "c_custkey")


@query(
    "j8_not_in_nulls",
    """SELECT 'null inside' AS side, count(*) AS row_count FROM orders
         WHERE o_custkey NOT IN (SELECT CASE WHEN c_acctbal < 0 THEN c_custkey END FROM customer)
       UNION ALL SELECT 'null tolerant', count(*) FROM orders
         WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_acctbal < 0 AND c_custkey = o_custkey)
       UNION ALL SELECT 'empty', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 1e9)
       UNION ALL SELECT 'null key', count(*) FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders) x
         WHERE k NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def not_in_nulls(t: Tables):
    with_null = t.customer.select(F.when(F.col("c_acctbal") < 0, F.col("c_custkey")).alias("c_custkey"))
    debtors = t.customer.where("c_acctbal < 0")
    open_keys = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    cases = {
        "null inside": not_in(t.orders, "o_custkey", with_null, "c_custkey"),
        "null tolerant": exclude(t.orders, with_null, {"o_custkey": "c_custkey"}),
        "empty": not_in(t.orders, "o_custkey", t.customer.where("c_acctbal > 1e9"), "c_custkey"),
        "null key": not_in(open_keys, "o_custkey", debtors, "c_custkey"),
    }
    result = None
    for name, rows in cases.items():
        counted = rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("side"), "row_count")
        result = counted if result is None else result.unionByName(counted)
    return result


@query(
    "j9_match_split",
    with_snapshots(
        """SELECT 'update' AS output, o_orderkey, o_totalprice FROM orders_after WHERE o_orderkey IN (SELECT o_orderkey FROM orders_before)
           UNION ALL SELECT 'insert', o_orderkey, o_totalprice FROM orders_after
             WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_before)"""
    ),
)
def split(t: Tables):
    matched, unmatched = match_split(orders_after(t), orders_before(t), ["o_orderkey"])
    both = matched.select(F.lit("update").alias("output"), "o_orderkey", "o_totalprice")
    return both.unionByName(unmatched.select(F.lit("insert").alias("output"), "o_orderkey", "o_totalprice"))


@query(
    "j9_match_flag",
    with_snapshots("SELECT *, EXISTS (SELECT 1 FROM customer_before b WHERE b.c_custkey = a.c_custkey) AS matched FROM customer_after a"),
)
def flagged(t: Tables):
    return flag_matches(customer_after(t), customer_before(t), ["c_custkey"])


@query(
    "j10_inner_chain",
    """SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def inner(t: Tables):
    joined = inner_chain(t.supplier, [(t.nation, [("s_nationkey", "n_nationkey")]), (t.region, [("n_regionkey", "r_regionkey")])])
    return joined.select("s_suppkey", "s_name", "n_name", "r_name")


@query(
    "j11_priority_pick",
    """SELECT c_custkey, c_nationkey, coalesce(s.best, n.n_name, r.r_name, 'none') AS contact FROM customer
       LEFT JOIN (SELECT s_nationkey, max(s_name) AS best FROM supplier WHERE s_acctbal > 9000 GROUP BY 1) s ON c_nationkey = s_nationkey
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 2) n ON c_nationkey = n_nationkey
       LEFT JOIN region r ON c_nationkey = r_regionkey""",
)
def priority_pick(t: Tables):
    best = t.supplier.where("s_acctbal > 9000").groupBy("s_nationkey").agg(F.max("s_name").alias("best"))
    candidates = [
        (best, {"c_nationkey": "s_nationkey"}, "best"),
        (t.nation.where("n_regionkey < 2"), {"c_nationkey": "n_nationkey"}, "n_name"),
        (t.region, {"c_nationkey": "r_regionkey"}, "r_name"),
    ]
    return enrich_first_of(t.customer.select("c_custkey", "c_nationkey"), candidates, "contact", "none", grouped=[0])
