"""Aggregates, filter/group steps, derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftmart.operators.aggregate import distinct_rows, filter_group, group_by, has_rows, last_row, latest_time, string_list
from weftmart.operators.derive import call_method, choose, derive
from weftmart.operators.joins import read_table
from weftmart.queries.registry import Tables, doubles, query
from weftmart.spec import Derived, FilterGroup, GroupColumn, TableSpec


def _lines(t: Tables):
    return t.lineitem.withColumn("l_extendedprice", F.col("l_extendedprice").cast("decimal(12,2)"))


@query(
    "a1_group_by",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS sum_price, avg(l_quantity) AS avg_qty,
              min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, count(l_orderkey) AS lines
       FROM lineitem GROUP BY 1, 2""",
)
def grouped(t: Tables):
    aggregates = {
        "sum_qty": ("Sum", "l_quantity"),
        "sum_price": ("Sum", "l_extendedprice"),
        "avg_qty": ("Avg", "l_quantity"),
        "first_ship": ("Min", "l_shipdate"),
        "last_ship": ("Max", "l_shipdate"),
        "lines": ("Count", "l_orderkey"),
    }
    return doubles(group_by(_lines(t), ["l_returnflag", "l_linestatus"], aggregates), "sum_price")


@query(
    "a2_distinct_count",
    "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderdate) AS days FROM orders GROUP BY 1",
)
def distinct_counts(t: Tables):
    return group_by(t.orders, ["o_orderstatus"], {"customers": ("Distinct_Count", "o_custkey"), "days": ("Distinct_Count", "o_orderdate")})


@query(
    "a3_stddev_samp",
    """SELECT l_orderkey, l_linenumber, round(stddev_samp(l_quantity), 6) AS spread, count(l_quantity) AS lines
       FROM lineitem GROUP BY 1, 2""",
)
def spread(t: Tables):
    aggregates = {"spread": ("Stddev_Samp", "l_quantity"), "lines": ("Count", "l_quantity")}
    return group_by(t.lineitem, ["l_orderkey", "l_linenumber"], aggregates).withColumn("spread", F.round("spread", 6))


@query(
    "a4_var_samp",
    "SELECT l_partkey, l_returnflag, round(var_samp(l_quantity), 6) AS variance FROM lineitem GROUP BY 1, 2",
)
def variance(t: Tables):
    rows = group_by(t.lineitem, ["l_partkey", "l_returnflag"], {"variance": ("Var_Samp", "l_quantity")})
    return rows.withColumn("variance", F.round("variance", 6))


@query(
    "a5_random_value",
    "SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS any_priority, arg_min(o_orderstatus, o_orderkey) AS any_status FROM orders GROUP BY 1",
)
def random_value(t: Tables):
    picks = {
        "any_priority": GroupColumn("o_orderpriority", "Random", "any_priority", ("o_orderkey",)),
        "any_status": GroupColumn("o_orderstatus", "Random", "any_status", ("o_orderkey",)),
    }
    return group_by(t.orders, ["o_custkey"], picks)


@query("a6_group_key_column", "SELECT c_mktsegment AS segment, c_nationkey AS nation, count(c_custkey) AS c_custkey FROM customer GROUP BY 1, 2")
def key_columns(t: Tables):
    columns = (GroupColumn("c_mktsegment", "GroupBy", "segment"), GroupColumn("c_custkey", "Count"), GroupColumn("c_nationkey", "GroupBy", "nation"))
    return filter_group(t.customer, FilterGroup(columns=columns))


_GROUP = (GroupColumn("o_orderpriority"), GroupColumn("o_orderkey", "Count"), GroupColumn("o_totalprice", "Max"))


@query(
    "a7_filter_group_shapes",
    """SELECT 'filter' AS shape, o_orderpriority, count(*) AS orders, max(o_totalprice) AS price FROM orders WHERE o_totalprice > 250000 GROUP BY 2
       UNION ALL SELECT 'F', o_orderpriority, count(*), max(o_totalprice) FROM orders WHERE o_totalprice > 250000 GROUP BY 2
       UNION ALL SELECT 'G', o_orderpriority, count(*), max(o_totalprice) FROM orders GROUP BY 2 HAVING avg(o_custkey) > 0 AND o_orderpriority <> '5-LOW'
       UNION ALL SELECT 'group', o_orderpriority, count(*), max(o_totalprice) FROM orders GROUP BY 2""",
)
def shapes(t: Tables):
    condition = "o_totalprice > 250000"
    only = filter_group(t.orders, FilterGroup(condition))
    steps = {
        "filter": filter_group(only, FilterGroup(columns=_GROUP)),
        "F": filter_group(t.orders, FilterGroup(condition, _GROUP, "F")),
        "G": filter_group(t.orders, FilterGroup("avg(o_custkey) > 0 and o_orderpriority <> '5-LOW'", _GROUP, "G")),
        "group": filter_group(t.orders, FilterGroup(columns=_GROUP)),
    }
    result = None
    for shape, rows in steps.items():
        part = rows.select(
            F.lit(shape).alias("shape"), "o_orderpriority", F.col("o_orderkey").alias("orders"), F.col("o_totalprice").alias("price")
        )
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "a8_source_level_group",
    """SELECT o_custkey AS buyer, max(o_totalprice) AS top_price, count(o_orderkey) AS orders FROM orders
       GROUP BY o_custkey HAVING count(o_orderkey) > 8 AND max(o_totalprice) > 1000""",
)
def source_level(t: Tables):
    columns = (GroupColumn("o_custkey"), GroupColumn("o_totalprice", "Max"), GroupColumn("o_orderkey", "Count"))
    step = FilterGroup("count(o_orderkey) > 8 and max(o_totalprice) > 1000", columns, "G")
    names = {"o_custkey": "buyer", "o_totalprice": "top_price", "o_orderkey": "orders"}
    return read_table(t.orders, TableSpec("orders", "o", names, "driving", step))


@query("a9_keys_only_group", "SELECT DISTINCT l_shipdate, l_returnflag FROM lineitem")
def keys_only(t: Tables):
    return filter_group(t.lineitem, FilterGroup(columns=(GroupColumn("l_shipdate"), GroupColumn("l_returnflag"))))


@query(
    "a10_string_list",
    """SELECT n_regionkey, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands
       FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       GROUP BY n_regionkey""",
)
def brand_lists(t: Tables):
    lines = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return string_list(lines, ["n_regionkey"], "p_brand", "brands")


@query(
    "a10_string_list_ordered",
    "SELECT conv_id, string_agg(role, ' > ' ORDER BY turn) AS roles FROM conversations GROUP BY 1",
)
def role_sequences(t: Tables):
    return string_list(t.conversations, ["conv_id"], "role", "roles", " > ", distinct=False, order_by=["turn"])


@query(
    "a11_last_row",
    """SELECT user_id, event_id, ts, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1""",
)
def last_event(t: Tables):
    return last_row(t.events.select("user_id", "event_id", "ts", "event_type", "value"), ["user_id"], ["ts", "event_id"])


@query("a12_latest_time", "SELECT user_id, event_type, max(ts) AS Updated_Date FROM events GROUP BY 1, 2")
def latest(t: Tables):
    return latest_time(t.events, ["user_id", "event_type"], "ts", "Updated_Date")


@query("a13_distinct", "SELECT DISTINCT source, lang FROM documents")
def distinct(t: Tables):
    return distinct_rows(t.documents, ["source", "lang"])


@query(
    "a14_has_rows",
    """SELECT n_nationkey, EXISTS (SELECT 1 FROM orders WHERE o_totalprice > 400000) AS has_large,
              EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0) AS has_negative FROM nation""",
)
def existence(t: Tables):
    large, negative = t.orders.where("o_totalprice > 400000"), t.orders.where("o_totalprice < 0")
    return t.nation.select("n_nationkey", has_rows(large).alias("has_large"), has_rows(negative).alias("has_negative"))


@query(
    "e1_derived_levels",
    """WITH a AS (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS revenue, l_quantity FROM lineitem),
       b AS (SELECT *, revenue * CAST(0.25 AS DECIMAL(3,2)) AS margin FROM a)
       SELECT l_orderkey, l_linenumber, l_quantity, CAST(revenue AS DOUBLE) AS revenue, CAST(margin AS DOUBLE) AS margin,
              CASE WHEN margin > 10000 THEN 'high' WHEN margin > 2000 THEN 'middle' ELSE 'low' END AS band FROM b""",
)
def levels(t: Tables):
    derived = (
        Derived("band", "case when margin > 10000 then 'high' when margin > 2000 then 'middle' else 'low' end", 3),
        Derived("revenue", "l_extendedprice * (1 - cast(l_discount as decimal(4,2)))", 1),
        Derived("margin", "revenue * cast(0.25 as decimal(3,2))", 2),
    )
    rows = derive(_lines(t), derived).select("l_orderkey", "l_linenumber", "l_quantity", "revenue", "margin", "band")
    return doubles(rows, "revenue", "margin")


@query(
    "e2_typed_expression",
    """SELECT o_orderkey, CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands,
              CAST(o_orderkey AS VARCHAR) || '-' || o_orderstatus AS label, o_totalprice FROM orders""",
)
def typed(t: Tables):
    derived = (
        Derived("thousands", "floor(o_totalprice / 1000)", kind="JAVA", arguments={"o_totalprice": "double"}, type="bigint"),
        Derived("label", "concat(o_orderkey, '-', o_orderstatus)", kind="JAVA", arguments={"o_orderkey": "varchar(20)", "o_orderstatus": "char(1)"}, type="varchar(30)"),
    )
    return derive(t.orders, derived).select("o_orderkey", "thousands", "label", "o_totalprice")


@query(
    "e3_level_order",
    """SELECT c_custkey, CAST(c_nationkey AS BIGINT) + 1 AS first_typed, (CAST(c_nationkey AS BIGINT) + 1) * 2 AS then_sql,
              (CAST(c_nationkey AS BIGINT) + 1) * 2 - 1 AS next_level FROM customer""",
)
def level_order(t: Tables):
    """Within a level typed columns come first, so a SQL column of the level sees them."""
    derived = (
        Derived("next_level", "then_sql - 1", 2),
        Derived("then_sql", "first_typed * 2", 1),
        Derived("first_typed", "c_nationkey + 1", 1, "JAVA", arguments={"c_nationkey": "bigint"}, type="bigint"),
    )
    return derive(t.customer, derived).select("c_custkey", "first_typed", "then_sql", "next_level")


@query(
    "e4_conditional_column",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'engaged' WHEN 'view' THEN 'engaged' WHEN 'purchase' THEN 'buyer' ELSE 'other' END AS bucket
       FROM events""",
)
def conditional(t: Tables):
    cases = {"click": "engaged", "view": "engaged", "purchase": "buyer"}
    return t.events.select("event_id", choose(F.col("event_type"), cases, "other").alias("bucket"))


@query(
    "e5_method_call",
    """SELECT p_partkey, p_brand || '_' || p_type AS joined, md5(concat_ws(chr(1), p_name, p_brand, CAST(p_size AS VARCHAR))) AS checksum FROM part""",
)
def method_call(t: Tables):
    rows = call_method(t.part, "string_join", ["p_brand", "p_type"], "joined")
    return call_method(rows, "checksum", ["p_name", "p_brand", "p_size"], "checksum").select("p_partkey", "joined", "checksum")
