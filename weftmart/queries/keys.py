"""Canonical text, key text, checksums, surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftmart.functions.canonical import canonical
from weftmart.functions.types import spark_type
from weftmart.operators.keys import surrogate_keys, with_change_hash, with_key_text, with_source_hash
from weftmart.queries.registry import Tables, query
from weftmart.queries.snapshots import customer_after, customer_before, with_snapshots


@query(
    "k0_canonical_text",
    """SELECT o_orderkey, CAST(CAST(o_totalprice * 1000 AS DECIMAL(18,2)) AS VARCHAR) AS number_text, strftime(o_orderdate, '%Y-%m-%d') AS date_text,
              strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS time_text FROM orders""",
)
def canonical_text(t: Tables):
    kinds = {c: t.orders.schema[c].dataType for c in t.orders.columns}
    large = F.col("o_totalprice") * 1000
    return t.orders.select(
        "o_orderkey",
        canonical(large, kinds["o_totalprice"], spark_type("decimal(18,2)")).alias("number_text"),
        canonical(F.col("o_orderdate"), kinds["o_orderdate"], "yyyy-MM-dd").alias("date_text"),
        canonical(F.col("o_orderdate"), kinds["o_orderdate"]).alias("time_text"),
    )


@query(
    "k1_key_text",
    "SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) || '_' || l_returnflag AS PKValue FROM lineitem",
)
def key_text(t: Tables):
    return with_key_text(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"), ["l_orderkey", "l_linenumber", "l_returnflag"]).drop("l_returnflag")


@query(
    "k2_source_hash",
    """SELECT c_custkey, md5(concat_ws(chr(1), CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
              CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR), coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, chr(2)))) AS Source_Hash_Value
       FROM customer""",
)
def source_hash(t: Tables):
    gaps = t.customer.withColumn("c_mktsegment", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")))
    hashed = with_source_hash(gaps, t.customer.columns, {"c_acctbal": spark_type("decimal(12,2)")})
    return hashed.select("c_custkey", "Source_Hash_Value")


@query(
    "k3_change_hash",
    """SELECT o_orderkey, md5(concat_ws(chr(1), o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'))) AS HashValue
       FROM orders""",
)
def change_hash(t: Tables):
    declared = {"o_totalprice": spark_type("decimal(14,2)"), "o_orderdate": "yyyy-MM-dd"}
    return with_change_hash(t.orders, ["o_orderstatus", "o_totalprice", "o_orderdate"], declared).select("o_orderkey", "HashValue")


@query(
    "k4_surrogate_keys",
    with_snapshots(
        """SELECT a.c_custkey, a.c_name, coalesce(k.Customer_Key, (SELECT count(*) FROM customer_before) + f.rn) AS Customer_Key
           FROM customer_after a LEFT JOIN known k ON a.c_custkey = k.c_custkey LEFT JOIN fresh f ON a.c_custkey = f.c_custkey""",
        "known AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS Customer_Key FROM customer_before)",
        """fresh AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer_after
                     WHERE c_custkey NOT IN (SELECT c_custkey FROM customer_before))""",
    ),
)
def surrogates(t: Tables):
    """First load numbers all customers; the second keeps those numbers and continues."""
    first = surrogate_keys(customer_before(t).select("c_custkey"), None, ["c_custkey"], "Customer_Key")
    return surrogate_keys(customer_after(t).select("c_custkey", "c_name"), first, ["c_custkey"], "Customer_Key")
