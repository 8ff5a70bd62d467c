"""Earlier and later states of tables, told apart by their own column values, on Spark and in SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from weftmart.queries.registry import Tables

FIRST_LOAD = (dt.datetime(2024, 1, 1), "loader")
SECOND_LOAD = (dt.datetime(2024, 2, 1), "loader")
THIRD_LOAD = (dt.datetime(2024, 3, 1), "loader")


def customer_before(t: Tables) -> DataFrame:
    """Customers as first loaded: one market segment was not served yet."""
    return t.customer.where("c_mktsegment <> 'MACHINERY'")


def customer_after(t: Tables) -> DataFrame:
    """Customers now: deep debtors left, one segment got a credit, the new segment joined."""
    credit = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 10).otherwise(F.col("c_acctbal"))
    return t.customer.where("c_acctbal >= -500").withColumn("c_acctbal", credit)


def orders_before(t: Tables) -> DataFrame:
    return t.orders.where("o_orderdate < timestamp_ntz'2000-01-01 00:00:00'")


def orders_after(t: Tables) -> DataFrame:
    """Orders of the overlapping next extract; pending ones were repriced."""
    price = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return t.orders.where("o_orderdate >= timestamp_ntz'1999-07-01 00:00:00'").withColumn("o_totalprice", price)


def orders_alive(t: Tables) -> DataFrame:
    """Orders the source still has: old finished ones were archived."""
    return t.orders.where("not (o_orderstatus = 'F' and o_orderdate < timestamp_ntz'1996-01-01 00:00:00')")


CTE = """
customer_before AS (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY'),
customer_after AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 10 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer WHERE c_acctbal >= -500),
orders_before AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'),
orders_after AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01 00:00:00'),
orders_alive AS (
  SELECT * FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01 00:00:00'))
"""


def with_snapshots(select: str, *more: str) -> str:
    """SQL over the snapshots, with further named row sets."""
    return "WITH " + ", ".join([CTE.strip(), *more]) + "\n" + select
