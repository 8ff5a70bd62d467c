"""Scalar functions that specifications use, each over a whole table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from weftmart.functions.scalars import list_items, list_size, months_before, render_in_zone
from weftmart.queries.registry import Tables, query


@query("fn_substring_index", "SELECT page_id, split_part(url, '/', 1) || '/' || split_part(url, '/', 2) || '/' || split_part(url, '/', 3) AS site FROM pages")
def substring_index(t: Tables):
    return t.pages.select("page_id", F.substring_index("url", "/", 3).alias("site"))


@query("fn_lower_upper", "SELECT c_custkey, lower(c_mktsegment) AS low, upper(c_name) AS high FROM customer")
def lower_upper(t: Tables):
    return t.customer.select("c_custkey", F.lower("c_mktsegment").alias("low"), F.upper("c_name").alias("high"))


@query("fn_concat", "SELECT s_suppkey, s_name || '@' || CAST(s_nationkey AS VARCHAR) AS tag FROM supplier")
def concat(t: Tables):
    return t.supplier.select("s_suppkey", F.concat("s_name", F.lit("@"), F.col("s_nationkey").cast("string")).alias("tag"))


@query("fn_replace", "SELECT o_orderkey, replace(o_orderpriority, '-', ' ') AS priority FROM orders")
def replace(t: Tables):
    return t.orders.select("o_orderkey", F.replace("o_orderpriority", F.lit("-"), F.lit(" ")).alias("priority"))


@query("fn_length", "SELECT doc_id, CAST(length(text) AS BIGINT) AS characters FROM documents")
def length(t: Tables):
    return t.documents.select("doc_id", F.length("text").cast("bigint").alias("characters"))


@query("fn_round", "SELECT p_partkey, CAST(round(CAST(p_retailprice AS DECIMAL(12,2)), 0) AS DOUBLE) AS whole FROM part")
def rounded(t: Tables):
    return t.part.select("p_partkey", F.round(F.col("p_retailprice").cast("decimal(12,2)"), 0).cast("double").alias("whole"))


@query("fn_list_size", "SELECT doc_id, CAST(length(text) - length(replace(text, ',', '')) AS BIGINT) AS commas FROM documents")
def separators(t: Tables):
    return t.documents.select("doc_id", list_size(F.col("text")).cast("bigint").alias("commas"))


@query("fn_split_keep_tail", "SELECT page_id, CAST(len(string_split(url, '/')) AS BIGINT) AS parts, string_split(url, '/')[-1] AS tail FROM pages")
def split_tail(t: Tables):
    items = list_items(F.col("url"), "/")
    return t.pages.select("page_id", F.size(items).cast("bigint").alias("parts"), F.element_at(items, -1).alias("tail"))


@query("fn_ifnull_coalesce", "SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(NULLIF(toxic, 0), quality, 9) AS marker FROM documents LEFT JOIN labels USING (doc_id)")
def ifnull(t: Tables):
    rows = t.documents.join(t.labels, "doc_id", "left_outer")
    return rows.select(
        "doc_id",
        F.ifnull("quality", F.lit(-1)).alias("quality"),
        F.coalesce(F.nullif("toxic", F.lit(0)), "quality", F.lit(9)).alias("marker"),
    )


@query("fn_case", "SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'L' WHEN o_totalprice > 100000 THEN 'M' ELSE 'S' END AS size FROM orders")
def case(t: Tables):
    size = F.when(F.col("o_totalprice") > 300000, "L").when(F.col("o_totalprice") > 100000, "M").otherwise("S")
    return t.orders.select("o_orderkey", size.alias("size"))


@query("fn_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' AND p_type NOT LIKE 'PROMO%'")
def like(t: Tables):
    return t.part.where(F.col("p_name").like("%ring%") & ~F.col("p_type").like("PROMO%")).select("p_partkey", "p_name")


@query("fn_trim", "SELECT doc_id, trim(text, ' ') AS trimmed FROM documents")
def trim(t: Tables):
    return t.documents.select("doc_id", F.trim("text").alias("trimmed"))


@query(
    "fn_convert_tz",
    "SELECT event_id, ts + INTERVAL 330 MINUTE AS local_time, ts - INTERVAL 60 MINUTE AS from_lagos FROM events",
)
def convert_tz(t: Tables):
    return t.events.select(
        "event_id",
        render_in_zone(F.col("ts"), "Asia/Kolkata").alias("local_time"),
        render_in_zone(F.col("ts"), "UTC", "Africa/Lagos").alias("from_lagos"),
    )


@query("fn_utc_timestamp", "SELECT n_nationkey, TRUE AS is_now FROM nation")
def utc_now(t: Tables):
    """The current time of a UTC session; only its closeness to the driver's clock is comparable."""
    near = F.abs(F.unix_timestamp(F.current_timestamp()) - F.lit(int(dt.datetime.now(dt.timezone.utc).timestamp()))) < 3600
    return t.nation.select("n_nationkey", near.alias("is_now"))


@query("fn_months_before", "SELECT o_orderkey, o_orderdate - INTERVAL 3 MONTH AS quarter_earlier FROM orders")
def quarter_earlier(t: Tables):
    return t.orders.select("o_orderkey", months_before(F.col("o_orderdate"), 3).alias("quarter_earlier"))


@query("fn_max", "SELECT o_custkey, max(o_orderdate) AS newest FROM orders GROUP BY 1")
def newest(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("newest"))
