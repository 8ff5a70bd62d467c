"""Coercion, cleansing, conformance and key checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftmart.operators.cleanse import coerce, fold_case, recoerce, replace_missing, trim_strings
from weftmart.operators.conform import (
    conform_losses, conform_source, conform_target, key_report, purge_orphans, tag_incremental, with_system_columns,
)
from weftmart.operators.diff import key_violations
from weftmart.operators.joins import lookup
from weftmart.operators.keys import with_change_hash
from weftmart.plans.warehouse import source_rows
from weftmart.functions.types import derive_target_type
from weftmart.queries.registry import Tables, doubles, longs, query
from weftmart.spec import ColumnMap, WarehouseSpec


@query(
    "c1_source_coercion",
    """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price, CAST(o_orderdate AS DATE) AS ordered,
              CASE WHEN o_orderstatus = 'F' THEN CAST(NULL AS BIGINT) ELSE o_custkey END AS customer FROM orders""",
)
def coerced(t: Tables):
    """Texts as a file would hold them, some unreadable, become typed columns; unreadable ones null."""
    texts = t.orders.select(
        "o_orderkey",
        F.concat(F.lit(" "), F.col("o_totalprice").cast("decimal(12,2)").cast("string")).alias("price"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("ordered"),
        F.when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
    )
    typed = coerce(texts, {"price": "decimal(12,2)", "ordered": "date", "customer": "bigint"}, {"ordered": "dd/MM/yyyy"})
    return doubles(typed, "price")


@query(
    "c2_recoerce",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(14,1)) AS DOUBLE) AS l_extendedprice,
              CAST(l_quantity AS INTEGER) AS l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag FROM lineitem""",
)
def recoerced(t: Tables):
    declared = {
        "l_extendedprice": "decimal(14,1)",
        "l_quantity": "int",
        "l_shipdate": "date",
        "l_returnflag": "varchar(1)",
        "l_orderkey": "varchar(20)",
    }
    # the price goes through its own scale first, as a double has no exact half
    exact = t.lineitem.withColumn("l_extendedprice", F.col("l_extendedprice").cast("decimal(12,2)"))
    rows = recoerce(exact, declared, skip=["l_orderkey"])
    return doubles(rows.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_shipdate", "l_returnflag"), "l_extendedprice")


@query(
    "c3_key_text_types",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || '_' || CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS PKValue,
              o_totalprice, o_orderdate FROM orders""",
)
def key_types(t: Tables):
    """Key text over a date and a decimal; the typed columns stay typed."""
    from weftmart.functions.canonical import composite_key
    from weftmart.functions.types import spark_type

    declared = {"o_orderdate": "yyyy-MM-dd", "o_totalprice": spark_type("decimal(14,2)")}
    text = composite_key(t.orders, ["o_orderdate", "o_totalprice"], declared).alias("PKValue")
    return t.orders.select("o_orderkey", text, "o_totalprice", "o_orderdate")


def _with_gaps(t: Tables):
    """Customers with missing values where a balance is negative and blanks in one segment."""
    negative = F.col("c_acctbal") < 0
    return t.customer.select(
        "c_custkey",
        F.when(negative, None).when(F.col("c_mktsegment") == "BUILDING", F.lit("  ")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(negative, None).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        F.when(negative, None).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(negative, None).otherwise(F.lit("2024-01-01").cast("date")).alias("since"),
        F.when(negative, None).otherwise(F.col("c_acctbal") > 5000).alias("is_good"),
    )


_DECLARED = {"c_name": "varchar(50)", "c_nationkey": "int", "c_acctbal": "double", "since": "date", "is_good": "boolean"}


@query(
    "c4_null_replacement",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_mktsegment = 'BUILDING' THEN 'N/A' ELSE c_name END AS c_name,
              CASE WHEN c_acctbal < 0 THEN 0 ELSE c_nationkey END AS c_nationkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
              CASE WHEN c_acctbal < 0 THEN DATE '1970-01-01' ELSE DATE '2024-01-01' END AS since,
              CASE WHEN c_acctbal < 0 THEN FALSE ELSE c_acctbal > 5000 END AS is_good FROM customer""",
)
def replaced(t: Tables):
    return replace_missing(_with_gaps(t), _DECLARED, defaults={"varchar": "N/A"})


@query(
    "c5_key_null_replacement",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_mktsegment = 'BUILDING' THEN 'no key' ELSE c_name END AS c_name,
              CASE WHEN c_acctbal < 0 THEN -1 ELSE c_nationkey END AS c_nationkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal
       FROM customer""",
)
def key_replaced(t: Tables):
    declared = {"c_name": "varchar(50)", "c_nationkey": "int"}
    rows = replace_missing(_with_gaps(t), declared, ["c_name", "c_nationkey"], key_defaults={"varchar": "no key", "int": -1})
    return rows.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


@query(
    "c6_warehouse_cleansing",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS c_name,
              CASE WHEN c_acctbal < 0 THEN 0 ELSE c_nationkey END AS c_nationkey, 'N/A' AS DataSource_Id FROM customer""",
)
def warehouse_cleansed(t: Tables):
    """Key and other columns in one step; a table without a source key gets its source as the fallback."""
    rows = _with_gaps(t).withColumn("DataSource_Id", F.lit(None).cast("string"))
    declared = {"c_name": "varchar(50)", "c_nationkey": "int", "DataSource_Id": "varchar(50)"}
    cleansed = replace_missing(rows, declared, ["c_nationkey", "DataSource_Id"], key_defaults={"varchar": "N/A"})
    return cleansed.select("c_custkey", "c_name", "c_nationkey", "DataSource_Id")


@query(
    "c7_type_defaults",
    """SELECT s_suppkey, '' AS as_varchar, 0 AS as_int, 0.0::DOUBLE AS as_decimal, FALSE AS as_boolean, DATE '1970-01-01' AS as_date FROM supplier""",
)
def type_defaults(t: Tables):
    declared = {"as_varchar": "varchar(9)", "as_int": "int", "as_decimal": "double", "as_boolean": "boolean", "as_date": "date"}
    kinds = {"as_varchar": "string", "as_int": "int", "as_decimal": "double", "as_boolean": "boolean", "as_date": "date"}
    empty = t.supplier.select("s_suppkey", *[F.lit(None).cast(k).alias(c) for c, k in kinds.items()])
    return replace_missing(empty, declared)


@query("c8_trim_strings", "SELECT doc_id, trim(text, ' ') AS text, lang, source, n_chars FROM documents")
def trimmed(t: Tables):
    padded = t.documents.withColumns({"lang": F.concat(F.lit("  "), "lang"), "source": F.concat("source", F.lit(" "))})
    return trim_strings(padded)


@query(
    "c9_case_insensitive_keys",
    """SELECT p_partkey, p_brand, largest FROM part
       LEFT JOIN (SELECT lower(p_brand) AS k, max(p_size) AS largest FROM part WHERE p_type = 'ECONOMY' GROUP BY 1) ON lower(p_brand) = k""",
)
def case_insensitive(t: Tables):
    """The looked-up table writes its key in another case."""
    sizes = t.part.where("p_type = 'ECONOMY'").groupBy(F.upper("p_brand").alias("brand")).agg(F.max("p_size").alias("largest"))
    rows = fold_case(t.part.select("p_partkey", "p_brand", F.col("p_brand").alias("folded")), ["folded"], False)
    return lookup(rows, fold_case(sizes, ["brand"], False), {"folded": "brand"}, {"largest": "largest"}).drop("folded")


@query("c10_date_format", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS plain, CAST(o_orderdate AS DATE) AS with_pattern FROM orders")
def date_formats(t: Tables):
    texts = t.orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("plain"),
        F.date_format("o_orderdate", "MM.dd.yyyy").alias("with_pattern"),
    )
    return coerce(texts, {"plain": "date", "with_pattern": "date"}, {"with_pattern": "MM.dd.yyyy"})


@query(
    "t1_conform_source",
    """SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, l_discount, CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DOUBLE) AS l_extendedprice,
              CAST(l_quantity AS SMALLINT)::INTEGER AS l_quantity, l_returnflag FROM lineitem""",
)
def source_conformed(t: Tables):
    declared = {
        "l_orderkey": "identity",
        "l_linenumber": "integer",
        "l_discount": "smallfloat",
        "l_extendedprice": "currency",
        "l_quantity": "smallint",
        "l_returnflag": "nvarchar",
    }
    rows = conform_source(t.lineitem, declared)
    return doubles(rows, "l_extendedprice").withColumn("l_quantity", F.col("l_quantity").cast("int"))


_TARGET = {"p_partkey": "bigint", "p_name": "varchar(8)", "p_brand": "varchar(20)", "p_retailprice": "decimal(6,2)", "p_size": "tinyint"}


@query(
    "t2_conform_target",
    """SELECT p_partkey, substr(p_name, 1, 8) AS p_name, p_brand, CAST(CASE WHEN p_retailprice < 10000 THEN p_retailprice END AS DOUBLE) AS p_retailprice,
              CAST(p_size AS INTEGER) AS p_size FROM part""",
)
def target_conformed(t: Tables):
    rows = conform_target(t.part, _TARGET, allow_losses=True)
    return doubles(rows, "p_retailprice").withColumn("p_size", F.col("p_size").cast("int"))


@query("t2_long_texts", "SELECT p_partkey, rpad(p_name, 400, 'x') AS long_name FROM part")
def long_texts(t: Tables):
    """A text type keeps its source length, so long texts come through whole."""
    rows = t.part.select("p_partkey", F.rpad("p_name", 400, "x").alias("long_name"))
    return conform_target(rows, {"p_partkey": "bigint", "long_name": derive_target_type("varchar", 400)})


@query(
    "t2_conform_losses",
    """SELECT 'o_orderkey' AS column_name, CAST(0 AS BIGINT) AS cut, count(CASE WHEN o_orderkey > 127 THEN 1 END) AS lost FROM orders
       UNION ALL SELECT 'o_orderpriority', count(CASE WHEN length(o_orderpriority) > 6 THEN 1 END), 0 FROM orders
       UNION ALL SELECT 'o_totalprice', 0, count(CASE WHEN o_totalprice >= 99999.995 THEN 1 END) FROM orders""",
)
def losses(t: Tables):
    return conform_losses(t.orders, {"o_orderkey": "tinyint", "o_orderpriority": "varchar(6)", "o_totalprice": "decimal(7,2)"})


@query(
    "t3_key_report",
    """WITH d AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1),
       p AS (SELECT count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) GROUP BY l_partkey)
       SELECT 'primary key l_orderkey,l_linenumber' AS check_name, count(*) AS bad_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS bad_rows FROM d
       UNION ALL SELECT 'foreign key l_partkey', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) FROM p
       UNION ALL SELECT 'foreign key l_orderkey', 0, 0""",
)
def keys_checked(t: Tables):
    parents = {"l_partkey": (t.part.where("p_size <= 40"), "p_partkey"), "l_orderkey": (t.orders, "o_orderkey")}
    return longs(key_report(t.lineitem, ["l_orderkey", "l_linenumber"], parents), "bad_keys", "bad_rows")


@query(
    "t5_system_columns",
    """SELECT c_custkey AS Id, c_name AS Name, 'crm' AS DataSource_Id, 'acme' AS Company_Id,
              row_number() OVER (ORDER BY c_custkey) AS Customer_Key FROM customer""",
)
def system_columns(t: Tables):
    from weftmart.operators.keys import surrogate_keys

    base = WarehouseSpec("Customer", "D", (ColumnMap("Id", "bigint", "c_custkey", "PK"), ColumnMap("Name", "varchar(50)", "c_name")))
    spec = with_system_columns(base, "crm", "acme")
    return surrogate_keys(source_rows(t.customer, spec), None, spec.keys, spec.surrogate)


@query(
    "t6_incremental_tags",
    """SELECT o_orderkey, md5(concat_ws(chr(1), CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority)) AS HashValue FROM orders""",
)
def incremental_tags(t: Tables):
    columns = (
        ColumnMap("o_orderkey", "bigint", "o_orderkey", "PK"),
        ColumnMap("o_custkey", "bigint", "o_custkey"),
        ColumnMap("o_orderstatus", "char(1)", "o_orderstatus"),
        ColumnMap("o_orderpriority", "varchar(20)", "o_orderpriority"),
    )
    spec = tag_incremental(WarehouseSpec("Orders", "D", columns), previous_kind="T")
    return with_change_hash(t.orders, spec.change_columns).select("o_orderkey", "HashValue")


@query("t7_purge_orphans", "SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= -500)")
def purged(t: Tables):
    return purge_orphans(t.orders, t.customer.where("c_acctbal >= -500"), {"o_custkey": "c_custkey"})


@query(
    "m3_key_violations",
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count, 'duplicate' AS issue FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def violations(t: Tables):
    return key_violations(t.lineitem, ["l_orderkey", "l_linenumber"])
