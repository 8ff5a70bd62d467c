"""Proposed keys and references."""

import random
from itertools import combinations

from weftmart.operators.discovery import inclusions, proposed_tags, unique_sets
from weftmart.queries.discovery import _COLUMNS


def test_tags_of_the_tables(spark, folder):
    tables = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in _COLUMNS}
    tags = proposed_tags(tables, _COLUMNS)
    keys = {(t, c) for t, c, tag, _ in tags if tag == "PK"}
    assert {("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"), ("orders", "o_orderkey")} <= keys
    assert {("conversations", "conv_id"), ("conversations", "turn")} <= keys
    wanted = {("nation", "n_regionkey", "region.r_regionkey"), ("customer", "c_nationkey", "nation.n_nationkey"), ("supplier", "s_nationkey", "nation.n_nationkey")}
    wanted |= {("orders", "o_custkey", "customer.c_custkey"), ("lineitem", "l_orderkey", "orders.o_orderkey"), ("lineitem", "l_suppkey", "supplier.s_suppkey")}
    assert {(t, c, p) for t, c, tag, p in tags if tag == "FK"} == wanted


def test_minimal_sets_equal_brute_force(spark):
    rng = random.Random(9)
    for _ in range(4):
        rows = [tuple(rng.choice([*range(k), None]) if k == 5 else rng.randrange(k) for k in (2, 5, 8, 30, 30)) for _ in range(40)]
        names = list("abcde")
        wanted = []
        for size in (1, 2, 3):
            for some in combinations(range(5), size):
                picked = [tuple(r[i] for i in some) for r in rows]
                unique = len(set(picked)) == len(rows) and not any(v is None for p in picked for v in p)
                if unique and not any(set(w) <= {names[i] for i in some} for w in wanted):
                    wanted.append(tuple(names[i] for i in some))
        df = spark.createDataFrame(rows, "a int, b int, c int, d long, e int")
        assert sorted(unique_sets(df)) == sorted(wanted)
    assert unique_sets(df.limit(0)) == [] and unique_sets(spark.createDataFrame([(1.5,)], "x double")) == []


def test_inclusions_across_types(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, code string")
    child = spark.createDataFrame([(1, "a", "1"), (2, None, "2"), (None, "c", "x")], "ref int, code string, text string")
    child = child.withColumn("amount", child["ref"].cast("decimal(10,2)"))
    found = inclusions({"p": parent, "q": child}, {"p": ["id", "code"]})
    assert {(r.table_name, r.column_name, r.parent_column, r.n_values, r.n_parent) for r in found.collect()} == {("q", "ref", "id", 2, 3), ("q", "amount", "id", 2, 3)}
