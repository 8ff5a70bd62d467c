import math

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F, types as T

from weftmart.session import scratch_path, shared_dir
from weftmart.sources.files import csv_source, file_source
from weftmart.sources.jdbc import (
    MART_BATCH_ROWS, block_count, block_of, key_range, partition_options, read_options, write_options,
)

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_corrupt_lines(spark):
    path = scratch_path(spark, "corrupt")
    spark.createDataFrame([("a,b",), ("1,x",), ("oops,y",)], "value string").coalesce(1).write.text(path)
    kept = csv_source(spark, path, SCHEMA, keep_corrupt=True).collect()
    assert [(r["a"], r["b"], r["_corrupt_record"]) for r in kept] == [(1, "x", None), (None, "y", "oops,y")]
    with pytest.raises(Exception):
        csv_source(spark, path, SCHEMA).collect()


def test_formats(spark):
    rows = spark.range(10).select(F.col("id").cast("int").alias("a"), F.col("id").cast("string").alias("b"))
    for kind in ("parquet", "orc"):
        path = scratch_path(spark, kind)
        rows.write.format(kind).save(path)
        assert sorted(map(tuple, file_source(spark, path, kind).collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(ValueError):
        file_source(spark, path, "xml")
    with pytest.raises(ValueError):
        file_source(spark, path, "csv")


@given(low=st.integers(-50, 50), width=st.integers(0, 200), blocks=st.integers(1, 20))
def test_blocks_are_disjoint_and_cover(low, width, blocks):
    high = low + width
    stride = max(1, math.ceil((high - low + 1) / blocks))
    placed = [(k - low) // stride + 1 for k in range(low, high + 1)]
    assert placed == sorted(placed) and placed[0] == 1 and placed[-1] <= blocks


def test_block_expression(spark):
    keys = spark.range(10, 110).withColumnRenamed("id", "k")
    low, high, rows = key_range(keys, "k")
    assert (low, high, rows) == (10, 109, 100)
    got = [r[0] for r in keys.select(block_of(F.col("k"), low, high, 3)).collect()]
    assert sorted(got) == [(k - 10) // 34 + 1 for k in range(10, 110)]


def test_jdbc_options():
    assert block_count(0) == 1 and block_count(40_001) == 2
    assert partition_options("id", 1, 5, 100) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "6", "numPartitions": "5"}
    assert read_options("jdbc:x", "t", **partition_options("id", 1, 5, 2))["dbtable"] == "t"
    assert write_options("jdbc:x", "t", MART_BATCH_ROWS)["batchsize"] == "25000"


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


class _Session:
    """Just what the shared folder asks of a session."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": master})


def test_only_local_sessions_get_a_temporary_folder():
    assert shared_dir(_Session("yarn", "hdfs://shared/")) == "hdfs://shared"
    assert shared_dir(_Session("local[2]")) == shared_dir(_Session("local[*]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("yarn"))


def test_lists_skip_nulls(spark):
    from weftmart.operators.aggregate import string_list

    rows = spark.createDataFrame([(1, None), (1, "b"), (1, "a"), (2, None), (None, "c")], "k int, v string")
    assert {r["k"]: r["t"] for r in string_list(rows, ["k"], "v", "t").collect()} == {1: "a,b", 2: None, None: "c"}
