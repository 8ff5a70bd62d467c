import datetime as dt
import sqlite3

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftmart.session import scratch_path
from weftmart.sources.batched import FolderTarget, batches_of, write_batched
from weftmart.sources.blocks import Block, arrow_condition, key_blocks, parquet_fetch, read_blocks, sql_condition


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, keys dense at one end, null keys."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 50 == 1, None).when(n % 10 == 1, n * 1000).otherwise(n % 400)
    rows = spark.range(30_000).select(key.cast("long").alias("k"), n.alias("n"), (n % 11).cast("int").alias("v"))
    path = scratch_path(spark, "skewed")
    rows.write.parquet(path)
    return spark.read.parquet(path), path


def test_every_row_in_one_block_of_fair_size(spark, skewed):
    rows, path = skewed
    fetch = parquet_fetch(path, ["k", "n", "v"])
    blocks = key_blocks(rows, "k", 12, "n")
    read = read_blocks(spark, "test_fair", rows.schema, blocks, fetch)
    assert read.rdd.getNumPartitions() == len(blocks)
    assert sorted(read.select("n").toArrow()["n"].to_pylist()) == list(range(30_000))
    sizes = sorted(r[0] for r in read.groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)").collect())
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]
    # by the key alone one block holds the hot third
    alone = read_blocks(spark, "test_alone", rows.schema, key_blocks(rows, "k", 12), fetch)
    assert alone.count() == 30_000
    assert max(r[1] for r in alone.groupBy(F.spark_partition_id()).agg(F.count("*")).collect()) >= 10_000


@pytest.mark.parametrize(
    ("where", "conditions"),
    [
        ("k = 7 AND v < 3", [("k", "=", 7), ("v", "<", 3)]),
        ("k > 100000", [("k", ">", 100_000)]),
        ("k IS NULL", [("k", "null", None)]),
        ("k IN (3, 7, 12)", [("k", "in", [3, 7, 12])]),
        ("k <= 5 AND v >= 10", [("k", "<=", 5), ("v", ">=", 10)]),
        ("k < 0", [("k", "<", 0)]),
        ("k > 5 AND k < 5", [("k", ">", 5), ("k", "<", 5)]),
        ("k IS NOT NULL AND n < 100", [("k", "not null", None), ("n", "<", 100)]),
    ],
)
def test_conditions_change_no_row(spark, skewed, where, conditions):
    rows, path = skewed
    read = read_blocks(spark, "test_where", rows.schema, key_blocks(rows, "k", 12, "n"), parquet_fetch(path, ["k", "n", "v"]), conditions)
    assert sorted(r["n"] for r in read.collect()) == sorted(r["n"] for r in rows.where(where).collect())


def test_conditions_drop_blocks(spark, skewed):
    rows, path = skewed
    blocks = key_blocks(rows, "k", 12, "n")
    read = read_blocks(spark, "test_drop", rows.schema, blocks, parquet_fetch(path, ["k", "n", "v"]), [("k", ">", 100_000)])
    assert read.rdd.getNumPartitions() < len(blocks) / 2


def test_one_frame_under_several_filters(spark, skewed):
    rows, path = skewed
    read = read_blocks(spark, "test_reuse", rows.schema, key_blocks(rows, "k", 12, "n"), parquet_fetch(path, ["k", "n", "v"]))
    assert read.where("v < 3").count() == rows.where("v < 3").count()
    assert read.count() == 30_000
    assert read.where("k = 7").join(read.where("k = 1"), "v").count() == rows.where("k = 7").join(rows.where("k = 1"), "v").count()


def test_blocks_of_odd_tables(spark):
    empty = spark.createDataFrame([], "k long, n long")
    assert [b.conditions for b in key_blocks(empty, "k", 4, "n")] == [(("k", "not null", None),), (("k", "null", None),)]
    one = spark.createDataFrame([(1, None)] * 50, "k long, n long")
    covered = [r for b in key_blocks(one, "k", 4, "n") for r in pa.table({"k": [1] * 50, "n": pa.array([None] * 50, pa.int64())}).filter(arrow_condition(b.conditions)).to_pylist()]
    assert len(covered) == 50
    days = spark.range(100).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("d"))
    assert len(key_blocks(days, "d", 4)) == 5
    with pytest.raises(ValueError, match="whole numbers"):
        key_blocks(spark.createDataFrame([(1.0,)], "k double"), "k", 4)


def test_conditions_as_sql():
    rows = [(k, k % 3) for k in range(20)] + [(None, 1)]
    base = sqlite3.connect(":memory:")
    base.execute('CREATE TABLE t ("a""b" INTEGER, n INTEGER)')
    base.executemany("INSERT INTO t VALUES (?, ?)", rows)
    for conditions in ([('a"b', ">", 3), ('a"b', "<=", 9)], [('a"b', "null", None)], [("n", "in", [0, 2]), ('a"b', "not null", None)], []):
        text, values = sql_condition(conditions)
        got = base.execute(f"SELECT * FROM t WHERE {text}", values).fetchall()
        expression = arrow_condition(conditions)
        table = pa.table({'a"b': [r[0] for r in rows], "n": [r[1] for r in rows]})
        want = table.filter(expression) if expression is not None else table
        assert sorted(got, key=repr) == sorted(map(tuple, (r.values() for r in want.to_pylist())), key=repr)
    assert Block((("a", "=", 1),)) == Block((("a", "=", 1),))


def test_batches_have_the_stated_size():
    parts = [pa.record_batch({"x": list(range(s, s + n))}) for s, n in ((0, 3), (3, 0), (3, 9), (12, 1))]
    got = [b["x"].to_pylist() for b in batches_of(iter(parts), 4)]
    assert got == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10, 11], [12]]


def test_a_failed_task_leaves_no_rows(spark):
    target = FolderTarget(scratch_path(spark, "target"))
    rows = spark.range(0, 1000, 1, 4)
    write_batched(rows, target, "a", batch_rows=100)

    def breaks(batches):
        for batch in batches:
            if 900 in batch["id"].to_pylist():
                raise RuntimeError("lost")
            yield batch

    with pytest.raises(Exception, match="lost"):
        write_batched(rows.mapInArrow(breaks, "id long"), target, "b", batch_rows=100)
    assert target.rows(spark, rows.schema).count() == 1000 and not target.published("b")
    # started again, it adds its rows once
    for _ in range(2):
        write_batched(rows, target, "b", batch_rows=100)
    assert target.rows(spark, rows.schema).count() == 2000
    write_batched(rows.limit(5), target, "c", replace=True)
    assert target.rows(spark, rows.schema).count() == 5
    write_batched(rows.limit(0), target, "d", replace=True)
    assert target.rows(spark, rows.schema).count() == 0


def test_a_second_commit_publishes_nothing(spark):
    from weftmart.sources.batched import _Writer

    target = FolderTarget(scratch_path(spark, "target"))
    for _ in range(2):
        writer = _Writer(target, "a", 10, False)
        writer.commit([writer.write(iter([pa.record_batch({"id": [1, 2]})])), writer.write(iter([]))])
    assert target.rows(spark, spark.range(1).schema).count() == 2
    with pytest.raises(ValueError):
        write_batched(spark.range(1), target, "b", batch_rows=0)
