"""What the physical plans of the queries must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from weftmart.operators.joins import exclude, flag_matches, keep_matching, lookup, not_in
from weftmart.operators.sinks import replace_by_key, save_bucketed, upsert
from weftmart.session import scratch_path

QUERIES = driver.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("f6_historical_range", "GreaterThanOrEqual(o_orderdate"),
        ("f7_incremental_date", "GreaterThanOrEqual(ts"),
        ("f3_trailing_months", "GreaterThanOrEqual(o_orderdate"),
        ("s1_select_source", "GreaterThan(o_totalprice"),
    ],
)
def test_windows_reach_the_scan(name, pushed, spark, folder):
    text = plan(QUERIES[name](spark, folder))
    assert pushed in text.split("PushedFilters:")[1]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_large_tables_never_meet_in_nested_loops(name, spark, folder, no_broadcast):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_at_a_time_python(name, spark, folder):
    text = plan(QUERIES[name](spark, folder))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_mart_reads_only_its_columns(spark, folder):
    text = plan(QUERIES["y1_mart_build"](spark, folder))
    assert "l_tax" not in text and "c_name" not in text and "o_totalprice" not in text


def test_bucketed_target_is_not_shuffled(spark, no_broadcast):
    path = scratch_path(spark, "bucketed")
    rows = spark.range(1000).selectExpr("id AS k", "id * 2 AS v")
    name = "t_" + path.rsplit("-", 1)[-1]
    target = save_bucketed(rows, name, path, ["k"], 8)
    text = plan(upsert(target, rows.where("k > 900"), ["k"]))
    assert text.count("Exchange hashpartitioning") == 1
    spark.sql(f"DROP TABLE {name}")


def test_delta_upsert_of_a_small_set_moves_nothing_large(spark):
    path = scratch_path(spark, "delta")
    spark.range(1000).selectExpr("id AS k", "id * 2 AS v").write.parquet(path)
    target = spark.read.parquet(path)
    text = plan(upsert(target, target.where("k > 990"), ["k"], strategy="delta"))
    assert "Exchange hashpartitioning" not in text


@pytest.fixture
def low_skew_limits(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.files.maxPartitionBytes": "200k",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_key_is_split(spark, low_skew_limits):
    """A third of the rows have one key; every join with a reduced side must let AQE split it."""
    path = scratch_path(spark, "hot")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    spark.range(0, 400000, 1, 16).select(key.alias("k"), F.xxhash64("id").alias("v")).write.parquet(path)
    rows = spark.read.parquet(path)
    other = spark.range(20000).selectExpr("id % 4000 AS k", "id AS o")
    renewed = other.where("k < 100").select("k", F.col("o").alias("v"))
    cases = {
        "exclude": exclude(rows, other, {"k": "k"}),
        "keep": keep_matching(rows, other, {"k": "k"}),
        "not in": not_in(rows, "k", other, "k"),
        "flag": flag_matches(rows, other, ["k"]),
        "first row": lookup(rows, other, {"k": "k"}, {"o": "first"}, ["o"]),
        "plain lookup": lookup(rows, other.where("o < 4000"), {"k": "k"}, {"o": "found"}),
        "replace": replace_by_key(rows, renewed, ["k"]),
    }
    for name, result in cases.items():
        total = result.agg(F.sum(F.xxhash64(*result.columns).cast("decimal(38,0)")))
        total.collect()
        assert "skew=true" in plan(total), name


def test_checksums_of_keys_agree_across_number_types(spark):
    left = spark.range(10).selectExpr("cast(id AS int) AS k")
    right = spark.range(5).selectExpr("cast(id AS decimal(9,2)) AS d", "cast(id AS string) AS s")
    assert keep_matching(left, right, {"k": "d"}).count() == 5
    assert keep_matching(left, right, {"k": "s"}).count() == 5
