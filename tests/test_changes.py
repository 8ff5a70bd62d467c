"""Change sets and journaled runs: bytes written, failures at every step, compaction."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from weftmart.operators.changesets import ChangeSets, Journal
from weftmart.operators.sinks import upsert
from weftmart.plans.changes import ChangeRuns
from weftmart.queries.extraction import settings
from weftmart.queries.snapshots import FIRST_LOAD, SECOND_LOAD
from weftmart.queries.warehouse import CUSTOMER, ORDERS
from weftmart.session import configure, scratch_path, scratch_scope


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path.removeprefix("file://")) for f in files if f.endswith(".parquet"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def journal(spark):
    configure(spark)
    return Journal(spark, scratch_path(spark, "journal"))


def test_a_small_window_writes_little(spark, journal):
    table = ChangeSets(journal, "t", ("k",))
    wide = [F.sha2((F.col("id") + i).cast("string"), 256).alias(f"v{i}") for i in range(4)]
    table.commit("1", lambda: spark.range(100_000).select(F.col("id").alias("k"), *wide))
    table.compact("base")
    before = size(journal.path)
    window = spark.range(0, 100_000, 100).select(F.col("id").alias("k"), F.lit("new").alias("v0"))
    table.merge("2", window, lambda old, new: upsert(old, new, ["k"]))
    assert size(journal.path) - before < 0.03 * before / 2
    assert table.rows().where("v0 = 'new'").count() == 1000 and table.rows().count() == 100_000
    # rows that stay as they are are not written again
    again = table.merge("3", window, lambda old, new: upsert(old, new, ["k"]))
    assert again.count() == 0


def test_null_keys_and_deletes(spark, journal):
    table = ChangeSets(journal, "t", ("a", "b"))
    first = spark.createDataFrame([(1, None, "x"), (None, "p", "y"), (2, "q", "z")], "a int, b string, v string")
    table.commit("1", lambda: first)
    table.commit("2", lambda: spark.createDataFrame([(1, None, "X")], first.schema))
    table.remove("3", spark.createDataFrame([(None, "p")], "a int, b string"))
    wanted = [(1, None, "X"), (2, "q", "z")]
    assert rows(table.rows()) == rows(table.compact("base")) == rows(table.rows()) == sorted(wanted, key=repr)
    table.commit("4", lambda: first.where("v = 'y'"))
    assert len(rows(table.rows())) == 3


def test_a_committed_run_is_not_done_again(spark, journal):
    table = ChangeSets(journal, "t", ("id",))
    table.commit("1", lambda: spark.range(5))
    assert table.commit("1", lambda: spark.range(9)).count() == 5
    with pytest.raises(LookupError):
        ChangeSets(journal, "other", ("id",)).rows()


def test_changed_keys_do_not_shuffle_the_base(spark, journal):
    table = ChangeSets(journal, "t", ("id",))
    table.commit("1", lambda: spark.range(20_000).withColumn("v", F.lit(1)))
    table.compact("base")
    table.commit("2", lambda: spark.range(3).withColumn("v", F.lit(2)))
    text = table.rows()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


class Stop(Exception):
    pass


class Failing(Journal):
    """Fails in place of its n-th new step."""

    left = None

    def step(self, run, step, build):
        if self.left is not None and self.found(run, step) is None:
            if self.left == 0:
                raise Stop
            self.left -= 1
        return super().step(run, step, build)


@pytest.mark.parametrize("spec", [CUSTOMER, ORDERS], ids=["dimension", "transactions"])
def test_a_run_resumes_at_every_step(spark, folder, spec):
    configure(spark)
    source = spark.read.parquet(f"{folder}/{'customer' if spec is CUSTOMER else 'orders'}.parquet")
    key, number = ("c_custkey", "c_acctbal") if spec is CUSTOMER else ("o_orderkey", "o_totalprice")
    before = source.where(f"{key} % 10 <> 0")
    after = source.where(f"{key} % 7 <> 0").withColumn(number, F.when(F.col(key) % 3 == 0, F.col(number) + 1).otherwise(F.col(number)))
    customers = {"Customer": spark.range(50).selectExpr("id AS Customer_Id", "id + 1 AS Customer_Key")}
    chosen = settings(write_mode="upsert", delete_flag=True)

    def tables(journal):
        runs = ChangeRuns(journal, spec)
        parts = [runs.staging.rows(), runs.warehouse.rows(), runs.deletes()] + ([] if spec is CUSTOMER else [runs.key_table.rows()])
        return [rows(p) for p in parts]

    whole = Journal(spark, scratch_path(spark, "journal"))
    ChangeRuns(whole, spec).run("1", before, chosen, FIRST_LOAD, customers)
    ChangeRuns(whole, spec).run("2", after, chosen, SECOND_LOAD, customers)
    wanted, steps = tables(whole), len([e for e in whole.entries() if e.run.startswith("2")])
    assert wanted[2]
    # one journal that fails again and again, each time one step later
    path = scratch_path(spark, "journal")
    ChangeRuns(Journal(spark, path), spec).run("1", before, chosen, FIRST_LOAD, customers)
    for _ in range(steps):
        journal = Failing(spark, path)
        journal.left = 1
        try:
            ChangeRuns(journal, spec).run("2", after, chosen, SECOND_LOAD, customers)
        except Stop:
            continue
    assert tables(Journal(spark, path)) == wanted
    ChangeRuns(Journal(spark, path), spec).run("2", source.limit(0), chosen, SECOND_LOAD, customers)
    assert tables(Journal(spark, path)) == wanted


def test_scratch_tables_of_a_run_are_removed(spark):
    with scratch_scope(spark):
        path = scratch_path(spark, "gone")
        spark.range(3).write.parquet(path)
        assert os.path.isdir(path.removeprefix("file://"))
    assert not os.path.isdir(path.removeprefix("file://"))


def test_watermark_and_surrogates_go_on(spark, journal):
    runs = ChangeRuns(journal, CUSTOMER)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    chosen = settings(write_mode="upsert", delete_flag=True)
    load = lambda run, keys, day: runs.run(run, spark.createDataFrame([(k, "n", 1, 1.0, "s") for k in keys], schema), chosen, (dt.datetime(2024, 1, day), "u"))
    load("1", [1, 2, 3], 1)
    load("2", [1, 2], 2)
    load("3", [1, 2, 4], 3)
    # the number of a deleted customer is not given out again
    assert {r.Customer_Id: r.Customer_Key for r in runs.warehouse.rows().collect()} == {1: 1, 2: 2, 4: 4}


def test_a_window_writes_only_its_groups(spark, journal):
    from weftmart.plans.mart_changes import MartStates
    from weftmart.spec import mart_from_json

    text = """{"name": "m", "tables": [{"name": "t", "alias": "t", "role": "driving", "columns": {"g": "g", "v": "v"}}],
      "derived_step": {"flow": "G", "condition": "count(v) > 1 and max(v) < 1000", "columns": [{"column": "g"},
        {"column": "v", "aggregate": "Sum", "alias": "total"}, {"column": "v", "aggregate": "Var_Samp", "alias": "spread"}]}}"""
    states = MartStates(journal, mart_from_json(text))
    rows_of = lambda pairs: {"t": spark.createDataFrame(pairs, "g string, v long")}
    first = [(f"g{i % 50}", i) for i in range(500)] + [(None, 1), (None, 3), ("one", 5), ("nulls", None)]
    states.apply("1", None, rows_of(first))
    states.apply("2", rows_of([("g7", 7), ("one", 5)]), rows_of([("g7", 9), ("new", 4), ("new", 6), ("nulls", None)]))
    written = journal.found("2", "groups")
    assert {r.g for r in written.collect()} == {"g7", "one", "new", "nulls"}
    now = [p for p in first if p not in [("g7", 7), ("one", 5)]] + [("g7", 9), ("new", 4), ("new", 6)]
    wanted = spark.createDataFrame(now, "g string, v long").groupBy("g").agg(F.sum("v"), F.round(F.var_samp("v"), 6), F.count("v"))
    wanted = sorted((tuple(r)[:3] for r in wanted.collect() if r[3] > 1), key=repr)
    assert rows(states.mart().withColumn("spread", F.round("spread", 6))) == wanted
    # a window that is brought in again changes nothing
    states.apply("2", None, rows_of([("g1", 1)]))
    assert rows(states.mart().withColumn("spread", F.round("spread", 6))) == wanted
    with pytest.raises(ValueError, match="kept aggregates"):
        MartStates(journal, mart_from_json(text.replace("count(v)", "percentile(v, 0.5)")))


def test_versions_are_compared_by_the_columns_and_keys_asked_for(spark, tmp_path):
    table = ChangeSets(Journal(spark, str(tmp_path / "asked")), "t", ("id",))
    kind = "id long, v long, word string"
    table.commit("1", lambda: spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (None, 3, "c")], kind))
    table.commit("2", lambda: spark.createDataFrame([(2, 20, "bb"), (4, 40, "d")], kind))
    table.remove("3", spark.createDataFrame([(1,)], "id long"))
    every = {tuple(r) for r in table.rows().collect()}
    assert every == {(2, 20, "bb"), (None, 3, "c"), (4, 40, "d")}
    assert {tuple(r) for r in table.rows(["v"]).collect()} == {r[:2] for r in every}
    # a column that is not asked for is not read, so not shuffled either
    assert "word#" not in table.rows(["v"])._jdf.queryExecution().executedPlan().toString()
    wanted = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    assert {tuple(r) for r in table.rows(wanted=wanted).collect()} == {r for r in every if r[0] in (2, None)}
    assert {tuple(r) for r in table.rows_of(wanted, null_safe=False).collect()} == {(2, 20, "bb")}
    # rows that lie by their keys meet others by them without another shuffle
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.rows_of(wanted, null_safe=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2
