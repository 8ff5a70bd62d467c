import datetime as dt

from weftmart.session import scratch_path
from weftmart.streaming.incremental import merge_stream

SCHEMA = "k int, at timestamp_ntz, v string"


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_batches_late_rows_and_resume(spark):
    path = scratch_path(spark, "stream-test")

    def run():
        schema = spark.createDataFrame([], SCHEMA).schema
        merged = merge_stream(spark, f"{path}/in", schema, ["k"], ["at"], f"{path}/state", f"{path}/ck", files_per_batch=1)
        return {r["k"]: r["v"] for r in merged.collect()}

    day = [dt.datetime(2024, 1, d) for d in range(1, 10)]
    land(spark, f"{path}/in", [(1, day[2], "b"), (1, day[1], "a"), (2, day[2], "x")])
    land(spark, f"{path}/in", [(2, day[1], "late"), (3, day[4], "new")])
    assert run() == {1: "b", 2: "x", 3: "new"}
    assert run() == {1: "b", 2: "x", 3: "new"}
    land(spark, f"{path}/in", [(1, day[5], "c")])
    assert run() == {1: "c", 2: "x", 3: "new"}


def test_keyed_state_over_batches_and_a_restart(spark):
    from weftmart.operators.changesets import ChangeSets, Journal
    from weftmart.streaming.keyed import merge_newest

    path = scratch_path(spark, "keyed-test")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        table = ChangeSets(Journal(spark, f"{path}/table"), "newest", ("k",))
        merge_newest(spark, f"{path}/in", schema, table, ["at", "v"], f"{path}/ck", files_per_batch=1)
        return {r["k"]: (r["at"], r["v"]) for r in table.rows().collect()}, len(table.journal.entries())

    day = [dt.datetime(2024, 1, d) for d in range(1, 10)]
    land(spark, f"{path}/in", [(1, day[2], "b"), (1, day[1], "a"), (2, day[2], "x"), (4, None, "no time")])
    land(spark, f"{path}/in", [(2, day[1], "late"), (3, day[4], "new"), (1, day[2], "b"), (1, day[2], "a tie")])
    wanted = {1: (day[2], "b"), 2: (day[2], "x"), 3: (day[4], "new"), 4: (None, "no time")}
    assert run()[0] == wanted
    before = run()
    assert before[0] == wanted
    land(spark, f"{path}/in", [(1, day[5], "c"), (2, day[0], "older"), (4, day[0], "a time")])
    now, steps = run()
    assert now == wanted | {1: (day[5], "c"), 4: (day[0], "a time")} and steps == before[1] + 1


def test_late_rows_are_dropped_and_silent_keys_forgotten(spark):
    from weftmart.operators.changesets import ChangeSets, Journal
    from weftmart.streaming.keyed import merge_newest

    path = scratch_path(spark, "keyed-test")
    schema = spark.createDataFrame([], SCHEMA).schema
    table = ChangeSets(Journal(spark, f"{path}/table"), "newest", ("k",))
    day = [dt.datetime(2024, 1, d) for d in range(1, 20)]
    for rows in ([(1, day[0], "a"), (2, day[0], "b")], [(3, day[10], "c")], [(1, day[1], "too late"), (2, day[10], "b2"), (3, day[9], "older")]):
        land(spark, f"{path}/in", rows)
        merge_newest(spark, f"{path}/in", schema, table, ["at"], f"{path}/ck", time="at", delay="2 days")
    assert {r["k"]: r["v"] for r in table.rows().collect()} == {1: "a", 2: "b2", 3: "c"}
