"""Digests of key ranges, and versions valid at a time, against plain comparisons."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from weftmart.operators.diff import SAME, keyed_diff
from weftmart.operators.digests import changed_rows, deleted_keys_by_range, differing_rows, digest
from weftmart.operators.history import ACTIVE, VALID_FROM, VALID_TO, track_history, valid_at
from weftmart.session import configure, scratch_path


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("key", ["id", "concat('k', id)", "date_add(date'2020-01-01', cast(id as int))", "cast(id as decimal(20,3))", "if(id = 3, null, id)"])
def test_changed_rows_equal_the_keyed_difference(spark, key):
    configure(spark)
    old = spark.range(0, 3000).selectExpr(f"{key} AS k", "id % 7 AS v", "if(id % 5 = 0, null, 'x') AS w", "id")
    new = old.where("id % 400 <> 1").unionByName(spark.range(3000, 3010).selectExpr(f"{key} AS k", "id % 7 AS v", "'x' AS w", "id"))
    new = new.withColumn("w", F.expr("if(id % 500 = 0, 'changed', w)")).withColumn("v", F.expr("if(id = 90, null, v)"))
    old, new = old.drop("id"), new.drop("id")
    wanted = rows(keyed_diff(new, old, ["k"]).where(F.col("change") != SAME).where("k IS NOT NULL"))
    kept = digest(old, ["k"], ["v", "w"], scratch_path(spark, "digest"), fan=8, levels=3)
    for how in ({}, {"fan": 4, "levels": 3}, {"stored": kept}):
        assert rows(changed_rows(new, old, ["k"], **how).where("k IS NOT NULL")) == wanted
    gone = rows(old.select("k").join(new.select("k"), "k", "left_anti").where("k IS NOT NULL"))
    assert rows(deleted_keys_by_range(old, new, ["k"]).where("k IS NOT NULL")) == gone


def test_equal_ranges_are_not_compared_row_by_row(spark):
    old = spark.range(100_000).selectExpr("id", "id * 2 AS v")
    new = old.withColumn("v", F.expr("if(id BETWEEN 50000 AND 50020, 0, v)"))
    for stored in (None, digest(old, ["id"], ["v"], scratch_path(spark, "digest"))):
        here, there = differing_rows(new, old, ["id"], ["v"], stored=stored)
        assert 0 < here.count() == there.count() <= 2 * 100_000 / 64**2 + 2
        text = here._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert changed_rows(old, old, ["id"]).count() == 0


def test_repeated_and_missing_rows(spark):
    some = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    once = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    here, there = differing_rows(some, once, ["k"], ["v"])
    assert rows(here) == [(1, "a"), (1, "a")] and rows(there) == [(1, "a")]
    assert rows(changed_rows(once.limit(0), once, ["k"])) == rows(once.selectExpr("k", "'D' AS change", "v"))
    assert rows(changed_rows(once, once.limit(0), ["k"])) == rows(once.selectExpr("k", "'I' AS change", "v"))
    # null and value change places
    swapped = spark.createDataFrame([(1, "x", None)], "k int, a string, b string"), spark.createDataFrame([(1, None, "x")], "k int, a string, b string")
    assert changed_rows(*swapped, ["k"]).count() == 1
    with pytest.raises(ValueError):
        deleted_keys_by_range(once, once.limit(0), ["k"])


def plain_lookup(facts, versions):
    out = []
    for key, at, n in facts:
        fitting = [(s, v) for k, s, v in versions if k == key and key is not None and at is not None and s is not None and s <= at]
        out.append((key, at, n, max(fitting, default=(None, None))[1]))
    return sorted(out, key=repr)


def test_lookups_by_time_span_partitions(spark):
    configure(spark)
    rng, day = random.Random(3), dt.datetime(2024, 1, 1)
    hot = [("hot", day + dt.timedelta(hours=h), h) for h in range(0, 2000, 3)]
    versions = [*hot, *((f"k{i % 40}", day + dt.timedelta(hours=i * 7 % 1900), i) for i in range(0, 400)), ("k1", None, -1), (None, day, -2)]
    versions = list({(k, s): (k, s, v) for k, s, v in versions}.values())
    facts = [(rng.choice(["hot", "hot", "none", None, *(f"k{i}" for i in range(40))]), rng.choice([None, *[day + dt.timedelta(hours=rng.randrange(-50, 2100)) for _ in range(9)]]), i) for i in range(3000)]
    f = spark.createDataFrame(facts, "key string, at timestamp_ntz, n int")
    v = spark.createDataFrame(versions, "k string, s timestamp_ntz, v int")
    got = valid_at(f.repartition(5), v, {"key": "k"}, "at", "s", {"v": "found"})
    assert rows(got) == plain_lookup(facts, versions)
    assert valid_at(f, v.limit(0), {"key": "k"}, "at", "s", {"v": "found"}).where("found IS NOT NULL").count() == 0
    assert valid_at(f.limit(0), v, {"key": "k"}, "at", "s", {"v": "found"}).count() == 0


def test_history_closes_and_opens_versions(spark):
    configure(spark)
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    load = lambda values: spark.createDataFrame(values, "k int, v string")
    history = track_history(None, load([(1, "a"), (2, "b"), (3, None)]), ["k"], days[0])
    history = track_history(history, load([(1, "a"), (2, "c"), (4, "d")]), ["k"], days[1])
    history = track_history(history, load([(3, "e"), (2, "c")]), ["k"], days[2], complete=False)
    assert rows(history.select("k", "v", VALID_FROM, VALID_TO, ACTIVE)) == sorted(
        [
            (1, "a", days[0], None, 1), (2, "b", days[0], days[1], 0), (2, "c", days[1], None, 1),
            (3, None, days[0], days[1], 0), (3, "e", days[2], None, 1), (4, "d", days[1], None, 1),
        ], key=repr,
    )
