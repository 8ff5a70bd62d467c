"""Properties of the operators on small made-up rows, next to a plain Python model."""

import datetime as dt
import uuid
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from weftmart.operators.aggregate import filter_group, group_by, last_row, string_list
from weftmart.operators.cleanse import coerce, replace_missing
from weftmart.operators.diff import apply_diff, keyed_diff, key_rules, key_violations, target_schema
from weftmart.operators.joins import deleted_rows, exclude, keep_matching, left_join, lookup, not_in
from weftmart.operators.keys import global_number, running_number, surrogate_keys
from weftmart.operators.project import clean_columns, clean_name
from weftmart.operators.sinks import delete_rows, full_sync, replace_by_key, stamped, upsert
from weftmart.queries.warehouse import CUSTOMER
from weftmart.spec import FilterGroup, GroupColumn

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TABLE = st.dictionaries(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 3)), max_size=10)
SCHEMA = "k int, v int"


def frame(spark, rows):
    return spark.createDataFrame(list(rows.items()) if isinstance(rows, dict) else rows, SCHEMA)


def collected(df):
    return Counter(tuple(r) for r in df.collect())


@SLOW
@given(old=TABLE, new=TABLE)
def test_upsert_and_diff(spark, old, new):
    before, incoming = frame(spark, old), frame(spark, new)
    wanted = Counter(({**old, **new}).items())
    for strategy in ("bulk", "delta"):
        once = upsert(before, incoming, ["k"], strategy=strategy)
        assert collected(once) == wanted
        assert collected(upsert(once, incoming, ["k"], strategy=strategy)) == wanted
    changes = keyed_diff(incoming, before, ["k"])
    labels = {r["k"]: r["change"] for r in changes.collect()}
    assert labels == {
        k: "I" if k not in old else "D" if k not in new else "=" if old[k] == new[k] else "U" for k in old.keys() | new.keys()
    }
    assert collected(apply_diff(before, changes, ["k"])) == Counter(new.items())
    assert collected(full_sync(before, incoming, ["k"])) == Counter(new.items())


@SLOW
@given(old=TABLE, live=TABLE.filter(bool))
def test_deletes_and_kept_rows_make_the_target(spark, old, live):
    target = frame(spark, old)
    gone = deleted_rows(target, frame(spark, live), ["k"])
    kept = delete_rows(target, gone, ["k"])
    assert collected(kept) + collected(gone.drop("DeleteIndicator")) == Counter(old.items())
    assert {r["k"] for r in kept.collect()} == old.keys() & live.keys()


def test_null_safe_deletes(spark):
    from weftmart.operators.joins import deleted_keys

    stored, live = frame(spark, [(None, 1), (1, 1), (2, 1)]), frame(spark, [(None, 1), (2, 5)])
    assert [r["k"] for r in deleted_keys(stored, live, ["k"], null_safe=True).collect()] == [1]
    assert {r["k"] for r in deleted_keys(stored, live, ["k"]).collect()} == {1, None}


def test_user_method(spark):
    import pandas as pd

    from weftmart.operators.derive import METHODS, call_method, register_method

    @F.pandas_udf("long")
    def product(a: pd.Series, b: pd.Series) -> pd.Series:
        return a * b

    register_method("product", lambda df, columns: product(*columns))
    assert [r["p"] for r in call_method(frame(spark, {3: 2}), "product", ["k", "v"], "p").collect()] == [6]
    del METHODS["product"]


def test_merge_needs_a_connector_with_row_operations(spark):
    from weftmart.operators.sinks import merge_into

    name = f"plain_{uuid.uuid4().hex}"
    frame(spark, {1: 1}).write.saveAsTable(name)
    with pytest.raises(Exception, match="MERGE|merge"):
        merge_into(name, frame(spark, {1: 2}), ["k"])
    spark.sql(f"DROP TABLE {name}")


def test_empty_extract_is_refused(spark):
    target = frame(spark, {1: 1})
    empty = frame(spark, {})
    with pytest.raises(ValueError, match="no rows"):
        deleted_rows(target, empty, ["k"])
    assert deleted_rows(target, empty, ["k"], allow_empty=True).count() == 1


@SLOW
@given(
    rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), max_size=12),
    others=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), max_size=5),
)
def test_exclusions(spark, rows, others):
    left, right = frame(spark, rows), frame(spark, others).withColumnRenamed("k", "other")
    keys = [k for k, _ in others]
    assert collected(exclude(left, right, {"k": "other"})) == Counter(r for r in rows if r[0] is None or r[0] not in keys)
    assert collected(keep_matching(left, right, {"k": "other"})) == Counter(r for r in rows if r[0] is not None and r[0] in keys)
    if not keys:
        wanted = rows
    elif None in keys:
        wanted = []
    else:
        wanted = [r for r in rows if r[0] is not None and r[0] not in keys]
    assert collected(not_in(left, "k", right, "other")) == Counter(wanted)


def hot_rows(spark, count=6000):
    """A third of the rows have one key, some have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 97)
    return spark.range(count).select(key.cast("int").alias("k"), (F.col("id") * 7919 % count).cast("int").alias("v"))


@pytest.fixture
def many_partitions(spark):
    """Tiny test rows stay in as many partitions as large ones would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_running_number_of_hot_keys(spark, many_partitions):
    rows = hot_rows(spark)
    got = running_number(rows, ["k"], ["v"], "n").collect()
    groups = {}
    for k, v in sorted(((r["k"], r["v"]) for r in rows.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        groups.setdefault(k, []).append(v)
    wanted = {(k, v, i + 1) for k, values in groups.items() for i, v in enumerate(values)}
    assert {tuple(r) for r in got} == wanted and len(got) == len(wanted)


def test_running_number_spans_partitions(spark, many_partitions):
    from weftmart.operators.keys import ranged

    parts = ranged(hot_rows(spark, 60000).where("k = 7"), ["k", "v"], "test").groupBy("__part").count().count()
    assert parts > 1


def test_global_number_is_dense(spark, many_partitions):
    numbered = global_number(hot_rows(spark).select("v"), ["v"], "n").orderBy("v").collect()
    assert [r["n"] for r in numbered] == list(range(1, 6001))


def test_surrogate_keys_continue(spark):
    first = surrogate_keys(frame(spark, {5: 0, 3: 0}), None, ["k"], "sk")
    second = surrogate_keys(frame(spark, {9: 0, 1: 0, 5: 0}), first, ["k"], "sk")
    assert {r["k"]: r["sk"] for r in first.collect()} == {3: 1, 5: 2}
    assert {r["k"]: r["sk"] for r in second.collect()} == {5: 2, 1: 3, 9: 4}
    again = surrogate_keys(frame(spark, {5: 0}), first, ["k"], "sk")
    assert {r["k"]: r["sk"] for r in again.collect()} == {5: 2}


def test_salted_join_equals_plain_join(spark):
    left = hot_rows(spark)
    right = spark.range(50).select(F.col("id").cast("int").alias("id"), (F.col("id") * 2).alias("w"))
    pairs = [("k", "id")]
    assert collected(left_join(left, right, pairs, 16)) == collected(left_join(left, right, pairs))


def test_join_refuses_shared_columns(spark):
    with pytest.raises(ValueError, match="share"):
        left_join(frame(spark, {1: 1}), frame(spark, {1: 1}), [("k", "k")])


def test_lookup_gives_one_row(spark):
    table = spark.createDataFrame([(1, 5, "b"), (1, 2, "a"), (2, 1, "c")], "id int, o int, t string")
    got = lookup(frame(spark, {1: 0, 2: 0, 3: 0}), table, {"k": "id"}, {"t": "text"}, ["o"])
    assert {r["k"]: r["text"] for r in got.collect()} == {1: "a", 2: "c", 3: None}


def test_stamps(spark):
    first, second = (dt.datetime(2024, 1, 1), "one"), (dt.datetime(2024, 2, 1), "two")
    start = stamped(frame(spark, {1: 1, 2: 2}), first)
    after = {r["k"]: r for r in upsert(start, frame(spark, {2: 3, 3: 3}), ["k"], second, date_only=True).collect()}
    assert (after[1]["Updated_Date"], after[1]["Updated_User"]) == first
    assert (after[2]["Added_Date"], after[2]["Added_User"]) == first
    assert (after[2]["Updated_Date"], after[2]["Updated_User"]) == (second[0], "one")
    assert (after[3]["Added_Date"], after[3]["Updated_User"]) == second


def test_replace_by_key_is_repeatable(spark):
    target, incoming = frame(spark, [(1, 1), (1, 2), (2, 1)]), frame(spark, [(1, 9)])
    once = replace_by_key(target, incoming, ["k"])
    assert collected(once) == collected(replace_by_key(once, incoming, ["k"])) == Counter([(1, 9), (2, 1)])


def test_last_row_keeps_nulls(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 1, "b")], "k int, o int, t string")
    assert collected(last_row(rows, ["k"], ["o"])) == Counter([(1, 2, None), (2, 1, "b")])


def test_having_sees_columns_before_grouping(spark):
    rows = frame(spark, [(1, 5), (1, 6), (2, 1)])
    step = FilterGroup("sum(v) > 10 and min(v) = 5", (GroupColumn("k"), GroupColumn("v", "Sum")), "G")
    assert collected(filter_group(rows, step)) == Counter([(1, 11)])
    braces = FilterGroup("max(concat('{', v)) <> '{x}'", (GroupColumn("k"), GroupColumn("v", "Sum")), "G")
    assert filter_group(rows, braces).count() == 2


def test_single_row_deviation_is_null(spark):
    got = group_by(frame(spark, {1: 5}), ["k"], {"s": ("Stddev_Samp", "v"), "r": ("Var_Samp", "v")}).first()
    assert got["s"] is None and got["r"] is None
    nan = spark.createDataFrame([(1, float("nan")), (1, 1.0)], "k int, v double")
    assert group_by(nan, ["k"], {"s": ("Stddev_Samp", "v")}).first()["s"] is None


def test_unknown_aggregate(spark):
    with pytest.raises(ValueError, match="unknown aggregate"):
        group_by(frame(spark, {1: 1}), ["k"], {"x": ("reflect", "v")})


def test_string_list_keeps_repeats_on_request(spark):
    rows = frame(spark, [(1, 2), (1, 2), (1, 1)])
    assert string_list(rows, ["k"], "v", "t").first()["t"] == "1,2"
    assert string_list(rows, ["k"], "v", "t", "|", distinct=False).first()["t"] == "1|2|2"


def test_key_violations_report_nulls(spark):
    got = {(r["k"], r["issue"], r["row_count"]) for r in key_violations(frame(spark, [(None, 1), (1, 1), (1, 2), (2, 1)]), ["k"]).collect()}
    assert got == {(None, "null", 1), (1, "duplicate", 2)}


def test_coercion_modes(spark):
    texts = spark.createDataFrame([("12.345", "2024-02-30"), ("x", "2024-02-29")], "n string, d string")
    got = coerce(texts, {"n": "decimal(5,2)", "d": "date"}).collect()
    assert [tuple(map(str, r)) for r in got] == [("12.35", "None"), ("None", "2024-02-29")]
    with pytest.raises(Exception):
        coerce(texts, {"n": "decimal(5,2)"}, strict=True).collect()


def test_blank_replacement_is_optional(spark):
    rows = spark.createDataFrame([(" ",), (None,), ("a",)], "t string")
    assert [r["t"] for r in replace_missing(rows, {"t": "varchar(5)"}, defaults={"varchar": "-"}).collect()] == ["-", "-", "a"]
    kept = replace_missing(rows, {"t": "varchar(5)"}, defaults={"varchar": "-"}, blank=False)
    assert [r["t"] for r in kept.collect()] == [" ", "-", "a"]


def test_names():
    assert clean_name("a b,c-d", [(" ", "_c_"), ("-", "x")]) == "a_b_c_c-d"
    assert clean_name("a.b", [(".", "_")]) == "a_b"


def test_colliding_names(spark):
    with pytest.raises(ValueError, match="collide"):
        clean_columns(spark.range(1).select(F.lit(1).alias("a b"), F.lit(2).alias("a_b")))


def test_key_rules():
    assert key_rules(["a", "b"], ["b", "c"]) == {"not_null": ["a"], "nullable": ["c"], "changed": ["a", "b"]}
    assert key_rules(["a"], ["a"])["changed"] == []


def test_target_schema():
    schema = target_schema(CUSTOMER)
    assert not schema["Customer_Id"].nullable and schema["Customer_Id"].metadata["default"] == "0"
    assert schema["Customer_Key"].dataType.typeName() == "long"
    assert "Source_Hash_Value" in schema.names
    assert "Source_Hash_Value" not in target_schema(CUSTOMER, "deletes").names


def test_siblings_of_a_level_are_not_visible(spark):
    from weftmart.operators.derive import derive
    from weftmart.spec import Derived

    with pytest.raises(ValueError, match="own level"):
        derive(frame(spark, {1: 1}), [Derived("a", "k + 1"), Derived("b", "a + 1")])
    shadow = derive(frame(spark, {1: 5}), [Derived("k", "k + 1"), Derived("w", "k + v")])
    assert tuple(shadow.first()) == (2, 5, 6)


def test_list_separators_are_text(spark):
    rows = frame(spark, [(1, 2), (1, 1)])
    for separator in ("'", "\\", "', 1) --"):
        assert string_list(rows, ["k"], "v", "t", separator).first()["t"] == f"1{separator}2"


def test_create_if_missing(spark):
    from weftmart.operators.diff import create_if_missing

    name = f"target_{uuid.uuid4().hex}"
    assert create_if_missing(spark, name, target_schema(CUSTOMER))
    assert not create_if_missing(spark, name, target_schema(CUSTOMER))
    assert spark.table(name).columns == target_schema(CUSTOMER).names
    spark.sql(f"DROP TABLE {name}")


def test_list_of_a_hot_key(spark, many_partitions):
    rows = hot_rows(spark, 3000)
    got = {r["k"]: r["t"] for r in string_list(rows, ["k"], "v", "t", "|", distinct=False, order_by=["v"]).collect()}
    groups = {}
    for k, v in sorted(((r["k"], r["v"]) for r in rows.collect()), key=lambda r: r[1]):
        groups.setdefault(k, []).append(str(v))
    assert got == {k: "|".join(values) for k, values in groups.items()}


def test_large_limits_are_taken_by_number(spark, many_partitions, monkeypatch):
    from weftmart.operators import sets

    rows = hot_rows(spark).select("v")
    small = [sets.first_rows(rows, 50, ["v"], d).collect() for d in ([], ["v"])]
    monkeypatch.setattr(sets, "ONE_TASK_LIMIT", 10)
    large = [sets.first_rows(rows, 50, ["v"], d) for d in ([], ["v"])]
    assert [collected(df) for df in large] == [Counter(map(tuple, wanted)) for wanted in small]
    assert sets.first_rows(rows, 50).count() == 50
    assert sets.first_rows(rows, 10**6).count() == 6000


def test_texts_in_expressions_are_no_names(spark):
    from weftmart.operators.derive import derive
    from weftmart.spec import Derived

    rows = frame(spark, {3: 4}).withColumn("kk", F.lit(7))
    typed = Derived("t", "concat('k v\\'k', k, `v`, kk, 'kk')", kind="JAVA", arguments={"k": "varchar(5)", "v": "int", "kk": "int"}, type="varchar(20)")
    plain = [Derived("label", "case when k > 1 then 'other' else 'x' end"), Derived("other", "v + 1")]
    got = derive(rows, [typed, *plain]).first()
    assert (got["t"], got["label"], got["other"], got["k"]) == ("k v'k347kk", "other", 5, 3)
