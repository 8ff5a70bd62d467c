"""Complete runs of a warehouse table on small made-up sources."""

import datetime as dt
import json
from dataclasses import replace

import pytest

from weftmart.operators.conform import conform_target, tag_incremental, with_system_columns
from weftmart.operators.diff import evolve
from weftmart.operators.joins import resolve_foreign_keys
from weftmart.operators.sinks import upsert_partitions
from weftmart.plans.evolve import evolve_target, mapping_changes, promote_mapping
from weftmart.plans.jobs import TableState, open_state, run_table
from weftmart.session import scratch_path, write_table
from weftmart.spec import ColumnMap, LoadSettings, WarehouseSpec

ITEM = with_system_columns(
    WarehouseSpec("Item", "D", (ColumnMap("Id", "int", "id", "PK"), ColumnMap("Since", "date", "since"), ColumnMap("Name", "varchar(9)", "name"))),
    "erp",
    "acme",
)
DAYS = [(dt.datetime(2024, 1, d), f"user{d}") for d in range(1, 6)]


def source(spark, rows):
    return spark.createDataFrame(rows, "id int, since string, name string")


def run(spark, rows, state, stamp, **props):
    props = {"write_mode": "upsert", "delete_flag": True, **props}
    settings = LoadSettings.from_json(json.dumps(props))
    return run_table(source(spark, rows), ITEM, settings, state, stamp, scratch_path(spark, "run"), formats={"Since": "dd/MM/yyyy"})


def seen(table):
    return {(r["Id"], r["Name"], r["Item_Key"], r["Updated_Date"].day) for r in table.collect()}


def test_surrogate_keys_are_not_given_out_again(spark):
    one, two, three = (1, "01/02/2020", "a"), (2, "01/02/2020", "b"), (3, "bad", "c")
    state = run(spark, [one, two], TableState(), DAYS[0])
    assert seen(state.warehouse) == {(1, "a", 1, 1), (2, "b", 2, 1)} and state.deletes is None
    state = run(spark, [one], state, DAYS[1])
    assert seen(state.warehouse) == {(1, "a", 1, 1)}
    assert {(r["Id"], r["Item_Key"], r["Added_User"]) for r in state.deletes.collect()} == {(2, 2, "user2")}
    state = run(spark, [one, three], state, DAYS[2])
    assert seen(state.warehouse) == {(1, "a", 1, 1), (3, "c", 3, 3)}
    since = {r["Id"]: r["Since"] for r in state.warehouse.collect()}
    assert since == {1: dt.date(2020, 2, 1), 3: dt.date(1970, 1, 1)}


def test_a_repeated_run_changes_nothing(spark):
    rows = [(1, "01/02/2020", "a"), (2, "01/02/2020", " ")]
    state = run(spark, rows, TableState(), DAYS[0])
    again = run(spark, rows, state, DAYS[1])
    assert seen(again.warehouse) == seen(state.warehouse) == {(1, "a", 1, 1), (2, "", 2, 1)}
    later = [rows[0], (2, "01/02/2020", "b"), (7, "01/02/2020", "n")]
    changed = run(spark, later, again, DAYS[2])
    assert seen(changed.warehouse) == {(1, "a", 1, 1), (2, "b", 2, 3), (7, "n", 3, 3)}
    delta = run_table(
        source(spark, later), ITEM, LoadSettings(write_mode="upsert"), again, DAYS[2],
        scratch_path(spark, "run"), formats={"Since": "dd/MM/yyyy"}, strategy="delta",
    )
    assert seen(delta.warehouse) == seen(changed.warehouse)


def test_overwrite_keeps_surrogate_keys(spark):
    state = run(spark, [(1, "01/02/2020", "a"), (5, "01/02/2020", "b")], TableState(), DAYS[0])
    state = run(spark, [(5, "01/02/2020", "b")], state, DAYS[1], write_mode="overwrite")
    assert seen(state.warehouse) == {(5, "b", 2, 2)}
    assert {(r["Id"], r["Item_Key"]) for r in state.deletes.collect()} == {(1, 1)}
    state = run(spark, [(5, "01/02/2020", "b"), (9, "01/02/2020", "n")], state, DAYS[2], write_mode="overwrite")
    assert seen(state.warehouse) == {(5, "b", 2, 3), (9, "n", 3, 3)}


def test_another_session_continues(spark):
    path = scratch_path(spark, "state")
    rows = [(1, "01/02/2020", "a"), (2, "01/02/2020", "b")]
    settings = LoadSettings(write_mode="upsert", delete_flag=True, incremental_kind="id", incremental_column="id")
    run_table(source(spark, rows), ITEM, settings, open_state(spark, f"{path}/0"), DAYS[0], f"{path}/1", formats={"Since": "dd/MM/yyyy"})
    later = spark.newSession()
    state = open_state(later, f"{path}/1")
    assert state.watermark == 2 and state.greatest == 2
    state = run_table(source(later, [rows[1], (3, "01/02/2020", "c")]), ITEM, settings, state, DAYS[1], f"{path}/2", formats={"Since": "dd/MM/yyyy"})
    assert seen(state.warehouse) == {(2, "b", 2, 1), (3, "c", 3, 2)}
    assert open_state(later, f"{path}/2").deletes.count() == 1


def test_unordered_repeats_of_a_dimension_are_refused(spark):
    facts, dimension = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, 10), (1, 11)], "k int, s int")
    column = ColumnMap("S", "int", tag="FK", dimension="D", dimension_key="s", join=(("k", "k"),))
    with pytest.raises(ValueError, match="repeats"):
        resolve_foreign_keys(facts, [column], {"D": dimension})
    assert resolve_foreign_keys(facts, [replace(column, order=("s",))], {"D": dimension}).collect() == [(1, 10)]


def test_lossy_changes_are_refused(spark):
    rows = spark.createDataFrame([(300, "abc")], "n int, t string")
    for change in ({"n": "tinyint"}, {"t": "int"}):
        with pytest.raises(ValueError, match="do not fit"):
            evolve(rows, change)
    assert evolve(rows, {"n": "tinyint"}, allow_losses=True).collect() == [(None,)]
    with pytest.raises(ValueError, match="t \\(1 cut"):
        conform_target(rows, {"t": "varchar(2)"})


def test_keys_must_not_change_their_partition(spark):
    path = scratch_path(spark, "parts")
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string"), path, ["p"])
    with pytest.raises(ValueError, match="another p"):
        upsert_partitions(spark, path, spark.createDataFrame([(1, "b")], "k int, p string"), ["k"], "p")


def test_mapping_changes_and_promotion(spark):
    schema = "IL_Table_Name string, IL_Column_Name string, IL_Data_Type string"
    live = spark.createDataFrame([("A", "x", "int"), ("A", "y", "int"), ("B", "z", "int")], schema)
    saved = spark.createDataFrame([("A", "x", "bigint"), ("A", "w", "int")], schema)
    changes = {(r["IL_Column_Name"], r["change"]) for r in mapping_changes(saved, live.where("IL_Table_Name = 'A'")).collect()}
    assert changes == {("x", "U"), ("w", "I"), ("y", "D")}
    promoted = {(r["IL_Table_Name"], r["IL_Column_Name"], r["IL_Data_Type"]) for r in promote_mapping(saved, live).collect()}
    assert promoted == {("A", "x", "bigint"), ("A", "w", "int"), ("B", "z", "int")}


def test_new_keys_must_be_unique(spark):
    state = run(spark, [(1, "01/02/2020", "a"), (2, "01/02/2020", "a")], TableState(), DAYS[0])
    by_name = replace(ITEM, columns=tuple(replace(c, tag={"Id": "", "Name": "PK"}.get(c.target, c.tag)) for c in ITEM.columns))
    with pytest.raises(ValueError, match="not unique"):
        evolve_target(ITEM, by_name, state, scratch_path(spark, "evolve"))
    state = run(spark, [(1, "01/02/2020", "a"), (2, "01/02/2020", None)], TableState(), DAYS[0])
    evolved = evolve_target(ITEM, by_name, state, scratch_path(spark, "evolve"))
    assert {(r["Id"], r["Name"]) for r in evolved.warehouse.collect()} == {(1, "a"), (2, "")}


def test_key_table_follows_a_key_change(spark):
    columns = (ColumnMap("Id", "int", "id", "PK"), ColumnMap("Since", "varchar(20)", "since"), ColumnMap("Name", "varchar(9)", "name"))
    old = tag_incremental(WarehouseSpec("Sale", "T", columns))
    new = replace(old, columns=tuple(replace(c, tag="PK") if c.target == "Name" else c for c in old.columns))
    settings = LoadSettings(write_mode="upsert")
    rows = source(spark, [(1, "s", "a"), (2, "s", "b")])
    state = run_table(rows, old, settings, TableState(), DAYS[0], scratch_path(spark, "run"))
    evolved = evolve_target(old, new, state, scratch_path(spark, "evolve"))
    assert {r["PKValue"] for r in state.key_table.collect()} == {"1", "2"}
    assert {r["PKValue"] for r in evolved.key_table.collect()} == {"1_a", "2_b"}
    again = run_table(rows, new, settings, evolved, DAYS[1], scratch_path(spark, "run"))
    assert again.warehouse.count() == again.key_table.count() == 2


def test_transaction_runs_with_deletes(spark):
    columns = (ColumnMap("Id", "int", "id", "PK"), ColumnMap("Since", "varchar(20)", "since"), ColumnMap("Name", "varchar(9)", "name"))
    spec = tag_incremental(WarehouseSpec("Sale", "T", columns))
    settings = LoadSettings(write_mode="upsert", delete_flag=True)
    state = TableState()
    for day, rows in zip(DAYS, ([(1, "s", "a"), (2, "s", "b")], [(2, "s", "c"), (3, "s", "d")], [(3, "s", "d")])):
        state = run_table(source(spark, rows), spec, settings, state, day, scratch_path(spark, "run"))
        for table in (state.warehouse, state.staging, state.key_table):
            assert {r["Id"] for r in table.collect()} == {r[0] for r in rows}
    assert {(r["Id"], r["Name"]) for r in state.deletes.collect()} == {(1, "a"), (2, "c")}
    assert [r["Updated_Date"].day for r in state.warehouse.collect()] == [2]


def test_repeated_source_keys(spark):
    rows = source(spark, [(1, "01/02/2020", "old"), (1, "01/03/2020", "new"), (2, "01/01/2020", "x")])
    settings = LoadSettings(write_mode="upsert")
    with pytest.raises(ValueError, match="repeat"):
        run_table(rows, ITEM, settings, TableState(), DAYS[0], scratch_path(spark, "run"))
    state = run_table(rows, ITEM, settings, TableState(), DAYS[0], scratch_path(spark, "run"), newest_by=["since"])
    assert seen(state.warehouse) == {(1, "new", 1, 1), (2, "x", 2, 1)}
