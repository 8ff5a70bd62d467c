import json

import pytest

from weftmart.queries.extraction import settings
from weftmart.queries.warehouse import CUSTOMER, MART_JSON, ORDERS, mart_spec
from weftmart.spec import LoadSettings, mart_from_json, warehouse_from_control, warehouse_from_json


def test_settings_are_independent():
    read = settings(limit=5, custom_filter="a > 1")
    assert (read.limit, read.custom_filter, read.write_mode) == (5, "a > 1", "overwrite")
    assert LoadSettings.from_json("{}") == LoadSettings()
    full = settings(
        write_mode="upsert",
        delete_flag="true",
        conditional={"conditional_date_param": "d", "trailing_months": "6"},
        incremental={"incremental_refresh_column_type": "ID", "incremental_refresh_column_name": "i"},
        historical={"historical_date_param": "h"},
    )
    assert (full.trailing_months, full.incremental_kind, full.historical_column, full.delete_flag) == (6, "id", "h", True)


def test_mart_validation():
    raw = json.loads(MART_JSON)
    raw["tables"][1]["role"] = "driving"
    with pytest.raises(ValueError, match="driving"):
        mart_from_json(json.dumps(raw))
    raw = json.loads(MART_JSON)
    raw["tables"][1]["columns"]["o_orderkey"] = "l_orderkey"
    with pytest.raises(ValueError, match="repeat"):
        mart_from_json(json.dumps(raw))
    raw = json.loads(MART_JSON)
    raw["joins"][0]["right"] = "nowhere"
    with pytest.raises(ValueError, match="unknown"):
        mart_from_json(json.dumps(raw))


def test_mart_parts():
    spec = mart_spec()
    assert spec.driving.alias == "l"
    assert [d.name for d in spec.derived if d.alias] == ["band", "nation"]


def test_warehouse_tags():
    assert CUSTOMER.keys == ["Customer_Id", "DataSource_Id", "Company_Id"]
    assert CUSTOMER.surrogate == "Customer_Key"
    assert ORDERS.change_columns == ["Buyer", "Status", "Price", "Ordered"]


def test_warehouse_from_json_and_control(spark):
    text = json.dumps(
        {
            "name": "Orders",
            "kind": "T",
            "columns": [
                {"target": "Order_Id", "type": "bigint", "source": "o_orderkey", "tag": "PK"},
                {"target": "Customer_Key", "type": "bigint", "tag": "FK", "dimension": "Customer", "dimension_key": "Customer_Key", "join": [["Buyer", "Customer_Id"]]},
            ],
        }
    )
    read = warehouse_from_json(text)
    columns = (
        "IL_Table_Name, IL_Column_Name, IL_Data_Type, Source_Column_Name, Constraints, Constant_Insert_Value, Constant_Insert_Column, "
        "Dimension_Name, Dimension_Key, LHS_Join_Condition, RHS_Join_Condition, Incremental_Column, Dimension_Transaction"
    )
    schema = ", ".join(f"{c.strip()} string" for c in columns.split(","))
    rows = [
        ("Orders", "Order_Id", "bigint", "o_orderkey", "PK", None, None, None, None, None, None, None, "T"),
        ("Orders", "Customer_Key", "bigint", None, "FK", None, None, "Customer", "Customer_Key", "Buyer", "Customer_Id", "N", "T"),
        ("Other", "x", "int", "x", None, None, None, None, None, None, None, None, "D"),
    ]
    assert warehouse_from_control("Orders", spark.createDataFrame(rows, schema)) == read
