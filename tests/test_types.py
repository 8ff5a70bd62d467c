import datetime as dt

import pytest
from pyspark.sql import types as T

from weftmart.functions.types import default_value, derive_target_type, normalise_source_type, parse_type, spark_type


@pytest.mark.parametrize(
    "text, expected",
    [
        ("varchar(50)", T.StringType()),
        ("NVARCHAR(9)", T.StringType()),
        ("tinyint(4)", T.ByteType()),
        ("bit(1)", T.ByteType()),
        ("smallint", T.ShortType()),
        ("int(11)", T.IntegerType()),
        ("bigint", T.LongType()),
        ("ubigint", T.DecimalType(20, 0)),
        ("decimal(18,2)", T.DecimalType(18, 2)),
        ("double", T.DoubleType()),
        ("double(10,3)", T.DecimalType(10, 3)),
        ("float", T.DoubleType()),
        ("float(8,2)", T.DecimalType(8, 2)),
        ("currency", T.DecimalType(19, 4)),
        ("date", T.DateType()),
        ("datetime", T.TimestampNTZType()),
        ("blob", T.BinaryType()),
        ("boolean", T.BooleanType()),
    ],
)
def test_spark_type(text, expected):
    assert spark_type(text) == expected


def test_type_text_round_trip():
    for text in ("varchar(50)", "decimal(18,2)", "date", "bigint"):
        assert str(parse_type(text)) == text


def test_unreadable_type():
    with pytest.raises(ValueError):
        parse_type("decimal(1,2")
    with pytest.raises(ValueError):
        spark_type("geometry")


def test_defaults():
    assert default_value("varchar(9)") == ""
    assert default_value("bigint") == 0
    assert default_value("decimal(9,2)") == 0.0
    assert default_value("boolean") is False
    assert default_value("date") == dt.date(1970, 1, 1)
    assert default_value("datetime", date_default=dt.date(1900, 1, 1)) == dt.datetime(1900, 1, 1)
    assert default_value("blob") is None
    with pytest.raises(ValueError):
        default_value("blob", key=True)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("identity", "bigint"),
        ("ubigint", "ubigint"),
        ("smallfloat", "float"),
        ("longvarbinary", "blob"),
        ("integer", "int"),
        ("numeric(9,2)", "numeric(9,2)"),
        ("currency", "decimal(19,4)"),
        ("varchar(5)", "varchar(5)"),
    ],
)
def test_source_types(text, expected):
    assert normalise_source_type(text) == expected


@pytest.mark.parametrize(
    "arguments, expected",
    [
        (("varchar", 20), "varchar(20)"),
        (("varchar", 400), "varchar(400)"),
        (("varchar2", 400), "varchar(400)"),
        (("varchar2", 20), "varchar(40)"),
        (("nvarchar", 200), "varchar(255)"),
        (("nchar", 3), "char(6)"),
        (("varchar", -1), "text"),
        (("decimal", None, 18, 2), "decimal(18,2)"),
        (("int", None, 10), "int(10)"),
        (("bit",), "bit(1)"),
        (("float", None, 8, 2), "float(8,2)"),
        (("geography", None, None, None, "varchar(99)"), "varchar(99)"),
    ],
)
def test_target_types(arguments, expected):
    assert derive_target_type(*arguments) == expected


def test_too_many_digits_are_refused():
    with pytest.raises(ValueError, match="digits"):
        spark_type("numeric(60,4)")
