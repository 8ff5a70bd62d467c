"""Run a registered query on Spark and its SQL in DuckDB, and compare the row multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def type_family(text: str) -> str:
    text = text.lower()
    for family, names in {
        "long": ("bigint", "hugeint"),
        "int": ("int", "integer"),
        "text": ("string", "varchar"),
        "time": ("timestamp_ntz", "timestamp", "timestamp_ns"),
    }.items():
        if text in names:
            return family
    return text


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """``None`` when equal, else a short description."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for name, kind in df.dtypes:
        if type_family(kind) != type_family(kinds[name]):
            return f"type of {name}: {kind} != {kinds[name]}"
    wanted = rows_of(names, result.fetchall())
    got = rows_of(df.columns, (tuple(r) for r in df.collect()))
    if wanted == got:
        return None
    missing, surplus = wanted - got, got - wanted
    return (
        f"{sum(wanted.values())} rows wanted, {sum(got.values())} got; "
        f"missing {list(missing.items())[:2]}, surplus {list(surplus.items())[:2]}"
    )
