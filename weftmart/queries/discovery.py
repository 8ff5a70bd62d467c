"""Keys and references found in the data."""

from __future__ import annotations

from itertools import combinations

from weftmart.operators.discovery import inclusions, unique_sets
from weftmart.queries.registry import Tables, query

_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_nationkey"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"],
    "conversations": ["conv_id", "turn", "role"],
}


def _unique(table: str, columns: tuple[str, ...]) -> str:
    nulls = " OR ".join(f"{c} IS NULL" for c in columns)
    return f"(SELECT count(*) = (SELECT count(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM {table})) AND count(*) > 0 AND count(*) FILTER (WHERE {nulls}) = 0 FROM {table})"


def _key_sql() -> str:
    parts = []
    for table, columns in _COLUMNS.items():
        parts += [f"SELECT '{table}' AS table_name, '{c}' AS key_columns WHERE {_unique(table, (c,))}" for c in columns]
        for a, b in combinations(columns, 2):
            parts.append(f"SELECT '{table}', '{a},{b}' WHERE {_unique(table, (a, b))} AND NOT {_unique(table, (a,))} AND NOT {_unique(table, (b,))}")
    return " UNION ALL ".join(parts)


@query("t3_key_discovery", _key_sql())
def keys_found(t: Tables):
    rows = [(name, ",".join(s)) for name, columns in _COLUMNS.items() for s in unique_sets(getattr(t, name), columns, most=2)]
    return t.spark.createDataFrame(rows, "table_name string, key_columns string")


_NUMBERS = {name: [c for c in columns if c.endswith(("key", "number")) or c in ("conv_id", "turn")] for name, columns in _COLUMNS.items()}
_PARENTS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "orders": ["o_orderkey"]}


def _reference_sql() -> str:
    parts = []
    for table, columns in _NUMBERS.items():
        for c in columns:
            for parent, (p,) in _PARENTS.items():
                if parent != table:
                    parts.append(
                        f"""SELECT '{table}' AS table_name, '{c}' AS column_name, '{parent}' AS parent_table, '{p}' AS parent_column,
                        (SELECT count(DISTINCT {c}) FROM {table}) AS n_values, (SELECT count(DISTINCT {p}) FROM {parent}) AS n_parent
                        WHERE EXISTS (SELECT 1 FROM {table} WHERE {c} IS NOT NULL)
                        AND NOT EXISTS (SELECT 1 FROM {table} WHERE {c} IS NOT NULL AND CAST({c} AS VARCHAR) NOT IN (SELECT CAST({p} AS VARCHAR) FROM {parent}))"""
                    )
    return " UNION ALL ".join(parts)


@query("t3_reference_discovery", _reference_sql())
def references_found(t: Tables):
    return inclusions({name: getattr(t, name) for name in _NUMBERS}, _PARENTS, _NUMBERS)
