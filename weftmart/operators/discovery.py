"""Key and reference tags proposed from the data: minimal unique column sets and inclusion dependencies.

Unique sets are searched level by level. A set that holds a unique one is never tried, nor one whose columns have too few
distinct values together to tell all rows apart, nor one with a null. What is left is estimated in one pass for all sets
of a level; only sets whose estimate comes near the row count are proved, by a count per value that combines in each
task and reads no other column.

Inclusions are found for all columns at once: each distinct value knows the columns it occurs in, so two columns share as
many values as they meet in. A column whose values all occur in a unique one refers to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftmart.operators.diff import key_violations
from weftmart.operators.project import named
from weftmart.spec import FK, PK

#: an estimate of distinct values is off by about a fiftieth; sets below this share of the rows are no keys
_ERROR, _NEAR = 0.02, 0.85
_KINDS = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def _estimate(columns: Sequence[str]) -> Column:
    return F.approx_count_distinct(F.struct(*[named(c) for c in columns]), _ERROR)


def unique_sets(df: DataFrame, columns: Sequence[str] | None = None, most: int = 3) -> list[tuple[str, ...]]:
    """The minimal sets of at most ``most`` columns that hold no null and tell all rows apart, smaller sets first.

    Without ``columns`` all whole numbers, decimals, texts, dates and times are tried. An empty table proposes nothing.
    """
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, _KINDS)]
    if not names:
        return []
    facts = df.agg(F.count("*"), *[F.count(named(c)) for c in names], *[_estimate([c]) for c in names]).first()
    rows = facts[0]
    if not rows:
        return []
    distinct = {c: facts[1 + len(names) + i] for i, c in enumerate(names) if facts[1 + i] == rows}
    found: list[tuple[str, ...]] = []
    for size in range(1, most + 1):
        tried = []
        for some in combinations(distinct, size):
            together = 1.0
            for c in some:
                together *= distinct[c] / (1 - 3 * _ERROR)
            if together >= rows and not any(set(f) <= set(some) for f in found):
                tried.append(some)
        if not tried:
            continue
        estimates = [distinct[s[0]] for s in tried] if size == 1 else df.agg(*[_estimate(s) for s in tried]).first()
        likely = [s for s, n in zip(tried, estimates, strict=True) if n >= _NEAR * rows]
        found += [s for s in likely if key_violations(df, list(s)).isEmpty()]
    return found


def _family(kind: T.DataType) -> str | None:
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return "number"
    if isinstance(kind, T.StringType):
        return "text"
    if isinstance(kind, T.DateType):
        return "date"
    return "time" if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else None


def inclusions(tables: Mapping[str, DataFrame], unique: Mapping[str, Sequence[str]], columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``(table_name, column_name, parent_table, parent_column, n_values, n_parent)``: every column whose values, one at
    least, all occur in a unique column of another table. Values are compared within numbers, texts, dates and times."""
    every = None
    for name, df in tables.items():
        chosen = columns[name] if columns and name in columns else df.columns
        cells = [
            F.struct(F.lit(name).alias("t"), F.lit(c).alias("c"), F.lit(c in unique.get(name, ())).alias("u"), F.lit(_family(df.schema[c].dataType)).alias("family"), _text(df, c).alias("value"))
            for c in chosen
            if _family(df.schema[c].dataType)
        ]
        if not cells:
            continue
        # repeats go in each task first, so a frequent value travels once
        values = df.select(F.explode(F.array(*cells)).alias("x")).select("x.*").where("value IS NOT NULL").distinct()
        every = values if every is None else every.unionByName(values)
    if every is None:
        raise ValueError("no table has a column to compare")
    met = every.groupBy("family", "value").agg(F.collect_list(F.struct("t", "c", "u")).alias("places"))
    ours = met.select(F.explode("places").alias("a"), "places")
    theirs = ours.select("a", F.explode(F.filter("places", lambda p: p["u"])).alias("b")).where("a.t <> b.t")
    shared = theirs.groupBy(F.col("a.t").alias("table_name"), F.col("a.c").alias("column_name"), F.col("b.t").alias("parent_table"), F.col("b.c").alias("parent_column")).agg(F.count("*").alias("n_shared"))
    sizes = ours.groupBy(F.col("a.t").alias("t"), F.col("a.c").alias("c")).agg(F.count("*").alias("n"))
    own = sizes.select(F.col("t").alias("table_name"), F.col("c").alias("column_name"), F.col("n").alias("n_values"))
    parent = sizes.select(F.col("t").alias("parent_table"), F.col("c").alias("parent_column"), F.col("n").alias("n_parent"))
    return shared.join(own, ["table_name", "column_name"]).where("n_shared = n_values").join(parent, ["parent_table", "parent_column"]).drop("n_shared")


def _text(df: DataFrame, column: str) -> Column:
    """A text that is equal for equal numbers of any type."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return F.regexp_replace(named(column).cast("string"), r"\.?0+$", "") if kind.scale else named(column).cast("string")
    return named(column).cast("string")


def _tail(column: str) -> str:
    """A column name without a short prefix of its table."""
    head, _, tail = column.lower().partition("_")
    return tail if tail and len(head) <= 3 else column.lower()


def proposed_tags(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None, most: int = 2) -> list[tuple[str, str, str, str | None]]:
    """``(table, column, tag, parent)``: the first of the smallest unique sets of each table as primary key, and columns
    that refer to a parent of a like name as foreign keys."""
    columns = columns or {}
    sets = {name: unique_sets(df, columns.get(name), most) for name, df in tables.items()}
    out = [(name, c, PK, None) for name, found in sets.items() for c in (found[0] if found else ())]
    single = {name: [s[0] for s in found if len(s) == 1] for name, found in sets.items()}
    for r in sorted(inclusions(tables, single, columns).collect()):  # a row per pair of columns
        if _tail(r.column_name) == _tail(r.parent_column):
            out.append((r.table_name, r.column_name, FK, f"{r.parent_table}.{r.parent_column}"))
    return out
