"""Filter and group steps, and the aggregates specifications may name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftmart.operators.project import named
from weftmart.spec import FilterGroup, GroupColumn

# Aggregate names that pass through to the engine.
PASSED_AGGREGATES = (
    "sum", "min", "max", "avg", "mean", "count", "stddev", "stddev_pop", "var_pop", "variance",
    "first", "last", "any_value", "bit_and", "bit_or", "bit_xor", "bool_and", "bool_or",
)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def aggregate_text(column: GroupColumn) -> str:
    """SQL of one aggregate; the name comes from a fixed list, the column is quoted."""
    name, c = column.aggregate.lower(), _quoted(column.column)
    if name == "distinct_count":
        return f"count(DISTINCT {c})"
    if name in ("stddev_samp", "var_samp"):
        return f"nullif({name}({c}), double('NaN'))"
    if name == "random":
        if column.order_by:
            order = ", ".join(_quoted(o) for o in column.order_by)
            return f"min_by({c}, struct({order}))"
        return f"min({c})"  # without an order the pick must not change between runs
    if name in PASSED_AGGREGATES:
        return f"{name}({c})"
    raise ValueError(f"unknown aggregate {column.aggregate!r}")


def filter_group(df: DataFrame, step: FilterGroup | None) -> DataFrame:
    """One filter/group step.

    Filter only, filter then group (flow F), group then filter on groups (flow G), or group only. A
    condition on groups may use aggregates and names the columns as they were before grouping. Without
    a group all columns pass.
    """
    if step is None or (not step.condition and not step.columns):
        return df
    if not step.columns:
        return df.where(step.condition)
    if step.condition and step.flow == "F":
        df = df.where(step.condition)
    keys = [c for c in step.columns if c.is_key]
    if len(keys) == len(step.columns) and not (step.condition and step.flow == "G"):
        return df.select(*[named(c.column).alias(c.name) for c in keys]).distinct()
    outputs = [f"{_quoted(c.column) if c.is_key else aggregate_text(c)} AS {_quoted(c.name)}" for c in step.columns]
    head, tail = f"SELECT {', '.join(outputs)} FROM ", ""
    if keys:
        tail += f" GROUP BY {', '.join(_quoted(c.column) for c in keys)}"
    if step.condition and step.flow == "G":
        tail += f" HAVING {step.condition}"
    return df.sparkSession.sql(_no_placeholders(head) + "{rows}" + _no_placeholders(tail), rows=df)


def _no_placeholders(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")


def string_list(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    alias: str,
    separator: str = ",",
    distinct: bool = True,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Ordered list of a column's values per key, as one text; by the values themselves or by ``order_by``.

    Repeats are removed by (key, value) first. The rows are then range-partitioned by key and order, so
    a hot key spans tasks: each makes the text of its piece, and the last step puts at most one piece
    per partition together. Only the finished text of a key has to fit one task, as it is one cell.
    """
    names = [f"__order_{i}" for i in range(len(order_by))]
    order = [named(c).alias(n) for c, n in zip(order_by, names)]
    kept = df.select(*[named(k) for k in keys], named(column).cast("string").alias("__item"), *order)
    if distinct:
        kept = kept.distinct()
    names = names or ["__item"]
    placed = kept.repartitionByRange(*[named(k) for k in keys], *names).withColumn("__part", F.spark_partition_id())
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")

    def joined(item: str, by: Sequence[str]) -> Column:
        return F.expr(f"listagg({item}, '{quoted}') WITHIN GROUP (ORDER BY {', '.join(by)})")

    pieces = placed.groupBy("__part", *[named(k) for k in keys]).agg(joined("__item", names).alias("__piece"))
    return pieces.groupBy(*[named(k) for k in keys]).agg(joined("__piece", ["__part"]).alias(alias))


def last_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest order columns per key. Each task keeps one row per key before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*[named(c) for c in others]), F.struct(*[named(o) for o in order]))
    rows = df.groupBy(*[named(k) for k in keys]).agg(picked.alias("__row"))
    return rows.select(*[named(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def latest_time(df: DataFrame, keys: Sequence[str], column: str, alias: str) -> DataFrame:
    return df.groupBy(*[named(k) for k in keys]).agg(F.max(named(column)).alias(alias))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[named(c) for c in columns]).distinct()


def has_rows(df: DataFrame) -> Column:
    """Whether a row set has any row, as a value usable in another query."""
    return (df.select(F.lit(1).alias("x")).limit(1).agg(F.count("*") > 0)).scalar()


def group_by(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, GroupColumn | tuple[str, str]]) -> DataFrame:
    """Shorthand for a group step: alias to (aggregate, column)."""
    columns = [GroupColumn(k) for k in keys]
    for alias, value in aggregates.items():
        columns.append(value if isinstance(value, GroupColumn) else GroupColumn(value[1], value[0], alias))
    return filter_group(df, FilterGroup(columns=tuple(columns)))
