"""Derived columns by level."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftmart.functions.canonical import composite_key, row_hash
from weftmart.functions.types import spark_type
from weftmart.operators.project import named
from weftmart.spec import Derived

# The methods a specification may call on fields; users add their own.
METHODS: dict[str, Callable[[DataFrame, Sequence[str]], Column]] = {
    "string_join": composite_key,
    "checksum": row_hash,
}


# a quoted text, or a bare or back-quoted name
_LITERAL = r"'(?:[^'\\]|\\.)*'"


def _bind(text: str, names: Mapping[str, str]) -> str:
    """Replace column names in an expression, but not inside its texts."""
    # longest name first, so that a name inside a longer one is not taken for it
    options = "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True))
    pattern = re.compile(rf"{_LITERAL}|(?<![\w.`])`?({options})`?(?![\w`])")
    return pattern.sub(lambda m: names[m[1]] if m[1] else m[0], text)


def sql_columns(df: DataFrame, derived: Sequence[Derived]) -> DataFrame:
    """Columns of one level; each sees the input only, not its siblings."""
    new = [d.name for d in derived if d.name not in df.columns]
    for d in derived:
        words = re.findall(r"\w+", re.sub(_LITERAL, "", d.expression))
        used = [n for n in new if n in words]
        if used:
            raise ValueError(f"derived column {d.name} uses {used} of its own level")
    return df.withColumns({d.name: F.expr(d.expression) for d in derived})


def typed_columns(df: DataFrame, derived: Sequence[Derived]) -> DataFrame:
    """Expressions over arguments of declared types, cast to a declared type.

    The arguments are cast on the side; the columns themselves keep their types.
    """
    outputs, helpers = {}, {}
    for i, d in enumerate(derived):
        names = {argument: f"__arg_{i}_{j}" for j, argument in enumerate(d.arguments)}
        helpers |= {names[a]: named(a).cast(spark_type(t)) for a, t in d.arguments.items()}
        value = F.expr(_bind(d.expression, names) if names else d.expression)
        outputs[d.name] = value.cast(spark_type(d.type)) if d.type else value
    return df.withColumns(helpers).withColumns(outputs).drop(*helpers) if helpers else df.withColumns(outputs)


def derive(df: DataFrame, derived: Sequence[Derived]) -> DataFrame:
    """All levels in order; within a level typed columns come before SQL columns."""
    for level in sorted({d.level for d in derived}):
        for kind, step in (("JAVA", typed_columns), ("SQL", sql_columns)):
            chosen = [d for d in derived if d.level == level and _kind(d) == kind]
            if chosen:
                df = step(df, chosen)
    return df


def _kind(d: Derived) -> str:
    return "SQL" if d.kind.upper() == "SQL" else "JAVA"


def register_method(name: str, method: Callable[[DataFrame, Sequence[str]], Column]) -> None:
    """Make a function of (rows, argument columns) callable; wrap Python code as a pandas UDF in it."""
    METHODS[name] = method


def call_method(df: DataFrame, method: str, arguments: Sequence[str], field: str) -> DataFrame:
    return df.withColumn(field, METHODS[method](df, arguments))


def choose(column: Column, cases: Mapping[object, object], default: object = None) -> Column:
    """CASE over the values of one column."""
    result = None
    for value, output in cases.items():
        result = F.when(column == F.lit(value), F.lit(output)) if result is None else result.when(column == F.lit(value), F.lit(output))
    return result.otherwise(F.lit(default))
