"""Left-outer chains, lookups and exclusions.

No join here is forced to broadcast: Catalyst broadcasts a side whose size it knows to be under the
session's threshold and AQE splits skewed shuffle partitions. AQE does so only where both sides of a join
are shuffled for it; a side that was just grouped by the join columns is used as it lies. ``join_grouped``
is for that case. ``salt`` additionally spreads a key that is known to be hot over several tasks, without
depending on measured sizes.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftmart.operators.aggregate import filter_group
from weftmart.operators.project import DELETE_INDICATOR, named, select_columns
from weftmart.spec import ColumnMap, JoinSpec, TableSpec

_SALT, _CHECK = "__salt", "__check"


def left_join(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], salt: int = 1, grouped: bool = False
) -> DataFrame:
    """Left-outer equi-join; right key columns stay in the result under their own names.

    With ``salt`` each right row is repeated that many times and each left row meets one copy. The copy
    depends on the row's content only, so a recomputed task places its rows as before. ``grouped`` tells
    that the right side is the result of grouping by its key.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"joined sides share columns {sorted(shared)}")
    if salt <= 1:
        return join_grouped(left, right, pairs, "left_outer") if grouped else left.join(right, _matching(pairs), "left_outer")
    plain = [named(c) for c in left.columns]
    salted_left = left.withColumn(_SALT, F.pmod(F.xxhash64(*plain), F.lit(salt)))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint")))
    salted_right = right.withColumn(_SALT + "_r", copies)
    condition = _matching(pairs) & (F.col(_SALT) == F.col(_SALT + "_r"))
    return salted_left.join(salted_right, condition, "left_outer").drop(_SALT, _SALT + "_r")


def join_grouped(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str) -> DataFrame:
    """Join with a right side that was grouped by its key, so that a hot key of the left side can be split.

    A checksum of the key is a second join column. It makes Spark shuffle the grouped side, one row per
    key, once more for the join, which is what lets AQE split the left side.
    """
    checks = _comparable(left, right, pairs)
    if checks is None:
        return left.join(right, _matching(pairs), how)
    checked = right.withColumn(_CHECK, F.xxhash64(*checks[1]))
    return left.join(checked, _matching(pairs) & (F.xxhash64(*checks[0]) == F.col(_CHECK)), how).drop(_CHECK)


def _comparable(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> tuple[list[Column], list[Column]] | None:
    """Key columns whose checksums are equal whenever the keys are; ``None`` if their types do not allow it."""
    ours, theirs = [], []
    for a, b in pairs:
        a_type, b_type = left.schema[a].dataType, right.schema[b].dataType
        if a_type == b_type:
            ours.append(named(a))
            theirs.append(named(b))
        elif isinstance(a_type, T.NumericType) and isinstance(b_type, T.NumericType):
            ours.append(named(a).cast("double"))
            theirs.append(named(b).cast("double"))
        else:
            return None
    return ours, theirs


def _matching(pairs: Sequence[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for i, (a, b) in enumerate(pairs):
        equal = named(a) == named(b)
        condition = equal if i == 0 else condition & equal
    return condition


def read_table(source: DataFrame, table: TableSpec) -> DataFrame:
    """Source rows of a mart table: pruned to its columns, filtered or grouped before any join.

    Conditions and group columns use source names; the aliases are given last.
    """
    if table.step is None or not table.step.columns:
        return select_columns(filter_group(source, table.step), table.columns)
    grouped = filter_group(source, table.step)
    return select_columns(grouped, {c: a for c, a in table.columns.items() if c in grouped.columns})


def join_chain(
    tables: Mapping[str, DataFrame], driving: str, joins: Sequence[JoinSpec], grouped: Collection[str] = ()
) -> DataFrame:
    """Fold the joins in level order; each step's left input is the previous step's output.

    ``grouped`` names the tables that are results of grouping.
    """
    joined = tables[driving]
    for join in sorted(joins, key=lambda j: j.level):
        joined = left_join(joined, tables[join.right], join.pairs, join.salt, join.right in grouped)
    return joined


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: Mapping[str, str],
    fetch: Mapping[str, str],
    order_by: Sequence[str] = (),
    salt: int = 1,
    grouped: bool = False,
) -> DataFrame:
    """Fetch columns of the one matching row of ``table``; no match gives nulls.

    ``on`` maps columns of ``df`` to columns of ``table``. Without ``order_by`` the table must be unique
    on its lookup columns (``key_violations`` reports where it is not); with it the first row wins.
    ``grouped`` tells that the table is a result of grouping by them.
    """
    keys = list(dict.fromkeys(on.values()))
    if order_by:
        row = F.struct(*[named(c) for c in fetch])
        first = F.min_by(row, F.struct(*[named(c) for c in order_by])).alias("__row")
        picked = table.groupBy(*[named(k) for k in keys]).agg(first)
        right = picked.select(
            *[named(k).alias(f"__lkp_{k}") for k in keys],
            *[F.col("__row")[c].alias(a) for c, a in fetch.items()],
        )
    else:
        right = table.select(
            *[named(k).alias(f"__lkp_{k}") for k in keys], *[named(c).alias(a) for c, a in fetch.items()]
        )
    pairs = [(a, f"__lkp_{b}") for a, b in on.items()]
    return left_join(df, right, pairs, salt, grouped=grouped or bool(order_by)).drop(*[f"__lkp_{k}" for k in keys])


def resolve_foreign_keys(df: DataFrame, foreign: Sequence[ColumnMap], dimensions: Mapping[str, DataFrame], salt: int = 1) -> DataFrame:
    """Fill each foreign-key column with the surrogate key of the matching dimension row.

    Where a mapping declares an order, the first of several matching rows by it counts. Without one a dimension
    that repeats its lookup columns is refused, as it would multiply the facts.
    """
    checked = set()
    for column in foreign:
        dimension, keys = dimensions[column.dimension], tuple(dict.fromkeys(b for _, b in column.join))
        if not column.order and (column.dimension, keys) not in checked:
            counted = dimension.dropna(subset=list(keys))
            if not counted.groupBy(*[named(k) for k in keys]).count().where("count > 1").isEmpty():
                raise ValueError(f"dimension {column.dimension} repeats {list(keys)}; declare an order")
            checked.add((column.dimension, keys))
        on, fetch = dict(column.join), {column.dimension_key: column.target}
        df = lookup(df.drop(column.target), dimension, on, fetch, column.order, salt)
    return df


def deleted_keys(
    warehouse: DataFrame, source_keys: DataFrame, keys: Sequence[str], allow_empty: bool = False, null_safe: bool = False
) -> DataFrame:
    """Warehouse keys the source no longer has. Only key columns are read and shuffled.

    An empty extract would delete everything and is refused unless asked for. Keys are cleansed before
    they are stored, so plain equality compares them; ``null_safe`` is for targets where they are not.
    """
    if not allow_empty and source_keys.isEmpty():
        raise ValueError("the source extract has no rows; pass allow_empty=True to delete everything")
    stored = warehouse.select(*[named(k) for k in keys])
    if not null_safe:
        return stored.join(source_keys.select(*[named(k) for k in keys]), list(keys), "left_anti")
    live = source_keys.select(*[named(k).alias(f"rhs_{k}") for k in keys])
    condition = F.lit(True)
    for i, k in enumerate(keys):
        equal = named(k).eqNullSafe(named(f"rhs_{k}"))
        condition = equal if i == 0 else condition & equal
    return stored.join(live, condition, "left_anti")


def deleted_rows(warehouse: DataFrame, source_keys: DataFrame, keys: Sequence[str], allow_empty: bool = False) -> DataFrame:
    """Warehouse rows whose key the source no longer has, flagged for deletion."""
    gone = deleted_keys(warehouse, source_keys, keys, allow_empty)
    return warehouse.join(gone, list(keys), "left_semi").withColumn(DELETE_INDICATOR, F.lit(True))


def _with_partner(df: DataFrame, other: DataFrame, on: Mapping[str, str], unique: bool, how: str) -> DataFrame:
    """Semi or anti join. Unless the other side's keys are unique, repeats are removed in each task before
    the shuffle, so a key that holds a large part of the other side reaches its join task as one row."""
    keys = other.select(*[named(b).alias(f"__x_{i}") for i, b in enumerate(on.values())])
    pairs = [(a, f"__x_{i}") for i, a in enumerate(on)]
    return df.join(keys, _matching(pairs), how) if unique else join_grouped(df, keys.distinct(), pairs, how)


def exclude(df: DataFrame, other: DataFrame, on: Mapping[str, str], unique: bool = False) -> DataFrame:
    """Rows without a partner; a null key has none and stays."""
    return _with_partner(df, other, on, unique, "left_anti")


def keep_matching(df: DataFrame, other: DataFrame, on: Mapping[str, str], unique: bool = False) -> DataFrame:
    """Rows with a partner, each once."""
    return _with_partner(df, other, on, unique, "left_semi")


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """``column NOT IN (other)`` with SQL's three-valued logic.

    Written as an equi anti-join plus two facts about the other side, which are computed as scalar
    values: a null there leaves nothing, an empty other side leaves everything. The built-in form would
    fall back to nested loops when the other side is too large to broadcast.
    """
    values = other.select(named(other_column).alias("__v"))
    nulls = values.agg(F.count_if(F.col("__v").isNull())).scalar()
    rows = values.agg(F.count("*")).scalar()
    kept = exclude(df, values.where("__v is not null"), {column: "__v"})
    return kept.where((rows == 0) | ((nulls == 0) & named(column).isNotNull()))


def flag_matches(df: DataFrame, existing: DataFrame, keys: Sequence[str], flag: str = "matched") -> DataFrame:
    """One pass that tells rows with an existing key from new ones."""
    known = existing.select(*[named(k).alias(f"__x_{i}") for i, k in enumerate(keys)]).distinct().withColumn(flag, F.lit(True))
    joined = join_grouped(df, known, [(k, f"__x_{i}") for i, k in enumerate(keys)], "left_outer")
    return joined.select(*[named(c) for c in df.columns], F.coalesce(F.col(flag), F.lit(False)).alias(flag))


def match_split(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to update, rows to insert)."""
    on = {k: k for k in keys}
    return keep_matching(df, existing, on), exclude(df, existing, on)


def inner_chain(first: DataFrame, others: Sequence[tuple[DataFrame, Sequence[tuple[str, str]]]]) -> DataFrame:
    joined = first
    for right, pairs in others:
        joined = joined.join(right, _matching(pairs), "inner")
    return joined


def enrich_first_of(
    df: DataFrame,
    candidates: Sequence[tuple[DataFrame, Mapping[str, str], str]],
    alias: str,
    default: object = None,
    grouped: Collection[int] = (),
) -> DataFrame:
    """Left-join several tables and take the first non-null value in the given order.

    ``grouped`` holds the numbers of the tables that are results of grouping by their lookup columns.
    """
    names = []
    for i, (table, on, column) in enumerate(candidates):
        names.append(f"__pick_{i}")
        df = lookup(df, table, on, {column: names[-1]}, grouped=i in grouped)
    picks = [F.col(n) for n in names] + ([F.lit(default)] if default is not None else [])
    return df.withColumn(alias, F.coalesce(*picks)).drop(*names)
