"""Parallel reads of a store in blocks of about equal size, through a Python data source.

Equal strides of a key give unequal blocks when keys are dense in places. Here the bounds are quantiles of the key, and
a key value that fills several blocks by itself is cut further by quantiles of a second column. A block is a list of
conditions ``(column, operator, value)``, all of which hold; so is what the reader asks of all rows. ``fetch`` gets both
and asks its store: as a pyarrow expression (``arrow_condition``) or as SQL with parameters (``sql_condition``).

Every row lies in exactly one block; null keys have a block of their own. Keys are numbers, dates or timestamps, but no floats, whose NaN has no place in an order.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: (column, operator, value); the operators are = < <= > >= in, and "null" and "not null" without a value
Condition = tuple[str, str, object]
Fetch = Callable[[Sequence[Condition]], Iterator[pa.RecordBatch]]

_COMPARE = {"=": operator.eq, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


@dataclass(frozen=True)
class Block(InputPartition):
    conditions: tuple[Condition, ...]


def _between(column: str, cuts: Sequence, outer: tuple[Condition, ...] = ()) -> list[Block]:
    """Blocks up to each cut (included), one beyond the last, one for nulls."""
    blocks, low = [], outer
    for cut in cuts:
        blocks.append(Block((*low, (column, "<=", cut))))
        low = (*outer, (column, ">", cut))
    blocks.append(Block(low if cuts else (*outer, (column, "not null", None))))
    return [*blocks, Block((*outer, (column, "null", None)))]


def key_blocks(df: DataFrame, key: str, blocks: int, second: str | None = None, accuracy: int = 10_000) -> list[Block]:
    """Blocks of about ``1 / blocks`` of the rows each, from mergeable quantile sketches of the key columns alone."""
    for c in (key, *([second] if second else [])):
        kind = df.schema[c].dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)) or not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise ValueError(f"{c}: blocks are cut by whole numbers, decimals, dates or timestamps")
    shares = [i / blocks for i in range(1, blocks)]
    if not shares:
        return _between(key, [])

    def cuts(column: str, at: list[float]):
        return F.percentile_approx(F.col(f"`{column}`"), at, accuracy)

    found = df.agg(cuts(key, shares).alias("cuts")).first()["cuts"] or []
    times = Counter(found)
    # a value that is several cuts fills the blocks between them; the list is at most as long as the cuts
    hot = {value: n for value, n in times.items() if n > 1} if second else {}
    out: list[Block] = []
    for block in _between(key, sorted(times)):
        upper = next((v for _, sign, v in block.conditions if sign == "<="), None)
        if upper not in hot or upper is None:
            out.append(block)
            continue
        below = tuple(c for c in block.conditions if c[1] != "<=")
        out.append(Block((*below, (key, "<", upper))))
    if hot:
        # enough cuts for the value that needs most; one that needs fewer takes every so-manieth
        finest = max(hot.values()) + 1
        rows = df.where(F.col(f"`{key}`").isin(list(hot))).groupBy(F.col(f"`{key}`").alias("k"))
        for row in rows.agg(cuts(second, [i / finest for i in range(1, finest)]).alias("cuts")).collect():
            own = row["cuts"] or []
            step = max(1, len(own) // (hot[row["k"]] + 1))
            out += _between(second, sorted(set(own[step - 1 :: step])), ((key, "=", row["k"]),))
    return out


def arrow_condition(conditions: Iterable[Condition]) -> ds.Expression | None:
    out = None
    for column, sign, value in conditions:
        field = ds.field(column)
        if sign in ("null", "not null"):
            part = field.is_null() if sign == "null" else field.is_valid()
        else:
            part = field.isin(list(value)) if sign == "in" else _COMPARE[sign](field, value)
        out = part if out is None else out & part
    return out


def sql_condition(conditions: Iterable[Condition], quote: str = '"') -> tuple[str, list]:
    """The text after WHERE, with a mark per value, and the values."""
    texts, values = ["1 = 1"], []
    for column, sign, value in conditions:
        name = f"{quote}{column.replace(quote, quote * 2)}{quote}"
        if sign in ("null", "not null"):
            texts.append(f"{name} IS {sign.upper()}")
        elif sign == "in":
            texts.append(f"{name} IN ({', '.join('?' * len(value))})")
            values += value
        else:
            texts.append(f"{name} {sign} ?")
            values.append(value)
    return " AND ".join(texts), values


def parquet_fetch(path: str, columns: Sequence[str]) -> Fetch:
    """Rows of a parquet folder; files and row groups outside a block are skipped by their statistics."""

    def fetch(conditions: Sequence[Condition]) -> Iterator[pa.RecordBatch]:
        system, place = fs.FileSystem.from_uri(path)
        rows = ds.dataset(place, format="parquet", filesystem=system)
        for batch in rows.to_batches(columns=list(columns), filter=arrow_condition(conditions)):
            if batch.num_rows:
                yield batch

    return fetch


def _possible(conditions: Sequence[Condition]) -> bool:
    """False where the conditions on one column exclude each other."""
    for column in {c for c, _, _ in conditions}:
        own = [(sign, value) for c, sign, value in conditions if c == column]
        if any(sign == "null" for sign, _ in own) and any(sign != "null" for sign, _ in own):
            return False
        lows = [v for sign, v in own if sign in (">", ">=", "=")] + [min(v) for sign, v in own if sign == "in" and v]
        highs = [v for sign, v in own if sign in ("<", "<=", "=")] + [max(v) for sign, v in own if sign == "in" and v]
        if lows and highs:
            low, high = max(lows), min(highs)
            strict = (">", low) in own or ("<", high) in own
            if low > high or (strict and low == high):
                return False
    return True


class _Reader(DataSourceReader):
    def __init__(self, blocks: Sequence[Block], fetch: Fetch):
        self.blocks, self.fetch = list(blocks), fetch

    def partitions(self) -> Sequence[InputPartition]:
        return self.blocks

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        return self.fetch(partition.conditions)


def read_blocks(
    spark: SparkSession, name: str, schema: T.StructType, blocks: Sequence[Block], fetch: Fetch, where: Sequence[Condition] = ()
) -> DataFrame:
    """The rows that ``fetch`` finds, a task per block. ``name`` is the format's name in the session.

    The conditions in ``where`` are the store's to apply, and blocks they rule out are not read. They are stated here
    and not taken from the plan: Spark keeps the filters that one plan pushed into a Python source for every later plan
    over the same DataFrame, which then lacks rows.
    """
    wanted = [Block((*b.conditions, *where)) for b in blocks if _possible((*b.conditions, *where))]
    if not wanted:
        return spark.createDataFrame([], schema)

    class Blocks(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return schema

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return _Reader(wanted, fetch)

    spark.dataSource.register(Blocks)
    return spark.read.format(name).load()
