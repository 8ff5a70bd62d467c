"""Shared helpers: Arrow texts as numpy bytes, bounded slices, checked semi joins, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftmart.session import materialise_narrow

U64 = np.uint64
#: bytes of text that one numpy step works on; every temporary array is a small multiple of it
SLICE_BYTES = 1 << 21
#: an id list is broadcast only when it was counted and has at most this many rows (8 bytes each)
BROADCAST_IDS = 1_000_000


def two_columns(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Only the id and the text, under fixed names, so that further columns cannot clash."""
    return df.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))


def slices(batches: Iterator[pa.RecordBatch], text_column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows with about ``limit`` bytes of text; one longer text is a run of its own."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text_column))
        ends = offsets(column)[1:].astype(np.int64)
        start, rows = 0, batch.num_rows
        while start < rows:
            base = ends[start - 1] if start else offsets(column)[0]
            stop = int(np.searchsorted(ends, base + limit, side="right"))
            stop = min(max(stop, start + 1), rows)
            yield batch.slice(start, stop - start)
            start = stop


def offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    whole = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32) if column.buffers()[1] else np.zeros(1, np.int32)
    return whole[column.offset : column.offset + len(column) + 1] if len(column) else whole[:1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the ``n + 1`` bounds; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    bounds = offsets(column).astype(np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        y = x ^ (x >> U64(30))
        y *= U64(0xBF58476D1CE4E5B9)
        y ^= y >> U64(27)
        y *= U64(0x94D049BB133111EB)
        y ^= y >> U64(31)
        return y


def only_ids(rows: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """Rows whose id is listed. The list is counted first: a short one is broadcast, a long one is joined by shuffle."""
    known = ids.select(column).distinct()
    if known.count() <= BROADCAST_IDS:
        known = F.broadcast(known)
    return rows.join(known, column, "left_semi")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every upper end has one lower end that is no upper end itself."""
    one, none = F.lit(1), F.lit(0)
    ends = edges.groupBy("u").agg(F.count("*").alias("ups")).select(F.col("u").alias("x"), "ups", none.alias("downs"))
    lows = edges.groupBy("v").agg(F.count("*").alias("n")).select(F.col("v").alias("x"), none.alias("ups"), one.alias("downs"))
    met = ends.unionByName(lows).groupBy("x").agg(F.sum("ups").alias("ups"), F.sum("downs").alias("downs"))
    return met.where("ups > 1 OR (ups > 0 AND downs > 0)").isEmpty()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(id, component)`` for every id of ``edges (a, b)``: the smallest id that can be reached.

    Large-star and small-star steps take turns until every component is a star around its smallest id. A node's minimum is an aggregate
    that combines in each task; it meets the edges in a join that AQE can split, so a hub of any size is no hot task.
    """
    edges = materialise_narrow(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label
    )
    while not _all_stars(edges):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(down, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        edges = materialise_narrow(small.where("u <> v").distinct(), label)
    nodes = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
