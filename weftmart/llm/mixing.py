"""Mixing sources to target weights by fitting word budgets.

Targets: sources share all words by weight; a target stops at ``limit`` times its source's size and the excess is
shared again by weight. A source is taken whole as often as it fits its target; what is left is a budget of words
that a subset of its documents has to fill. Documents are counted by exact size, every size first gives its share,
and bounded-knapsack dynamic programming over the sizes fills the last ``WINDOW`` words as exactly as they allow.
Which documents of a size are taken follows a seeded hash of their ids, so reruns agree.

No task sees all documents of a source or of a size: sizes are counted first, and the cut inside a size is found
over hash buckets.

Defined results: a null text has size 0; size 0 takes 0; a null source is a source of its own and comes last; rows
that share id, source and size are interchangeable; an empty table gives an empty result; further columns are
ignored by ``mix`` and kept by ``apply_mix``, which numbers repetitions in ``copy`` or, where a column has that name
already, in the first of ``copy_``, ``copy__`` ... that is free.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from weftmart.llm.common import BROADCAST_IDS
from weftmart.operators.keys import global_number
from weftmart.session import materialise

WEIGHTS = (5, 2, 1)
LIMIT = 3
#: words that the dynamic program fills; its table has one entry per word
WINDOW = 1 << 16
BUCKET_BITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``(source, number, source_size, target)`` of ``sized (source, size)``."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = global_number(sources, [F.asc_nulls_last("source")], "number")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = materialise(sources.withColumn("weight", weight), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    most = F.col("source_size") * limit
    level = -1.0
    while True:
        # words per unit of weight, if all sources that are above their limit at the last level stay at it
        full = F.col("weight") * F.lit(level) > most
        row = sources.agg(F.sum(F.when(full, most).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if not row[1]:
            break
        now = (total - row[0]) / row[1]
        if now <= level:
            break
        level = now
    target = F.least(F.col("weight") * F.lit(level), most.cast("double"))
    return materialise(sources.select("source", "number", "source_size", target.alias("target")), "targets")


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW) -> np.ndarray:
    """How many documents of each size to take so that their words come as near to the budget as sizes allow."""
    sizes, counts = sizes.astype(np.int64), counts.astype(np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or not total:
        return np.zeros(len(sizes), np.int64)
    if budget >= total:
        return counts.copy()
    take = np.array([int(c) * budget // total for c in counts], np.int64)
    left = budget - int((take * sizes).sum())
    order = np.argsort(-sizes, kind="stable")
    for i in order:
        more = min(int(counts[i] - take[i]), max(0, left - window) // int(sizes[i]))
        take[i] += more
        left -= more * int(sizes[i])
    spare = counts - take
    usable = [i for i in order if spare[i] > 0]
    if not usable or not left:
        return take
    room = left + int(min(sizes[i] for i in usable))
    reach = np.zeros(room + 1, bool)
    reach[0] = True
    by = np.full(room + 1, -1, np.int32)
    items: list[tuple[int, int]] = []
    for i in usable:
        some, piece = min(int(spare[i]), room // int(sizes[i])), 1
        while some > 0 and not reach[left]:
            piece_now = min(piece, some)
            words = piece_now * int(sizes[i])
            fresh = reach[: room + 1 - words] & ~reach[words:]
            by[words:][fresh] = len(items)
            reach[words:] |= fresh
            items.append((i, piece_now))
            some -= piece_now
            piece *= 2
        if reach[left]:
            break
    found = np.flatnonzero(reach)
    best = int(found[np.argmin(np.abs(found - left))])
    while best:
        i, piece = items[by[best]]
        take[i] += piece
        best -= piece * int(sizes[i])
    return take


def mix(
    docs: DataFrame, seed: int = 7, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    row_column: str | None = None,
) -> DataFrame:
    """``(id, source, size, source_size, target, copies)`` for every row of ``docs``, and ``row`` where a column names it."""
    sized = docs.select(
        *([F.col(f"`{row_column}`").alias("row")] if row_column else []),
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{source_column}`").alias("source"),
        word_count(F.col(f"`{text_column}`")).alias("size"),
    )
    sized = materialise(sized, "sizes")
    goal = targets(sized)
    # whole passes, and the words that a subset has to fill
    some = F.col("source_size") > 0
    passes = F.when(some, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("passes", passes)
    goal = materialise(goal.withColumn("budget", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")), "budgets")
    same = sized["source"].eqNullSafe(goal["source"])
    carried = ["row"] if row_column else []
    rows = sized.join(goal.drop("budget"), same).select(*carried, "id", sized["source"], "size", "number", "source_size", "target", "passes")
    counts = rows.where("size > 0").groupBy("number", "size").agg(F.count("*").alias("n"))
    counts = counts.join(goal.select("number", "budget"), "number").where("budget > 0")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("size", kind="stable")
        taken = fit_budget(part["size"].to_numpy(), part["n"].to_numpy(), int(part["budget"].iloc[0]))
        return part[["number", "size", "n"]].assign(take=taken)

    # one row per size of a source, however many documents it has
    fitted = counts.groupBy("number").applyInPandas(fit, "number bigint, size bigint, n bigint, take bigint")
    fitted = materialise(fitted.where("take > 0"), "fitted")
    whole = fitted.where("take = n").select("number", "size", F.lit(1).alias("all_of"))
    part = fitted.where("take < n").select("number", "size", "take")

    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 1)
    rows = rows.withColumn("order", order).withColumn("bucket", F.shiftright("order", 63 - BUCKET_BITS))
    buckets = rows.join(part, ["number", "size"]).groupBy("number", "size", "bucket", "take").agg(F.count("*").alias("n"))
    before = Window.partitionBy("number", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("need", F.col("take") - F.coalesce(F.sum("n").over(before), F.lit(0)))
    buckets = materialise(buckets.where("need > 0").select("number", "size", "bucket", "need", "n"), "buckets")
    edge = buckets.where("need < n").select("number", "size", "bucket", "need")
    rank = Window.partitionBy("number", "size", "bucket").orderBy("order", F.col("id").asc_nulls_last(), *carried)
    # only the one bucket of a size in which the cut lies is ranked
    inside = rows.join(edge, ["number", "size", "bucket"]).withColumn("chosen", (F.row_number().over(rank) <= F.col("need")).cast("long"))
    outside = rows.join(edge, ["number", "size", "bucket"], "left_anti")
    full = buckets.where("need >= n").select("number", "size", "bucket", F.lit(1).alias("bucket_of"))
    outside = outside.join(whole, ["number", "size"], "left").join(full, ["number", "size", "bucket"], "left")
    outside = outside.withColumn("chosen", F.coalesce("all_of", "bucket_of", F.lit(0)).cast("long"))
    names = [*carried, "id", "source", "size", "source_size", "target", "passes", "chosen"]
    every = inside.select(*names).unionByName(outside.select(*names))
    return every.select(*carried, "id", "source", "size", "source_size", "target", (F.col("passes") + F.col("chosen")).alias("copies"))


def _free(name: str, columns: list[str]) -> str:
    """The name, lengthened until no column has it in any case."""
    known = {c.lower() for c in columns}
    while name in known:
        name += "_"
    return name


def apply_mix(docs: DataFrame, seed: int = 7, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it is taken, numbered by ``copy``."""
    row, copies, copy = (_free(name, docs.columns) for name in ("__row", "__copies", "copy"))
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    found = mix(rows, seed, id_column, text_column, source_column, row).where("copies > 0")
    found = found.select(F.col("row").alias(row), F.col("copies").alias(copies))
    found = materialise(found, "mix-copies")
    found = F.broadcast(found) if found.count() <= BROADCAST_IDS else found
    spread = rows.join(found, row).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return spread.select(*[f"`{c}`" for c in docs.columns], copy)


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    found = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def brute_targets(sizes: dict, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> dict:
    """Targets by sharing out step by step; for tests."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out = {s: 0.0 for s in names}
    rest, free = float(sum(sizes.values())), set(names)
    while free and rest > 1e-9:
        unit = rest / sum(weight[s] for s in free)
        rest = 0.0
        for s in sorted(free, key=names.index):
            out[s] += unit * weight[s]
        for s in list(free):
            if out[s] >= limit * sizes[s]:
                rest += out[s] - limit * sizes[s]
                out[s] = float(limit * sizes[s])
                free.discard(s)
    return out
