"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A signature has ``symbols`` b-bit minimum hashes; the distance of two signatures is the number of symbols that
differ. The symbols are split into chunks. By the pigeonhole principle a pair within
``chunks * (errors + 1) - 1`` differing symbols agrees in some chunk but for ``errors`` symbols, so every chunk is
indexed under each choice of ``errors`` symbols left out. With the defaults (64 symbols, chunks of 4, 1 error) that
finds every pair with at most 31 of 64 symbols different; at similarity 0.75 about 16 differ. Found pairs are
confirmed on their whole shingle sets.

Equal sets become one node first. Then an index bucket is never paired out: each member meets the bucket's leader
(its smallest node), and confirmed links are joined into components. In buckets that still hold several components
each node then meets its nearest likely partner of another component, so that large groups of
near copies grow together by few pairs. Only what is still apart is compared in full, by signature, in groups of
bounded size. In a larger bucket that is one component but for a few members, blocks of that component each meet these
few; any other is cut by further symbols (again by pigeonhole) and what remains large in pairs of blocks. So no link is
lost, and no step gives out all pairs of a group.

Defined results: a null, empty or blank text has an empty set and links with nothing; rows that share an id are
one document with several texts; a null id links with nothing, its component is null and it is kept; an empty
table gives an empty result. Only id and text are read, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftmart.llm.common import SLICE_BYTES, U64, components, mixed, offsets, only_ids, slices, text_bytes, two_columns
from weftmart.session import materialise, materialise_narrow

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True

# random odd numbers and byte values from fixed seeds
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = U64(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(17).integers(1, 1 << 63, 256).astype(U64)


@dataclass(frozen=True)
class Plan:
    """How signatures are made and indexed."""

    shingle: int = 5
    percent: int = 75
    symbols: int = 64
    chunk: int = 4
    errors: int = 1
    #: members of a bucket that one task compares with each other
    group: int = 2048
    #: times that open buckets are thinned by nearest partners, and the most that such partners differ
    rounds: int = 1
    likely: int = 22

    def choices(self) -> list[list[int]]:
        """The symbols of every chunk under each choice of ``errors`` symbols left out."""
        starts = range(0, self.symbols, self.chunk)
        return [[start + c for c in kept] for start in starts for kept in combinations(range(self.chunk), self.chunk - self.errors)]

    @property
    def radius(self) -> int:
        """The signature distance up to which every pair is found."""
        return (self.symbols // self.chunk) * (self.errors + 1) - 1


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of all texts, and the bounds of each text among the words."""
    n = len(data)
    if not n:
        return np.zeros(0, U64), np.zeros(len(bounds), np.int64)
    low = _FOLD[data]
    inside = ~_WHITE[low]
    fresh, last = inside.copy(), inside.copy()
    fresh[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = bounds[:-1][bounds[:-1] < n]
    fresh[edges] = inside[edges]
    tails = bounds[1:][bounds[1:] > 0] - 1
    last[tails] = inside[tails]
    starts, stops = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    powers = np.full(n, _BASE, U64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(n + 1, U64)
    np.cumsum(_BYTES[low] * powers, out=sums[1:])
    back = np.full(n, _BASE_INVERSE, U64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    hashes = mixed((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(U64) * _STEP)
    return hashes, np.searchsorted(starts, bounds).astype(np.int64)


def shingle_hashes(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every run of ``size`` words (of all words of a shorter text), and the bounds of each text."""
    words, at = word_hashes(data, bounds)
    counts = np.diff(at)
    runs = np.maximum(counts - size + 1, np.minimum(counts, 1))
    out_at = np.concatenate([[0], np.cumsum(runs)]).astype(np.int64)
    out = np.zeros(out_at[-1], U64)
    full = np.flatnonzero(counts >= size)
    if len(words) >= size:
        rolled = words[: len(words) - size + 1].copy()
        for i in range(1, size):
            rolled *= _STEP
            rolled += words[i : len(words) - size + 1 + i]
        owner = np.repeat(np.arange(len(counts)), counts)
        valid = owner[: len(rolled)] == owner[size - 1 :]
        wanted = np.zeros(len(out), bool)
        for i in full:
            wanted[out_at[i] : out_at[i + 1]] = True
        out[wanted] = rolled[valid]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        value = U64(counts[i])
        for word in words[at[i] : at[i + 1]]:
            value = value * _STEP + word
        out[out_at[i]] = value
    return mixed(out), out_at


_SIGNED = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("signature", pa.binary())])
_SETS = pa.schema([("id", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("shingles", pa.binary())])


def _signer(plan: Plan, with_sets: bool):
    factors = mixed(np.arange(1, plan.symbols + 1, dtype=U64)) | U64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for part in slices(batches):
                hashes, at = shingle_hashes(*text_bytes(part["text"]), plan.shingle)
                rows = part.num_rows
                sizes, f1, f2, sets = np.zeros(rows, np.int64), np.zeros(rows, U64), np.zeros(rows, U64), []
                for i in range(rows):
                    own = np.unique(hashes[at[i] : at[i + 1]])
                    sizes[i] = len(own)
                    f1[i] = np.add.reduce(own * (own | U64(1))) + U64(len(own))
                    f2[i] = np.add.reduce(mixed(own))
                    if with_sets:
                        sets.append(own.tobytes())
                known = sizes > 0
                if with_sets:
                    columns = [part["id"], pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array(sets, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, schema=_SETS)
                    continue
                marks = np.zeros((rows, plan.symbols), "<u2")
                if known.any():
                    firsts = at[:-1][known]
                    for j, factor in enumerate(factors):
                        lowest = np.minimum.reduceat(hashes * factor, firsts)
                        marks[known, j] = mixed(lowest) >> U64(48)
                columns = [
                    part["id"], pa.array(sizes), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                    pa.array([m.tobytes() for m in marks], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_SIGNED)

    return sign


def signatures(docs: DataFrame, plan: Plan) -> DataFrame:
    """``(id, n, f1, f2, signature)``: set size, a 128-bit fingerprint of the set, and the signature."""
    return docs.mapInArrow(_signer(plan, False), "id bigint, n bigint, f1 bigint, f2 bigint, signature binary")


def shingle_sets(docs: DataFrame, plan: Plan) -> DataFrame:
    return docs.mapInArrow(_signer(plan, True), "id bigint, f1 bigint, f2 bigint, shingles binary")


def _marks(column: pa.Array, symbols: int) -> np.ndarray:
    data, _ = text_bytes(column)
    return data.view("<u2").reshape(-1, symbols)


def index_keys(nodes: DataFrame, plan: Plan) -> DataFrame:
    """``(key, node, choice)``: every chunk under each choice of symbols left out."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("choice", pa.int32())])
    choices = plan.choices()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                marks, node = _marks(batch["signature"], plan.symbols).astype(U64), batch["node"]
                for number, kept in enumerate(choices):
                    key = np.full(len(marks), number, U64)
                    for c in kept:
                        key = mixed(key * _STEP + marks[:, c] + U64(1))
                    columns = [pa.array(key.view(np.int64)), node, pa.array(np.full(len(marks), number, np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return nodes.select("node", "signature").mapInArrow(keys, "key bigint, node bigint, choice int")


def further_keys(rows: DataFrame, plan: Plan, level: int) -> DataFrame:
    """Cut buckets ``(key, node, component, choice, signature)``: symbols dealt into ``radius + 1`` sets, one of which must agree."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("component", pa.int64()), ("choice", pa.int32())])
    order = np.random.default_rng(level).permutation(plan.symbols)
    dealt = [order[i :: plan.radius + 1] for i in range(min(plan.radius + 1, plan.symbols))]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                marks = _marks(batch["signature"], plan.symbols).astype(U64)
                base = np.asarray(batch["key"]).view(U64)
                for number, kept in enumerate(dealt):
                    key = mixed(base + U64(number + 1) * _STEP)
                    for c in kept:
                        key = mixed(key * _STEP + marks[:, c] + U64(1))
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch["node"], batch["component"], batch["choice"]], schema=schema)

    return rows.select("key", "node", "component", "choice", "signature").mapInArrow(keys, "key bigint, node bigint, component bigint, choice int")


def _close(plan: Plan):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = (_marks(batch["left"], plan.symbols) != _marks(batch["right"], plan.symbols)).sum(1)
            near = (apart <= plan.radius) & _sizes_fit(np.asarray(batch["m"]), np.asarray(batch["n"]), plan)
            near = pa.array(near)
            yield pa.RecordBatch.from_arrays([batch["a"].filter(near), batch["b"].filter(near)], schema=schema)

    return close


def _sizes_fit(m: np.ndarray, n: np.ndarray, plan: Plan) -> np.ndarray:
    """Whether sets of these sizes can be similar enough at all."""
    return 100 * np.minimum(m, n) >= plan.percent * np.maximum(m, n)


def within_radius(pairs: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("left"), F.col("n").alias("m"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("right"), "n")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right", "m", "n").mapInArrow(_close(plan), "a bigint, b bigint")


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """The number of values that two sorted sets have in common."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups ``(key, low, high)`` and the groups' bounds, from rows sorted by them; a group has a bounded size."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        keys = np.stack([np.asarray(table[c]) for c in ("key", "low", "high")], 1)
        cuts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1))) if len(keys) else np.zeros(1, np.int64)
        if cuts[-1]:
            yield table.slice(0, cuts[-1]).combine_chunks(), cuts
        rest = table.slice(cuts[-1])
    if rest is not None and rest.num_rows > 1:
        yield rest.combine_chunks(), np.array([0, rest.num_rows])


def _differing(unlike: np.ndarray) -> np.ndarray:
    """How many symbols differ, from a row of truth values per pair."""
    if unlike.shape[1] % 8 or unlike.shape[1] > 248:
        return unlike.sum(1)
    eight = unlike.view(U64)
    total = eight[:, 0].copy()
    for k in range(1, eight.shape[1]):
        total += eight[:, k]
    return ((total * U64(0x0101010101010101)) >> U64(56)).astype(np.int64)


#: pairs of groups up to this size are listed for all groups at once; those of larger ones are compared in blocks
_SMALL = 64
_PIECE = 1 << 16


def _near_pairs(table: pa.Table, bounds: np.ndarray, plan: Plan, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers ``i < j`` and distance of each group's pairs within ``limit`` symbols, of different components and fitting sizes."""
    marks = _marks(table["signature"].chunk(0), plan.symbols)
    component, block, size, low, high = (np.asarray(table[c]) for c in ("component", "block", "n", "low", "high"))
    two = low != high

    def fit(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        some = (component[i] != component[j]) & _sizes_fit(size[i], size[j], plan)
        return some & (~two[i] | (block[i] != block[j]))

    def compared(i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for at in range(0, len(i), _PIECE):
            x, y = i[at : at + _PIECE], j[at : at + _PIECE]
            apart = _differing(marks[x] != marks[y])
            near = apart <= limit
            yield x[near], y[near], apart[near]

    sizes = np.diff(bounds)
    # every row of a small group meets the rows after it
    after = np.repeat(bounds[1:], sizes) - 1 - np.arange(bounds[0], bounds[-1])
    after[np.repeat(sizes > _SMALL, sizes)] = 0
    upto = np.concatenate([[0], np.cumsum(after)])
    start = 0
    while start < len(after) and upto[-1] > upto[start]:
        stop = max(start + 1, int(np.searchsorted(upto, upto[start] + _PIECE, side="right")) - 1)
        i = np.repeat(np.arange(start, stop), after[start:stop])
        j = i + 1 + np.arange(len(i)) - (upto[i] - upto[start])
        fitting = fit(i, j)
        yield from compared(i[fitting], j[fitting])
        start = stop
    for g in np.flatnonzero(sizes > _SMALL):
        begin, end = int(bounds[g]), int(bounds[g + 1])
        columns = np.ascontiguousarray(marks[begin:end].T)
        for first in range(begin, end, 64):
            rows, others = np.arange(first, min(first + 64, end)), np.arange(first, end)
            fitting = fit(rows[:, None], others[None, :]) & (rows[:, None] < others[None, :])
            if 8 * np.count_nonzero(fitting) < fitting.size:
                i, j = np.nonzero(fitting)
                yield from compared(i + first, j + first)
                continue
            apart, unlike = np.zeros(fitting.shape, np.uint16), np.empty(fitting.shape, bool)
            for symbol in columns[:, first - begin :]:
                np.not_equal(symbol[: len(rows), None], symbol[None, :], out=unlike)
                apart += unlike
            fitting &= apart <= limit
            i, j = np.nonzero(fitting)
            yield i + first, j + first, apart[fitting].astype(np.int64)


def _nearest(plan: Plan):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _whole_groups(batches):
            node = np.asarray(table["node"])
            # distance in the upper half, row in the lower
            best = np.full(len(node), (plan.likely + 1) << 32)
            for i, j, apart in _near_pairs(table, bounds, plan, plan.likely):
                np.minimum.at(best, i, (apart << 32) | j)
                np.minimum.at(best, j, (apart << 32) | i)
            have = np.flatnonzero(best < (plan.likely + 1) << 32)
            a, b = node[have], node[best[have] & 0xFFFFFFFF]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=schema)

    return nearest


def _packed(same: np.ndarray) -> np.ndarray:
    """Truth values as bits of 64-bit words, a row per pair."""
    bits = np.zeros((len(same), -(-same.shape[1] // 64) * 8), np.uint8)
    packed = np.packbits(same, axis=1, bitorder="little")
    bits[:, : packed.shape[1]] = packed
    return bits.view(U64)


def _first_met(table: pa.Table, bounds: np.ndarray, plan: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The groups' pairs within the radius that agree under no earlier choice, so that each is looked at once."""
    marks = _marks(table["signature"].chunk(0), plan.symbols)
    choice = np.asarray(table["choice"])
    wanted = np.zeros((len(plan.choices()), plan.symbols), bool)
    for number, kept in enumerate(plan.choices()):
        wanted[number, kept] = True
    wanted = _packed(wanted)
    for i, j, _ in _near_pairs(table, bounds, plan, plan.radius):
        for at in range(0, len(i), _PIECE):
            x, y = i[at : at + _PIECE], j[at : at + _PIECE]
            same, own = _packed(marks[x] == marks[y]), choice[x]
            met = np.zeros(len(x), bool)
            for number in range(int(own.max())):
                agree = own > number
                # words without a symbol of this choice agree anyway
                for word in np.flatnonzero(wanted[number]):
                    agree &= (same[:, word] & wanted[number, word]) == wanted[number, word]
                met |= agree
            yield x[~met], y[~met]


def _active(plan: Plan):
    schema = pa.schema([(c, pa.int64()) for c in ("key", "low", "high", "node")])

    def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _whole_groups(batches):
            some = np.zeros(table.num_rows, bool)
            for i, j in _first_met(table, bounds, plan):
                some[i] = some[j] = True
            if some.any():
                mask = pa.array(some)
                yield pa.RecordBatch.from_arrays([table[c].chunk(0).filter(mask) for c in schema.names], schema=schema)

    return active


def _similar(i: np.ndarray, j: np.ndarray, sets: tuple[np.ndarray, np.ndarray], plan: Plan) -> np.ndarray:
    """Whether the sets of these rows, in order of ``i``, are similar enough. A row's set is marked once for all its partners."""
    numbers, at = sets
    size = np.diff(at)
    mark = np.zeros(int(numbers.max(initial=-1)) + 1, bool)
    out = np.zeros(len(i), bool)
    heads = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
    for begin, end in zip(heads.tolist(), [*heads[1:].tolist(), len(i)], strict=True):
        row = i[begin]
        own = numbers[at[row] : at[row + 1]]
        mark[own] = True
        upto = np.concatenate([[0], np.cumsum(size[j[begin:end]])])
        first = 0
        while first < end - begin:
            last = max(first + 1, int(np.searchsorted(upto, upto[first] + (1 << 20), side="right")) - 1)
            partners = j[begin + first : begin + last]
            starts = upto[first:last] - upto[first]
            places = np.arange(upto[last] - upto[first]) + np.repeat(at[partners] - starts, size[partners])
            shared = np.add.reduceat(mark[numbers[places]].astype(np.int64), starts)
            out[begin + first : begin + last] = 100 * shared >= plan.percent * (len(own) + size[partners] - shared)
            first = last
        mark[own] = False
    return out


def _links(plan: Plan):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def confirmed_in(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, sets = np.asarray(table["node"]), None
        for i, j in _first_met(table, bounds, plan):
            if not len(i):
                continue
            if sets is None:
                data, at = text_bytes(table["shingles"].chunk(0))
                # shingles as small numbers, so that a set can be marked in an array
                sets = np.unique(data.view(U64), return_inverse=True)[1], at // 8
            near = _similar(i, j, sets, plan)
            if near.any():
                yield pa.RecordBatch.from_arrays([pa.array(node[i[near]]), pa.array(node[j[near]])], schema=schema)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _whole_groups(batches):
            ends, first = offsets(table["shingles"].chunk(0))[bounds].astype(np.int64), 0
            while first < len(bounds) - 1:
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE_BYTES * 8, side="right")) - 1)
                part = table.slice(bounds[first], bounds[last] - bounds[first])
                yield from confirmed_in(part, bounds[first : last + 1] - bounds[first])
                first = last

    return links


def open_groups(rows: DataFrame) -> DataFrame:
    """Rows ``(key, node, component, choice)`` of the keys that hold more than one component, with the key's size, its
    largest component and how many members that has."""
    each = rows.groupBy("key", "component").agg(F.count("*").alias("n"))
    counts = each.groupBy("key").agg(F.count("*").alias("several"), F.sum("n").alias("size"), F.max_by("component", "n").alias("main"), F.max("n").alias("most"))
    counts = materialise_narrow(counts.where("several > 1").drop("several"), "open-keys")
    return materialise_narrow(rows.select("key", "node", "component", "choice").join(counts, "key"), "open-rows")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")


def against_main(rows: DataFrame, plan: Plan) -> DataFrame:
    """Buckets that are one component but for at most half a group: blocks of that component, each with all other members."""
    blocks = F.ceil(2 * F.col("size") / plan.group).cast("long")
    own = F.array(F.pmod(F.xxhash64("node"), blocks))
    place = F.when(F.col("component") == F.col("main"), own).otherwise(F.sequence(F.lit(0).cast("long"), blocks - 1))
    return rows.withColumn("low", F.explode(place)).withColumns({"high": F.col("low"), "block": F.col("low")})


def likely_pairs(rows: DataFrame, nodes: DataFrame, plan: Plan, number: int) -> DataFrame:
    """Each node's nearest likely partner of another component, from open buckets cut into parts of bounded size."""
    rows = open_groups(rows)
    parts = F.ceil(2 * F.col("size") / plan.group).cast("long")
    part = F.when(F.col("size") <= plan.group, 0).otherwise(F.pmod(F.xxhash64("node", F.lit(number)), parts)).cast("long")
    dealt = rows.withColumn("low", part).withColumns({"high": F.col("low"), "block": F.col("low")})
    dealt = dealt.join(nodes.select("node", "signature", "n"), "node")
    return _dealt(dealt).mapInArrow(_nearest(plan), "a bigint, b bigint").distinct()


def remaining_links(members: DataFrame, docs: DataFrame, nodes: DataFrame, plan: Plan, levels: int = 3) -> DataFrame:
    """Links between different components, from buckets ``(key, node, component, choice)``.

    First only signatures meet, and say which members have any partner within the radius. Those get their whole sets,
    and the same groups confirm their pairs in place; neither step gives out a row per pair.
    """
    signed, rows = nodes.select("node", "signature", "n"), members
    zero = F.lit(0).cast("long")
    parts = []
    for level in range(levels + 1):
        rows = open_groups(rows)
        fitting = F.col("size") <= plan.group
        parts.append(rows.where(fitting).withColumns({"low": zero, "high": zero, "block": zero}))
        few = 2 * (F.col("size") - F.col("most")) <= plan.group
        parts.append(against_main(rows.where(~fitting & few), plan))
        rest = rows.where(~fitting & ~few)
        if rest.isEmpty():
            break
        if level < levels:
            rows = further_keys(rest.join(signed, "node"), plan, level)
            continue
        # the rest: blocks of a bucket against each other
        blocks = F.ceil(2 * F.col("size") / plan.group).cast("long")
        large = rest.withColumn("block", F.pmod(F.xxhash64("node"), blocks))
        large = large.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        parts.append(large.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other"))
    groups = parts[0]
    for more in parts[1:]:
        groups = groups.unionByName(more)
    groups = materialise_narrow(groups, "groups")
    place = ["key", "low", "high", "node"]
    active = _dealt(groups.join(signed, "node")).mapInArrow(_active(plan), "key bigint, low bigint, high bigint, node bigint")
    active = materialise_narrow(active.distinct(), "active")
    sets = node_sets(active.select("node"), docs, nodes, plan)
    full = groups.join(active, place, "left_semi").join(signed, "node").join(sets, "node")
    return _dealt(full).mapInArrow(_links(plan), "a bigint, b bigint").distinct()


def node_sets(used: DataFrame, docs: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """``(node, shingles)`` of the nodes in ``used (node)``, from the texts of their documents."""
    wanted = nodes.join(used.distinct(), "node", "left_semi").select("node", "id", "f1", "f2")
    wanted = materialise_narrow(wanted, "wanted")
    sets = shingle_sets(only_ids(docs, wanted), plan).join(wanted, ["id", "f1", "f2"])
    return sets.select("node", "shingles")


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """Those pairs of nodes whose whole sets are similar enough."""
    used = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    sets = node_sets(used, docs, nodes, plan)
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch["left"], batch["right"], strict=True):
                x, y = np.frombuffer(one.as_buffer(), U64), np.frombuffer(two.as_buffer(), U64)
                shared = _shared(x, y)
                keep.append(100 * shared >= plan.percent * (len(x) + len(y) - shared))
            near = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(near), batch["b"].filter(near)], schema=schema)

    # each set is sent once per pair, so the sides meet in joins that AQE can split
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return materialise_narrow(both.mapInArrow(check, "a bigint, b bigint").distinct(), "links")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", plan: Plan = Plan()) -> DataFrame:
    """``(id, n_shingles, component)`` for every row of ``docs``."""
    docs = two_columns(docs, id_column, text_column)
    signed = materialise(signatures(docs, plan), "signatures")
    known = signed.where("n > 0 AND id IS NOT NULL")
    nodes = known.groupBy("f1", "f2", "n", "signature").agg(F.min("id").alias("id"))
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    keys = index_keys(nodes, plan)
    leaders = keys.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("size")).where("size > 1")
    leaders = materialise_narrow(leaders, "leaders")
    members = materialise_narrow(keys.join(leaders, "key"), "members")
    stars = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    looked = materialise_narrow(within_radius(stars, nodes, plan), "stars")
    links = confirmed(looked, docs, nodes, plan)
    rows = known.join(nodes.select("f1", "f2", "node"), ["f1", "f2"]).select("id", "node")
    rows = materialise_narrow(rows.distinct(), "rows")
    # rows that share an id are one document
    shared = rows.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    same = shared.join(rows, "id").select("a", F.col("node").alias("b")).where("a <> b")
    linked = components(links.unionByName(same))
    for number in range(plan.rounds + 1):
        joined = members.where("size > 2").join(linked, members["node"] == linked["id"], "left")
        joined = joined.select("key", "node", "choice", F.coalesce("component", "node").alias("component"))
        if number < plan.rounds:
            # a pair that was looked at before is no link
            pairs = likely_pairs(joined, nodes, plan, number).join(looked, ["a", "b"], "left_anti")
            pairs = materialise_narrow(pairs, "pairs")
            looked = looked.unionByName(pairs)
            more = confirmed(pairs, docs, nodes, plan)
        else:
            more = materialise_narrow(remaining_links(joined, docs, nodes, plan), "last-links")
        if not more.isEmpty():
            # the components so far stand for all links before
            linked = components(linked.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))
    placed = rows.join(linked.withColumnRenamed("id", "node"), "node", "left")
    placed = materialise_narrow(placed.select("id", F.coalesce("component", "node").alias("component")).distinct(), "placed")
    smallest = placed.groupBy("component").agg(F.min("id").alias("smallest"))
    named = placed.join(smallest, "component").select(F.col("id").alias("known_id"), "smallest")
    out = signed.select("id", "n").join(named, F.col("id") == F.col("known_id"), "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "id").alias("component"))


def op6_minhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def brute_force(texts: list[tuple[int, str | None]], size: int = 5, percent: int = 75) -> list[tuple]:
    """The same by comparing all sets that share a shingle; for tests."""
    fold = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    sets = []
    for doc, text in texts:
        words = [w.decode() for w in (text or "").translate(fold).encode().split()]
        runs = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
        sets.append((doc, runs))
    parent = {doc: doc for doc, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_run: dict[tuple, list[int]] = {}
    for i, (_, runs) in enumerate(sets):
        for run in runs:
            by_run.setdefault(run, []).append(i)
    for i, (doc, runs) in enumerate(sets):
        shared: dict[int, int] = {}
        for run in runs:
            for j in by_run[run]:
                if j > i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= percent * (len(runs) + len(sets[j][1]) - n):
                a, b = sorted((root(doc), root(sets[j][0])))
                parent[b] = a
    return [(doc, len(runs), root(doc), root(doc) == doc) for doc, runs in sets]
