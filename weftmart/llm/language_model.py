"""A hierarchical Pitman-Yor language model over the whole corpus, fitted by sampled Chinese-restaurant seatings.

A word's context is the word before it, or the end token before a text's first word. Every context is a restaurant
whose customers are the words after it; all of them share one root restaurant over single words, and below the root
lies the uniform distribution over the known words and one unknown one. A table of a context's restaurant is a customer
of the root. Contexts and words both grow with the corpus, so nothing that is kept by either meets in one place: dishes
(context, word) lie in the shard of their word's hash, a context's customers and tables are added up in the shard of
its own, and both go back and forth as lists by shard.

Gibbs sampling goes in sweeps. In a sweep each dish (word) of each restaurant is reseated: its customers leave and
come back one by one, each opening a table with odds of strength plus discount times tables, times the parent's
probability, against those of the seated customers. The restaurants' table counts are added up after each sweep, so
within a sweep a dish sees the other dishes' tables as of the sweep before. Customers of a
dish beyond the fiftieth come back in blocks of two in a hundred, during which the odds stand still. The first
sweep only warms up; probabilities are averaged over the others. Discounts follow from how many dishes have one and
two customers.

Texts are gathered in buckets of bounded size; a bucket asks each shard once for each of its words and (context, word)
pairs, and the answers, customers and tables as whole numbers, meet the bucket's documents. A word is known by a 64-bit
hash of its bytes. Tables of a step are removed when the next one is written.

Defined results: a null or empty text is one end token; rows that share an id are documents of their own, alike in
whether they are held out; a null id is not held out; without any training text every word is unknown; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from copy import copy
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from weftmart.llm.common import U64, slices, text_bytes, two_columns
from weftmart.llm.minhash import word_hashes
from weftmart.session import discard, freed_shuffles, read_if_there, scratch_path, small_batches, write_table

#: bytes of text of a bucket, and of the corpus per shard
BUCKET, SHARD = 12 << 20, 32 << 20
#: bytes of text that are hashed at once, which takes about fifty bytes for each
STEP = 1 << 19
#: a bucket's pairs are scored in about so many parts
PARTS = 16
#: the shards answer in so many jobs, so that only a share of what they are asked lies in a shuffle beside its table
WAVES = 4
#: rows of an Arrow batch, where a row holds lists of a shard or of a bucket and shard
ROWS = 16
#: sweeps to warm up, and sweeps whose probabilities are averaged
WARM, SAMPLES = 1, 2
#: customers of a dish that come back one by one, and the share of the seated that then come at once
SINGLES = 50
#: contexts that the tests seat a shard over; those of a corpus have no bound
CHILDREN = 4096
#: documents whose crc32 is divisible by this are held out
HELD = 10
#: the end token
END = U64(0x5DEECE66D1234567)
STRENGTH = 1.0


def pack(values: np.ndarray) -> bytes:
    """Compressed, all first bytes of the values before all second ones."""
    values = np.ascontiguousarray(values)
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def unpack(blob: bytes, kind) -> np.ndarray:
    data = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in half of the bytes where they fit."""
    return values.astype(np.int32) if values.max(initial=0) < 1 << 31 else values


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=U64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, U64), dtype=U64)


# -- tokens ----------------------------------------------------------------------------------------------------------


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, contexts, bounds)`` of all texts: the hashes of a text's words and its end, and of the word before each."""
    words, at = word_hashes(data, bounds)
    edges = np.concatenate([[0], np.cumsum(np.diff(at) + 1)])
    out = np.full(edges[-1], END, U64)
    kept = np.ones(edges[-1], bool)
    kept[edges[1:] - 1] = False
    out[kept] = words
    return out, np.concatenate([[END], out[:-1]]).astype(U64) if len(out) else out, edges


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """By the first bits, so that sorted hashes lie shard by shard."""
    return (hashes >> U64(64 - (shards.bit_length() - 1))).astype(np.int64) if shards > 1 else np.zeros(len(hashes), np.int64)


GATHERED = "kind int, bucket long, shard long, id long, held boolean, a binary, b binary, c binary, d binary, e binary"
_COLUMNS = [x.split()[0] for x in GATHERED.split(", ")]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), *[pa.binary()] * 5]


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(_COLUMNS, _TYPES, strict=True)], _COLUMNS)


def pairs_of(words: np.ndarray, held: np.ndarray, end: int, known: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs ``word * known + context`` of a bucket's texts in order, and how many tokens of each are not held out.

    ``words`` are numbers under ``known``; each text ends with the number ``end``, which also stands before its first.
    """
    # sorted in place: one array of all tokens is the most that is held
    pairs = words.astype(np.int64)
    pairs *= known
    pairs[0] += end
    pairs[1:] += words[:-1]
    pairs *= 2
    pairs += held
    pairs.sort()
    gone = (pairs & 1).astype(bool)
    pairs >>= 1
    starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    stops = np.append(starts[1:], len(pairs))
    upto = np.concatenate([[0], np.cumsum(~gone, dtype=np.uint32)])
    return pairs[starts], (upto[stops] - upto[starts]).astype(np.uint32)


def gather(docs: DataFrame, shards: int) -> DataFrame:
    """Per document a row (kind 1) with the numbers of its words in its bucket; per bucket and shard a row (kind 0) with
    the words and the pairs (context, word) in order of word and context, with their counts in training documents."""

    def bucketed(number: int, parts: list, ids: list, gone: list) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bucket = (TaskContext.get().partitionId() << 32) | number
        sizes = np.concatenate([p[2] for p in parts])
        known = np.unique(np.concatenate([p[0] for p in parts]))
        place = np.concatenate([np.searchsorted(known, own).astype(np.uint32)[at] for own, at, _ in parts])
        parts.clear()
        pairs, trained = pairs_of(place, np.repeat(np.array(gone, bool), sizes), int(np.searchsorted(known, END)), len(known))
        edges = np.concatenate([[0], np.cumsum(sizes)])
        rows = []
        for i, doc in enumerate(ids):
            rows.append({"kind": 1, "bucket": bucket, "id": doc, "held": gone[i], "a": pack(place[edges[i] : edges[i + 1]])})
            if len(rows) >= 2000:
                yield _rows(rows)
                rows = []
        yield _rows(rows)
        del rows, place
        shard = shard_of(known, shards)
        word, context = (x.astype(np.uint32) for x in np.divmod(pairs, len(known)))
        del pairs
        per_word = np.bincount(word, minlength=len(known)).astype(np.uint32)
        pair_edges = np.concatenate([[0], np.cumsum(per_word.astype(np.int64))])
        for s in np.unique(shard):
            i, j = np.searchsorted(shard, [s, s + 1])
            p, q = pair_edges[i], pair_edges[j]
            heads, head = np.unique(context[p:q], return_inverse=True)
            blobs = {"a": pack_sorted(known[i:j]), "b": pack(per_word[i:j]), "c": pack_sorted(known[heads]), "d": pack(head.astype(np.uint32)), "e": pack(trained[p:q])}
            yield _rows([{"kind": 0, "bucket": bucket, "shard": int(s), **blobs}])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, parts, ids, gone = 0, 0, [], [], []
        for batch in slices(batches, limit=STEP):
            data, bounds = text_bytes(batch.column(1))
            words, _, edges = tokens(data, bounds)
            # a token is kept as the number of its word in the slice
            own, at = np.unique(words, return_inverse=True)
            parts.append((own, at.astype(np.uint32), np.diff(edges)))
            for doc in batch.column(0).to_pylist():
                ids.append(doc)
                gone.append(doc is not None and zlib.crc32(str(doc).encode()) % HELD == 0)
            # rows count too, for texts that are all but empty
            size += len(data) + 16 * batch.num_rows
            if size >= BUCKET:
                yield from bucketed(number, parts, ids, gone)
                number, size, parts, ids, gone = number + 1, 0, [], [], []
        if ids:
            yield from bucketed(number, parts, ids, gone)

    return docs.mapInArrow(gathered, GATHERED)


# -- the model -------------------------------------------------------------------------------------------------------


@dataclass
class Restaurants:
    """What is known of the root and of some contexts' restaurants in one state of the seating; other contexts have no customers."""

    heads: np.ndarray
    customers: np.ndarray
    tables: np.ndarray
    root: tuple[int, int]
    words: int
    tokens: int
    discounts: list[float]

    @staticmethod
    def of(sums: tuple) -> Restaurants:
        """From what ``Shard.sums`` gives, added over all shards: a few numbers, and the contexts' customers and tables."""
        fixed, heads, customers, tables = sums
        tokens, one, two, *above, words = (int(v) for v in fixed)
        ends = [(one, two), tuple(above[2:])]
        discounts = [float(np.clip(x / max(x + 2 * y, 1), 0.05, 0.95)) for x, y in ends]
        return Restaurants(heads, customers, tables, (above[0], above[1]), words, tokens, discounts)

    def at(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of contexts."""
        place, there = found(self.heads, contexts)
        return tuple(np.where(there, x[place], 0) if len(x) else np.zeros(len(contexts), np.int64) for x in (self.customers, self.tables))

    def single(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The root's probability of words with these customers and tables there."""
        all_customers, all_tables = self.root
        d = self.discounts[1]
        left = (STRENGTH + d * all_tables) / (STRENGTH + all_customers) / (self.words + 1)
        return (customers - d * tables) / (STRENGTH + all_customers) + left

    def after(self, own: tuple, context: tuple, single: np.ndarray) -> np.ndarray:
        """Probabilities of pairs from customers and tables of the pair, of its context, and the root's probability of its word."""
        d = self.discounts[0]
        return (own[0] - d * own[1] + (STRENGTH + d * context[1]) * single) / (STRENGTH + context[0])


def found(keys: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values among sorted keys, and whether they are there."""
    at = np.minimum(np.searchsorted(keys, of), max(len(keys) - 1, 0))
    return at, keys[at] == of if len(keys) else np.zeros(len(of), bool)


class Shard:
    """All dishes of some words: counts by (word, context), with tables there and at the root.

    ``contexts`` are numbers among the sorted ``heads`` if these are given."""

    def __init__(self, words, per_word, contexts, counts, tables=None, heads=None):
        self.words, self.counts = np.asarray(words, U64), counts
        self.word = np.repeat(np.arange(len(words), dtype=np.uint32), per_word)
        if heads is None:
            heads, contexts = np.unique(np.asarray(contexts, U64), return_inverse=True)
        self.heads, self.head = heads, np.asarray(contexts, np.uint32)
        self.tables = tables or [np.ones(len(counts), np.int64), np.ones(len(words), np.int64)]

    @cached_property
    def keys(self) -> np.ndarray:
        """The pairs in order, by which they are looked up."""
        keys = self.word.astype(np.int64)
        keys *= max(len(self.heads), 1)
        keys += self.head
        return keys

    def customers(self) -> list[np.ndarray]:
        return [self.counts, np.bincount(self.word, weights=self.tables[0], minlength=len(self.words)).astype(np.int64)]

    def fixed(self) -> np.ndarray:
        customers, above = self.customers()
        ends = [(customers == 1).sum(), (customers == 2).sum()], [(above == 1).sum(), (above == 2).sum()]
        return np.array([customers.sum(), *ends[0], above.sum(), self.tables[1].sum(), *ends[1], len(self.words)], np.int64)

    def sums(self) -> tuple:
        by_head = [np.bincount(self.head, weights=x, minlength=len(self.heads)).astype(np.int64) for x in (self.counts, self.tables[0])]
        return self.fixed(), self.heads, *by_head

    def sweep(self, r: Restaurants, rng: np.random.Generator) -> None:
        """Reseat every dish, contexts first, so that the root seats the tables they have now."""
        d, t = r.discounts, self.tables
        single = r.single(self.customers()[1], t[1])
        t[0] = reseat(self.counts, r.at(self.heads)[1][self.head] - t[0], single[self.word], d[0], rng)
        t[1] = reseat(self.customers()[1], r.root[1] - t[1], np.full(len(self.words), 1 / (r.words + 1)), d[1], rng)

    def by_word(self) -> list[np.ndarray]:
        """Count, customers and tables at the root of every word."""
        total = np.bincount(self.word, weights=self.counts, minlength=len(self.words)).astype(np.int64)
        return [total, self.customers()[1], self.tables[1]]

    def seated(self, by_word: list, words: np.ndarray, per_word: np.ndarray, heads: np.ndarray, head: np.ndarray) -> tuple[list, list]:
        """Of words what ``by_word`` tells, of pairs customers and tables. All are 0 for those not known."""
        at, there = found(self.words, words)
        of_words = [np.where(there, x[at], 0) if len(x) else np.zeros(len(words), np.int64) for x in by_word]
        place, known = found(self.heads, heads)
        inner = np.repeat(np.where(there, at, -1), per_word)
        pair, both = found(self.keys, np.where((inner >= 0) & known[head], inner * max(len(self.heads), 1) + place[head], -1))
        of_pairs = [np.where(both, x[pair], 0) if len(x) else np.zeros(len(head), np.int64) for x in (self.counts, self.tables[0])]
        return of_words, of_pairs


def reseat(customers: np.ndarray, others: np.ndarray, above: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """The tables of each dish after its customers came back, given the restaurant's ``others`` tables and the parent's probability."""
    tables, seated = np.ones(len(customers), np.int64), np.ones(len(customers), np.int64)
    active = np.flatnonzero(customers > 1)
    base = (STRENGTH + discount * np.maximum(others, 0)) * above
    while len(active):
        k, t = seated[active], tables[active]
        many = np.minimum(np.maximum(1, k // SINGLES), customers[active] - k)
        fresh = base[active] + discount * above[active] * t
        odds = fresh / (fresh + k - discount * t)
        new = np.where(many == 1, rng.random(len(active)) < odds, 0)
        blocks = np.flatnonzero(many > 1)
        new[blocks] = rng.binomial(many[blocks], odds[blocks])
        tables[active] = t + new
        seated[active] = k + many
        active = active[k + many < customers[active]]
    return tables


STATE = "shard long, words binary, per_word binary, heads binary, head binary, counts binary, tables array<binary>, fixed array<long>"
_STATE = [pa.int64(), *[pa.binary()] * 5, pa.list_(pa.binary()), pa.list_(pa.int64())]


def _state_row(shard: int, x: Shard, kept: list[bytes]) -> pa.RecordBatch:
    """``kept`` holds the packed tables of earlier states."""
    per_word = np.bincount(x.word, minlength=len(x.words)).astype(np.uint32)
    blobs = [pack_sorted(x.words), pack(per_word), pack_sorted(x.heads), pack(x.head.astype(np.uint32)), pack(x.counts)]
    values = [shard, *blobs, [*kept, *map(pack, x.tables)], x.fixed()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _STATE, strict=True)], [c.split()[0] for c in STATE.split(", ")])


def _shard_of(row: dict, state: int = -1) -> Shard:
    at = state % (len(row["tables"]) // 2) * 2
    tables = [unpack(b, np.int64).copy() for b in row["tables"][at : at + 2]]
    head, heads = unpack(row["head"], np.uint32), unpack_sorted(row["heads"])
    return Shard(unpack_sorted(row["words"]), unpack(row["per_word"], np.uint32), head, unpack(row["counts"], np.int64), tables, heads)


def _by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def first_state(asked: DataFrame) -> DataFrame:
    """One row per shard with the summed counts of its training pairs, every dish at one table."""

    def merged(parts: list[tuple]) -> tuple:
        known, place = np.unique(np.concatenate([np.repeat(p[0], p[1]) for p in parts]), return_inverse=True)
        heads, of = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
        starts = np.cumsum([0, *[len(p[2]) for p in parts[:-1]]])
        head = of[np.concatenate([p[3] + n for p, n in zip(parts, starts, strict=True)])]
        keys, at = np.unique(place * max(len(heads), 1) + head, return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([p[4] for p in parts]), minlength=len(keys)).astype(np.int64)
        word, head = np.divmod(keys, max(len(heads), 1))
        return known, np.bincount(word, minlength=len(known)), heads, head, counts

    def shard_row(shard: int, parts: list[tuple]) -> pa.RecordBatch:
        known, per_word, heads, head, counts = merged(parts)
        return _state_row(shard, Shard(known, per_word, heads[head], counts), [])

    def trained(row: dict) -> tuple:
        words, per_word, heads, head, n = unpack_sorted(row["a"]), unpack(row["b"], np.uint32), unpack_sorted(row["c"]), unpack(row["d"], np.uint32), unpack(row["e"], np.uint32)
        inside = np.bincount(np.repeat(np.arange(len(words)), per_word)[n > 0], minlength=len(words))
        return words, inside, heads, head[n > 0].astype(np.int64), n[n > 0]

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, held, kept = None, [], 0, 0
        for row in _by_row(batches):
            if row["shard"] != shard:
                if shard is not None:
                    yield shard_row(shard, parts)
                shard, parts, held, kept = row["shard"], [], 0, 0
            parts.append(trained(row))
            held += len(parts[-1][3])
            # what has come so far is summed up whenever it has doubled
            if held > max(1 << 20, 2 * kept):
                parts = [merged(parts)]
                held = kept = len(parts[0][3])
        if shard is not None:
            yield shard_row(shard, parts)

    rows = asked.select("shard", "bucket", "a", "b", "c", "d", "e")
    return rows.repartition("shard").sortWithinPartitions("shard", "bucket").mapInArrow(states, STATE)


def added_up(state: DataFrame) -> np.ndarray:
    """The sums of all shards that have a fixed size."""
    rows = state.select(F.posexplode("fixed").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    sums = np.zeros(8, np.int64)
    for r in rows:
        sums[r.i] = r.v
    return sums


_TOLD = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("heads", pa.binary()), ("customers", pa.binary()), ("tables", pa.binary())])
TOLD = "shard long, kind int, block long, heads binary, customers binary, tables binary"


def _told(*values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _TOLD, strict=True)], schema=_TOLD)


def contexts_of(state: DataFrame, shards: int) -> DataFrame:
    """Customers and tables of all contexts, added up in the shard of the context's hash (``block``).

    Kind 1: all contexts of a block, once. Kind 0: for each shard its own contexts of the block, in their order.
    """

    def said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _by_row(batches):
            _, heads, customers, tables = _shard_of(row).sums()
            cuts = np.searchsorted(shard_of(heads, shards), np.arange(shards + 1))
            for block in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[block], cuts[block + 1])
                yield _told(row["shard"], 0, int(block), pack_sorted(heads[part]), pack(customers[part]), pack(tables[part]))

    def block_rows(block: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        own = [unpack_sorted(r["heads"]) for r in rows]
        heads, place = np.unique(np.concatenate(own), return_inverse=True)
        customers, tables = (np.bincount(place, weights=np.concatenate([unpack(r[c], np.int64) for r in rows]), minlength=len(heads)).astype(np.int64) for c in ("customers", "tables"))
        yield _told(block, 1, block, pack_sorted(heads), pack(customers), pack(tables))
        for r, at in zip(rows, np.split(place, np.cumsum([len(x) for x in own])[:-1]), strict=True):
            yield _told(r["shard"], 0, block, r["heads"], pack(customers[at]), pack(tables[at]))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for row in _by_row(batches):
            if rows and row["block"] != rows[0]["block"]:
                yield from block_rows(rows[0]["block"], rows)
                rows = []
            rows.append(row)
        if rows:
            yield from block_rows(rows[0]["block"], rows)

    every = state.select("shard", "words", "per_word", "heads", "head", "counts", "tables").mapInArrow(said, TOLD)
    return every.repartition("block").sortWithinPartitions("block", "shard").mapInArrow(summed, TOLD)


def _restaurants(fixed: np.ndarray, rows: list[dict]) -> Restaurants:
    parts = [(unpack_sorted(r["heads"]), unpack(r["customers"], np.int64), unpack(r["tables"], np.int64)) for r in rows]
    none = (np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return Restaurants.of((fixed, *(np.concatenate(x) for x in zip(none, *parts, strict=True))))


def swept(state: DataFrame, contexts: DataFrame, fixed: np.ndarray, number: int, keep: bool) -> DataFrame:
    """The next state; with ``keep`` the tables of the last one stay beside its own."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[dict] = []  # what comes before a shard's own row
        for row in _by_row(batches):
            if row["kind"] == 0:
                known.append({"heads": row["heads"], "customers": row["customers"], "tables": row["told"]})
                continue
            x = _shard_of(row)
            x.sweep(_restaurants(fixed, known), np.random.default_rng([row["shard"], number]))
            known = []
            yield _state_row(row["shard"], x, row["tables"] if keep else [])

    none = lambda *names: [F.lit(None).cast("array<binary>" if n == "tables" else "binary").alias(n) for n in names]
    told = contexts.where("kind = 0").select("shard", "kind", "block", "heads", "customers", F.col("tables").alias("told"), *none("words", "per_word", "head", "counts", "tables"))
    own = state.select("shard", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("block"), "heads", *none("customers"), F.lit(None).cast("binary").alias("told"), "words", "per_word", "head", "counts", "tables")
    dealt = told.unionByName(own).repartition("shard").sortWithinPartitions("shard", "kind", "block")

    return dealt.mapInArrow(sweep, STATE)


def answer(x: list[Shard], r: list[Restaurants], words: np.ndarray, per_word: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs in order: the log10 probability averaged over the samples, and the word's count."""
    heads, head = np.unique(np.asarray(contexts, U64), return_inverse=True)
    word = np.repeat(np.arange(len(words)), per_word)
    seated = [s.seated(s.by_word(), np.asarray(words, U64), per_word, heads, head) for s in x]
    sums = np.zeros(len(word))
    for (of_words, of_pairs), known in zip(seated, r, strict=True):
        at = known.at(heads)
        sums += known.after(of_pairs, [v[head] for v in at], known.single(*of_words[1:])[word])
    return np.log10(sums / len(x)), seated[0][0][0][word]


SAID = "bucket long, shard long, of_words array<binary>, of_pairs array<binary>"


def answers(asked: DataFrame, state: DataFrame, contexts: list[DataFrame]) -> DataFrame:
    """What each shard says of each bucket: of words ``(count, then per sample customers and tables at the root, customers and
    tables of the word as a context)``, of pairs ``(customers, then tables per sample)``."""
    samples = len(contexts)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Restaurants] = {}
        shard, seats = None, []
        nothing = np.array([0] * 8)
        for row in _by_row(batches):
            if row["shard"] != shard:
                shard, known, seats = row["shard"], {}, []
            if row["kind"] < 0:
                known[-1 - row["kind"]] = _restaurants(nothing, [{"heads": row["c"], "customers": row["a"], "tables": row["b"]}])
                continue
            if row["kind"] == 0:
                state_row = {"words": row["a"], "per_word": row["b"], "heads": row["c"], "head": row["d"], "counts": row["e"], "tables": row["tables"]}
                x = _shard_of(state_row)
                x.counts, _ = narrow(x.counts), x.keys  # which all samples share
                seats = []
                for s in range(samples):  # the samples differ in their tables only
                    one = copy(x)
                    one.tables = [narrow(unpack(b, np.int64)) for b in row["tables"][2 * s : 2 * s + 2]]
                    seats.append((one, one.by_word()))
                continue
            if not seats:  # a shard always has a state, be it without words
                raise RuntimeError("a shard has no state")
            words, per_word, heads, head = unpack_sorted(row["a"]), unpack(row["b"], np.uint32), unpack_sorted(row["c"]), unpack(row["d"], np.uint32)
            of_words, of_pairs = [], []
            for s, (x, by_word) in enumerate(seats):
                (n, *root), (count, tables) = x.seated(by_word, words, per_word, heads, head)
                of_words += [*([n] if s == 0 else []), *root, *known.get(s, _restaurants(nothing, [])).at(words)]
                of_pairs += [*([count] if s == 0 else []), tables]
            values = [row["bucket"], shard, *([pack(np.asarray(v, np.int64)) for v in some] for some in (of_words, of_pairs))]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.binary())], strict=True)], ["bucket", "shard", "of_words", "of_pairs"])

    none = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    zero = F.lit(0).cast("long").alias("bucket")
    dealt = asked.select("shard", F.lit(1).alias("kind"), "bucket", "a", "b", "c", "d", *none("binary", "e"), *none("array<binary>", "tables"))
    own = state.select("shard", F.lit(0).alias("kind"), zero, F.col("words").alias("a"), F.col("per_word").alias("b"), F.col("heads").alias("c"), F.col("head").alias("d"), F.col("counts").alias("e"), "tables")
    dealt = dealt.unionByName(own)
    for s, sums in enumerate(contexts):
        block = sums.where("kind = 1").select("shard", F.lit(-1 - s).alias("kind"), zero, F.col("customers").alias("a"), F.col("tables").alias("b"), F.col("heads").alias("c"), *none("binary", "d", "e"), *none("array<binary>", "tables"))
        dealt = dealt.unionByName(block)
    return dealt.repartition("shard").sortWithinPartitions("shard", "kind", "bucket").mapInArrow(told, SAID)


def totals(docs: DataFrame, said: DataFrame, fixed: list[np.ndarray]) -> DataFrame:
    """The rows of ``score``: the answers of a bucket, then its documents."""
    known = [_restaurants(f, []) for f in fixed]
    train, norm = known[0].tokens, known[0].tokens + 0.1 * (known[0].words + 1)
    names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def bucket_rows(parts: list[dict], texts: list[dict]) -> Iterator[pa.RecordBatch]:
        (n, *of_words), (count, *tables) = ([np.concatenate([narrow(unpack(p[c][i], np.int64)) for p in parts]) for i in range(len(parts[0][c]))] for c in ("of_words", "of_pairs"))
        parts.clear()
        places = [unpack(t["a"], np.uint32) for t in texts]
        sizes, words = np.array([len(p) for p in places]), np.concatenate(places)
        held = [(t["id"], t["held"]) for t in texts]
        texts.clear()
        del places
        singles = [r.single(*of_words[4 * s : 4 * s + 2]) for s, r in enumerate(known)]
        before = np.concatenate([words[-1:], words[:-1]])
        logs, done = np.zeros(len(words)), 0
        # the pairs of some words at a time, so that only small arrays are sorted
        for low in range(0, len(n), max(len(n) // PARTS, 1)):
            some = np.flatnonzero((words >= low) & (words < low + max(len(n) // PARTS, 1)))
            pairs, at = np.unique(words[some].astype(np.int64) * len(n) + before[some], return_inverse=True)
            word, context = np.divmod(pairs, len(n))
            own, done = slice(done, done + len(pairs)), done + len(pairs)
            sums = np.zeros(len(pairs))
            for s, r in enumerate(known):
                sums += r.after((count[own], tables[s][own]), [v[context] for v in of_words[4 * s + 2 : 4 * s + 4]], singles[s][word])
            logs[some] = np.log10(sums / len(known))[at]
        del before, count, tables
        starts = np.cumsum(sizes) - sizes
        logs = np.add.reduceat(logs, starts)
        base = np.add.reduceat(np.log10((n + 0.1) / norm)[words], starts)
        found_in = np.add.reduceat((n > 0)[words], starts, dtype=np.int64)
        out = [*map(list, zip(*held, strict=True)), sizes, found_in, np.full(len(held), train), base, logs]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, texts = None, [], []
        for part in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            for row in part.to_pylist():
                if row["bucket"] != bucket:
                    if texts:
                        yield from bucket_rows(parts, texts)
                    bucket, parts, texts = row["bucket"], [], []
                (texts if row["kind"] else parts).append(row)
        if texts:
            yield from bucket_rows(parts, texts)

    none = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    own = docs.select("bucket", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("shard"), "id", "held", "a", *none("array<binary>", "of_words", "of_pairs"))
    told = said.select("bucket", F.lit(0).alias("kind"), "shard", *none("long", "id"), *none("boolean", "held"), *none("binary", "a"), "of_words", "of_pairs")
    dealt = own.unionByName(told).repartition("bucket").sortWithinPartitions("bucket", "kind", "shard")
    return dealt.mapInArrow(scored, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    texts = two_columns(docs, id_column, text_column)
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(16).cast("long")), F.lit(0))).first()[0]
    shards = max(16, 1 << (max(size // SHARD, 1) - 1).bit_length())

    def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, label)
        return write_table(df, path), path

    with freed_shuffles(spark):
        path = scratch_path(spark, "lm-gathered")
        gather(texts, shards).write.partitionBy("kind").parquet(path)
        schema = GATHERED.removeprefix("kind int, ")
        asked, texts = (read_if_there(spark, f"{path}/kind={k}", schema) for k in (0, 1))
    with freed_shuffles(spark), small_batches(spark, ROWS):
        state, stored = store(first_state(asked), "lm-state")
        samples, used = [], [f"{path}/kind=0"]
        for number in range(WARM + SAMPLES + 1):
            fixed = added_up(state)
            contexts, lies = store(contexts_of(state, shards), "lm-contexts")
            if number > WARM:
                samples.append((contexts, fixed))
                used.append(lies)
            if number < WARM + SAMPLES:
                last = stored
                state, stored = store(swept(state, contexts, fixed, number, keep=number > WARM), "lm-state")
                discard(spark, last)
            if number <= WARM:
                discard(spark, lies)
        path = scratch_path(spark, "lm-answers")
        for wave in range(WAVES):
            own = lambda df: df.where(F.col("shard") % WAVES == wave)  # noqa: B023, E731
            said = write_table(answers(own(asked), own(state), [own(c) for c, _ in samples]), path, mode="append")
        for path in [*used, stored]:
            discard(spark, path)
    return totals(texts, said, [f for _, f in samples])


def op12_language_model(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")


def brute_force(texts: list[tuple[int | None, str | None]]) -> list[tuple]:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score)`` by plain loops."""
    import math
    import re
    from collections import Counter

    fold = {i: i + 32 for i in range(65, 91)}
    split = [(d, [*re.findall("[^ \t-\r]+", (t or "").translate(fold)), None]) for d, t in texts]
    held = [d is not None and zlib.crc32(str(d).encode()) % HELD == 0 for d, _ in split]
    count: Counter = Counter()
    for (_, words), out in zip(split, held, strict=True):
        if not out:
            count.update(words)
    n, v = sum(count.values()), len(count)
    rows = []
    for (doc, words), out in zip(split, held, strict=True):
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        rows.append((doc, out, len(words), sum(count[w] > 0 for w in words), n, base))
    return rows
