"""Cross-tokenizer alignment by an associative fragment monoid.

Two tokenizers cut the same bytes; offsets where tokens of both end cut them into groups. The tokens that end in a
byte range form a fragment: an open prefix (up to the first shared end), closed groups, and an open suffix (after the
last shared end). Fragments compose associatively: the suffix of one and the prefix of the next close a group
together. So byte ranges are aligned on their own, and the fragments of a text are reduced in a tree: inside a task
for texts of one piece; across Spark tasks for longer ones, whose pieces are tokenized and aligned in tasks of their own.

Tokenizing needs no whole text either. Both vocabularies start a token at every space that follows a character other
than white space (the first cuts words so, no piece of the second holds a space after other characters), so the
stretches between such places are encoded once per slice of texts. That is checked on the bytes of every stretch; one
that fails the check is encoded alone, and a text whose bytes do not come back has no tokens.

How many documents hold a linked id pair is counted from one row per pair and slice, and the counts go back to the
slices the same way: streamed past their documents, which stay grouped by slice.

Defined results: a null or empty text, and one that does not come back, has no tokens and zeros; every row is a
document of its own, so repeated rows count again; a null id stays null; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftmart.llm.common import slices, text_bytes, two_columns
from weftmart.operators.joins import join_grouped
from weftmart.session import materialise

#: bytes of a slice of texts, of a piece of a long text, and of the byte range of one fragment
SLICE, PIECE, RANGE = 1 << 20, 32 << 10, 8 << 10
#: fragments that one task composes in a round of the reduction
FAN = 16
#: stretches that are encoded in one call, and those that a task remembers
JOINED, KEPT = 1000, 300_000
#: links that one numpy step expands; groups beyond are counted by distinct ids
EXPAND = 1 << 20

_CUT = re.compile(r"(?<=\S) (?!\Z)")
_ODD = re.compile(r"\s\s|\s\Z")


# -- the monoid ------------------------------------------------------------------------------------------------------


def _none() -> np.ndarray:
    return np.zeros(0, np.int32)


@dataclass
class Fragment:
    """Tokens that end in one byte range. Without a shared end (``cut``) all of them are in ``prefix``.

    ``prefix`` and ``suffix`` are ``(ids of A, ids of B)``; the closed groups are the ids of each side in order and the
    number of them in every group.
    """

    cut: bool = False
    prefix: tuple = field(default_factory=lambda: (_none(), _none()))
    ids: tuple = field(default_factory=lambda: (_none(), _none()))
    sizes: tuple = field(default_factory=lambda: (_none(), _none()))
    suffix: tuple = field(default_factory=lambda: (_none(), _none()))


def fragment(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Fragment:
    """The fragment of tokens ``a`` and ``b`` with the ascending offsets at which they end."""
    shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
    if not len(shared):
        return Fragment(prefix=(a, b))
    parts = []
    for ids, ends in ((a, a_ends), (b, b_ends)):
        upto = np.searchsorted(ends, shared, side="right")
        parts.append((ids[: upto[0]], ids[upto[0] : upto[-1]], np.diff(upto).astype(np.int32), ids[upto[-1] :]))
    prefix, ids, sizes, suffix = zip(*parts, strict=True)
    return Fragment(True, prefix, ids, sizes, suffix)


def _joined(x: tuple, y: tuple) -> tuple:
    return tuple(np.concatenate(pair) for pair in zip(x, y, strict=True))


def compose(x: Fragment, y: Fragment) -> Fragment:
    """Associative; ``Fragment()`` is neutral."""
    if not x.cut:
        return Fragment(y.cut, _joined(x.prefix, y.prefix), y.ids, y.sizes, y.suffix)
    if not y.cut:
        return Fragment(True, x.prefix, x.ids, x.sizes, _joined(x.suffix, y.prefix))
    middle = _joined(x.suffix, y.prefix)
    ids = tuple(np.concatenate(three) for three in zip(x.ids, middle, y.ids, strict=True))
    sizes = tuple(np.concatenate([p, np.array([len(m)], np.int32), q]) for p, m, q in zip(x.sizes, middle, y.sizes, strict=True))
    return Fragment(True, x.prefix, ids, sizes, y.suffix)


def composed(parts: list[Fragment]) -> Fragment:
    """All parts in order, by halves."""
    while len(parts) > 1:
        parts = [reduce(compose, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0] if parts else Fragment()


def closed(whole: Fragment) -> tuple[tuple, tuple]:
    """Ids and group sizes of a whole text: what is open at its ends are groups too."""
    edge = Fragment(True)
    out = compose(compose(edge, whole), edge)
    full = (out.sizes[0] > 0) | (out.sizes[1] > 0)
    return out.ids, tuple(s[full] for s in out.sizes)


# -- tokenizing ------------------------------------------------------------------------------------------------------


def _alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes are themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """One tokenizer: ids of a text that starts with a space, and the bytes of every id."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.starts[ids], self.lengths[ids])]


class ByteLevel(Encoder):
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        letters = _alphabet()
        names = [self.model.id_to_token(i) or "" for i in range(self.model.get_vocab_size())]
        super().__init__([bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names])

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, np.int32)


class Pieces(Encoder):
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        super().__init__([bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)])

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text[1:]), np.int32)


def encoders(paths: tuple[str, str]) -> tuple[Encoder, Encoder]:
    """Loaded once per Python worker, which tasks share."""
    kept = sys.modules.setdefault("weftmart_worker", types.ModuleType("weftmart_worker"))
    if getattr(kept, "paths", None) != paths:
        kept.encoders, kept.paths = (ByteLevel(paths[0]), Pieces(paths[1])), paths
    return kept.encoders


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start .. start + length`` of every row, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def stretches(text: str) -> list[str]:
    """A text cut before every space inside it that follows a character other than white space, each without the space it starts with."""
    if _ODD.search(text):
        at = [m.start() for m in _CUT.finditer(text)]
        return [text[i + 1 : j] if i >= 0 else text[:j] for i, j in zip([-1, *at], [*at, len(text)], strict=True)]
    return text.split(" ")


def _joinable(part: str) -> bool:
    """White space at the end could run into the next space, and the mark for a space is itself read as one."""
    return bool(part) and not part[-1].isspace() and "▁" not in part


def encode_stretches(parts: list[str], encoder: Encoder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, sizes, right)``: the tokens of space+part for every part, how many each has, and whether its bytes come back."""
    if all(map(_joinable, parts)):
        raw = [f" {p}" for p in parts]
        ids = encoder.encode("".join(raw))
        whole = np.frombuffer("".join(raw).encode(), np.uint8)
        ends = np.cumsum(encoder.lengths[ids])
        stops = np.cumsum(np.array([len(r.encode()) for r in raw], np.int64))
        at = np.searchsorted(ends, stops)
        if len(ids) and ends[-1] == len(whole) and np.array_equal(ends[at], stops) and np.array_equal(encoder.bytes_of(ids), whole):
            return ids, np.diff(at, prepend=-1), np.ones(len(parts), bool)
    found = [encoder.encode(f" {p}") for p in parts]
    right = np.array([encoder.bytes_of(ids).tobytes() == f" {p}".encode() for p, ids in zip(parts, found, strict=True)], bool)
    return np.concatenate(found), np.array([len(x) for x in found], np.int64), right


@dataclass
class Encoded:
    """Tokens of several texts by both tokenizers: ids, the byte offset in its text at which each ends, bounds by text."""

    ids: tuple
    ends: tuple
    bounds: tuple
    right: np.ndarray


class Stretches:
    """The tokens of the stretches that a task has met, so that each is encoded once; forgotten when there are many."""

    def __init__(self, paths: tuple[str, str]):
        self.encoders = encoders(paths)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.known = [(_none(), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in self.encoders]

    def learn(self, fresh: list[str]) -> None:
        alike = [list(g) for _, g in groupby(fresh, _joinable)]
        groups = [g[i : i + JOINED] for g in alike for i in range(0, len(g), JOINED)]
        for side, encoder in enumerate(self.encoders):
            self.known[side] = tuple(np.concatenate(x) for x in zip(self.known[side], *(encode_stretches(g, encoder) for g in groups), strict=True))

    def encode(self, texts: list[str]) -> Encoded:
        """Encode space+text for every text that is not empty."""
        if len(self.number) > KEPT:
            self.forget()
        number, before = self.number, len(self.number)
        rows = [[number.setdefault(p, len(number)) for p in stretches(t)] if t else [] for t in texts]
        self.learn(list(islice(number, before, None)))
        at = np.array(list(chain.from_iterable(rows)), np.int64)
        edges = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        right = np.ones(len(texts), bool)
        out = []
        for encoder, (ids, sizes, fits) in zip(self.encoders, self.known, strict=True):
            lengths = sizes[at]
            tokens = ids[ragged((np.cumsum(sizes) - sizes)[at], lengths)]
            wrong = np.concatenate([[0], np.cumsum(~fits[at])])
            right &= wrong[edges[1:]] == wrong[edges[:-1]]
            upto = np.concatenate([[0], np.cumsum(lengths)])[edges]
            ends = np.cumsum(encoder.lengths[tokens])
            base = np.concatenate([[0], ends])[upto[:-1]]
            out.append((tokens, ends - np.repeat(base, np.diff(upto)), upto))
        ids, ends, bounds = zip(*out, strict=True)
        return Encoded(ids, ends, bounds, right)


def fragments_of(encoded: Encoded, i: int, first: int = 0) -> Fragment:
    """The fragment of one text that starts at byte ``first``: those of its byte ranges, composed."""
    sides = [(ids[b[i] : b[i + 1]], ends[b[i] : b[i + 1]] + first) for ids, ends, b in zip(encoded.ids, encoded.ends, encoded.bounds, strict=True)]
    (a, a_ends), (b, b_ends) = sides
    last = int(a_ends[-1]) if len(a_ends) else first
    edges = np.arange((first // RANGE + 1) * RANGE, last + RANGE, RANGE)
    if len(edges) < 2:
        return fragment(a, a_ends, b, b_ends)
    x, y = np.searchsorted(a_ends, edges, side="right"), np.searchsorted(b_ends, edges, side="right")
    parts, i0, j0 = [], 0, 0
    for i1, j1 in zip(x.tolist(), y.tolist(), strict=True):
        parts.append(fragment(a[i0:i1], a_ends[i0:i1], b[j0:j1], b_ends[j0:j1]))
        i0, j0 = i1, j1
    return composed(parts)


# -- results of whole texts ------------------------------------------------------------------------------------------


def digits(upto: int) -> np.ndarray:
    """A row for every number below ``upto``: its decimal digits, right-aligned after zero bytes, and a place for a sign."""
    width = len(str(upto))
    numbers = np.arange(upto)
    out = np.zeros((upto, width + 1), np.uint8)
    for d in range(width):
        has = numbers >= 10**d if d else np.ones(upto, bool)
        out[has, width - 1 - d] = 48 + numbers[has] // 10**d % 10
    return out


def written(ids: tuple, sizes: tuple, table: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2`` of groups, made in numpy: every id with the sign that follows it."""
    count = np.stack(sizes, 1).reshape(-1)
    if not len(count):
        return b""
    stops = np.cumsum(count)
    order = np.empty(stops[-1], np.int64)
    for side in (0, 1):
        order[ragged((stops - count)[side::2], count[side::2])] = ids[side]
    out = table[order]
    out[:, -1] = ord(",")
    out[stops[0::2] - 1, -1] = ord("|")
    out[stops[1::2] - 1, -1] = ord(";")
    flat = out.reshape(-1)
    return flat[flat > 0][:-1].tobytes()


def linked(ids: tuple, sizes: tuple, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(owner, pair, times)`` of all links of groups; ``pair`` is the A id times 2^32 plus the B id. Rows may repeat."""
    na, nb = (s.astype(np.int64) for s in sizes)
    at, bt = np.cumsum(na) - na, np.cumsum(nb) - nb
    out = []
    large = na * nb > EXPAND
    small = np.flatnonzero(~large)
    ends = np.cumsum((na * nb)[small])
    cuts = np.searchsorted(ends, np.arange(EXPAND, int(ends[-1]) if len(ends) else 0, EXPAND)).tolist()
    for lo, hi in zip([0, *cuts], [*cuts, len(small)], strict=True):
        some = small[lo:hi]
        left = ragged(at[some], na[some])
        times = np.repeat(nb[some], na[some])
        pairs = (np.repeat(ids[0][left].astype(np.int64), times) << 32) | ids[1][ragged(np.repeat(bt[some], na[some]), times)]
        out.append((np.repeat(owner[some], (na * nb)[some]), pairs, np.ones(len(pairs), np.int64)))
    for g in np.flatnonzero(large):
        a, a_n = np.unique(ids[0][at[g] : at[g] + na[g]], return_counts=True)
        b, b_n = np.unique(ids[1][bt[g] : bt[g] + nb[g]], return_counts=True)
        pairs = ((a.astype(np.int64) << 32)[:, None] | b[None, :]).reshape(-1)
        out.append((np.full(len(pairs), owner[g]), pairs, (a_n[:, None] * b_n[None, :]).reshape(-1)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


RESULT = "bucket long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, at array<int>, times array<long>, pairs array<long>, held array<long>"
_FIELDS = [("bucket", pa.int64()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
           ("groups_sha256", pa.string()), ("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int64()))]


def _lists(values: np.ndarray, owner: np.ndarray, rows: int, kind) -> pa.Array:
    bounds = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, kind))


def finished(bucket: int, ids: list, texts: list[tuple[tuple, tuple]]) -> Iterator[pa.RecordBatch]:
    """Rows of whole texts, given their closed groups, and one row of the bucket's pairs with the number of its texts that hold each."""
    rows = len(ids)
    if not rows:
        return
    owner = np.repeat(np.arange(rows), [len(s[0]) for _, s in texts])
    flat = [tuple(np.concatenate([t[part][side] for t in texts]) for side in (0, 1)) for part in (0, 1)]
    doc, pair, times = linked(flat[0], flat[1], owner)
    pairs, place = np.unique(pair, return_inverse=True)
    key = doc * max(len(pairs), 1) + place
    keys, back = np.unique(key, return_inverse=True)
    summed = np.bincount(back, weights=times, minlength=len(keys)).astype(np.int64)
    holder, at = keys // max(len(pairs), 1), keys % max(len(pairs), 1)
    held = np.bincount(at, minlength=len(pairs)).astype(np.int64)
    links = np.bincount(holder, weights=summed, minlength=rows).astype(np.int64)
    counts = [np.array([len(t[0][side]) for t in texts], np.int64) for side in (0, 1)]
    groups = np.array([len(t[1][0]) for t in texts], np.int64)
    table = digits(1 + int(max([0, *(ids.max() for ids in flat[0] if len(ids))])))
    digests = [hashlib.sha256(written(*t, table)).hexdigest() if len(t[1][0]) else "" for t in texts]
    none = lambda kind: pa.nulls(rows, kind)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(rows, bucket)), pa.array(ids, pa.int64()), *(pa.array(x) for x in (*counts, groups, links)), pa.array(digests),
         _lists(at, holder, rows, pa.int32()), _lists(summed, holder, rows, pa.int64()), none(_FIELDS[9][1]), none(_FIELDS[10][1])],
        [n for n, _ in _FIELDS],
    )
    yield pa.RecordBatch.from_pylist(
        [dict.fromkeys((n for n, _ in _FIELDS)) | {"bucket": bucket, "pairs": pairs, "held": held}], pa.schema(_FIELDS)
    )


def _bucket(part: int, number: int) -> int:
    return (part << 32) | number


def align_short(docs: DataFrame, paths: tuple[str, str], offset: int) -> DataFrame:
    """Rows as of ``finished`` for ``docs (id, text)`` of one piece each; a slice of texts is a bucket."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, known = TaskContext.get().partitionId() * 2 + offset, Stretches(paths)
        for number, batch in enumerate(slices(batches, limit=SLICE)):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            encoded = known.encode(texts)
            groups = [closed(fragments_of(encoded, i)) if ok and texts[i] else closed(Fragment()) for i, ok in enumerate(encoded.right.tolist())]
            yield from finished(_bucket(part, number), batch.column(0).to_pylist(), groups)

    return docs.mapInArrow(aligned, RESULT)


def cut_pieces(docs: DataFrame) -> DataFrame:
    """``(row, id, piece, first, text)`` of ``docs (row, id, text)``: each text in pieces between places where stretches may start."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for row, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                out, start, first = [], 0, 0
                while start <= len(text):
                    # pieces go by code points, so none has fewer bytes than that
                    found = _CUT.search(text, start + PIECE) if len(text) - start > 2 * PIECE else None
                    stop = found.start() if found else len(text)
                    out.append((row, doc, len(out), first, text[start:stop]))
                    first += len(text[start:stop].encode()) + 1
                    start = stop + 1
                    if not found:
                        break
                yield pa.RecordBatch.from_pydict(dict(zip(("row", "id", "piece", "first", "text"), map(list, zip(*out, strict=True)), strict=True)))

    return docs.mapInArrow(cut, "row long, id long, piece long, first long, text string")


_PARTS = ("prefix", "ids", "sizes", "suffix")
_PACKED = "row long, id long, piece long, good boolean, cut boolean, " + ", ".join(f"{p}_{s} array<int>" for p in _PARTS for s in "ab")


def _packed(row, doc, piece, good: bool, f: Fragment) -> pa.RecordBatch:
    lists = [pa.array([x], pa.list_(pa.int32())) for p in _PARTS for x in getattr(f, p)]
    names = [n.split()[0] for n in _PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([doc], pa.int64()), pa.array([piece], pa.int64()), pa.array([good]), pa.array([f.cut]), *lists], names)


def _unpacked(batch: pa.RecordBatch, i: int) -> Fragment:
    at = {n: k for k, n in enumerate(batch.schema.names)}
    sides = {p: tuple(batch.column(at[f"{p}_{s}"])[i].values.to_numpy() for s in "ab") for p in _PARTS}
    return Fragment(batch.column(at["cut"])[i].as_py(), **sides)


def align_pieces(pieces: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """One packed fragment for every piece."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Stretches(paths)
        for batch in slices(batches, "text", SLICE):
            texts = batch.column(4).to_pylist()
            encoded = known.encode(texts)
            keys = [batch.column(i).to_pylist() for i in range(4)]
            for i, (row, doc, piece, first) in enumerate(zip(*keys, strict=True)):
                good = bool(encoded.right[i])
                yield _packed(row, doc, piece, good, fragments_of(encoded, i, first) if good else Fragment())

    return pieces.mapInArrow(aligned, _PACKED)


def compose_neighbours(packed: DataFrame) -> DataFrame:
    """Every ``FAN`` neighbouring fragments of a text as one."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, good, doc = None, [], True, None
        for batch in batches:
            for i, (row, own, piece, ok) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)):
                if at != (row, piece // FAN):
                    if parts:
                        yield _packed(at[0], doc, at[1], good, composed(parts))
                    at, parts, good, doc = (row, piece // FAN), [], True, own
                parts.append(_unpacked(batch, i))
                good = good and ok
        if parts:
            yield _packed(at[0], doc, at[1], good, composed(parts))

    dealt = packed.repartition("row", F.expr(f"piece div {FAN}")).sortWithinPartitions("row", "piece")
    return dealt.mapInArrow(up, _PACKED)


def align_long(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Rows as of ``finished`` for ``docs (id, text)`` of several pieces, by a tree reduction of their fragments."""
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("row"), "id", "text"), "long-texts")
    pieces = cut_pieces(rows).repartition("row", "piece")
    packed = materialise(align_pieces(pieces, paths), "fragments")
    while not packed.where("piece > 0").isEmpty():
        packed = materialise(compose_neighbours(packed), "fragments")

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId() * 2 + 1, 0
        ids, groups, held = [], [], 0
        for batch in batches:
            for i, (doc, ok) in enumerate(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                ids.append(doc)
                groups.append(closed(_unpacked(batch, i) if ok else Fragment()))
                held += len(groups[-1][0][0])
                if held * 4 >= SLICE:
                    yield from finished(_bucket(part, number), ids, groups)
                    ids, groups, held, number = [], [], 0, number + 1
        yield from finished(_bucket(part, number), ids, groups)

    return packed.mapInArrow(ended, RESULT)


def corpus_counts(asked: DataFrame) -> DataFrame:
    """``(bucket, total, best)`` lists in the order of a bucket's pairs, of ``asked (bucket, pairs, held)``."""
    rows = asked.select("bucket", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "p")).select("bucket", "place", F.col("p.pairs").alias("pair"), F.col("p.held").alias("held"))
    totals = materialise(rows.groupBy("pair").agg(F.sum("held").alias("total")), "pair-counts")
    totals = totals.withColumn("a", F.shiftright("pair", 32))
    highest = totals.groupBy("a").agg(F.max("total").alias("top")).select(F.col("a").alias("of"), "top")
    known = join_grouped(totals, highest, [("a", "of")], "inner").select(F.col("pair").alias("asked"), "total", (F.col("total") == F.col("top")).alias("best"))
    met = rows.select("bucket", "place", "pair").join(known, F.col("pair") == F.col("asked"))
    # a bucket is a slice of texts, which bounds its pairs
    listed = met.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("place", "total", "best"))).alias("l"))
    return listed.select("bucket", F.col("l.total").alias("total"), F.col("l.best").alias("best"))


def align(docs: DataFrame, paths: tuple[str, str], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: ``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    texts = two_columns(docs, id_column, text_column)
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > 2 * PIECE
    short = align_short(texts.where(~long), paths, 0)
    rows = materialise(short.unionByName(align_long(texts.where(long), paths)), "aligned")
    counts = corpus_counts(rows.where("pairs IS NOT NULL").select("bucket", "pairs", "held"))
    told = rows.where("pairs IS NULL").select("bucket", F.lit(1).alias("kind"), *[n for n, _ in _FIELDS[1:9]], F.lit(None).cast("array<long>").alias("total"), F.lit(None).cast("array<boolean>").alias("best"))
    empty = [F.lit(None).cast(dict(told.dtypes)[n]).alias(n) for n, _ in _FIELDS[1:9]]
    both = told.unionByName(counts.select("bucket", F.lit(0).alias("kind"), *empty, "total", "best"))
    dealt = both.repartition("bucket").sortWithinPartitions("bucket", "kind")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = best = np.zeros(0, np.int64)
        for batch in batches:
            kinds = batch.column(1).to_numpy()
            at, times = batch.column(8), batch.column(9)
            chosen, n_best, sums = [], [], []
            for i, kind in enumerate(kinds.tolist()):
                if kind == 0:
                    total = batch.column(10)[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                    best = batch.column(11)[i].values.to_numpy(zero_copy_only=False)
                    continue
                place, n = at[i].values.to_numpy(), times[i].values.to_numpy()
                chosen.append(i)
                n_best.append(int(n[best[place]].sum()) if len(place) else 0)
                sums.append(int((n * total[place]).sum()) if len(place) else 0)
            own = batch.take(pa.array(chosen, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(own.column(i) for i in range(2, 7)), pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), own.column(7)],
                ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return dealt.mapInArrow(summed, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


VOCABULARIES = ("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model")


def op11_alignment(spark, sf_dir: str, paths: tuple[str, str] = VOCABULARIES) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"), paths).withColumnRenamed("id", "doc_id")


def brute_force(texts: list[tuple[int | None, str | None]], paths: tuple[str, str] = VOCABULARIES) -> list[tuple]:
    """The rows of ``op11_alignment`` by whole texts and plain loops."""
    from collections import Counter

    coders = encoders(paths)
    kept = []
    for doc, text in texts:
        sides = []
        for coder in coders if text else ():
            ids = coder.encode(f" {text}").tolist()
            tokens = [coder.bytes_of(np.array([i])).tobytes() for i in ids]
            sides.append((ids, tokens))
        if not text or any(b"".join(t) != f" {text}".encode() for _, t in sides):
            kept.append((doc, [], 0, 0))
            continue
        stops = []
        for _, tokens in sides:
            ends, at = [], 0
            for t in tokens:
                at += len(t)
                ends.append(at)
            stops.append(ends)
        shared = sorted(set(stops[0]) & set(stops[1]))
        groups, i, j = [], 0, 0
        for end in shared:
            a, b = [], []
            while i < len(stops[0]) and stops[0][i] <= end:
                a.append(sides[0][0][i])
                i += 1
            while j < len(stops[1]) and stops[1][j] <= end:
                b.append(sides[1][0][j])
                j += 1
            groups.append((a, b))
        kept.append((doc, groups, len(sides[0][0]), len(sides[1][0])))
    count: Counter = Counter()
    for _, groups, _, _ in kept:
        count.update({(a, b) for x, y in groups for a in x for b in y})
    top: dict[int, int] = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    rows = []
    for doc, groups, n_a, n_b in kept:
        links = [(a, b) for x, y in groups for a in x for b in y]
        told = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(told.encode()).hexdigest() if groups else ""
        rows.append((doc, n_a, n_b, len(groups), len(links), sum(count[x] == top[x[0]] for x in links), sum(count[x] for x in links), digest))
    return rows
