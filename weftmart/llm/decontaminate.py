"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton of all item words is streamed over the document words and gives, at every word, the longest
run of words ending there that occurs in some item. A run of ``window`` words, or a whole item that is
shorter, is a hit; hit words are joined into spans.

Items are cut into pieces that overlap by ``window - 1`` words and dealt into blocks of bounded size, so the
automaton held by a task is bounded whatever the benchmark's size. Each block is one pass over the documents
and the passes are merged by document.

Defined results: null and empty texts have no words; a null or empty item has no window; repeated items count
under each id (a null id is left out); repeated document rows get a row each; an empty benchmark leaves all
documents clean. Further columns of either table are ignored, or kept by ``remove``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftmart.llm.common import slices, two_columns
from weftmart.session import materialise

#: words a block's automaton holds at most: about 150 MB of Python objects
BLOCK_WORDS = 200_000
#: words of an item in one piece
PIECE_WORDS = 20_000

# A-Z become a-z; every other character below 0x80 that is no letter or digit separates words
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

PIECES = "item_id bigint, piece long, whole boolean, words array<binary>"
HITS = "row long, doc_id bigint, n_words long, spans array<struct<start:int,stop:int>>, items array<bigint>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton over words, with the items of every window."""

    def __init__(self, items: list[tuple[int, list[bytes], bool]], window: int):
        self.step: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words, _ in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._mark(items, window)

    def _state(self, step: dict, link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        clone = self._state(dict(self.step[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        q = self.step[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new, p = self._state({}, 0, self.length[last] + 1), last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def _mark(self, items: list[tuple[int, list[bytes], bool]], window: int) -> None:
        """``sure[s]``: the match length from which state ``s`` reports; ``fires[s]``: what it reports, longest first."""
        n = len(self.step)
        own: list[dict[int, set[int]]] = [{} for _ in range(n)]
        for item, words, whole in items:
            short = whole and 0 < len(words) < window
            state = 0
            for k, word in enumerate(words, 1):
                state = self.step[state][word]
                size = len(words) if short else window
                if k >= size and (not short or k == len(words)):
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    own[at].setdefault(size, set()).add(item)
        self.fires: list[tuple[tuple[int, frozenset[int]], ...]] = [()] * n
        for s in sorted(range(1, n), key=self.length.__getitem__):
            mine = tuple(sorted(((k, frozenset(v)) for k, v in own[s].items()), reverse=True, key=lambda x: x[0]))
            self.fires[s] = mine + self.fires[self.link[s]] if mine else self.fires[self.link[s]]
        never = 1 << 60
        self.sure = [f[-1][0] if f else never for f in self.fires]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Maximal runs of hit words as ``[start, stop)``, and the items with windows among them."""
        step, link, length, sure, fires = self.step, self.link, self.length, self.sure, self.fires
        spans: list[list[int]] = []
        seen: set[tuple[int, int]] = set()
        state = size = 0
        for i, word in enumerate(words):
            to = step[state].get(word)
            if to is None:
                while state and to is None:
                    state = link[state]
                    to = step[state].get(word)
                if to is None:
                    size = 0
                    continue
                size = length[state]
            state = to
            size += 1
            if size >= sure[state]:
                reach = next(k for k, _ in fires[state] if k <= size)
                seen.add((state, reach))
                start = i + 1 - reach
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = i + 1
                    while len(spans) > 1 and start <= spans[-2][1]:
                        spans[-2][1] = spans.pop()[1]
                    spans[-1][0] = min(spans[-1][0], start)
                else:
                    spans.append([start, i + 1])
        items: set[int] = set()
        for state, reach in seen:
            for k, some in fires[state]:
                if k <= reach:
                    items |= some
        return [(a, b) for a, b in spans], items


def blocks_of(benchmark: DataFrame, id_column: str, text_column: str, window: int) -> list[list[tuple[int, list[bytes], bool]]]:
    """Item pieces in blocks of at most ``BLOCK_WORDS`` words, read block by block.

    The blocks are yielded one after the other; a block is the most that the driver holds.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of((text or "").encode("utf-8", "surrogatepass"))
                for start in range(0, max(1, len(words) - window + 1), PIECE_WORDS):
                    part = words[start : start + PIECE_WORDS + window - 1]
                    if part:
                        rows.append({"item_id": item, "piece": start, "whole": len(part) == len(words), "words": part})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("item_id", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()), ("words", pa.list_(pa.binary()))]))

    items = two_columns(benchmark, id_column, text_column).where("id IS NOT NULL")
    cut = materialise(items.mapInArrow(pieces, PIECES).withColumn("size", F.size("words")), "item-pieces")
    total = cut.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-2 * total // BLOCK_WORDS))
    while True:
        placed = cut.withColumn("block", F.pmod(F.xxhash64("item_id", "piece"), F.lit(parts)))
        largest = placed.groupBy("block").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0] or 0
        if largest <= BLOCK_WORDS:
            break
        parts *= 2
    for block in range(parts):
        rows = placed.where(F.col("block") == block).select("item_id", "words", "whole").collect()
        if rows or block == 0:
            yield [(r.item_id, [bytes(w) for w in r.words], r.whole) for r in rows]


def scan_block(docs: DataFrame, block: list[tuple[int, list[bytes], bool]], window: int) -> DataFrame:
    """``(row, doc_id, n_words, spans, items)`` of ``docs (row, id, text)`` against one block of items."""
    automaton = Automaton(block, window)
    shared = docs.sparkSession.sparkContext.broadcast((automaton.__dict__, window))
    schema = pa.schema(
        [
            ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("items", pa.list_(pa.int64())),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Automaton.__new__(Automaton)
        machine.__dict__ = shared.value[0]
        for part in slices(batches):
            out = []
            for row, doc, text in zip(part["row"].to_pylist(), part["id"].to_pylist(), part["text"].cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(text or b"")
                spans, items = machine.scan(words)
                spans = [{"start": a, "stop": b} for a, b in spans]
                out.append({"row": row, "doc_id": doc, "n_words": len(words), "spans": spans, "items": sorted(items)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return docs.select("row", "id", "text").mapInArrow(scan, HITS)


def find_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = 13,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit, items, spans``, spans in words, not overlapping, in order."""
    rows = two_columns(docs, id_column, text_column)
    blocks = blocks_of(benchmark, item_column, item_text, window)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        found = scan_block(rows.withColumn("row", F.lit(0).cast("long")), first, window)
    else:
        # several passes: rows need a name by which the passes meet
        rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "numbered-docs")
        passes = [scan_block(rows, first, window), scan_block(rows, second, window)]
        passes += [scan_block(rows, block, window) for block in blocks]
        every = passes[0]
        for more in passes[1:]:
            every = every.unionByName(more)
        every = every.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
        found = every.withColumn("spans", F.expr(_JOIN_SPANS))
    length = "aggregate(spans, 0L, (n, s) -> n + (s.stop - s.start))"
    return found.select("doc_id", "n_words", F.expr(length).alias("n_hit"), "items", "spans")


# sorted spans into maximal runs
_JOIN_SPANS = """
aggregate(spans, cast(array() as array<struct<start:int,stop:int>>), (done, s) ->
  if(size(done) > 0 and s.start <= element_at(done, -1).stop,
     concat(slice(done, 1, size(done) - 1), array(named_struct(
       'start', element_at(done, -1).start, 'stop', greatest(element_at(done, -1).stop, s.stop)))),
     concat(done, array(s))))
"""


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words", share: int = 20):
    """At least one part in ``share`` of the words is hit."""
    return (F.col(n_hit) > 0) & (F.lit(share) * F.col(n_hit) >= F.col(n_words))


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given runs of words; what stands between the words of a run goes with it."""
    raw = text.encode("utf-8", "surrogatepass")
    folded = raw.translate(_FOLD)
    bounds, at = [], 0
    for word in folded.split():
        at = folded.index(word, at)
        bounds.append((at, at + len(word)))
        at += len(word)
    kept, done = [], 0
    for start, stop in spans:
        kept.append(raw[done : bounds[start][0]])
        done = bounds[stop - 1][1]
    kept.append(raw[done:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def remove(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, max_words: int | None = None, max_share: int = 20,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``docs`` with test passages taken out.

    A document with hits in one part of ``max_share`` or more is dropped. From the others, spans longer than
    ``max_words`` words are cut (None: they stay). All columns of ``docs`` come back.
    """
    names = docs.columns
    blocks = blocks_of(benchmark, "item_id", "text", window)
    first = next(blocks)
    if next(blocks, None) is None:
        return _remove_in_one_pass(docs, first, window, max_words, max_share, text_column)
    kept = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "decontaminate")
    inner = kept.select(F.col("__row").alias("row_id"), F.col(f"`{text_column}`").alias("text"))
    hits = find_hits(inner, benchmark, window, "row_id", "text")
    limits = hits.where("n_hit > 0").select(F.col("doc_id").alias("__row"), contaminated(share=max_share).alias("__out"), F.col("spans").alias("__spans"))
    joined = kept.join(limits, "__row", "left").where("__out IS NULL OR NOT __out")
    if max_words is not None:
        too_long = F.filter("__spans", lambda s: s["stop"] - s["start"] > max_words)

        @F.udf("string")
        def cut(text, spans):
            return text if not spans else cut_words(text, [(s["start"], s["stop"]) for s in spans])

        shorter = F.when(F.size(too_long) > 0, cut(F.col(f"`{text_column}`"), too_long)).otherwise(F.col(f"`{text_column}`"))
        joined = joined.withColumn(text_column, shorter)
    return joined.select(*[f"`{c}`" for c in names])


def _remove_in_one_pass(docs: DataFrame, block: list, window: int, max_words: int | None, max_share: int, text_column: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(block, window).__dict__)
    at = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Automaton.__new__(Automaton)
        machine.__dict__ = shared.value
        for part in slices(batches, text_column):
            good, texts = [], []
            for text in part.column(at).to_pylist():
                words = words_of((text or "").encode("utf-8", "surrogatepass"))
                spans, _ = machine.scan(words)
                hit = sum(b - a for a, b in spans)
                good.append(not (hit and max_share * hit >= len(words)))
                long = [s for s in spans if max_words is not None and s[1] - s[0] > max_words]
                texts.append(cut_words(text, long) if long else text)
            part = part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
            yield part.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    """The digest of every document against the whole benchmark."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return find_hits(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        F.coalesce(contaminated(), F.lit(False)).alias("contaminated"),
    )


def brute_force(texts: list[tuple[int, str | None]], items: list[tuple[int, str | None]], window: int = 13) -> list[tuple]:
    """The same by comparing every run of words; for tests."""
    windows: dict[tuple, set[int]] = {}
    for item, text in items:
        words = words_of((text or "").encode())
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in texts:
        words = words_of((text or "").encode())
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                some = windows.get(tuple(words[i : i + size]))
                if some:
                    hit.update(range(i, i + size))
                    found |= some
        names = ",".join(sorted(map(str, found)))
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    return out
