"""Spelling variants by reduced-alphabet generation.

Letters are hashed to ``SYMBOLS`` symbols. One edit of a word is at most one edit of its reduced word, so the one-edit
neighbourhood of every reduced word over the few symbols, joined with the reduced words of the vocabulary, holds every
near pair; candidates are verified on the original strings. Each unordered pair is generated from one of its sides: a
word gives its reduced word, all one-symbol deletions, and all replacements by a greater symbol. The insertions and the
replacements by a smaller symbol of one word are the deletions and greater replacements of the other.

Words are counted in each task before any shuffle. Reduced words travel as 64-bit polynomial hashes, which only gather
candidates. A word of at most ``CARRIED`` code points travels along with its keys; of a longer one only its hash does,
and the few candidates fetch the strings by a second join, so the bytes sent stay in proportion to the vocabulary.

Defined results: a null or empty text has no words; a row with a null id has no runs with a letter deleted, as there
is nothing to hash; rows that repeat count again; of near words with equal counts the smallest in code-point order is
the form; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftmart.llm.common import U64, slices, text_bytes, two_columns
from weftmart.session import materialise

#: a run's letter is deleted when its hash is divisible by this; shortest word; fewest occurrences
DIVISOR, LETTERS, OCCURRENCES = 31, 7, 2
#: a word's form occurs at least so many times as often
FACTOR = 10
#: size of the reduced alphabet, and the longest word that travels with its keys
SYMBOLS, CARRIED = 6, 48
#: distinct words that a task counts before it gives them out, and letters of words that one numpy step works on
COUNTED, STEP = 400_000, 1 << 17

_BASE = 0x9E3779B97F4A7C15
_INVERSE = U64(pow(_BASE, -1, 1 << 64))


def runs_only(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z in lower case and a space for all that is in no run of ``[A-Za-z\\u00C0-\\u00FF]``."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    lead = data == 0xC3
    inside = ((low >= 97) & (low <= 122)) | lead
    inside[1:] |= lead[:-1]
    return np.where(inside, low, 32).astype(np.uint8)


def _shortened(run: bytes, h: int) -> bytes:
    word = run.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1 :]).encode()


def count_words(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of ``docs (id, text)``, with letters deleted as the hash of id and run says."""

    def out(counts: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if len(w) >= LETTERS and len(w.decode()) >= LETTERS]
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            data, bounds = text_bytes(batch.column(1))
            clean = runs_only(data).tobytes()
            for doc, start, stop in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                runs = Counter(clean[start:stop].split())
                if doc is not None:
                    seed = zlib.crc32(f"{doc}:".encode())
                    for run in [r for r in runs if zlib.crc32(r, seed) % DIVISOR == 0]:
                        n = runs.pop(run)
                        counts[_shortened(run, zlib.crc32(run, seed))] += n
                counts.update(runs)
                if len(counts) >= COUNTED:
                    yield out(counts)
                    counts.clear()
        yield out(counts)

    return docs.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def symbols(points: np.ndarray) -> np.ndarray:
    """The symbol of every letter, from 1 on: a hash of its code point."""
    return ((points.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64) % SYMBOLS + 1


def reduced_keys(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words of one length, as rows of symbols: the hash of each reduced word; the row and key of each of its neighbours.

    Neighbours are the distinct one-symbol deletions and the replacements by a greater symbol.
    """
    rows, length = letters.shape
    powers = np.full(length, _BASE, U64)
    powers[:1] = 1
    np.multiply.accumulate(powers, out=powers)
    upto = np.zeros((rows, length + 1), U64)
    np.cumsum(letters.astype(U64) * powers, axis=1, out=upto[:, 1:])
    whole = upto[:, -1]
    # deleting any symbol of a run of equal ones gives the same word
    fresh = np.ones((rows, length), bool)
    fresh[:, 1:] = letters[:, 1:] != letters[:, :-1]
    row, at = np.nonzero(fresh)
    owners, keys = [row], [upto[row, at] + (whole[row] - upto[row, at + 1]) * _INVERSE]
    for up in range(1, SYMBOLS):
        row, at = np.nonzero(letters + up <= SYMBOLS)
        owners.append(row)
        keys.append(whole[row] + U64(up) * powers[at])
    return whole, np.concatenate(owners), np.concatenate(keys)


def neighbourhood(words: DataFrame, carried: str, edits: bool = True) -> DataFrame:
    """Rows ``(key, own, word, n)`` of ``words (word, n, id)``: ``own`` marks a word's own reduced word.

    ``carried`` names what travels as ``word``: the string itself or its hash. Without ``edits`` only own rows come.
    """
    kind = dict(words.dtypes)[carried]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", STEP):
            texts = batch.column(0).to_pylist()
            names, counts = batch.column(batch.schema.get_field_index(carried)), batch.column(1)
            lengths = np.array([len(t) for t in texts], np.int64)
            for length in np.unique(lengths):
                of = np.flatnonzero(lengths == length)
                step = max(1, STEP // int(length))
                for some in (of[i : i + step] for i in range(0, len(of), step)):
                    points = np.frombuffer("".join(texts[i] for i in some).encode("utf-32-le"), np.uint32)
                    whole, owner, keys = reduced_keys(symbols(points).reshape(len(some), int(length)))
                    if not edits:
                        owner, keys = owner[:0], keys[:0]
                    where = pa.array(np.concatenate([some, some[owner]]))
                    own = np.arange(len(where)) < len(some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([whole, keys]).view(np.int64)), pa.array(own), names.take(where), counts.take(where)],
                        ["key", "own", "word", "n"],
                    )

    return words.select("word", "n", "id").mapInArrow(keyed, f"key long, own boolean, word {kind}, n long")


def _near(candidates: DataFrame) -> DataFrame:
    """Candidates ``(a, a_n, b, b_n, own)`` that differ by one edit; of two words with one reduced word each is met from both sides."""
    return candidates.where("levenshtein(a, b, 1) = 1 AND (NOT own OR a < b)").select("a", "a_n", "b", "b_n")


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, a_n, b, b_n)``: every unordered pair of ``words (word, n)`` that differs by one edit, once."""
    named = words.select("word", "n", F.xxhash64("word").alias("id"))
    long = F.char_length("word") > CARRIED
    # words of CARRIED code points are near longer ones, so both branches hold them
    short, wide = named.where(~long), materialise(named.where(F.char_length("word") >= CARRIED), "wide-words")
    keyed = neighbourhood(short, "word").select("key", "own", F.col("word").alias("a"), F.col("n").alias("a_n"))
    reduced = neighbourhood(short, "word", edits=False).select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    pairs = _near(keyed.join(reduced.hint("shuffle_hash"), "key"))
    keys = neighbourhood(wide, "id").select("key", "own", "word")
    met = keys.select("key", "own", F.col("word").alias("x")).join(neighbourhood(wide, "id", edits=False).select("key", F.col("word").alias("y")), "key")
    met = met.select("x", "y", "own").distinct()
    a = wide.select(F.col("id").alias("x"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = wide.select(F.col("id").alias("y"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    both_short = (F.char_length("a") <= CARRIED) & (F.char_length("b") <= CARRIED)
    return pairs.unionByName(_near(met.join(a, "x").join(b, "y").where(~both_short)).distinct())


def with_roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms (word, form)``, whose forms lead to ever more frequent words, by doubling the steps."""
    known = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        known = materialise(known.join(further, "root", "left_outer").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "roots")
        if known.where("went").isEmpty():
            return known.select("word", "root")


def variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per word: ``word, n, n_near, form, form_n, root``."""
    counted = count_words(two_columns(docs, id_column, text_column))
    words = materialise(counted.where(F.col("n") >= OCCURRENCES), "words")
    pairs = near_pairs(words)
    ends = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("m")))
    best = pairs.select(F.explode(ends).alias("e")).select("e.*").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("best")
    )
    known = words.join(best, "word", "left_outer")
    frequent = -F.col("best.less") >= FACTOR * F.col("n")
    judged = materialise(
        known.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n"),
        ), "forms",
    )
    roots = with_roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left_outer").withColumn("root", F.coalesce("root", "word"))


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


def brute_force(texts: list[tuple[int | None, str | None]]) -> list[tuple]:
    """``(word, form, root, n, n_near, form_n)`` by comparing all words with all edits of each."""
    import re

    fold = {i: i + 32 for i in range(65, 91)}
    counts: Counter = Counter()
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(fold)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % DIVISOR == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= LETTERS and n >= OCCURRENCES}
    gaps: dict[tuple, list] = {}
    for w in words:
        for i in range(len(w)):
            gaps.setdefault((w[:i], w[i + 1 :]), []).append(w)
    near: dict[str, set] = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            near[w].update(x for x in gaps[w[:i], w[i + 1 :]] if x != w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= FACTOR * n:
            form[w] = best
    rows = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return rows
