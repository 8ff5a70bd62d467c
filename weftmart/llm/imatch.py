"""I-Match document fingerprints, in DataFrame operations only.

The lexicon holds all terms whose inverse document frequency lies in a chosen band, counted over all documents. It
meets the texts' terms by shuffle, after the terms above the band were taken out, whose list is broadcast only if its
measured size is under ``BROADCAST_BYTES``. A fingerprint is one hash per randomised subset of the lexicon: the text's
distinct lexicon terms that belong to the subset, sorted and hashed. Subsets thin the lexicon at several rates, so some
of them keep few terms and survive edits of long texts while others tell short texts apart. A text with fewer than
``least`` lexicon terms takes all of its terms instead.

Terms travel as rows, so the texts are worked on in waves: ranges of buckets of neighbours, each with shuffle files of
its own that are gone before the next one's. Nearly all terms of an edited text are terms of the text or of the next
one, so a term is one row, which tells whose it is (``OWN``, ``EDITED``, ``BEFORE``).

The likeness of two fingerprints is the share of equal hashes among the subsets that are non-empty in either;
it is 1 for equal fingerprints.

Defined results: a null text is empty, and empty texts share one fingerprint; rows that share id and text are one
document, each with the same next document; a null id comes last in descending order; of rows that share an id but
not the text the order is that of a text hash; one document alone is its own next one; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftmart.llm.common import BROADCAST_IDS
from weftmart.operators.keys import global_number
from weftmart.session import discard, freed_shuffles, materialise, scratch_path, write_table


@dataclass(frozen=True)
class Lexicon:
    """The band of inverse document frequencies, ln(documents / document frequency), and the bounds."""

    idf_low: float = 3.0
    idf_high: float = 12.0
    least_documents: int = 2
    least: int = 3


#: shares of the lexicon that the randomised subsets keep: one in 8, one in 32 ... with twelve subsets each
RATES = (8, 32, 128, 512, 2048)
COPIES = 12
SUBSETS = len(RATES) * COPIES
#: the terms above the band are broadcast only when they take at most this much memory, ``TERM_BYTES`` a term besides its text
BROADCAST_BYTES, TERM_BYTES = 64 << 20, 100
#: the rows that carry what belongs to a whole text have so many keys, so that a shuffle by term spreads them
MARKERS = 1024
#: neighbours to a bucket, buckets that make a wave worth its jobs, and the most waves
BUCKET, WAVE, WAVES = 512, 16, 6
#: bits over the subsets' ones: a term of the text, of the edited text, and of the edited text of the one before that has it from here
OWN, EDITED, BEFORE = (1 << (SUBSETS + i) for i in range(3))


def terms(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), "")


def lexicon_terms(texts: DataFrame, band: Lexicon) -> DataFrame:
    """``(term, common, mask)``: the lexicon of all ``texts (text)``, and as ``common`` the terms more frequent than the
    band; bit j of the mask is set for members of subset j."""
    total = texts.count()
    counted = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(F.lit(max(total, 1)).cast("double") / F.col("df"))
    chosen = counted.where((idf <= band.idf_high) & (F.col("df") >= band.least_documents))
    return chosen.select("term", (idf < band.idf_low).alias("common"), mask(F.col("term")))


def _fits(words: DataFrame) -> bool:
    """Whether ``words (term)`` are small enough to be broadcast."""
    size = words.agg(F.sum(F.octet_length("term") + F.lit(TERM_BYTES).cast("long"))).first()[0]
    return (size or 0) <= BROADCAST_BYTES


def in_lexicon(counted: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Gives the rows of a ``spread (bucket, term, ...)`` whose term is in the lexicon or marks a text, with the term's mask, by bucket."""
    lexicon, common = counted.where("NOT common").select("term", "mask"), counted.where("common").select("term")
    marker = counted.sparkSession.range(MARKERS).select(F.concat(F.lit(" "), F.col("id").cast("string")).alias("term"), F.lit(0).cast("long").alias("mask"))
    words = lexicon.unionByName(marker)
    # terms above the band are few (each is in one of e^idf_low documents), but most of the rows
    few = _fits(common)

    def met(spread: DataFrame) -> DataFrame:
        if few:
            spread = spread.join(F.broadcast(common), "term", "left_anti")
        # a task's share of the lexicon is small, so the many rows need no sort
        return spread.join(words.hint("shuffle_hash"), "term").repartition("bucket")

    return met


def mask(term: Column) -> Column:
    out = F.lit(0).cast("long")
    for j in range(SUBSETS):
        inside = F.pmod(F.xxhash64(F.lit(j), term), F.lit(RATES[j // COPIES])) == 0
        out = out.bitwiseOR(F.when(inside, F.lit(1 << j)).otherwise(F.lit(0)).cast("long"))
    return out.alias("mask")


def subset_hashes(found: str, every: str, least: int) -> str:
    """SQL: an array with one hash per subset, null where the subset is empty.

    ``found`` holds sorted ``(term, mask)``, ``every`` a hash of all terms (null: no terms).
    """
    # the subsets of one rate share a first pass, and threes of them a second, which leave them only the terms that any of them keeps
    def kept(some: str, subsets: range) -> str:
        return f"filter({some}, t -> (t.mask & {sum(1 << j for j in subsets)}L) <> 0)"

    def three(first: int) -> str:
        ones = (f"nullif(array_join(transform({kept('few', range(j, j + 1))}, t -> t.term), ' '), '')" for j in range(first, first + 3))
        return f"flatten(transform(array({kept('some', range(first, first + 3))}), few -> array({', '.join(ones)})))"

    rates = (range(r * COPIES, (r + 1) * COPIES) for r in range(len(RATES)))
    each = [f"flatten(transform(array({kept(found, rate)}), some -> concat({', '.join(map(three, rate[::3]))})))" for rate in rates]
    one = f"concat({', '.join(each)})"
    hashed = f"transform({one}, s -> if(s is null, null, xxhash64(s)))"
    return f"if(size({found}) < {least}, array_repeat({every}, {SUBSETS}), {hashed})"


def likeness(a: str, b: str) -> Column:
    """The share of equal hashes among the subsets that are non-empty in either fingerprint."""
    same = f"size(filter(zip_with({a}, {b}, (x, y) -> x = y), p -> p))"
    either = f"size(filter(zip_with({a}, {b}, (x, y) -> x is not null or y is not null), p -> p))"
    return F.expr(f"if({a} <=> {b}, 1D, coalesce({same} / cast(nullif({either}, 0) as double), 0D))")


def places_of(docs: DataFrame) -> tuple[DataFrame, int]:
    """``(nid, nhash, bucket, place, extra)`` of ``docs (id, hash)``, and how many places there are.

    Ids are numbered in descending order, ``BUCKET`` numbers to a bucket. The first row of each bucket is also given to
    the bucket before it, marked ``extra``, so the next text is found without another shuffle of texts.
    """
    ids = docs.select("id", "hash").distinct()
    numbered = materialise(global_number(ids, [F.desc_nulls_last("id"), F.col("hash")], "place"), "places")
    last = numbered.count()
    home = f"((place - 1) div {BUCKET})"
    copies = F.expr(
        f"""filter(array(
            named_struct('bucket', {home}, 'place', place, 'extra', false),
            if(place > 1 and (place - 1) % {BUCKET} = 0, named_struct('bucket', {home} - 1, 'place', place, 'extra', true), null),
            if(place = 1, named_struct('bucket', ({last} - 1) div {BUCKET}, 'place', {last} + 1L, 'extra', true), null)), c -> c is not null)"""
    )
    dealt = numbered.select(F.col("id").alias("nid"), F.col("hash").alias("nhash"), F.explode(copies).alias("c"))
    return dealt.select("nid", "nhash", "c.*"), last


def with_next(docs: DataFrame, places: DataFrame, last: int) -> DataFrame:
    """``docs (id, text, hash)`` of some buckets of ``places``: ``bucket, place, row, id, text, next_text, extra``."""
    # only the ids from the first to the last place are read, and for the very last place the first of all
    inside = F.col("place") <= last
    low, high, null, first, n = places.agg(
        F.min(F.when(inside, F.col("nid"))), F.max(F.when(inside, F.col("nid"))), F.max(F.col("nid").isNull()), F.max(F.when(~inside, F.col("nid"))), F.count("*")
    ).first()
    wanted = F.col("id").between(F.lit(low), F.lit(high)) | (F.col("id") == F.lit(first)) | (F.col("id").isNull() & F.lit(bool(null)))
    side = F.broadcast(places) if n <= BROADCAST_IDS else places
    rows = docs.where(wanted).join(side, F.col("id").eqNullSafe(F.col("nid")) & (F.col("hash") == F.col("nhash"))).drop("nid", "nhash", "hash")
    order = Window.partitionBy("bucket").orderBy("place")
    return rows.select(
        "bucket", "place", "extra", "id", "text",
        F.row_number().over(order).alias("row"),
        F.first("text").over(order.rangeBetween(1, 1)).alias("next_text"),
    )


def spread_terms(texts: DataFrame) -> DataFrame:
    """``(bucket, row, term, whose, info)``: a row per term of ``with_next``'s texts and their edited texts, and one marker
    row a text, joined like a term, that carries what belongs to the whole text."""
    half = "(char_length(text) div 2)"
    edited = F.expr(f"concat(substring(text, 1, char_length(text) - {half}), substring(coalesce(next_text, ''), 1, {half}))")
    texts = texts.withColumn("edited", edited).select(
        "bucket", "place", "row", "extra", "id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("sha"), terms(F.col("text")).alias("own"), terms(F.col("edited")).alias("changed"),
    )
    order = Window.partitionBy("bucket").orderBy("place")
    none = F.array().cast("array<string>")
    texts = texts.withColumn("fresh", F.array_except("changed", "own")).withColumn("both", F.array_intersect("own", "changed"))
    texts = texts.withColumn("asked", F.coalesce(F.first("fresh").over(order.rangeBetween(-1, -1)), none))
    texts = texts.withColumn("next_own", F.coalesce(F.first("own").over(order.rangeBetween(1, 1)), none))
    texts = texts.withColumn("only", F.array_except("own", "both"))
    info = """named_struct('place', place, 'id', id, 'n', n_chars, 'sha', sha, 'extra', extra,
        'own', if(size(own) = 0, null, xxhash64(array_join(sort_array(own), ' '))),
        'changed', if(size(changed) = 0, null, xxhash64(array_join(sort_array(changed), ' '))))"""
    kinds = {
        "array_intersect(both, asked)": OWN | EDITED | BEFORE, "array_except(both, asked)": OWN | EDITED,
        "array_intersect(only, asked)": OWN | BEFORE, "array_except(only, asked)": OWN, "array_except(fresh, next_own)": EDITED,
    }
    each = [f"transform({some}, t -> named_struct('term', t, 'whose', {whose}L, 'info', null))" for some, whose in kinds.items()]
    items = f"concat(array(named_struct('term', concat(' ', cast(place % {MARKERS} as string)), 'whose', 0L, 'info', {info})), {', '.join(each)})"
    return texts.select("bucket", "row", F.explode(F.expr(items)).alias("i")).select("bucket", "row", "i.*")


def marks(found: DataFrame, band: Lexicon) -> DataFrame:
    """``(id, n_chars, sha, own, changed, near_edited, near_next)`` from the lexicon's rows of whole buckets, with the hash of each subset."""
    lists = found.groupBy("bucket", "row").agg(
        F.first("info", ignorenulls=True).alias("info"),
        F.expr("sort_array(collect_list(named_struct('term', term, 'mask', mask | whose)) filter (where info is null))").alias("every"),
    )
    having = "filter(every, t -> (t.mask & {}L) <> 0)"
    lists = lists.select("bucket", "info", *[F.expr(having.format(bit)).alias(c) for bit, c in ((OWN, "of_own"), (EDITED, "here"), (BEFORE, "before"))])
    own = lists.select("bucket", "info", F.col("info.place").alias("place"), "here", "before", F.expr(subset_hashes("of_own", "info.own", band.least)).alias("own"))
    following = Window.partitionBy("bucket").orderBy("place").rangeBetween(1, 1)
    own = own.withColumn("there", F.first("before").over(following)).withColumn("following", F.first("own").over(following))
    own = own.where("NOT info.extra").withColumn("of_changed", F.expr("sort_array(concat(here, coalesce(there, filter(here, t -> false))))"))
    both = own.select("info", "own", "following", F.expr(subset_hashes("of_changed", "info.changed", band.least)).alias("changed"))
    return both.select(
        F.col("info.id").alias("id"), F.col("info.n").alias("n_chars"), F.col("info.sha").alias("sha"), "own", "changed",
        likeness("own", "changed").alias("near_edited"), likeness("own", "following").alias("near_next"),
    )


def fingerprints(docs: DataFrame, band: Lexicon = Lexicon()) -> DataFrame:
    """Per row of ``docs (id, text)``: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    spark = docs.sparkSession
    hashed = docs.select("id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    path = scratch_path(spark, "fingerprints")
    with freed_shuffles(spark):
        stored = scratch_path(spark, "lexicon")
        meet = in_lexicon(write_table(lexicon_terms(docs.select("text"), band), stored))
        places, last = places_of(hashed)
        buckets = -(-last // BUCKET)
        waves = max(1, min(WAVES, buckets // WAVE))
        for wave in range(waves):
            some = F.col("bucket").between(wave * buckets // waves, (wave + 1) * buckets // waves - 1)
            texts = with_next(hashed, places.where(some), last)
            made = write_table(marks(meet(spread_terms(texts)), band), path, mode="append")
        discard(spark, stored)
    text = "array_join(transform({}, h -> coalesce(lower(hex(h)), '-')), ':')"
    return made.select(
        "id", "n_chars", F.col("sha").alias("edited_sha256"),
        F.expr(text.format("own")).alias("fingerprint"),
        F.expr(text.format("changed")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


def op10_imatch(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    return fingerprints(docs).withColumnRenamed("id", "doc_id")
