"""Toxicity by a weighted finite-state grammar over clauses.

Small transducers for targets, negation, reported speech and threats are composed into one machine that reads the
words of a clause by class; insult words carry weights. The machine says for every matched insult or threat whether it
is plain, aimed at somebody, negated or reported; a logistic model weighs these matches per document. So a clause
counts by what it says about an insult, not the word alone.

The insult words and word stems, their weights and the model's are learned from labelled rows: at most ``SAMPLE`` of
them, chosen by a hash of their ids, never those that are held out (crc32 of the id as text is divisible by 5). The
grammar's function words are fixed lists.

Defined results: a null or empty text matches nothing and gets the score of such texts; without labels of both kinds
the score is the same for all; a null id is not held out and has no label; repeated rows get a row each; an empty
table gives an empty result; further columns are ignored, and language and source are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weftmart.llm.common import slices, two_columns
from weftmart.llm.linear import Logistic, fit, label_sample

#: labelled rows that the lexicon and the weights are learned from, at most
SAMPLE = 40_000
#: insult stems that are kept, at most, and the evidence (log-likelihood ratio) that each needs
STEMS, EVIDENCE = 8_192, 16.0
#: lengths of word beginnings that may be stems, beside whole words
PREFIXES = (4, 5, 6)

# fixed values: function words of the grammar
TARGETS = "you your yours yourself u ur he she him her they them du dich dir euch ihr sie tu toi te vous usted ustedes vosotros él ella".split()
NEGATIONS = "not never no nobody don't isn't aren't nicht kein keine nie niemals ne pas jamais aucun nunca jamás tampoco".split()
REPORTS = "said says say told wrote writes quoted called reported allegedly according sagte schrieb nannte laut dit disait écrit selon dijo decía escribió según".split()
THREATS = "kill hurt murder destroy shoot stab beat die burn töten umbringen schlagen tuer frapper mourir matar golpear morir".split()
INTENTS = "will gonna going i'll we'll shall should werde wirst soll vais va doit voy vas debe".split()

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n]")
_ENDS = frozenset(".!?;:\n")

INSULT, TARGET, NEGATION, REPORT, THREAT, INTENT, END = range(7)


class Transducer:
    """Deterministic: ``arcs[state, class] -> (state, mark)``; an absent arc stays where it is and marks nothing."""

    def __init__(self, start, arcs: dict):
        self.start = start
        self.arcs = arcs

    def step(self, state, kind):
        return self.arcs.get((state, kind), (state, ""))

    def states(self) -> set:
        return {self.start, *(s for s, _ in self.arcs), *(t for t, _ in self.arcs.values())}


def flag(kind: int, mark: str, on: tuple[int, ...]) -> Transducer:
    """After ``kind`` in a clause, the given classes are marked until the clause ends."""
    arcs = {("off", kind): ("on", ""), ("on", END): ("off", "")}
    return Transducer("off", arcs | {("on", k): ("on", mark) for k in on})


def compose(machines: list[Transducer]) -> tuple[tuple, dict]:
    """The product machine: all read the same class, and their marks are joined."""
    arcs = {}
    for state in product(*(m.states() for m in machines)):
        for kind in range(7):
            steps = [m.step(s, kind) for m, s in zip(machines, state, strict=True)]
            arcs[state, kind] = (tuple(s for s, _ in steps), "".join(sorted(mark for _, mark in steps)))
    return tuple(m.start for m in machines), arcs


def grammar() -> tuple[int, list[list[tuple[int, str]]]]:
    """The composed machine with numbered states: ``table[state][class] -> (state, marks)``."""
    hits = Transducer("clause", {("clause", INSULT): ("clause", "I"), ("clause", THREAT): ("clause", "K")})
    start, arcs = compose(
        [hits, flag(TARGET, "t", (INSULT, THREAT)), flag(NEGATION, "n", (INSULT, THREAT)), flag(REPORT, "r", (INSULT, THREAT)), flag(INTENT, "w", (THREAT,))]
    )
    number = {state: i for i, state in enumerate(sorted({s for s, _ in arcs}))}
    table = [[(0, "")] * 7 for _ in number]
    for (state, kind), (to, marks) in arcs.items():
        table[number[state]][kind] = (number[to], marks)
    return number[start], table


FEATURES = ("plain", "aimed", "negated", "reported", "threats", "strongest", "clauses")


def matches(text: str, lexicon: dict[str, float], machine, cache: dict) -> np.ndarray:
    """``FEATURES`` of a text: summed weights by kind of match, the strongest one, the number of matched clauses."""
    start, table = machine
    plain = aimed = negated = reported = threats = strongest = 0.0
    clauses, state, hit = 0, start, False
    for word in _WORD.findall(text.lower()):
        known = cache.get(word, cache)
        if known is cache:
            if len(cache) > 200_000:
                cache.clear()
                cache.update(_function_words())
            known = cache[word] = _insult(word, lexicon)
        if known is None:
            continue
        kind, weight = known
        state, marks = table[state][kind]
        if kind == END:
            clauses += hit
            hit = False
        elif marks and ("I" in marks or "t" in marks or "w" in marks):
            if "I" in marks:
                strongest = max(strongest, weight)
                if "n" in marks:
                    negated += weight
                elif "r" in marks:
                    reported += weight
                elif "t" in marks:
                    aimed += weight
                else:
                    plain += weight
                hit = True
            elif "t" in marks and "w" in marks and "n" not in marks and "r" not in marks:
                threats += 1
                hit = True
    sums = (plain, aimed, negated, reported, threats, strongest, clauses + hit)
    return np.log1p(np.array(sums, float))


def _insult(word: str, lexicon: dict[str, float]):
    best = max((lexicon.get(word[:k] + "*", 0.0) for k in PREFIXES if len(word) >= k), default=0.0)
    best = max(best, lexicon.get(word, 0.0))
    return (INSULT, best) if best else None


def _function_words() -> dict:
    kinds = ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT), (INTENTS, INTENT), (_ENDS, END))
    return {word: (kind, 0.0) for words, kind in kinds for word in words}


def held_out(column: Column) -> Column:
    return F.coalesce(F.crc32(column.cast("string")) % 5 == 0, F.lit(False))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Stems with their weights from ``rows (text, label)``: counts per stem are combined in each task first."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()

        def give():
            stems = list(toxic.keys() | clean.keys())
            columns = [pa.array(stems, pa.string()), pa.array([toxic[s] for s in stems], pa.int64()), pa.array([clean[s] for s in stems], pa.int64())]
            toxic.clear()
            clean.clear()
            return pa.RecordBatch.from_arrays(columns, names=["stem", "toxic", "clean"])

        for part in slices(batches):
            for text, label in zip(part["text"].to_pylist(), part["label"].to_pylist(), strict=True):
                words = {w for w in _WORD.findall((text or "").lower()) if w not in _ENDS}
                stems = words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) >= k}
                (toxic if label else clean).update(stems)
            if len(toxic) + len(clean) > 500_000:
                yield give()
        yield give()

    total = rows.groupBy().agg(F.sum("label"), F.count("*")).first()
    p, n = int(total[0] or 0), int(total[1])
    if not 0 < p < n:
        return {}
    found = rows.select("text", "label").mapInArrow(counts, "stem string, toxic bigint, clean bigint")
    found = found.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic >= 3")
    a, b = F.col("toxic") + 0.0, F.col("clean") + 0.0
    rate = (a + b) / float(n)
    # log-likelihood ratio of two shares against one, for stems more frequent in toxic rows
    evidence = 2 * (a * F.log(a / (rate * float(p))) + F.when(b > 0, b * F.log(b / (rate * float(n - p)))).otherwise(0.0))
    weight = F.log((a + 0.5) / (p + 1.0)) - F.log((b + 0.5) / (n - p + 1.0))
    found = found.withColumns({"evidence": evidence, "weight": weight}).where((F.col("evidence") >= EVIDENCE) & (F.col("weight") >= 2.0))
    # a bounded list: the stems with the most evidence
    best = found.orderBy(F.desc("evidence"), "stem").limit(STEMS).select("stem", "weight").collect()
    return {r.stem: min(r.weight, 8.0) for r in best if not math.isnan(r.weight)}


def _with_matches(rows: DataFrame, lexicon: dict[str, float], model: Logistic | None, keep: list[str]) -> DataFrame:
    machine = grammar()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _function_words()
        for part in slices(batches):
            found = np.array([matches(t or "", lexicon, machine, cache) for t in part["text"].to_pylist()]).reshape(-1, len(FEATURES))
            columns = [part[c] for c in keep]
            if model is None:
                columns.append(pa.array(list(found), pa.list_(pa.float64())))
            else:
                columns += [pa.array(model(found)), pa.array(np.rint(np.expm1(found[:, -1])).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [*keep, "features"] if model is None else [*keep, "score", "n_clauses"]
    form = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in keep)
    form += ", features array<double>" if model is None else ", score double, n_clauses bigint"
    return rows.select("text", *keep).mapInArrow(read, form)


def learn(docs: DataFrame, labels: DataFrame, label_column: str = "toxic", sample: int = SAMPLE) -> tuple[dict[str, float], Logistic]:
    """Lexicon and model from labelled rows of ``docs (id, text)`` that are not held out."""
    used = label_sample(labels.where(~held_out(F.col("doc_id"))), label_column, sample)
    rows = docs.join(F.broadcast(used), "id").select("text", "label")
    lexicon = learn_lexicon(rows)
    table = _with_matches(rows, lexicon, None, ["label"]).toArrow()
    found = np.array(table["features"].to_pylist(), float).reshape(-1, len(FEATURES))
    return lexicon, fit(found, np.array(table["label"].to_pylist(), float))


def score(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, score, n_clauses)`` for every row of ``docs``."""
    rows = two_columns(docs, id_column, text_column)
    lexicon, model = learn(rows, labels)
    return _with_matches(rows, lexicon, model, ["id"])


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    found = score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_clauses",
    )
