"""Quality classifier by co-training of a text view and a page-metadata view.

Two logistic classifiers see different things: one the text's content (characters, words, repetition), the other the
page's metadata (language, source, length and line layout). Over some rounds each labels the unlabelled documents it
is surest about for the other one. A held-out part of the labelled rows then calibrates both and combines them into
one score for every document.

The features of all documents are taken from the texts once and written beside them. At most ``LABELLED`` labelled
ids (a parameter), chosen by a hash, have theirs sent to the driver; every other document takes part in every round: a
histogram of all scores gives the cuts beyond which a view is among its surest, whole bins at a time, and the documents
beyond them enter the Newton steps of the other view as sums of slopes and curvatures that tasks send. All pseudo-labels
together weigh at most as much as the labelled rows, so that rounds behave alike at every size.

Defined results: a null or empty text has features 0 and is scored like any other; null language and source are
values of their own; without labels of both kinds among the documents nothing tells good from bad, so every score is
0.5 and ``accepted`` keeps all documents, whatever its limit; repeated rows get a row each; a
null id is scored but has no label (of rows that share a labelled id, the one whose features come first in order is
learned from); an empty table gives an empty result; further columns, of any name, are kept by ``accepted``.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftmart.llm.common import slices
from weftmart.llm.linear import Logistic, fit, label_sample, sigmoid
from weftmart.session import materialise

LABELLED = 20_000
#: rounds; how sure a view must be; half the share of all documents that a view labels in a round at most
ROUNDS, SURE, GIVEN = 4, 0.95, 0.05
#: passes over the documents for the Newton steps of a round
PASSES = 4
#: logits are counted in bins of this width, up to this distance from 0
BIN, FAR = 0.02, 40.0
BINS = int(2 * FAR / BIN)
SOURCE_SLOTS, LANGUAGE_SLOTS = 32, 8

_KIND = np.full(256, 5, np.int8)  # 0 lower, 1 upper, 2 digit, 3 white, 4 sentence mark, 5 other sign, 6 beyond ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 6
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[[44, 46, 39, 45]] = 4


def content(text: str) -> list[float]:
    """The text view: shares of kinds of characters, and how words repeat, over the whole text and its worst part."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if not len(raw):
        return [0.0] * 18
    kinds = np.bincount(_KIND[raw], minlength=7)
    letters = max(1, kinds[0] + kinds[1] + kinds[6])
    words = text.split()
    n = max(1, len(words))
    lows = [w.lower() for w in words]
    again = sum(a == b for a, b in zip(lows, lows[1:], strict=False))
    distinct = len(set(lows))
    shouted = sum(w.isupper() and len(w) > 1 for w in words)
    signed = sum(not w[-1].isalnum() and w[-1] not in ".,;:'\")?" for w in words)
    lone = sum(not any(c.isalnum() for c in w) for w in words)
    worst_upper = worst_sign = worst_again = worst_few = 0.0
    for start in range(0, len(words), 40):
        # the last part reaches back, so that it is as long as the others
        start = max(0, min(start, len(words) - 40))
        part, own = lows[start : start + 40], words[start : start + 40]
        worst_upper = max(worst_upper, sum(w.isupper() and len(w) > 1 for w in own) / len(part))
        worst_sign = max(worst_sign, sum(not w[-1].isalnum() and w[-1] not in ".,;:'\")?" for w in own) / len(part))
        worst_again = max(worst_again, sum(a == b for a, b in zip(part, part[1:], strict=False)) / len(part))
        worst_few = max(worst_few, 1 - len(set(part)) / len(part))
    return [
        kinds[1] / letters, kinds[2] / len(raw), kinds[3] / len(raw), kinds[4] / len(raw), kinds[5] / len(raw), kinds[6] / len(raw),
        len(text) / n / 10, again / n, distinct / n, shouted / n, signed / n, lone / n,
        worst_upper, worst_sign, worst_again, worst_few, float(np.log1p(n)), max(Counter(lows).values(), default=0) / n,
    ]


def metadata(text: str, language: str | None, source: str | None, stated: int | None) -> list[float]:
    """The metadata view: language, source, lengths as stated and found, line layout."""
    lines = text.split("\n")
    sizes = np.array([len(x) for x in lines], float)
    out = [
        float(np.log1p(max(0, stated or 0))), float(np.log1p(len(text))), float((stated or 0) != len(text)),
        float(np.log1p(len(lines))), float(np.log1p(sizes.mean())), float(np.log1p(sizes.max())), float(np.log1p(sizes.std())),
        float((sizes < 40).mean()), float(text.endswith((".", "!", "?"))),
    ]
    slots = [0.0] * (LANGUAGE_SLOTS + SOURCE_SLOTS)
    slots[zlib.crc32((language or "").encode()) % LANGUAGE_SLOTS] = 1.0
    slots[LANGUAGE_SLOTS + zlib.crc32((source or "").encode()) % SOURCE_SLOTS] = 1.0
    return out + slots


#: sums ``work(features)`` over all unlabelled rows
Pool = Callable[[Callable[[np.ndarray], np.ndarray]], np.ndarray]


def _chance(z: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-FAR), F.least(F.lit(FAR), z))))


def _logit(model: Logistic, values: list[Column]) -> Column:
    weights = model.weights / model.scale
    out = F.lit(float(model.bias - weights @ model.mean))
    for value, weight in zip(values, weights, strict=True):
        out = out + value * F.lit(float(weight))
    return out


@dataclass
class Views:
    text: Logistic
    page: Logistic
    combine: Logistic
    informed: bool = True  # False: there were no labels of both kinds

    def __call__(self, content_rows: np.ndarray, page_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.text.logit(content_rows), self.page.logit(page_rows)
        return sigmoid(a), sigmoid(b), self.combine(np.stack([np.clip(a, -15, 15), np.clip(b, -15, 15)], 1))

    def columns(self, features: Column) -> tuple[Column, Column, Column]:
        """The same three scores as Spark expressions over the array of both views' features."""
        split = len(self.text.weights)
        values = [features[i].cast("double") for i in range(split + len(self.page.weights))]
        a, b = _logit(self.text, values[:split]), _logit(self.page, values[split:])
        clipped = [F.greatest(F.lit(-15.0), F.least(F.lit(15.0), z)) for z in (a, b)]
        return _chance(a), _chance(b), _chance(_logit(self.combine, clipped))


def _bins(logits: np.ndarray) -> np.ndarray:
    return np.clip(((logits + FAR) / BIN).astype(np.int64), 0, BINS - 1)


_SURE_BIN = int(np.ceil((np.log(SURE / (1 - SURE)) + FAR) / BIN))


def _cuts(counts: np.ndarray, good_share: float) -> tuple[int, int]:
    """The least bin that is labelled good and the greatest that is labelled bad.

    Both kinds get their share of what a round labels, so that it shifts no model's prior. Whole bins from either end,
    as long as they hold no more; the outermost one always counts.
    """
    most = 2 * GIVEN * counts.sum()

    def reach(from_end: np.ndarray, share: float) -> int:
        held = np.cumsum(from_end)
        filled = np.flatnonzero(from_end)
        return max(int(np.searchsorted(held, most * share, side="right")), int(filled[0]) + 1 if len(filled) else 0)

    good, bad = BINS - reach(counts[::-1], good_share), reach(counts, 1 - good_share) - 1
    return max(good, _SURE_BIN), min(bad, BINS - 1 - _SURE_BIN)


@dataclass
class _Taught:
    """What one view says of unlabelled rows: per round a model and its cuts, the latest word counting."""

    said: list[tuple[Logistic, int, int]]

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        marks = np.full(len(rows), -1, np.int8)
        for model, good, bad in self.said:
            at = _bins(model.logit(rows))
            marks[at >= good] = 1
            marks[at <= bad] = 0
        return marks


def _sums(model: Logistic, rows: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Rows, loss, slope and curvature, one after the other."""
    x = np.hstack([(rows - model.mean) / model.scale, np.ones((len(rows), 1))])
    z = x @ np.append(model.weights, model.bias)
    p = sigmoid(z)
    curve = (x * (p * (1 - p))[:, None]).T @ x
    return np.concatenate([[len(rows), (np.logaddexp(0, z) - marks * z).sum()], x.T @ (marks - p), curve.ravel()])


def _size(model: Logistic) -> int:
    k = len(model.weights) + 1
    return 2 + k + k * k


def _refit(models: list[Logistic], own: list[np.ndarray], marks: np.ndarray, pool: Pool, taught: list[_Taught], ridge: float = 1.0) -> list[Logistic]:
    """Both views fitted on the labelled rows and on what the other view says of the rest; the best weights that were evaluated."""
    best: list[tuple[float, Logistic, np.ndarray] | None] = [None, None]
    tried = list(models)
    split = len(models[0].weights)
    for _ in range(PASSES):
        now = list(tried)

        def work(rows: np.ndarray, now=now) -> np.ndarray:
            views, out = (rows[:, :split], rows[:, split:]), []
            for v in (0, 1):
                said = taught[1 - v](views[1 - v])
                out.append(_sums(now[v], views[v][said >= 0], said[said >= 0]))
            return np.concatenate(out)

        found = pool(work)
        for v, part in enumerate((found[: _size(models[0])], found[_size(models[0]) :])):
            weight = min(1.0, len(marks) / part[0]) if part[0] else 0.0
            both = _sums(now[v], own[v], marks) + weight * part
            k = len(now[v].weights) + 1
            w, keep = np.append(now[v].weights, now[v].bias), np.append(np.full(k - 1, ridge), 1e-6)
            loss = float(both[1] + (keep * w * w).sum() / 2)
            if best[v] is None or loss < best[v][0]:
                step = np.linalg.solve(both[2 + k :].reshape(k, k) + np.diag(keep), both[2 : 2 + k] - keep * w)
                best[v] = loss, now[v], step
            else:
                # the step went too far: half of it
                best[v] = best[v][0], best[v][1], best[v][2] / 2
            w = np.append(best[v][1].weights, best[v][1].bias) + best[v][2]
            tried[v] = Logistic(now[v].mean, now[v].scale, w[:-1], float(w[-1]))
    return [b[1] for b in best]


def _combine(logits: np.ndarray, labels: np.ndarray, trust: float = 10.0) -> Logistic:
    """Weights of the two views' log-odds, drawn to their sum less the prior's.

    That sum is right for views that are independent given the class; few calibration rows do not overrule it.
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    x = np.hstack([logits, np.ones((len(logits), 1))])
    start = np.array([1.0, 1.0, -np.log(share / (1 - share))])
    keep = np.array([trust, trust, 1e-2])
    w = start.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - labels * z).sum() + (keep * (w - start) ** 2).sum() / 2)

    for _ in range(30):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (labels - p) - keep * (w - start))
        while np.abs(step).max() > 1e-9 and loss(w + step) > loss(w):
            step = step / 2
        w = w + step
        if np.abs(step).max() <= 1e-9:
            break
    return Logistic(np.zeros(2), np.ones(2), w[:2], float(w[2]))


def co_train(rows: tuple[np.ndarray, np.ndarray], labels: np.ndarray, pool: tuple[np.ndarray, np.ndarray] | Pool, rounds: int = ROUNDS) -> Views:
    """``rows`` holds the two views of labelled rows, every third of which is kept for calibration.

    ``pool`` sums over the unlabelled rows, or holds their two views.
    """
    if not len(labels) or labels.min() == labels.max():
        flat = [Logistic(np.zeros(k), np.ones(k), np.zeros(k), 0.0) for k in (rows[0].shape[1], rows[1].shape[1], 2)]
        return Views(*flat, informed=False)
    if not callable(pool):
        together = np.hstack(pool)
        pool = lambda work: work(together)
    third = np.arange(len(labels)) % 3 == 2
    if any(not len(part) or part.min() == part.max() for part in (labels[third], labels[~third])):
        third = np.zeros(len(labels), bool)
    own = [r[~third] for r in rows]
    marks = labels[~third]
    models = [fit(own[v], marks) for v in (0, 1)]
    taught = [_Taught([]), _Taught([])]
    split = rows[0].shape[1]
    for _ in range(rounds):
        now = list(models)

        def count(found: np.ndarray, now=now) -> np.ndarray:
            views = found[:, :split], found[:, split:]
            return np.concatenate([np.bincount(_bins(now[v].logit(views[v])), minlength=BINS).astype(float) for v in (0, 1)])

        counts = pool(count).reshape(2, BINS)
        if not counts.any():
            break
        taught = [_Taught([*taught[v].said, (now[v], *_cuts(counts[v], float(marks.mean())))]) for v in (0, 1)]
        models = _refit(now, own, marks, pool, taught)
    held = third if third.any() else np.ones(len(labels), bool)
    logits = np.stack([np.clip(models[v].logit(rows[v][held]), -15, 15) for v in (0, 1)], 1)
    return Views(models[0], models[1], _combine(logits, labels[held]))


_SPLIT = len(content("a"))
_WIDTH = _SPLIT + len(metadata("", None, None, None))
_KINDS = {"id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
NAMES = {"id": "doc_id", "text": "text", "lang": "lang", "source": "source", "n_chars": "n_chars"}


def _features(batch: pa.RecordBatch) -> pa.Array:
    columns = (batch[c].to_pylist() for c in ("text", "lang", "source", "n_chars"))
    rows = [content(text or "") + metadata(text or "", lang, source, n) for text, lang, source, n in zip(*columns, strict=True)]
    return pa.array(rows, pa.list_(pa.float32()))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), _WIDTH)


def _view_table(docs: DataFrame, used: DataFrame, names: dict[str, str], whole: bool) -> DataFrame:
    """Every row's id, its label if it is one of the ``used`` ones, its features and, if ``whole``, all its columns as ``row``."""
    columns = [F.col(f"`{names[c]}`").cast(kind).alias(c) for c, kind in _KINDS.items()]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("features", T.ArrayType(T.FloatType()))])
    if whole:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        schema = schema.add("row", T.StructType(docs.schema.fields))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = {"id": part["id"], "features": _features(part)}
            if whole:
                found["row"] = part["row"]
            yield pa.RecordBatch.from_arrays(list(found.values()), names=list(found))

    # the labels' ids were written and are at most as many as their bound
    return materialise(docs.select(*columns).mapInArrow(read, schema).join(F.broadcast(used), "id", "left"), "views")


def _spark_pool(rows: DataFrame) -> Pool:
    """Sums over the rows: a task sends one vector, Spark adds them up exactly, so that their order does not matter."""

    def gather(work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        width = len(work(np.zeros((0, _WIDTH))))

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width)
            for batch in batches:
                total += work(_matrix(batch["features"]))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["at", "value"])

        parts = rows.mapInArrow(read, "at int, value double")
        sums = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,12)")).cast("double").alias("value")).toArrow()
        out = np.zeros(width)
        out[np.asarray(sums["at"])] = np.asarray(sums["value"])
        return out

    return gather


def learn(table: DataFrame, rounds: int = ROUNDS) -> Views:
    """Both views from a table of features and labels."""
    known = table.where("label IS NOT NULL").groupBy("id", "label").agg(F.min("features").alias("features"))
    known = known.toArrow().sort_by("id").combine_chunks()
    rows = np.array(known["features"].to_pylist(), float).reshape(-1, _WIDTH)
    marks = np.array(known["label"].to_pylist(), float)
    pool = _spark_pool(table.where("label IS NULL").select("features"))
    return co_train((rows[:, :_SPLIT], rows[:, _SPLIT:]), marks, pool, rounds)


def score(docs: DataFrame, labels: DataFrame, names: dict[str, str] = NAMES, label_column: str = "quality", labelled: int = LABELLED) -> DataFrame:
    """``(id, text_score, page_score, score)`` for every row of ``docs``: how likely it is of good quality."""
    table = _view_table(docs, label_sample(labels, label_column, labelled), names, whole=False)
    a, b, both = learn(table).columns(F.col("features"))
    return table.select("id", a.alias("text_score"), b.alias("page_score"), both.alias("score"))


def accepted(
    docs: DataFrame, labels: DataFrame, least: float = 0.5, names: dict[str, str] = NAMES, label_column: str = "quality", labelled: int = LABELLED
) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, with all their columns."""
    table = _view_table(docs, label_sample(labels, label_column, labelled), names, whole=True)
    views = learn(table)
    if not views.informed:
        return docs
    return table.where(views.columns(F.col("features"))[2] >= least).select("row.*")


def op5_cotraining(spark, sf_dir: str) -> DataFrame:
    found = score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select(F.col("id").alias("doc_id"), "text_score", "page_score", "score", (F.col("score") >= 0.5).alias("accepted"))
