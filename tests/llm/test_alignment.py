"""The fragment monoid and the alignment of two tokenizers against whole texts in plain loops."""

import random

import numpy as np
import pytest

from tests.llm.test_small import corpus, frame, result, with_odd_columns
from weftmart.llm import alignment
from weftmart.llm.queries import LLM_QUERIES

COLUMNS = ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain(f):
    return f.cut, *(tuple(x.tolist() for x in getattr(f, part)) for part in ("prefix", "ids", "sizes", "suffix"))


def some_tokens(rng, total):
    """Ids and ends of tokens that cover ``total`` bytes."""
    ends = sorted({total, *rng.sample(range(1, total), rng.randint(0, total - 2))})
    return np.array([rng.randrange(50) for _ in ends], np.int32), np.array(ends)


def test_fragments_compose_associatively_wherever_a_text_is_cut():
    rng = random.Random(4)
    for _ in range(300):
        total = rng.randint(3, 40)
        (a, x), (b, y) = some_tokens(rng, total), some_tokens(rng, total)
        whole = alignment.fragment(a, x, b, y)
        edges = [0, *sorted(rng.sample(range(total + 1), rng.randint(0, min(6, total)))), total]
        parts = []
        for lo, hi in zip(edges, edges[1:]):
            i, j = (x > lo) & (x <= hi), (y > lo) & (y <= hi)
            parts.append(alignment.fragment(a[i], x[i], b[j], y[j]))
        left = alignment.Fragment()
        for p in parts:
            left = alignment.compose(left, p)
        right = alignment.Fragment()
        for p in reversed(parts):
            right = alignment.compose(p, right)
        assert plain(left) == plain(right) == plain(alignment.composed(parts)) == plain(whole)


def test_texts_equal_brute_force(spark, monkeypatch):
    rows = [*corpus(), (None, "one two"), (None, None), (401, "a ▁ b"), (402, "  two  spaces \n and a tail  "), (403, "x" * 3000), (404, "\0 a"), (405, "<|endoftext|> <s> </s>")]
    rows += [(406, "é😀   x " * 300), (407, "word, " * 900), (407, "word, " * 900), (408, "longer ▁ " * 400)]
    wanted = sorted(alignment.brute_force(rows), key=repr)
    docs = with_odd_columns(frame(spark, rows))
    for piece, reach, fan in ((alignment.PIECE, alignment.RANGE, alignment.FAN), (300, 70, 2)):
        # small pieces send texts through several rounds of the reduction
        monkeypatch.setattr(alignment, "PIECE", piece)
        monkeypatch.setattr(alignment, "RANGE", reach)
        monkeypatch.setattr(alignment, "FAN", fan)
        assert result(alignment.align(docs, alignment.VOCABULARIES), *COLUMNS) == wanted
    assert alignment.align(docs.limit(0), alignment.VOCABULARIES).count() == 0


def test_groups_without_shared_ends_are_counted_by_distinct_ids(monkeypatch):
    ids = (np.array([1, 1, 2, 7], np.int32), np.array([5, 6, 5, 9], np.int32))
    sizes = (np.array([3, 1], np.int32), np.array([3, 1], np.int32))
    links = lambda: sorted(zip(*(x.tolist() for x in alignment.linked(ids, sizes, np.array([0, 1])))))
    expanded = links()
    monkeypatch.setattr(alignment, "EXPAND", 4)
    summed = {}
    for owner, pair, times in expanded:
        summed[owner, pair] = summed.get((owner, pair), 0) + times
    again = {}
    for owner, pair, times in links():
        again[owner, pair] = again.get((owner, pair), 0) + times
    assert again == summed and sum(summed.values()) == 10


@pytest.mark.parametrize("parts", [["a", "b c"], ["x "], ["▁"], ["ab", "\n"], ["y" * 500]])
def test_stretches_come_back(parts):
    for encoder in alignment.encoders(alignment.VOCABULARIES):
        ids, sizes, right = alignment.encode_stretches(parts, encoder)
        at = np.concatenate([[0], np.cumsum(sizes)])
        for i, p in enumerate(parts):
            assert ids[at[i] : at[i + 1]].tolist() == encoder.encode(f" {p}").tolist()
            assert right[i] == (encoder.bytes_of(ids[at[i] : at[i + 1]]).tobytes() == f" {p}".encode())


def test_op11(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert result(LLM_QUERIES["op11_alignment"](spark, folder), "doc_id", *COLUMNS[1:]) == sorted(alignment.brute_force(texts), key=repr)


def test_a_slice_of_texts_takes_little_memory(monkeypatch):
    """What numpy and Python hold at most over texts of several slices."""
    import tracemalloc

    import pyarrow as pa
    import pyspark

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)  # noqa: N815

    class Table:
        def mapInArrow(self, run, schema):
            return run

    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(2000)]
    texts = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(1500)]
    monkeypatch.setattr(pyspark, "TaskContext", Task)
    alignment.encoders(alignment.VOCABULARIES)
    run = alignment.align_short(Table(), alignment.VOCABULARIES, 0)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    assert batch.nbytes > 2 << 20
    tracemalloc.start()
    rows = sum(b.num_rows for b in run(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > len(texts) and most < 130e6
