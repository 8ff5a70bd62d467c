"""The language model: counts against plain loops, probabilities that add up, seatings of the right distribution."""

import math

import numpy as np
import pytest

from tests.llm.test_small import corpus, frame, with_odd_columns
from weftmart.llm import language_model as lm
from weftmart.llm.queries import LLM_QUERIES


def rows_of(df):
    return sorted(map(tuple, df.select("id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=repr)


def equal_counts(got, wanted):
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    assert all(a[5] == pytest.approx(b[5]) for a, b in zip(got, wanted, strict=True))


def test_counts_equal_brute_force(spark, monkeypatch):
    rows = [*corpus(), (None, "one Two"), (None, None), (400, "ÀÉ àé"), (401, "word " * 4000), (401, "other")]
    docs = with_odd_columns(frame(spark, rows + rows[:3]))
    wanted = sorted(lm.brute_force(rows + rows[:3]), key=repr)
    got = rows_of(lm.score(docs))
    equal_counts(got, wanted)
    assert rows_of(lm.score(docs)) == got
    # small buckets and shards
    monkeypatch.setattr(lm, "BUCKET", 2000)
    monkeypatch.setattr(lm, "SHARD", 100)
    equal_counts(rows_of(lm.score(docs)), wanted)
    assert lm.score(docs.limit(0)).count() == 0
    held = frame(spark, [(d, "a b") for d in range(200) if lm.zlib.crc32(str(d).encode()) % lm.HELD == 0])
    assert {(r[1], r[3], r[4]) for r in rows_of(lm.score(held))} == {(True, 0, 0)}


def shard(seed=3, words=40):
    rng = np.random.default_rng(seed)
    per_word = rng.integers(1, 30, words)
    contexts = np.concatenate([np.sort(rng.choice(lm.CHILDREN, n, replace=False)) for n in per_word])
    return lm.Shard(np.arange(words).astype(np.uint64), per_word, contexts, rng.geometric(0.1, len(contexts)))


def test_probabilities_of_every_context_add_up_to_one():
    x = shard()
    for number in range(3):
        known = lm.Restaurants.of(x.sums())
        everywhere = np.arange(lm.CHILDREN)[::97]
        total = np.zeros(len(everywhere))
        for word in [*range(40), 10**6]:
            logs, _ = lm.answer([x], [known], np.array([word], np.uint64), np.array([len(everywhere)]), everywhere)
            total += 10.0 ** logs
        assert total == pytest.approx(1)
        x.sweep(known, np.random.default_rng(number))


def test_tables_stay_between_one_and_the_customers():
    x = shard()
    for number in range(4):
        x.sweep(lm.Restaurants.of(x.sums()), np.random.default_rng(number))
        for customers, tables in zip(x.customers(), x.tables, strict=True):
            assert (tables >= 1).all() and (tables <= customers).all()


def test_seatings_have_the_distribution_of_the_restaurant():
    """Three customers against the sum over all seatings, and many against one customer after the other."""
    n, above, d, others = 200_000, 0.3, 0.6, 4
    got = np.bincount(lm.reseat(np.full(n, 2), np.full(n, others), np.full(n, above), d, np.random.default_rng(1)), minlength=3)[1:] / n
    new = (lm.STRENGTH + d * (others + 1)) * above
    assert got[1] == pytest.approx(new / (new + 1 - d), abs=0.01)
    many = lm.reseat(np.full(2000, 3000), np.full(2000, others), np.full(2000, above), d, np.random.default_rng(2)).mean()
    rng, one = np.random.default_rng(3), np.ones(2000)
    for k in range(1, 3000):
        new = (lm.STRENGTH + d * (others + one)) * above
        one += rng.random(2000) < new / (new + k - d * one)
    assert many == pytest.approx(one.mean(), rel=0.03)


def test_hash_of_words_and_classes():
    text = "Ab ab\txyz, ab"
    data = np.frombuffer(text.encode(), np.uint8)
    words, classes, edges = lm.tokens(data, np.array([0, 5, 5, len(data)]))
    assert edges.tolist() == [0, 3, 4, 7]
    assert words[0] == words[1] == words[5] and words[2] == words[3] == words[6] == lm.END
    assert classes[0] == classes[3] == classes[4] and classes[1] == classes[2] == classes[6]


def test_pairs_of_a_bucket_with_little_memory():
    """Counts of distinct pairs as by plain loops, in less than six times the bytes of the tokens' numbers beside them."""
    import tracemalloc
    from collections import Counter

    rng = np.random.default_rng(6)
    words = np.append(rng.integers(0, 50, 9999), 7).astype(np.uint32)
    held = np.repeat(rng.random(100) < 0.1, 100)
    before = np.append(np.uint32(7), words[:-1])
    wanted = Counter(zip(words.tolist(), before.tolist()))
    trained = Counter(zip(words[~held].tolist(), before[~held].tolist()))
    pairs, counts = lm.pairs_of(words, held, 7, 50)
    assert [divmod(p, 50) for p in pairs.tolist()] == sorted(wanted)
    assert counts.tolist() == [trained[p] for p in sorted(wanted)]
    words, held = np.tile(words, 100), np.tile(held, 100)
    tracemalloc.start()
    lm.pairs_of(words, held, 7, 50)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 6 * words.nbytes


def test_a_stored_shard_comes_back_with_little_memory():
    """The same dishes, in less than five times the bytes of their counts, as nothing is sorted again."""
    import tracemalloc

    rng = np.random.default_rng(4)
    per_word = np.full(4000, 50)
    contexts = np.concatenate([np.sort(rng.choice(lm.CHILDREN, 50, replace=False)) for _ in range(4000)])
    x = lm.Shard(np.arange(4000).astype(np.uint64), per_word, contexts, rng.geometric(0.1, len(contexts)))
    row = next(lm._by_row(iter([lm._state_row(3, x, [])])))
    tracemalloc.start()
    y = lm._shard_of(row)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for name in ("words", "word", "heads", "head", "keys", "counts"):
        assert (getattr(x, name) == getattr(y, name)).all()
    assert all((a == b).all() for a, b in zip(x.tables, y.tables, strict=True))
    assert most < 5 * x.counts.nbytes


def test_op12(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = rows_of(LLM_QUERIES["op12_language_model"](spark, folder).withColumnRenamed("doc_id", "id"))
    equal_counts(got, sorted(lm.brute_force(texts), key=repr))
    held = [r for r in got if r[1]]
    words = sum(r[2] for r in held)
    # perplexity of held-out texts, against single words alone
    assert 10 ** (-sum(r[6] for r in held) / words) < 0.6 * 10 ** (-sum(r[5] for r in held) / words)
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in got)


def test_a_context_is_the_whole_word_before(spark):
    """Words that end alike are followed by different words."""
    inside = [d for d in range(300) if lm.zlib.crc32(str(d).encode()) % lm.HELD]
    texts = [(d, "first-ending left" if i % 2 else "other-ending right") for i, d in enumerate(inside)]
    asked = [d for d in range(300, 900) if lm.zlib.crc32(str(d).encode()) % lm.HELD == 0][:4]
    questions = ["first-ending left", "first-ending right", "other-ending left", "other-ending right"]
    got = {r.id: r.score for r in lm.score(frame(spark, texts + list(zip(asked, questions, strict=True)))).collect()}
    likely, unlikely, also_unlikely, also_likely = (got[d] for d in asked)
    assert likely > unlikely + 1 and also_likely > also_unlikely + 1
