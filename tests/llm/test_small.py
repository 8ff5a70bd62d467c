"""Every dealt operator on small tables against a brute-force version, and its defined results on odd rows."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from weftmart.llm import chat, cotrain, decontaminate, imatch, mixing, minhash, pages, pii, suffix_dedup, toxicity

VOCABULARY = [f"w{i}" for i in range(60)]


def sentence(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def corpus(seed=5):
    """Copies, near copies, shared passages, nulls, empties, ties and repeated rows."""
    rng = random.Random(seed)
    passage = sentence(rng, 30)
    rows = []
    for i in range(60):
        text = sentence(rng, rng.randint(1, 80))
        if i % 4 == 0:
            text = f"{text[: len(text) // 2]} {passage}. {text[len(text) // 2 :]}"
        rows.append((i, text))
    rows += [(100 + i, rows[i][1]) for i in range(0, 30, 3)]
    for i in range(12):
        words = (passage + " " + sentence(random.Random(1), 60)).split()
        words[rng.randrange(len(words))] = "Changed"
        rows.append((200 + i, " ".join(words)))
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "é€😀 " * 40), (304, "one two"), (305, "One  TWO"), (306, "a" * 4000)]
    return rows


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def with_odd_columns(df):
    """Further columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in ("id", "node", "component", "key", "size", "n", "row", "spans", "hash", "place", "bucket", "label")})


def result(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_decontaminate_equals_brute_force(spark, monkeypatch):
    rows = corpus()
    items = [(i, rows[i * 3][1][20:200]) for i in range(8)] + [(8, "one two"), (9, None), (10, ""), (11, rows[3][1]), (12, "w1 w2")]
    docs, bench = with_odd_columns(frame(spark, rows + rows[:2])), frame(spark, [*items, (None, "w1")], "item_id long, text string")
    wanted = [(d, n, h, k) for d, n, h, k, _, _ in decontaminate.brute_force(rows + rows[:2], items)]
    for words in (decontaminate.BLOCK_WORDS, 60):
        # a small bound deals the items over several passes
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", words)
        monkeypatch.setattr(decontaminate, "PIECE_WORDS", 20)
        got = decontaminate.find_hits(docs, bench)
        got = [(r.doc_id, r.n_words, r.n_hit, len(set(r["items"]))) for r in got.collect()]
        assert sorted(got, key=repr) == sorted(wanted, key=repr)
        kept = {r.doc_id for r in decontaminate.remove(docs, bench).collect()}
        assert kept == {d for d, n, h, _ in wanted if not (h and 20 * h >= n)}
    assert decontaminate.find_hits(docs.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontaminate.find_hits(docs, bench.limit(0)).collect()} == {0}


def test_long_spans_are_cut():
    text = "Keep this; and CUT, these words. End"
    assert decontaminate.cut_words(text, [(3, 6)]) == "Keep this; and . End"


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    docs = with_odd_columns(frame(spark, rows))
    wanted = [(d, n, c) for d, n, c, _ in minhash.brute_force(rows)]
    for plan in (minhash.Plan(), minhash.Plan(group=4, rounds=0)):
        # small groups and no thinning send buckets through further keys and blocks
        got = minhash.near_duplicates(docs, plan=plan)
        assert result(got, "id", "n_shingles", "component") == sorted(wanted, key=repr)
    odd = frame(spark, [(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (1, "x y z u v w"), (0, "x y z u v w")])
    assert result(minhash.near_duplicates(odd), "id", "component") == sorted([(None, None), (None, None), (1, 0), (1, 0), (0, 0)], key=repr)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_a_large_component_meets_few_others_in_blocks(spark, monkeypatch):
    """Near copies that fill buckets beyond a group, and a few texts that share keys with them: some linked by one pair only."""
    rng = random.Random(11)
    words = [f"v{i}" for i in range(120)]

    def changed(some, n):
        some = list(some)
        for i in rng.sample(range(len(some)), n):
            some[i] = f"z{rng.random()}"
        return some

    rows = [(i, " ".join(changed(words, 2))) for i in range(60)]
    rows += [(100 + i, " ".join(words[:60] + [f"u{i}x{j}" for j in range(60)])) for i in range(2)]
    rows += [(200, " ".join(changed(rows[7][1].split(), 3)))]
    wanted = [(d, n, c) for d, n, c, _ in minhash.brute_force(rows)]
    assert len({c for _, _, c in wanted}) > 1

    def unused(rows, plan, level):
        raise AssertionError("a bucket of one component and a few others was cut by further symbols")

    monkeypatch.setattr(minhash, "further_keys", unused)
    got = minhash.near_duplicates(frame(spark, rows), plan=minhash.Plan(group=16))
    assert result(got, "id", "n_shingles", "component") == sorted(wanted, key=repr)


def test_many_small_groups_and_large_ones_are_compared_a_batch_at_a_time():
    """Pairs of groups against brute force, and no output batch per group."""
    import pyarrow as pa

    plan, rng = minhash.Plan(), np.random.default_rng(4)
    rows = []
    for key, size in enumerate([2] * 1500 + [1, 3, 64, 65, 200, 1, 130]):
        base, two = rng.integers(0, 1 << 16, plan.symbols, np.uint16), size == 130
        for _ in range(size):
            marks = base.copy()
            marks[rng.permutation(plan.symbols)[: rng.integers(0, 26)]] ^= 1
            block = int(rng.integers(0, 2)) if two else 0
            # sets of which about half or most is shared
            shingles = np.unique(rng.choice(16 if key % 2 else 40, 13)).astype(np.uint64) << np.uint64(40)
            rows.append((key, 0, int(two), len(rows), int(rng.integers(0, 9)), 20, block, len(shingles), marks.tobytes(), shingles.tobytes()))
    names = ["key", "low", "high", "node", "component", "choice", "block", "n", "signature", "shingles"]
    table = pa.table({c: pa.array(x, pa.binary() if c in names[8:] else pa.int64()) for c, x in zip(names, zip(*rows, strict=True), strict=True)})
    met, links, best = set(), set(), {}
    for _, group in itertools.groupby(rows, key=lambda r: r[:3]):
        for x, y in itertools.combinations(group, 2):
            if x[4] == y[4] or 100 * min(x[7], y[7]) < plan.percent * max(x[7], y[7]) or (x[2] and x[6] == y[6]):
                continue
            same = np.frombuffer(x[8], np.uint16) == np.frombuffer(y[8], np.uint16)
            apart = int((~same).sum())
            for one, other in ((x, y), (y, x)):
                if apart <= plan.likely:
                    best[one[3]] = min(best.get(one[3], (99, 0)), (apart, other[3]))
            if apart <= plan.radius and not any(same[kept].all() for kept in plan.choices()[:20]):
                met |= {x[3], y[3]}
                a, b = (set(np.frombuffer(r[9], np.uint64).tolist()) for r in (x, y))
                if 100 * len(a & b) >= plan.percent * len(a | b):
                    links.add((x[3], y[3]))
    assert met and links and best
    batches = table.to_batches(max_chunksize=500)
    active = list(minhash._active(plan)(iter(batches)))
    assert {n for b in active for n in b["node"].to_pylist()} == met
    assert len(active) <= len(batches) + 1
    rows_of = lambda found: {(r["a"], r["b"]) for b in found for r in b.to_pylist()}
    assert rows_of(minhash._links(plan)(iter(batches))) == links
    nearest = list(minhash._nearest(plan)(iter(batches)))
    assert rows_of(nearest) == {(min(n, m), max(n, m)) for n, (_, m) in best.items()}
    assert len(nearest) <= len(batches) + 1


def test_tables_of_links_are_written_by_a_few_tasks_per_core(spark, monkeypatch):
    from pathlib import Path

    from weftmart import session
    from weftmart.llm.common import components

    paths, path_of = [], session.scratch_path

    def noted(*args):
        paths.append(path_of(*args))
        return paths[-1]

    monkeypatch.setattr(session, "scratch_path", noted)
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        # chains of four, whose ends meet in several steps
        edges = spark.range(2000).where("id % 4 > 0").selectExpr("id AS a", "id - 1 AS b")
        assert result(components(edges), "id", "component") == sorted(((i, i - i % 4) for i in range(2000)), key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = [len(list(Path(p.removeprefix("file://")).glob("*.parquet"))) for p in paths]
    assert len(files) > 1 and max(files) <= max(24, 4 * spark.sparkContext.defaultParallelism) < 60


def test_every_pair_within_the_radius_shares_a_key():
    plan, rng = minhash.Plan(), np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, plan.symbols)
        b = a.copy()
        b[rng.permutation(plan.symbols)[: plan.radius]] ^= 1
        assert any((a[k] == b[k]).all() for k in plan.choices())


def test_repeated_bytes_equal_brute_force(spark, monkeypatch):
    rows = [*corpus(), (400, None), (None, corpus()[0][1]), (401, "ab" * 300), (402, "ab" * 200 + "\0" * 60), (403, "\0" * 80)]
    docs = with_odd_columns(frame(spark, rows))
    wanted = sorted([(d, n, r, s) for d, n, r, s, _ in suffix_dedup.brute_force(rows)], key=repr)
    for size in (suffix_dedup.SHARD_BYTES, 500):
        # small shards are merged by binary search
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", size)
        got = suffix_dedup.without_repeats(docs)
        assert result(got, "id", "n_bytes", "n_removed", "n_spans") == wanted
    assert suffix_dedup.without_repeats(docs.limit(0)).count() == 0


def test_no_task_holds_a_hot_anchor(spark, monkeypatch):
    """A passage in many documents, or often in a few, with different text at its edges."""
    from pyspark.sql import functions as F

    rng = random.Random(6)
    edge = lambda: "".join(rng.choice("abcdefgh") for _ in range(60))
    passage = sentence(rng, 60)
    rows = [(i, edge() + passage + edge()) for i in range(60)]
    rows += [(100 + i, edge() + "".join(passage[:90] + edge() for _ in range(60))) for i in range(2)]
    rows += [(200, passage), (201, edge() + rows[3][1][20:] + edge()), *((1000 + d, t) for d, t in corpus())]
    wanted = sorted([(d, n, r, s) for d, n, r, s, _ in suffix_dedup.brute_force(rows)], key=repr)
    held, whole = [], suffix_dedup.covered

    def watched(around, length):
        held.append(around.groupBy("gram").agg(F.sum(F.size("ids")).alias("n")).agg(F.max("n")).first()[0])
        return whole(around, length)

    monkeypatch.setattr(suffix_dedup, "covered", watched)
    for hot in (5, 0):
        monkeypatch.setattr(suffix_dedup, "HOT", hot, raising=False)
        got = suffix_dedup.without_repeats(frame(spark, rows))
        assert result(got, "id", "n_bytes", "n_removed", "n_spans") == wanted
        assert (held.pop() or 0) <= hot * 8


def test_only_surroundings_with_an_equal_half_beside_them_are_sent(spark, monkeypatch):
    """Grams shared by many documents without a longer string, passages just long enough, and too many documents to broadcast."""
    from pathlib import Path

    from weftmart import session

    rng = random.Random(13)
    edge = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    grams = [edge(20) for _ in range(4)]
    rows = [(i, "".join(edge(40) + rng.choice(grams) for _ in range(6)) + edge(40)) for i in range(80)]
    held = [edge(50), edge(51), edge(90)]
    rows += [(100 + i, edge(60) + held[i % 3] + edge(60)) for i in range(12)]
    rows += [(200, held[0]), (201, held[0]), (202, rows[0][1]), (None, rows[0][1]), (203, held[2][:49]), (204, None), (205, held[1])]
    wanted = sorted([(d, n, r, s) for d, n, r, s, _ in suffix_dedup.brute_force(rows)], key=repr)
    sent, whole = [], suffix_dedup.covered
    paths, path_of = [], session.scratch_path

    def watched(around, length):
        sent.append({i for r in around.select("ids").collect() for i in r.ids})
        return whole(around, length)

    def noted(*args):
        paths.append(path_of(*args))
        return paths[-1]

    monkeypatch.setattr(suffix_dedup, "covered", watched)
    monkeypatch.setattr(session, "scratch_path", noted)
    for bound in (suffix_dedup.BROADCAST_IDS, 0):
        monkeypatch.setattr(suffix_dedup, "BROADCAST_IDS", bound)
        got = suffix_dedup.without_repeats(frame(spark, rows))
        assert result(got, "id", "n_bytes", "n_removed", "n_spans") == wanted
        # documents that share a gram only
        assert sent.pop() <= {d for d, _ in rows if d is not None and d >= 100} | {0}
    # tables of steps that are done are gone
    left = [p for p in paths if Path(p.removeprefix("file://")).exists()]
    assert len(left) <= 4 < len(paths)


def test_lonely_surroundings_share_no_string():
    """Surroundings of one anchor and of others, most of which share less than a string with any other of their anchor."""
    import pyarrow as pa

    rng = random.Random(9)
    some = lambda n: bytes(rng.choice(b"ab") for _ in range(n))
    sides = [(some(34), some(34)) for _ in range(12)]
    texts, grams, at = [], [], []
    for i in range(300):
        gram = i % 3
        left, right = rng.choice(sides)[0][-rng.randint(1, 34) :], rng.choice(sides)[1][: rng.randint(1, 34)]
        if rng.random() < 0.5:
            left, right = some(17) + left[-17:], right[:17] + some(17)
        text = left + bytes([65 + gram]) * suffix_dedup.GRAM + right
        if len(text) >= 50:
            texts.append(text)
            grams.append(gram)
            at.append(len(left))
    single = suffix_dedup.lonely(np.array(grams, np.int64), pa.array(texts, pa.binary()), np.array(at, np.int32), 50)
    strings = [{t[i : i + 50] for i in range(len(t) - 49)} for t in texts]
    shares = [any(g == h and i != j and a & b for j, (h, b) in enumerate(zip(grams, strings))) for i, (g, a) in enumerate(zip(grams, strings))]
    assert not any(s and alone for s, alone in zip(shares, single))
    assert 0 < single.sum() < len(single)


def test_hot_occurrences_of_a_document_are_joined(spark, monkeypatch):
    rng = random.Random(10)
    edge = lambda: "".join(rng.choice("abcdefgh") for _ in range(60))
    passage = sentence(rng, 150)
    rows = [(i, edge() + passage + edge()) for i in range(30)]
    wanted = sorted([(d, n, r, s) for d, n, r, s, _ in suffix_dedup.brute_force(rows)], key=repr)
    found, whole = [], suffix_dedup.covered_hot

    def watched(around, length):
        ranges = whole(around, length)
        found.append(ranges.count())
        return ranges

    monkeypatch.setattr(suffix_dedup, "HOT", 5)
    monkeypatch.setattr(suffix_dedup, "covered_hot", watched)
    for bound in (suffix_dedup.BROADCAST_STRINGS, 0):
        monkeypatch.setattr(suffix_dedup, "BROADCAST_STRINGS", bound)
        assert result(suffix_dedup.without_repeats(frame(spark, rows)), "id", "n_bytes", "n_removed", "n_spans") == wanted
    assert found[0] == 29


def test_suffix_arrays_are_sorted():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 90))) for _ in range(40)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    data = np.frombuffer(b"".join(texts), np.uint8)
    rest = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(data))
    order = suffix_dedup.suffix_array(data, rest)
    suffixes = [data[i : i + rest[i]].tobytes() for i in order]
    assert suffixes == sorted(suffixes)
    shared = suffix_dedup.common_prefixes(data, bounds, rest, order, 50)
    for k in range(1, len(order)):
        a, b = suffixes[k - 1], suffixes[k]
        common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == min(common, 50)


def test_cut_and_owners_equal_plain_loops():
    """Ranges that touch, overlap, and end where the next text begins; empty texts between the others; a null list."""
    import pyarrow as pa

    texts = ["", "abcdefghij" * 8, "", "0123456789" * 7, "xy" * 30, ""]
    ranges = [None, [(0, 50), (50, 60), (10, 55), (70, 80)], [], [(0, 70)], [(0, 50), (55, 60)], []]
    wanted = []
    for doc, (text, some) in enumerate(zip(texts, ranges)):
        gone = [any(a <= i < b for a, b in some or ()) for i in range(len(text))]
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        wanted.append((doc, len(text), sum(gone), spans, "".join(c for c, g in zip(text, gone) if not g).encode()))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    lists = pa.array([x and [{"start": a, "stop": b} for a, b in x] for x in ranges], kind)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), lists], ["id", "text", "ranges"])
    for some in ([batch], [batch.slice(0, 3), batch.slice(3)]):
        got = [tuple(r.values()) for b in suffix_dedup._cut(iter(some)) for r in b.to_pylist()]
        assert got == wanted
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    with np.errstate(over="ignore"):
        _, first, last, owner, place = suffix_dedup.anchors_of(data, bounds, 50)
    starts = [p for a, b in zip(first, last) for p in range(a, b + 1)]
    assert starts == [p for a, b in zip(bounds, bounds[1:]) for p in range(a, b - 49)]
    assert all(bounds[o] <= a <= b <= bounds[o + 1] - 50 and a <= p <= a + 34 for a, b, o, p in zip(first, last, owner, place))


def test_fingerprints(spark):
    rows = [(d, t) for d, t in corpus() if d != 303] + [(7, corpus()[7][1]), (None, "w1 w2 w3")]
    found = imatch.fingerprints(frame(spark, rows, "id long, text string")).collect()
    assert len(found) == len(rows)
    by_text = {}
    texts = {}
    for d, t in rows:
        texts.setdefault(d, t or "")
    for r in found:
        by_text.setdefault(texts[r.id], set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(v) == 1 for v in by_text.values())
    alone = imatch.fingerprints(frame(spark, [(1, "ab cd")], "id long, text string")).first()
    assert (alone.n_chars, alone.near_next) == (5, 1.0)
    assert imatch.fingerprints(frame(spark, [], "id long, text string")).count() == 0


def test_fingerprints_equal_brute_force(spark, monkeypatch):
    """Over a band of more than 32,768 terms, none of which may be left out, with a broadcast lexicon and by shuffle."""
    from pyspark.sql import functions as F

    rng = random.Random(8)
    words = [f"t{i}" for i in range(40_000)] * 2
    rng.shuffle(words)
    rows = [(i, " ".join(["the", "of", *words[i * 800 : (i + 1) * 800], f"only{i}"])) for i in range(100)]
    rows += [(200 + i, " ".join(rows[i][1].split()[:-i])) for i in range(1, 5)]
    rows += [(300, "the of t5"), (301, "the t7 t9 t39999"), (302, "the t7 t9 t39998"), (303, ""), (304, "the of")]
    rows.sort(reverse=True)
    own = [set(t.split()) for _, t in rows]
    edited = [t[: len(t) - len(t) // 2] + rows[(i + 1) % len(rows)][1][: len(t) // 2] for i, (_, t) in enumerate(rows)]
    counts = Counter(t for some in own for t in some)
    band = {t for t, n in counts.items() if n >= 2 and 3 <= math.log(len(rows) / n) <= 12}
    assert len(band) > 32_768
    masks = {r.term: r.mask for r in frame(spark, [(t,) for t in band], "term string").select("term", imatch.mask(F.col("term"))).collect()}

    def subsets(some):
        kept = sorted(some & band)
        if len(kept) < 3:
            return [" ".join(sorted(some)) or None] * imatch.SUBSETS
        return [" ".join(t for t in kept if masks[t] >> j & 1) or None for j in range(imatch.SUBSETS)]

    def likeness(a, b):
        either = sum(x is not None or y is not None for x, y in zip(a, b))
        return 1.0 if a == b else sum(x is not None and x == y for x, y in zip(a, b)) / either if either else 0.0

    first, second = [subsets(s) for s in own], [subsets(set(e.split())) for e in edited]
    near = {d: (likeness(first[i], second[i]), likeness(first[i], first[(i + 1) % len(rows)])) for i, (d, _) in enumerate(rows)}
    hashed = frame(spark, [(d, a, b) for (d, _), a, b in zip(rows, first, second)], "id long, a array<string>, b array<string>")
    hexed = "array_join(transform({}, s -> if(s is null, '-', lower(hex(xxhash64(s))))), ':')"
    wanted = sorted((r.id, r.a, r.b, *near[r.id]) for r in hashed.select("id", *[F.expr(hexed.format(c)).alias(c) for c in "ab"]).collect())
    docs = frame(spark, rows, "id long, text string")
    for bound in (imatch.BROADCAST_BYTES, 10_000, 0):
        monkeypatch.setattr(imatch, "BROADCAST_BYTES", bound)
        assert result(imatch.fingerprints(docs), "id", "fingerprint", "edited_fingerprint", "near_edited", "near_next") == sorted(wanted, key=repr)


def test_fingerprints_in_waves(spark, monkeypatch):
    """Terms travel in waves of buckets: repeated rows, a null id and the wrap from last to first give the same in any of them."""
    rng = random.Random(3)
    rows = [(i // 2, sentence(rng, rng.randint(0, 60))) for i in range(120)] + [(7, "one two three")] * 5 + [(None, "w1 w2 w3"), (None, None)]
    docs = frame(spark, rows, "id long, text string")
    band = imatch.Lexicon(idf_low=0.5, least_documents=2)
    whole = result(imatch.fingerprints(docs, band), "id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    written = []
    write = imatch.write_table

    def counting(df, path, **more):
        made = write(df, path, **more)
        written.append(made.count() if more else 0)
        return made

    monkeypatch.setattr(imatch, "write_table", counting)
    monkeypatch.setattr(imatch, "BUCKET", 8)
    monkeypatch.setattr(imatch, "WAVE", 3)
    for bound in (imatch.BROADCAST_BYTES, 0):
        written.clear()
        monkeypatch.setattr(imatch, "BROADCAST_BYTES", bound)
        assert result(imatch.fingerprints(docs, band), "id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next") == whole
        waves = np.diff([n for n in written if n], prepend=0)
        assert len(waves) >= 4 and max(waves) < len(rows) / 2


def test_budget_fits_as_exactly_as_sizes_allow():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = np.unique(rng.integers(1, 40, 6))
        counts = rng.integers(1, 5, len(sizes))
        budget = int(rng.integers(0, (sizes * counts).sum() + 1))
        take = mixing.fit_budget(sizes, counts, budget)
        assert ((0 <= take) & (take <= counts)).all()
        sums = {0}
        for s, c in zip(sizes, counts, strict=True):
            sums = {t + int(s) * k for t in sums for k in range(int(c) + 1)}
        # the share that every size gives first may cost a word or two
        assert abs(int((take * sizes).sum()) - budget) <= min(abs(t - budget) for t in sums) + int(sizes.min())


def test_mix(spark):
    rng = random.Random(1)
    names = ["a", "b", "c", "d", None, "e"]
    rows = [(i, names[min(5, int(rng.random() * 9))], sentence(rng, rng.randint(0, 30)) if i % 9 else None) for i in range(400)]
    docs = frame(spark, [(d, t, s) for d, s, t in rows], "doc_id long, text string, source string")
    once, again = (result(mixing.mix(docs), "id", "source", "size", "target", "copies") for _ in range(2))
    assert once == again
    sizes = {}
    for _, s, n, _, _ in once:
        sizes[s] = sizes.get(s, 0) + n
    wanted, taken = mixing.brute_targets(sizes), {}
    for _, s, n, target, copies in once:
        assert target == pytest.approx(wanted[s]) and 0 <= copies <= 3
        taken[s] = taken.get(s, 0) + n * copies
    assert all(abs(taken[s] - wanted[s]) <= 1 for s in sizes)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.apply_mix(docs).count() == sum(r[4] for r in once)
    # columns that have the names the operator uses are kept
    odd = with_odd_columns(docs).selectExpr("*", "doc_id AS Copy", "text AS copies", "1 AS __row", "2 AS __COPIES")
    mixed = mixing.apply_mix(odd)
    assert mixed.columns == [*odd.columns, "copy_"]
    assert sum(r.copy_ == 1 for r in mixed.collect()) == sum(r[4] > 0 for r in once)


def test_role_repair_has_least_cost():
    for n in range(4):
        for roles in itertools.product(["system", "user", "assistant", None], repeat=n):
            reach = chat.matrix(list(roles), chat.Costs())[0]
            least = min(reach[s] + chat._finish(s, chat.Costs()) for s in range(4))
            assert least == pytest.approx(chat.brute_cost(list(roles)))


def test_chats_in_chunks(spark):
    rng = random.Random(3)
    rows = [(k, i, rng.choice(["system", "user", "assistant", None, "tool"]), f"t{i}") for k in (1, 2, None) for i in range(37)]
    rows += [(5, None, "user", None), (6, 1, "user", "x"), (6, 1, "user", "x")]
    turns = frame(spark, rows, "conv_id long, turn long, role string, text string")
    text = []
    for chunk in (1000, 6):
        pieces = chat.format_chats(turns, chunk=chunk).orderBy("conv_id", "position", "part").collect()
        cost = {}
        for r in pieces:
            known = 0 if "relabel" not in r.action else 2 if r.role in chat.ROLES else 1
            cost[r.conv_id] = cost.get(r.conv_id, 0) + known + ("merge" in r.action) + 3 * (r.action == "insert")
        labels = {}
        for r in pieces:
            labels.setdefault(r.conv_id, {}).setdefault(r.out_turn, set()).add(r.new_role)
        for turns_of in labels.values():
            order = [*itertools.chain(*(turns_of[k] for k in sorted(turns_of)))]
            assert len(order) == len(turns_of) and order[-1] != "system"
            assert all(b == ("assistant" if a == "user" else "user") for a, b in zip(order, order[1:]))
        text.append((cost, {r.conv_id for r in pieces}))
    assert text[0] == text[1]


def test_patterns_equal_plain_ones():
    rng = random.Random(1)
    parts = ["a", "@", ".", "1", "5", "25", "+", " ", "-", "(", ")", "1.2", "@a.b", "+1 ", "4111111111111111", "\n", "é"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 18)))
        base = pii.patterns(text)
        counts = tuple(sum(s[0] == k for s in base) for k in pii.KINDS)
        assert counts == pii.brute_base(text)[:4], text
        assert pii.written(base) == pii.written(sorted(base, key=lambda s: (pii.KINDS.index(s[0]), s[1])))


def test_field_learns_its_table_and_adds_spans(spark):
    field = pii.Field()
    for line in pii.LABELLED.strip().split("\n"):
        tokens = pii.parse(line)
        assert [pii.TAGS[t] for t in field.decode([[w for w, _ in tokens]])[0]] == [g for _, g in tokens]
    text = "Call (555) 123-9876 or a.b@c.example.org. Version 2.0."
    base, spans = pii.find([text], field)[0]
    assert [s[0] for s in base] == ["email"] and ("phone", 5, 19) in spans
    assert pii.mask(text, spans) == "Call [PHONE] or [EMAIL]. Version 2.0."
    docs = frame(spark, [(1, text), (2, None), (3, ""), (None, "x@y.zz")])
    assert [r.n_email for r in pii.spans_of(docs).orderBy("id").collect()] == [1, 1, 0, 0]


def test_field_path_is_the_best_one():
    field = pii.Field()
    tokens = ["call", "555", "010-7788", "@x"]
    scores = [field.weights[row].sum(0) for row in field._rows(tokens)]
    scores[0][1:] -= 1e6

    def total(path):
        value = scores[0][path[0]] - (1e6 if path[0] and path[0] % 2 == 0 else 0)
        return value + sum(field.moves[a, b] + scores[i + 1][b] for i, (a, b) in enumerate(zip(path, path[1:])))

    best = max(itertools.product(range(len(pii.TAGS)), repeat=4), key=total)
    assert tuple(field.decode([tokens])[0]) == best


def test_main_text(spark):
    tree = pages.train()
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=/>Home</a></nav>
        <div class="cookie-notice">We use cookies</div><main><article><h1>Big &amp; small</h1><p>First  line<br>second<p>Third
        <a href=x>link</a>.<script>var a = "</p>";</script><aside>Buy</aside><div class=ad>Ad</div></article></main>
        <section id="comments"><p>Nice!</p></section><form>Name <input></form><footer>&copy; 2020</footer>"""
    assert pages.main_text(page, tree) == "Big & small First line second Third link."
    assert [pages.main_text(x, tree) for x in (None, "", "<p></p>")] == ["", "", ""]
    assert pages.main_text("just text", tree) == "just text"
    rows = frame(spark, [(1, "u", page), (None, None, None), (1, "u", page)], "page_id long, url string, html string")
    assert pages.extract(rows).count() == 3


def test_toxicity_by_clauses(spark):
    lexicon, machine = {"grumble": 3.0, "zorp*": 2.0}, toxicity.grammar()
    read = lambda t: dict(zip(toxicity.FEATURES, np.expm1(toxicity.matches(t, lexicon, machine, toxicity._function_words())), strict=True))
    assert read("a grumble zorpish")["plain"] == pytest.approx(5)
    assert read("you are a grumble")["aimed"] == pytest.approx(3)
    assert read("that is not grumble")["negated"] == pytest.approx(3)
    assert read("he said grumble. grumble")["reported"] == pytest.approx(3)
    assert read("you will die now")["threats"] == 1 and read("you will not die")["threats"] == 0
    rng = random.Random(2)
    rows = [(i, sentence(rng, 20) + (" zorp" + rng.choice("abc") if i % 4 == 0 else "")) for i in range(300)] + [(900, None), (901, "")]
    labels = frame(spark, [(i, int(i % 4 == 0)) for i in range(300)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    found = {r.id: r.score for r in toxicity.score(frame(spark, rows), labels).collect()}
    held = [r.id for r in frame(spark, rows).select("doc_id").withColumnRenamed("doc_id", "id").where(toxicity.held_out(_col("id"))).collect()]
    assert all((found[i] >= 0.5) == (i % 4 == 0) for i in held if i < 300) and found[900] == found[901] < 0.5
    assert toxicity.score(frame(spark, rows), labels.limit(0)).count() == len(rows)


def _col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_quality_by_two_views(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        text = sentence(rng, 40)
        rows.append((i, text.upper().replace(" ", "!! ") if i % 5 == 0 else text, "en", f"s{i % 3}", len(text)))
    rows += [(900, None, None, None, None), (901, "", "en", "s0", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = frame(spark, rows, schema)
    labels = frame(spark, [(i, int(i % 5 > 0)) for i in range(0, 300, 2)] + [(5, None), (None, 1)], "doc_id long, quality int")
    found = {r.id: r.score for r in cotrain.score(docs, labels).collect()}
    assert all((found[i] >= 0.5) == (i % 5 > 0) for i in range(300))
    assert set(found) == {r[0] for r in rows}
    kept = cotrain.accepted(with_odd_columns(docs), labels)
    assert {r.doc_id for r in kept.collect()} == {i for i, s in found.items() if s >= 0.5}
    assert cotrain.score(docs.limit(0), labels).count() == 0
    assert cotrain.score(docs, labels.limit(0)).count() == len(rows)


def test_quality_keeps_all_without_labels_of_both_kinds(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, 30), "en", "s0", 100) for i in range(20)]
    docs = frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long")
    for marks in ([], [(900, 1), (901, 0)], [(i, 0) for i in range(9)], [(i, 1) for i in range(9)]):
        labels = frame(spark, marks, "doc_id long, quality int")
        assert {r.score for r in cotrain.score(docs, labels).collect()} == {0.5}
        assert cotrain.accepted(docs, labels, least=0.7).count() == len(rows)
    # labels of both kinds of which the calibration's third would take all good ones
    views = cotrain.co_train((np.array([[0.0], [0.0], [9.0]] * 3),) * 2, np.array([0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (np.zeros((0, 1)),) * 2)
    assert views.informed


def test_content_reads_the_whole_text():
    plain = [f"w{i}" for i in range(80)]
    assert cotrain.content(" ".join([*plain, *["junk x"] * 20]))[17] == 20 / 120
    assert cotrain.content(" ".join([*plain, *["LOUD"] * 5]))[12] == 5 / 40
    assert cotrain.content("LOUD LOUD w")[12] == 2 / 3
    assert cotrain.content(" \n")[12:16] == [0.0] * 4


def two_views(rng, n):
    """Views that are independent given the class; each tells the classes apart, the labelled few do not show how well."""
    marks = rng.integers(0, 2, n).astype(float)
    a = rng.normal(0, 1, (n, 12)) + (marks[:, None] * 2 - 1) * 0.5
    b = rng.normal(0, 1, (n, 12)) + (marks[:, None] * 2 - 1) * 0.5
    return (a, b), marks


def test_rounds_raise_accuracy():
    rng = np.random.default_rng(4)
    gains = []
    for _ in range(5):
        labelled, marks = two_views(rng, 12)
        pool, _ = two_views(rng, 5000)
        fresh, truth = two_views(rng, 5000)
        right = [np.mean((cotrain.co_train(labelled, marks, pool, rounds)(*fresh)[0] >= 0.5) == truth) for rounds in (0, 4)]
        gains.append(right[1] - right[0])
    assert min(gains) > 0.02


def test_cuts_take_whole_bins():
    counts = np.zeros(cotrain.BINS)
    counts[-1], counts[-2], counts[cotrain.BINS // 2], counts[0] = 3, 2, 995, 100
    # a tenth of 1100 rows, half of each kind; the outermost bin counts whole even where it holds more
    assert cotrain._cuts(counts, 0.5) == (max(cotrain._SURE_BIN, cotrain.BINS // 2 + 1), 0)
    counts[-1], counts[-2] = 30, 40
    assert cotrain._cuts(counts, 0.5)[0] == cotrain.BINS - 1
    good, bad = cotrain._cuts(np.zeros(cotrain.BINS), 0.5)
    assert good > bad


def test_unlabelled_rows_of_all_tasks_take_part(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    used = cotrain.label_sample(labels, "quality", 60)
    table = cotrain._view_table(docs.unionByName(docs.limit(1)).repartition(7), used, cotrain.NAMES, whole=False)
    found = table.orderBy("id").toArrow()
    rows, marks = cotrain._matrix(found["features"].combine_chunks()), found["label"].to_pylist()
    free = rows[[m is None for m in marks]]
    halves = lambda x: (x[:, : cotrain._SPLIT], x[:, cotrain._SPLIT :])
    first = {i: (m, r) for i, m, r in zip(found["id"].to_pylist(), marks, rows, strict=True) if m is not None}
    known = np.array([r for _, r in first.values()]), np.array([m for m, _ in first.values()], float)
    plain = cotrain.co_train(halves(known[0]), known[1], halves(free))
    views = cotrain.learn(table)
    want = plain(*halves(rows))
    got = table.select("id", *[c.alias(f"c{i}") for i, c in enumerate(views.columns(table["features"]))]).orderBy("id").toArrow()
    for i in range(3):
        assert np.allclose(want[i], got[f"c{i}"].to_numpy(), atol=1e-5)


def test_very_long_and_clashing_rows_of_the_classifier(spark):
    from pyspark.sql import functions as F

    rows = [(i, "word " * (200_000 if i == 1 else 30) if i % 2 else "#$ @@ !! " * 30, None, None, None) for i in range(20)]
    docs = frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = docs.withColumns({c: F.lit("x") for c in ("id", "row", "features", "label", "__view_text")})
    labels = frame(spark, [(i, i % 2) for i in range(12)], "doc_id long, quality int")
    kept = cotrain.accepted(odd.unionByName(odd), labels)
    assert kept.columns == odd.columns
    # the long text is unlike all others; either answer about it is fine
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id != 1) == sorted([i for i in range(3, 20, 2)] * 2)
    assert cotrain.score(odd, labels).count() == 20
