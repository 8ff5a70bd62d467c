"""The registered queries of this folder over the small tables, and the pipeline's stages."""

import hashlib

import pytest

import corpus_pipeline
from weftmart.llm import decontaminate, minhash, mixing, pii, suffix_dedup
from weftmart.llm.queries import LLM_QUERIES
from weftmart.session import configure, materialise


@pytest.fixture(scope="module")
def texts(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def got(spark, folder, name, *columns):
    return sorted(map(tuple, LLM_QUERIES[name](spark, folder).select(*columns).collect()))


def test_registered(spark):
    assert [sum(n.startswith(f"op{i}_") for n in LLM_QUERIES) for i in range(1, 14)] == [1] * 13


def test_op1(spark, folder, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    wanted = sorted(decontaminate.brute_force(texts, items))
    assert got(spark, folder, "op1_decontaminate", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == wanted


def test_op6(spark, folder, texts):
    assert got(spark, folder, "op6_minhash", "doc_id", "n_shingles", "component_id", "kept") == sorted(minhash.brute_force(texts))


def test_op7(spark, folder, texts):
    wanted = sorted((d, *pii.brute_base(t)) for d, t in texts)
    assert got(spark, folder, "op7_pii", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == wanted


def test_op9(spark, folder, texts):
    wanted = sorted(suffix_dedup.brute_force(texts))
    assert got(spark, folder, "op9_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == wanted


def test_op10(spark, folder, texts):
    rows = sorted(texts, reverse=True)
    wanted = []
    for i, (doc, text) in enumerate(rows):
        half = len(text) // 2
        edited = text[: len(text) - half] + rows[(i + 1) % len(rows)][1][:half]
        wanted.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert got(spark, folder, "op10_imatch", "doc_id", "n_chars", "edited_sha256") == sorted(wanted)


def test_op3(spark, folder):
    rows = LLM_QUERIES["op3_mixing"](spark, folder).collect()
    by_target = {}
    for r in rows:
        assert r.taken % max(r["size"], 1) == 0 and r.taken <= 3 * r["size"]
        key = (r.source_size, r.target)
        by_target[key] = by_target.get(key, 0) + r.taken
    assert sum(t for _, t in by_target) == pytest.approx(sum(r["size"] for r in rows))
    assert all(abs(taken - target) <= 60 for (_, target), taken in by_target.items())


@pytest.mark.parametrize("name", ["op2_toxicity", "op4_chat", "op5_cotraining", "op8_page_text"])
def test_whole_tables(spark, folder, name):
    table = {"op4_chat": "conversations", "op8_page_text": "pages"}.get(name, "documents")
    assert LLM_QUERIES[name](spark, folder).count() >= spark.read.parquet(f"{folder}/{table}.parquet").count()


def test_pipeline_stages(spark, folder):
    """Each stage on its own input against a brute-force version."""
    configure(spark)
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = materialise(stages["quality"](spark, docs, folder), "t")
    left = {r.doc_id: r.text for r in kept.collect()}
    wrong = [d for d, q in labels.items() if (d in left) != (q == 1)]
    assert len(wrong) <= 0.1 * len(labels) and kept.columns == docs.columns

    unique = materialise(stages["near_duplicates"](spark, kept, folder), "t")
    groups = {d: c for d, _, c, _ in minhash.brute_force(sorted(left.items()))}
    assert sorted(r.doc_id for r in unique.collect()) == sorted(set(groups.values()))

    clean = materialise(stages["decontaminate"](spark, unique, folder), "t")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    marks = decontaminate.brute_force([(r.doc_id, r.text) for r in unique.collect()], items)
    assert {r.doc_id for r in clean.collect()} == {m[0] for m in marks if not m[5]}

    safe = materialise(stages["personal_data"](spark, clean, folder), "t")
    assert all(not pii.patterns(r.text) and r.n_chars == len(r.text) for r in safe.collect() if r.doc_id in left)

    mixed = stages["mix"](spark, safe, folder).collect()
    copies = {}
    for r in mixed:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    wanted = {r.id: r.copies for r in mixing.mix(safe).collect() if r.copies}
    assert copies == wanted


def test_pipeline_stages_take_odd_tables(spark, folder):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (None, None, None, None, None), (2, "", None, "s", 0), (3, "A B c d e f", "en", None, 11)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES[1:]:
            docs = materialise(stage(spark, docs, folder), "odd")
            if name == "near_duplicates":
                assert sorted([r.doc_id for r in docs.collect()], key=str) in ([1, 2, None], [])


def test_all_pipeline_stages_take_odd_tables(spark, folder):
    """The quality stage too, whose labels name none of these documents."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(-1, "a b c d e f", "en", "s", 11), (-1, "a b c d e f", "en", "s", 11), (None, None, None, None, None), (-2, "", None, "s", 0)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        size = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, folder), "odd")
            if name == "quality":
                assert docs.count() == size
            if name == "near_duplicates":
                assert sorted([r.doc_id for r in docs.collect()], key=str) in ([-1, -2, None], [])


def test_repeated_ids_lose_no_text(spark, folder):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    one, other = "a clean text of quite some words", "nothing here is like what stands in that one"
    rows = [(1, one, "en", "s", 32), (1, other, "en", "s", 44), (1, other, "de", "s", 44), (2, "b", "en", "s", 1)]
    kept = corpus_pipeline.near_duplicates(configure(spark), spark.createDataFrame(rows, schema), folder)
    assert sorted(map(tuple, kept.collect())) == sorted([rows[0], rows[2], rows[3]])
