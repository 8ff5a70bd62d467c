"""Spelling variants against a comparison of all words."""

from tests.llm.test_small import corpus, frame, result, with_odd_columns
from weftmart.llm import spelling
from weftmart.llm.queries import LLM_QUERIES

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def variants_of(word):
    return [word[:3] + word[4:], word[:2] + "q" + word[2:], word[:-1] + "z", word + "e"]


def rows():
    common = ["necessary", "Übergröße", "abcdefgh", "letters" * 8, "aaaaaaaa", "x" * 400]
    out = [*corpus(), (None, "Necessary necessary"), (None, None), (500, ""), (501, "a-b × ÷÷÷÷÷÷÷ " * 3)]
    for i, word in enumerate(common):
        out += [(1000 + 100 * i + j, f"{word} {word}, {word.upper()}.") for j in range(40)]
        for k, other in enumerate(variants_of(word)):
            out += [(5000 + 100 * i + 10 * k + j, f"{other}; {other[:-1]}y {variants_of(other)[k % 4]}") for j in range(2 + k)]
    # ties, and chains of forms
    out += [(9000 + j, "tiebreaka tiebreakb") for j in range(30)] + [(9100 + j, "tiebreakx") for j in range(2)]
    out += [(9200 + j, "chainword") for j in range(400)] + [(9700 + j, "chainwors") for j in range(30)] + [(9800, "chainwrs chainwrs")]
    return out + out[:5]


def test_variants_equal_brute_force(spark, monkeypatch):
    wanted = sorted(spelling.brute_force(rows()), key=repr)
    assert any(r[1] and r[1] != r[2] for r in wanted) and any(len(r[0]) > spelling.CARRIED and r[4] for r in wanted)
    docs = with_odd_columns(frame(spark, rows()))
    for carried, counted in ((spelling.CARRIED, spelling.COUNTED), (9, 50)):
        # words beyond the length that is carried meet by their hashes
        monkeypatch.setattr(spelling, "CARRIED", carried)
        monkeypatch.setattr(spelling, "COUNTED", counted)
        assert result(spelling.variants(docs), *COLUMNS) == wanted
    assert spelling.variants(docs.limit(0)).count() == 0


def test_every_edit_is_generated_from_one_side():
    import itertools

    import numpy as np

    words = ["".join(w) for n in (2, 3, 4) for w in itertools.product("abc", repeat=n)]
    symbol = lambda w: np.array([["abc".index(c) + 1 for c in w]])
    keys = {w: spelling.reduced_keys(symbol(w)) for w in words}
    for u, v in itertools.combinations(words, 2):
        near = (len(u) == len(v) and sum(a != b for a, b in zip(u, v)) == 1) or any(max(u, v, key=len)[:i] + max(u, v, key=len)[i + 1 :] == min(u, v, key=len) for i in range(4) if abs(len(u) - len(v)) == 1)
        met = (keys[u][2] == keys[v][0][0]).sum() + (keys[v][2] == keys[u][0][0]).sum()
        assert met == near


def test_op13(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert result(LLM_QUERIES["op13_spelling"](spark, folder), *COLUMNS) == sorted(spelling.brute_force(texts), key=repr)
