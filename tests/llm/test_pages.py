"""The page parser on malformed pages."""

import time

import pytest

from weftmart.llm.pages import blocks_of, op8_page_text

MALFORMED = [
    "<b " * 300_000, "<div>" * 150_000 + "</p>" * 150_000, "<b><div>" + "<i>" * 150_000 + "</b>" * 150_000, "<i>" * 150_000 + "<div/>" * 150_000,
    '<b "' * 200_001, "<div>" * 20_000 + "<b " * 200_000, "<p>" * 300_000, "<b><i>" * 100_000 + "</b>" * 100_000, "<" * 500_000,
]


@pytest.mark.parametrize("page", MALFORMED, ids=range(len(MALFORMED)))
def test_malformed_pages_take_linear_time(page):
    began = time.process_time()
    blocks_of(page)
    assert time.process_time() - began < 25


@pytest.mark.parametrize(
    "page",
    [
        '<body class="page-with-sidebar"><article><p>{}</p></article></body>',
        '<body class="home legal"><main>{}</main></body>',
        '<div class="content-header-wrap comments-open share"><article><p>{}</p></article></div>',
        "<p>a <b title='x < y'>{}</b></p>",
    ],
)
def test_class_words_around_the_article_say_nothing_of_it(page):
    text = "Some words of the text stand here, and a few more of them."
    (block,) = blocks_of(page.format(text))
    assert block[0].endswith(text) and not block[4]


def test_odd_tables(spark, tmp_path):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "x", "y"), (1, "u", "", "x", "y"), (None, None, "<div>" * 3000 + "plain words", "x", "y")]
    for some in (rows, []):
        path = f"{tmp_path}/{len(some)}"
        spark.createDataFrame(some, schema).write.parquet(f"{path}/pages.parquet")
        got = op8_page_text(spark, path)
        assert sorted((str(r.page_id), r.n_chars == len(r.text)) for r in got.collect()) == sorted((str(r[0]), True) for r in some)
