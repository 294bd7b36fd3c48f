"""Operator 8 on forms of pages that the given tables do not have."""
import pytest

from touchline.llm import extraction

SMALL = "/root/testdata/sf0.001"
TITLE, FIRST, SECOND = "Of the old harbour", "The harbour was built over the course of many years by the town.", "Nobody knows who paid for the second pier, which is longer."
ARTICLE = f"<h1>{TITLE}</h1><p>{FIRST}</p><p>{SECOND}</p>"
WHOLE = f"{TITLE}\n\n{FIRST}\n\n{SECOND}"


@pytest.fixture(scope="module")
def chain(spark):
    return extraction.train(spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html"))


@pytest.mark.parametrize("page", [
    f'<body class="post right-sidebar"><article>{ARTICLE}</article></body>',
    f'<main class="has-header-image"><article>{ARTICLE}</article></main>',
    f'<body><article class="post comments-open" id="related-7">{ARTICLE}</article></body>',
    f'<html class="no-sidebar"><body id="search-page"><main role="main"><article>{ARTICLE}</article></main></body></html>',
    f'<article><h1>{TITLE}</h1><section id="form-of-government"><p>{FIRST}</p></section><p>{SECOND}</p></article>',
])
def test_class_words_of_the_whole_page_lose_no_article(chain, page):
    assert extraction_text(chain, page) == WHOLE


@pytest.mark.parametrize("around", [
    '<div class="site-sidebar"><p>{}</p></div>', '<div id="comments"><p>{}</p></div>', '<div class="entry related-posts"><p>{}</p></div>',
    '<div class="wp-block-sidebar"><p>{}</p></div>', '<div class="cookie-notice"><p>{}</p></div>'])
def test_class_words_of_parts_still_count(chain, around):
    page = f'<body class="post right-sidebar"><article>{ARTICLE}</article>{around.format("Read more of what we wrote about it.")}</body>'
    assert extraction_text(chain, page) == WHOLE


def extraction_text(chain, page):
    blocks = extraction.blocks(page)
    labels = chain.viterbi(extraction.page_features(blocks))
    return "\n\n".join(t for (t, _, _), y in zip(blocks, labels, strict=True) if y)


def test_around_reads_the_last_word_of_long_names():
    assert [extraction.around(n) for n in ("form-of-government", "has-header-image", "site-main-sidebar", "comments-open", "ad", "adult")] == [
        None, None, "sidebar", "comment", "ad", None]
