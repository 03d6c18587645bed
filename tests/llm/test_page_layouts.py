"""Short and long articles in layouts of many kinds, against hand-written texts."""

import pytest

from hireflow.llm import page_model

PARAGRAPHS = [
    "The river rose slowly after the long rain.", "Nobody in the village had seen it that high before.",
    "They moved the animals to the hill and waited there.", "By morning the water had gone down again.",
    "Work on the bridge starts next week.", "It will take a month or two.",
]
MENU = '<nav><a href="/">Home</a> <a href="/b">News</a></nav>'
FOOT = "<footer><p>Copyright 2024 by the paper. All rights reserved.</p></footer>"
LAYOUTS = {
    "article": "<article>{}</article>",
    "main": "<main>{}</main>",
    "article named by its topic": '<article class="post category-research">{}</article>',
    "article named by a tag": '<article class="tag-football">{}</article>',
    "main that has a sidebar": '<main class="content with-sidebar">{}</main>',
    "id inside another word": '<div id="design">{}</div>',
    "class inside another word": '<div class="president">{}</div>',
    "wrapper that has a sidebar": '<div class="has-sidebar"><div class="content">{}</div></div>',
    "wrapper around a nameless one": '<div class="has-sidebar"><div>{}</div></div>',
    "nameless": "<div>{}</div>",
    "straight in the body": "{}",
    "section": "<section>{}</section>",
    "entry": '<div class="entry-content">{}</div>',
    "story": '<div class="story">{}</div>',
    "role": '<div role="main">{}</div>',
    "id": '<div id="content">{}</div>',
    "nested": '<div class="wrap"><div class="inner">{}</div></div>',
    "cell": "<table><tr><td>{}</td></tr></table>",
    "beside a sidebar": '<div class="sidebar"><p>Read more of this.</p></div><div class="post">{}</div>',
    "with comments": '<article>{}</article><div class="comments"><p>I saw it too. It was very high.</p></div>',
}


@pytest.fixture(scope="module")
def weights(spark):
    return page_model.trained(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def text(weights, body, names=""):
    page = f"<html><head><title>t</title></head><body{names}>{MENU}{body}{FOOT}</body></html>"
    return page_model.main_texts([page_model.page_of(page)], weights)[0]


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("n", [1, 2, 3, 6])
def test_layout(weights, layout, n):
    body = "".join(f"<p>{p}</p>" for p in PARAGRAPHS[:n])
    assert text(weights, LAYOUTS[layout].format(body)) == " ".join(PARAGRAPHS[:n])


def test_names_of_the_body(weights):
    body = f"<article><h1>High water</h1><p>{PARAGRAPHS[0]}</p></article>"
    assert text(weights, body, ' class="has-sidebar menu-open"') == f"High water {PARAGRAPHS[0]}"


def test_pages_without_text(weights):
    assert text(weights, "") == "" and page_model.main_texts([page_model.page_of("")], weights) == [""]


def test_whole_words_of_names():
    assert page_model.speaks("page-foot", page_model.AGAINST) and page_model.speaks("ad", page_model.AGAINST)
    for name in ("category-research", "football", "president", "design", "with-sidebar", "headland", ""):
        assert not page_model.speaks(name, page_model.AGAINST)


def test_sample_has_distinct_labelled_pages(spark):
    """Copies and pages without a landmark do not fill it, and null pages do no harm."""
    pages = [f"<article><p>Text number {i} of some length.</p></article>" for i in range(5)] * 50
    rows = [(h,) for h in [*pages, *["<div>plain</div>"] * 500, None, ""]]
    few = spark.createDataFrame(rows, "html string")
    one = page_model.trained(few)
    again = page_model.trained(few.distinct())
    assert (one.nodes == again.nodes).all() and (one.edges == again.edges).all()
    none = page_model.trained(few.where("html is null"))
    assert (none.nodes == page_model.prior().nodes).all()


def test_very_long_page(spark):
    body = "".join(f"<p>Sentence number {i} goes on for a while.</p>" for i in range(4000))
    rows = [(1, "u", f"<body>{MENU}<article>{body}</article>{FOOT}</body>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = page_model.extracted(df, ["page_id", "url"]).first()
    assert got.text == " ".join(f"Sentence number {i} goes on for a while." for i in range(4000))
    assert got.n_chars == len(got.text)
