import time

import pytest

from terrace.llm import op10_wrappers as op10


@pytest.fixture(autouse=True)
def _deep():
    op10.deep()


def alone(html):
    """The text of a page that is its own wrapper."""
    return op10.extract(html, op10.decisions(op10.unpacked(op10.packed(op10.node_of(op10.parse(html))))))


@pytest.mark.parametrize("n", [3, 119, 121, 5000])
def test_article_at_any_depth(n):
    html = f"<body><div class=x><p>Latest news box</p></div>{'<div>' * n}<article><p>first text of it</p><p>second text of it</p></article>{'</div>' * n}<div class=y>Trailing box</div></body>"
    assert alone(html) == "first text of it\nsecond text of it"


def test_cards_and_comments_are_no_content(spark):
    page = (
        "<body><main><article><h1>Title {i}</h1><p>Long main text {i} of the page, which goes on and on here.</p></article>"
        '<section class="discussion"><article class="comment"><p>reader {i} says</p></article><article class="comment"><p>another {i}</p></article></section></main>'
        '<section class="more"><article class="card"><h3>Card {i}</h3><p>teaser {i}</p></article><article class="card"><h3>Other card {i}</h3><p>more {i}</p></article></section></body>'
    )
    rows = [(i, f"http://x.example/{i}", page.replace("{i}", f"n{i}")) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in op10.main_texts(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Title n{i}\nLong main text n{i} of the page, which goes on and on here." for i in range(12)}


def test_only_whole_names_tell_within_an_article():
    kept = '<div class="reply">a reply</div><section class="promotion">a promotion</section><div class="header-row">a row</div><div class="banner-image">caption</div>'
    gone = '<div class="ad-box">advert</div><div class="cookie-notice">cookies</div><div class="comments">comments</div><aside>aside</aside><ul class="nav-list"><li>menu</li></ul><p hidden>hidden</p>'
    assert alone(f"<body><article><p>text</p>{kept}{gone}</article></body>") == "text\na reply\na promotion\na row\ncaption"


def test_cards_are_content_where_no_article_stands_alone():
    html = "<body><main>" + "".join(f"<article><h2>Part {i}</h2><p>text {i}</p></article>" for i in range(3)) + "</main></body>"
    assert alone(html) == "\n".join(f"Part {i}\ntext {i}" for i in range(3))


@pytest.mark.parametrize(
    "html",
    ["<a x " * 200_000, "<a x " * 200_000 + ">", '<a x="' * 170_000, "<div>" * 4000 + "</span>" * 100_000, "<ul>" + "<div>" * 20_000 + "<li></li>" * 40_000, "<script>" * 120_000, "<" * 1_000_000, "<!--" * 200_000, "<p>" + "<b>" * 50_000 + "<hr>" * 20_000],
    ids=["unclosed", "closed at last", "quotes", "stray ends", "items", "scripts", "signs", "comments", "inline"],
)
def test_hostile_pages_are_parsed_in_linear_time(html):
    began = time.time()
    op10.parse(html)
    assert time.time() - began < 2


def test_very_long_page():
    """A page of some megabytes with thousands of siblings."""
    paragraphs = [f"paragraph {i} " + "word " * 40 for i in range(8000)]
    began = time.time()
    assert alone("<body><article>" + "".join(f"<p>{p}</p><hr>" for p in paragraphs) + "</article></body>") == "\n".join(p.strip() for p in paragraphs)
    assert time.time() - began < 20


def test_packed_wrappers():
    page = op10.node_of(op10.parse("<div><h1>T</h1><ul><li>a<li>b</ul><p>x</p></div><p>y</p>"), 7)
    assert op10.unpacked(op10.packed(page)) == page
    assert op10.pruned(page, 0) == page
    rare = op10.merged(page, op10.node_of(op10.parse("<div><h1>T</h1><em>once</em></div>"), 8))
    assert [k[0] for k in op10.pruned(rare, 2)[7]] == ["div"]
    assert sum(n[5] for n in op10.in_order(op10.pruned(rare, 2))[0]) == sum(n[5] for n in op10.in_order(rare)[0])
