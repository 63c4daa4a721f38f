from __future__ import annotations

import html
import re
import time
from collections import Counter

import pytest

from tallyline.llm import htmltext

LONG = "This is the story of a town that was not on any map and of the people who had to live there, and it is told by one of them who is no longer there."


def test_articles_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r for r in htmltext.extract_text(pages).collect()}
    for page in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", page["html"], re.S)[1]
        body = re.sub(r"<[^>]*\Z", "", body)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", body))
        want = "\n\n".join(p for p in parts if p)
        assert (got[page["page_id"]]["text"], got[page["page_id"]]["n_chars"]) == (want, len(want))


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<p>", ""),
        ("<script>var a = '<p>no</p>'", ""),
        ("<!-- <article><p>no</p></article>", ""),
        ("<article><p>short", "short"),
        ("<article><p>a &amp b &lt;i&gt; &#233; &am", "a & b <i> é &am"),
        ("<article><p>one<br>two\n\t three&nbsp;four<p>five</article>", "one two three four\n\nfive"),
        ("<article><header><h1>T</h1></header><p>x</p><aside>side</aside><form>f<button>b</button></form><p>y</p></article>", "T\n\nx\n\ny"),
        ("<article><p>a <span class='ad'>buy</span> b</p><div class='comments'><article class='comment'>hi</article></div></article>", "a b"),
        ("<main><article class='post has-sidebar'><p>a</p></article><div id='cookie-notice'>ok?</div></main>", "a"),
        ("<body class='no-sidebar'><header>H</header><article><p>a<p hidden>b<p style='display: none'>c</article><footer>f", "a"),
        ("<article><p>x</p><p><a href=/1>one of many links</a> <a href=/2>and two</a></p></article>", "x"),
        ('<article><p title="a > b">x</p><div data-x=\'<p>\'>y</div></article>', "x\n\ny"),
    ],
)
def test_small_pages(page, want):
    assert htmltext.main_text(page) == want


def test_pages_without_an_article_are_judged_by_their_blocks():
    page = (
        "<div>Home of all the best things we have for you today</div>"
        f"<h1>The town</h1><p>{LONG} {LONG}</p><p>She was the last.</p><p>{LONG} {LONG}</p>"
        "<div><a href=/a>more about this</a> <a href=/b>and that</a></div>"
        "<p>Lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua</p>"
    )
    assert htmltext.main_text(page) == f"Home of all the best things we have for you today\n\nThe town\n\n{LONG} {LONG}\n\nShe was the last.\n\n{LONG} {LONG}"


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><p class=ad>x<p>text<p>more</article>", "text\n\nmore"),
        ("<article><p class=ad>x<div>text</div>more</article>", "text\n\nmore"),
        ("<article><p>a <span class=ad>x<p>text</article>", "a\n\ntext"),
        ("<article><ul><li class=social>a<li>b<li class=share><p>c<ul><li>d</ul>e<li>f</ul>g</article>", "b\n\nf\n\ng"),
        ("<article><dl><dt class=ad>a<dd class=ad>b<dt>c<dd>d</dl>e</article>", "c\n\nd\n\ne"),
        ("<article><table><thead class=ad><tr><th>h<tbody><tr><td class=ad>a<td>b<tr class=ad><td>c<tr><td>d</table>e</article>", "b\n\nd\n\ne"),
        ("<article><p class=ad>x<table><tr><td><p>y</table></article>", "y"),
        ("<head><title>t</title><meta charset=utf-8><article><p>text", "text"),
        ("<html><head><noscript><p>n<body><article><p>text", "text"),
        ("<div class=share><ul><li>a</ul><p>b</div><article>c</article>", "c"),
    ],
)
def test_missing_end_tags(page, want):
    assert htmltext.main_text(page) == want


@pytest.mark.parametrize(
    "name", ["overflow-hidden", "md:hidden", "elementor-widget-container", "content-with-sidebar", "hidden-xs", "layout-sidebar", "no-ads", "nav-tabs-content"]
)
def test_classes_of_layout_do_not_empty_a_page(name):
    assert htmltext.main_text(f"<div class='{name} x'><article><p>text</p></article></div>") == "text"


@pytest.mark.parametrize(
    "name", ["hidden", "ad", "main-nav", "siteFooter", "cookie-banner", "share-buttons", "comment-list", "widget-area", "site-header", "l-sidebar", "visually-hidden"]
)
def test_classes_that_are_left_out(name):
    assert htmltext.main_text(f"<main><p>text</p></main><div class='x {name}'><main>no</main></div>") == "text"


@pytest.mark.parametrize(
    "sentence",
    [
        "Ta opowieść mówi o mieście, którego nie było na żadnej mapie, i o ludziach, którzy musieli tam mieszkać przez wiele lat. ",
        "Это рассказ о городе, которого не было ни на одной карте, и о людях, которым пришлось там жить много лет подряд. ",
        "Il gatto dorme sopra una sedia mentre fuori piove forte e nessuno osa aprire quella vecchia porta verde. ",
        "这是一个关于一座不在任何地图上的城市的故事，也是关于那些不得不在那里生活多年的人们的故事。",
    ],
)
def test_pages_in_other_languages(sentence):
    long = (sentence * 3).strip()
    page = f"<div><a href=/a>menu one two</a> <a href=/b>three</a></div><h1>T</h1><p>{long}</p><p>{long}</p><div><a href=/c>x</a></div>"
    assert htmltext.main_text(page) == f"T\n\n{long}\n\n{long}"
    listed = f"<p>{LONG} {LONG}</p><p>{long}</p>"  # a page in a listed language is judged by its stop words
    assert htmltext.main_text(listed) == f"{LONG} {LONG}"


def test_short_block_follows_the_nearest_decided_one():
    links = "<p><a href=/>one two three</a></p>"
    good = f"<p>{LONG} {LONG}</p>"
    assert "near" in htmltext.main_text(f"{good}<p>near</p><p>far</p>{links}")
    assert "far" not in htmltext.main_text(f"{good}<p>near</p><p>so</p><p>far</p>{links}")


def test_a_page_that_nests_deeply_or_is_cut_ends_somewhere():
    assert htmltext.main_text("<div>" * 3000 + "<article><p>x") == "x"
    assert htmltext.main_text("<article><p>x</p><p class='unclosed") == "x"
    assert htmltext.main_text("<article><p>" + "word " * 200_000) == ("word " * 200_000).strip()


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "</x>" * 100_000,
        "<div>" * 60_000 + "</p></li></td>" * 20_000 + "<article>x",
        "<li><ul>" + "<div>" * 90_000 + "</li>" * 90_000,
        "<li>" + "<div>" * 90_000 + "<p>x" * 60_000,
        "<ul><li>" * 60_000 + "<p>" * 60_000 + "</ul>" * 60_000,
        "<table><tr><td>" * 40_000 + "<tr>" * 60_000,
        "<a href=1><b>" * 60_000 + "</b>" * 60_000,
        "<article>" + "<a '" * 100_000,
        "<!" * 300_000,
    ],
)
def test_a_page_of_nested_or_foreign_tags_takes_linear_time(page):
    start = time.process_time()
    htmltext.main_text(page)
    assert time.process_time() - start < 4


def test_rules_alone_find_the_articles_of_the_table(spark, sf_dir):
    """Without article tags, the two passes keep nearly all blocks of the articles and add hardly any."""
    kept = lost = added = 0
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        want = Counter(htmltext.main_text(row["html"]).split("\n\n"))
        got = Counter(htmltext.main_text(re.sub(r"<(/?)(article|main)\b", r"<\1div", row["html"])).split("\n\n"))
        kept, lost, added = kept + (want & got).total(), lost + (want - got).total(), added + (got - want).total()
    assert kept >= 0.95 * (kept + lost) and added <= 0.02 * kept


def test_a_page_without_a_long_block_has_its_short_ones():
    assert htmltext.main_text("<div><a href=/>menu</a></div><p>Only this.<p>And that.") == "Only this.\n\nAnd that."


def test_odd_tables(spark):
    rows = [(None, None, None, 1, "t"), (1, "u", "", 2, "t"), (1, "u", "<article>a</article>", 3, None), (1, "u", "<article>a</article>", 3, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long, text string")
    got = [tuple(r) for r in htmltext.extract_text(pages).collect()]
    assert sorted(got, key=repr) == sorted([(None, None, "", 0), (1, "u", "", 0), (1, "u", "a", 1), (1, "u", "a", 1)], key=repr)
    assert htmltext.extract_text(pages.limit(0)).count() == 0
