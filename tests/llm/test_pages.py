import re
import time
from html import unescape

import pytest

from gleaner.llm.pages import extract, main_text, op5_main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site head</header>
<nav><a href=x>One</a></nav><div class="cookie-notice">We use cookies, many of them, to serve you well and long.</div>
<main><article><header><h1>A &amp; B</h1></header><p>First para, long enough to count, really.<p>Second  para
 with &nbsp; spaces &#233; and, well, <b>commas</b>.<!-- <p>no --><script>var a = "</p><p>no";</script><ul><li>item one<li>item two</ul>
<aside>side, bar, text that is long enough to count here</aside><form><input>name</form></article>
<section class="comments"><p>Reader says, nice article, thanks a lot for all the things, yes.</p></section></main>
<div id="Ad-1">Buy, buy, buy, this is a long advert that would count.</div><footer>&copy; foot</footer></body></html>"""


def test_page_parts():
    assert main_text(PAGE) == "A & B\nFirst para, long enough to count, really.\nSecond para with spaces é and, well, commas.\nitem one\nitem two"


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>x<p>y", "x\ny"), ("<", "<"), ("a < b", "a < b"), ('<div class="ad">x</div>', ""),
    ("<p>x</q></p></div>y", "x\ny"), ("<script>x", ""), ("<!-- x", ""), ("&lt;p&gt;", "<p>"), ("<p>a<br>b</p>", "a b"), ("<div hidden>x</div>y", "y"),
    ('<p title="a > b">x</p>', "x"), ("<article><p>s</p></article><p>out</p>", "s"),
])
def test_small_pages(page, text):
    assert main_text(page) == text


ONE, TWO = ("A paragraph of this page, long enough to count, number " + n for n in ("one.", "two."))


@pytest.mark.parametrize("start", [
    '<div style="overflow:hidden">', '<article aria-hidden="false">', '<div title="a hidden valley">', '<div data-id="comments">', '<div data-x=/p?id=comments>',
    '<div class="content with-sidebar">', '<div id=main class="sidebar">', '<div class="no-ads">', '<div class="page-sidebar"><h1>T</h1>', '<div class="widget">',
])
def test_what_only_looks_like_junk_stays(start):
    end = "</article>" if "article" in start else "</div>"
    assert main_text(f"{start}<p>{ONE}</p><p>{TWO}</p>{end}").removeprefix("T\n") == f"{ONE}\n{TWO}"


def test_links_keep_their_words():
    assert main_text(f'<article><p>{ONE} <a href="/hidden-gems">Gems</a> <a href="/p?id=comments">and more</a></p></article>') == f"{ONE} Gems and more"


@pytest.mark.parametrize("junk", [
    "<p class=notice>Take note", "<p class=notice>Take note<div>", '<div class="ad"><p>Buy', '<ul><li class="ad">Buy<li>', "<div hidden>x</div>", "<nav><a>One</a>", "<div><nav>One</div>",
    '<div class="comment-content"><p>Reader</div>', "<div aria-hidden=true>x</div>", '<div style="visibility: hidden">x</div>', "<div class=article-comments>x</div>",
])
def test_junk_ends_where_it_must(junk):
    page = f"<body><article><section>{junk}</section><p>{ONE}</p><p>{TWO}</p></article></body>"
    assert main_text(page) == f"{ONE}\n{TWO}"


def test_junk_without_end_tags_drops_nothing_else():
    assert main_text(f"<head><title>T</title><body><p>{ONE}<p>{TWO}") == f"{ONE}\n{TWO}"
    assert main_text(f"<article><p class=notice>Note<p>{ONE}<p>{TWO}</article>") == f"{ONE}\n{TWO}"
    comments = f'<div class="comments"><article class="comment"><p>{"Reader, says. " * 90}</p></article></div>'
    assert main_text(f"<div><p>{ONE}</p><p>{TWO}</p></div>{comments}") == f"{ONE}\n{TWO}"


def test_split_articles_and_link_lists():
    section = "<section><p>" + "Many words, and commas, for a paragraph of text. " * 4 + "</p></section>"
    links = "<div><p>" + '<a href="x">a link text, long enough to be counted as such</a> ' * 9 + "</p></div>"
    got = main_text(f"<body><div id=main>{section * 3}</div>{links}</body>")
    assert got.count("\n") == 2 and "link" not in got


MANY = "<p>" + "Many words, and commas, for a paragraph of text. " * 4 + "</p>"
SHORT = "<section><p>A short last section, of one paragraph, no more.</p></section>"
TAIL = "A short last section, of one paragraph, no more."


def lines(page):
    return ["many" if line.startswith("Many") else line for line in main_text(page).split("\n")]


@pytest.mark.parametrize("tag", ["article", "main"])
def test_an_article_is_taken_whole(tag):
    assert lines(f"<body><{tag}><h1>T</h1><div>{MANY * 3}</div><pre>code</pre></{tag}></body>") == ["T", "many", "many", "many", "code"]
    assert lines(f"<body><{tag}><section>{MANY * 9}</section>{SHORT}</{tag}></body>")[-2:] == ["many", TAIL]
    links = "<ul>" + "<li><a href=x>some other page of this site</a>" * 5 + "</ul>"
    assert lines(f"<body><{tag}><h1>T</h1><div>{MANY * 3}</div>{links}</{tag}><p>{'<a>x</a> ' * 50}</body>") == ["T", "many", "many", "many"]


def test_siblings_of_the_winner():
    links = "<ul><li><a href=x>Home</a><li><a href=y>News</a></ul>"
    body = f"<h3>Pages</h3>{links}<h1>T</h1><div>by X</div><div>{MANY * 3}</div>"
    pieces = "<h2>Code</h2><pre>x = 1</pre><ul><li>a<li>b</ul><table><tr><td>1<td>2</table><figure><figcaption>F</figcaption></figure>"
    assert lines(f"<body>{body}{pieces}<h3>More</h3>{links}<h3>End</h3></body>") == ["T", "many", "many", "many", "Code", "x = 1", "a", "b", "1", "2", "F"]


def test_a_fifth_of_the_points_is_enough():
    assert lines(f"<body><div>{MANY}</div>{SHORT}</body>") == ["many", TAIL]


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "deep text"
    assert main_text(deep) == "deep text"
    words = "word, " * 200_000
    assert main_text(f"<article><p>{words}</p></article>") == words.strip()


def test_rows(spark):
    frame = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None)], "page_id long, url string, html string, text string")
    rows = sorted(map(tuple, extract(frame).collect()), key=repr)
    assert rows == [(1, "u", main_text(PAGE)), (1, "u", main_text(PAGE)), (2, None, "")]
    assert extract(frame.limit(0)).count() == 0


def test_all_pages_against_their_article(spark):
    sf = "/root/testdata/sf0.001"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in op5_main_text(spark, sf).collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", html[r.page_id], re.S)[1]
        lines = (" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:h1|p)>", inside))
        assert r.text == "\n".join(x for x in lines if x) and r.n_chars == len(r.text)


@pytest.mark.parametrize("piece", ["<div ", "<b>", "<b></i>", "<i><header>", "<ul><b><li>x</li>", "<!-- ", "</script", "<b><p></p>", '<a "'])
def test_time_grows_with_the_page(piece):
    """A quadratic walk over these took minutes."""
    for lead in ("", "<ul><li><ul>" + "<b>" * 20_000):
        begin = time.process_time()
        main_text(lead + piece * (200_000 // len(piece)))
        assert time.process_time() - begin < 10


def test_what_is_left_open_at_the_end():
    assert main_text("<p>One <b two") == "One <b two" and main_text("<p>One <!-- two > three") == "One" and main_text("<p>One <!-- two") == "One"
    assert main_text("<p>One <!--> two") == "One" and main_text("<p>One <!-- x --> two") == "One two" and main_text("a < b") == "a < b"
    assert main_text("<title>x <!-- y</title><p>One <b>two</b></p>") == "One two"
