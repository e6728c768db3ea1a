"""Main text of pages: the scan against brute force, pages against their marked articles, hand-made pages."""

import html
import random
import re
import time

import pytest

import __spark_entry__ as entry_points
from tests.llm.conftest import SF
from tidemark.llm.html_text import Counts, Weights, best_stretch, events, extract_text, learn_weights, main_text, signatures


def marked_article(page):
    """The blocks of the sample pages' article by plain replacement."""
    body = re.search("<article>(.*?)</article>", page, re.S)[1]
    blocks = (re.sub("<[^>]*>", lambda tag: " " if tag[0] == "<br>" else "", block) for block in re.split("</?(?:p|h1)>", body))
    return "\n\n".join(said for said in (" ".join(html.unescape(block).split()) for block in blocks) if said)


def test_all_sample_pages(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in entry_points.queries()["op12_html_text"](spark, SF).collect()}
    assert len(got) == len(rows)
    for row in rows:
        found = got[row.page_id]
        assert (found.url, found.text, found.n_chars) == (row.url, marked_article(row.html), len(marked_article(row.html)))


def test_pages_without_the_mark_go_by_what_was_learned(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    counts = Counts()
    for page in pages[: len(pages) // 2]:
        counts.learn(page)
    weights = Weights.of(counts.found)
    assert weights.elements["nav"] < -1 and weights.elements[".ad"] < -1 and weights.elements["p"] > 1
    for page in pages[len(pages) // 2 :]:
        bare = re.sub("<(/?)article>", r"<\1div>", page)
        assert main_text(bare, weights) == main_text(page, Weights()) == marked_article(page)


def test_scan_against_all_stretches():
    rng = random.Random(5)
    for _ in range(300):
        scores = [rng.choice([-3.0, -1.0, 0.5, 1.0, 2.0]) for _ in range(rng.randint(0, 25))]
        sums = {(a, b): sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
        first, last = best_stretch(scores)
        top = max(sums.values(), default=0)
        assert (first, last) == (0, 0) if top <= 0 else sums[first, last] == top


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>no{}</style></head><body class="page article"><form id="wrap">
<header class="top"><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a><li><a>News</a></ul></nav>
<article class="post"><header><h1>Title &amp; more</h1></header><p>First with <a href="x">a link</a>,&nbsp;text &lt;b&gt; caf&eacute; &#8364;<script>no("</p>")</script>.
<p>Second<br>line<!-- no --><div class="ad banner">Buy now, a long advert of many words that nobody ever wants to read at all</div>
<ul><li>One item<li>Two <b>it</b>em</ul><table><tr><td>a<td>b</table><p>Tail</p></article>
<section id="comments"><h2>Comments</h2><article class="comment"><p>I think this is a very long comment with many words in it, and more and more words.</p></article></section>
<aside><p>Related things to read for you now</p></aside></form><div role="contentinfo">c</div></body></html>"""


def test_hand_made_page():
    assert main_text(PAGE, Weights()).split("\n\n") == [
        "Title & more", "First with a link, text <b> café €.", "Second line", "One item", "Two item", "a", "b", "Tail",
    ]


@pytest.mark.parametrize(
    "beside",
    [
        '<nav><a href="/">One two three four five six seven</a></nav>', '<div class="sidebar"><p>Words in the sidebar of the page</p></div>',
        '<div id="cookieNotice">We use cookies on this site to serve you</div>', "<form><label>Your name, please</label><input></form>",
        '<div class="comments-list"><p>A reader said that this was good</p></div>', "<footer>All rights are reserved by us</footer>",
        "<script>var x = 1 < 2;</script>", "<style>p > b {}</style>", "<noscript><p>Turn it on, please, do it now</p></noscript>",
        '<div class="social share">Share this with all your friends</div>', "<aside>Something else that you may like</aside>",
        '<div hidden>Not to be seen by any reader here</div>', '<section role="complementary"><p>More things for you</p></section>',
    ],
)
def test_what_is_no_main_text(beside):
    article = "<h1>Heading</h1><p>Some words of the main text stand here.</p><p>More of them follow.</p>"
    wanted = "Heading\n\nSome words of the main text stand here.\n\nMore of them follow."
    for page in (beside + f"<main>{article}</main>", f"<div>{article}</div>" + beside, f"<article><h1>Heading</h1>{beside}{article[16:]}</article>"):
        assert main_text(f"<html><body>{page}</body></html>", Weights()) == wanted


def test_awkward_pages():
    none = Weights()
    assert main_text(None, none) == main_text("", none) == main_text("<nav>x</nav>", none) == main_text("<!-- x", none) == ""
    assert main_text("plain  text\n only", none) == "plain text only"
    assert main_text("<p>a</p></b></p>b<p>c <i", none) == "a\n\nb\n\nc"
    assert main_text('<p title="a > b">x</p><p title="c>y', none) == "x\n\ny"
    assert main_text("<p>&am &amp &bogus; 1 < 2</p>", none) == "&am & &bogus; 1 < 2"
    assert [name for kind, name, _ in events("<p>a<div>b</p>") if kind == 0] == ["p", "div"]
    assert signatures("div", ' class="sideBar Top" id=x1 data-id="no"') == ("div", ".side", ".bar", ".top", ".x1")


@pytest.mark.parametrize("part", ["<a", "<!", '<a "', "<p>x ", "</b>", "<div>", "x ", "<p class='a", "<!--", "<script>", "<li>", "&amp"])
def test_long_pages_take_linear_time(part):
    started = time.perf_counter()
    main_text(part * 100_000, Weights())
    assert time.perf_counter() - started < 5


def test_rows_repeats_and_clashing_columns(spark, nothing):
    rows = [(1, "u", PAGE, "t", 3), (1, "u", PAGE, "t", 3), (None, None, None, "t", 3), (2, "v", "", None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = [(r.page_id, r.url, len(r.text), r.n_chars) for r in extract_text(frame).collect()]
    size = len(main_text(PAGE, Weights()))
    assert sorted(got, key=str) == sorted([(1, "u", size, size)] * 2 + [(None, None, 0, 0), (2, "v", 0, 0)], key=str)
    assert extract_text(frame.where("false")).count() == 0


def test_the_bounded_sample(spark):
    page = "<body><nav>{0}</nav><article><p>{0} words</p></article></body>"
    frame = spark.createDataFrame([(page.format(k),) for k in range(300)] + [("<p>none</p>",)] * 50, "html string")
    whole, some = learn_weights(frame), learn_weights(frame, labelled=50)
    assert whole.elements["nav"] < some.elements["nav"] < -1 and set(whole.tags) == {"nav", "p", "article"}
    assert learn_weights(frame.where("html = '<p>none</p>'")) == Weights()
