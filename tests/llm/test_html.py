import random
import re
import time
from html import unescape
from itertools import product

import pytest

from gridpulse.llm import queries
from gridpulse.llm.html import blocks, extracted, main_text, minimum_cut

PAGE = """<!DOCTYPE html><html lang="en"><head><title>Title here</title><style>p{{}}</style>
<script>var a = "</p><article>no</article>";</script></head><body class="post main">
<header class="top"><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this page better for all of you.</p></div>{main}
<aside><h3>Related</h3><p>Another long story about things that happened, with many words in it.</p></aside>
<form action="/s"><label>Search</label><input name=q><button>Go</button></form>
<section id="comments"><h2>Comments</h2><p>I liked this one a lot, thank you for writing it down here.</p></section>
<footer>&copy; someone &middot; all rights reserved.<p>Footer text that goes on for quite a while, really it does.</p></footer></body></html>"""
MAIN = """<article><h1>Head &amp; line</h1><p>First   paragraph,\n with <b>bold</b> and <a href=x>a link</a>.</p><p>Short.
<div class="ad">Buy this now, it is a very good thing to buy for you and yours.</div>
<ul><li>one<li>two &lt;b&gt;</ul><!-- <p>gone</p> --><p>x<br>y &#228;&nbsp;z a < b</article>"""
TEXT = "Head & line\nFirst paragraph, with bold and a link.\nShort.\none\ntwo <b>\nx y ä z a < b"
LONG = "This is a sentence of some length, so it looks like prose. It goes on for a bit."


def test_article():
    assert main_text(PAGE.format(main=MAIN)) == TEXT


def test_cut_short():
    whole = PAGE.format(main=MAIN)
    assert main_text(whole[: whole.index("<aside>")]) == TEXT
    assert main_text(whole[: whole.rindex("</article>")]) == TEXT
    assert main_text(whole[: whole.index("Footer text")] + "<div cla") == TEXT


def test_no_article_element():
    page = PAGE.replace(' class="post main"', "").format(main=f"<div><p>{LONG}</p><p>Hm.</p><p>{LONG}</p></div>")
    assert main_text(page) == f"{LONG}\nHm.\n{LONG}"


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<!-- x", "<script>a", "</p></div>", "<html><body></body></html>"])
def test_no_text(page):
    assert main_text(page) in ("", "<")


def test_plain_text_and_comments():
    assert main_text(f"<p>{LONG}</p>" * 3) == "\n".join([LONG] * 3)
    assert main_text(f'<article><p>{LONG}</p><div class="reader-comments"><article><p>{LONG}</p></article></div></article>') == LONG
    assert main_text(f"<main><p>{LONG}</p><div role='alert'>{LONG}</div><p hidden>{LONG}</p></main>") == LONG
    assert main_text(f'<article><p title="a > b">{LONG}<p class=\'x"y\'>{LONG}</article>') == f"{LONG}\n{LONG}"


@pytest.mark.parametrize("opening, kept", [
    ('<article class="post has-comments">', True), ('<article class="comment">', False), ('<div class="main-content with-sidebar">', True),
    ('<div class="post-comments">', False), ('<ins class="adsbygoogle">', False), ('<div class="adsbygoogle">', False),
    ('<main id="content" class="sidebar-right">', True), ('<div id="siteHeader">', False), ('<body class="single has-sidebar comments-open">', True),
])
def test_names_of_elements(opening, kept):
    page = f"{opening}<p>{LONG}</p><p>{LONG}</p>"
    assert main_text(page) == (f"{LONG}\n{LONG}" if kept else "")


@pytest.mark.parametrize("opening, kept", [
    ('<div class="container right-sidebar"><article>', True), ('<body><form action="/"><div><main>', True),
    ('<div class="comments"><article>', False), ('<div class="right-sidebar"><article class="comment">', False),
    ('<nav><article>', False), ('<div hidden><article>', False), ('<div class="popup"><form><main><article>', True),
])
def test_marks_around_an_article(opening, kept):
    page = f'{opening}<p>{LONG}</p><p>{LONG}</p><div class="ad">{LONG}</div>'
    assert main_text(page) == (f"{LONG}\n{LONG}" if kept else "")


def test_an_article_beside_the_main_text_stays_out():
    page = f'<main><p>{LONG}</p><p>{LONG}</p></main><div class="related"><article><p>{LONG}</p></article></div>'
    assert main_text(page) == f"{LONG}\n{LONG}"


def test_mathematics_and_what_is_not_closed():
    formula = "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x = 1</annotation></math>"
    assert main_text(f"<article><p>{LONG} {formula} holds.</p></article>") == f"{LONG} x=1 holds."
    for tag in ("svg", "video", "object"):
        assert main_text(f"<article><p>{LONG}</p><{tag} width=1><p>{LONG}</p></article>") == f"{LONG}\n{LONG}"
    assert main_text(f"<article><p>{LONG}</p><svg><text>no</text></svg><p>{LONG}</p></article>") == f"{LONG}\n{LONG}"


def test_very_long_page():
    page = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>" + "<p><b>" * 5000
    assert main_text(page).count("\n") == 19_999


def test_blocks_keep_all_text():
    assert [b.text for b in blocks("a<p>b<i>c</i>d</p>e<br>f<div>g<hr>h")] == ["a", "bcd", "e f", "g", "h"]


def cost(labels, values, edges):
    own = sum(-min(v, 0) if k else max(v, 0) for k, v in zip(labels, values))
    return own + sum(w for a, b, w in edges if labels[a] != labels[b])


def test_minimum_cut_against_all_labellings():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 9)
        values = [rng.randint(-6, 6) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randint(0, 5)) for _ in range(rng.randint(0, 14))]
        edges = [e for e in edges if e[0] != e[1]]
        every = {c: cost(c, values, edges) for c in product([False, True], repeat=n)}
        least = min(every.values())
        got = tuple(minimum_cut(values, edges))
        assert every[got] == least
        assert sum(got) == min(sum(c) for c, v in every.items() if v == least)


def test_smoothing_joins_a_short_line_to_its_neighbours():
    values, chain = [100, -30, 100], [(0, 1, 40), (1, 2, 40)]
    assert minimum_cut(values, chain) == [True, True, True]
    assert minimum_cut(values, [(0, 1, 10), (1, 2, 10)]) == [True, False, True]


def test_rows(spark):
    rows = [(1, None, None, "c"), (2, "u", "", "c"), (None, "u", MAIN, "c"), (1, "u", MAIN, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.id or 0, r.url or "", r.text, r.n_chars) for r in extracted(pages).collect())
    assert got == sorted([(1, "", "", 0), (2, "u", "", 0), (0, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT))])
    assert extracted(pages.limit(0)).count() == 0


def test_query_finds_all_articles(spark, small):
    got = {r.page_id: (r.text, r.n_chars) for r in queries.QUERIES["op7_minimum_cut_html"](spark, small).collect()}
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    assert len(pages) == len(got)
    for p in pages:
        inner = re.search("<article>(.*?)</article>", p.html, re.S)[1]
        lines = [" ".join(unescape(re.sub("</?b>", "", x.replace("<br>", " "))).split()) for x in re.split("</?h1>|</?p>", inner)]
        want = "\n".join(x for x in lines if x)
        assert got[p.page_id] == (want, len(want))


@pytest.mark.parametrize("page", [
    "<div>a b c" * 300_000, "<b>x" * 300_000, "<i><div>" + "<b>x</i>" * 100_000, "<b>" * 100_000 + "<hr>x" * 100_000,
    "<form>" + "<article>one two three four five six seven eight nine ten eleven twelve" * 50_000, "<ul>" + "<li>x<b>" * 100_000,
    "<svg/>" * 100_000,
], ids=["nested", "unclosed", "stray ends", "lines in unclosed", "nested articles", "closed by the next", "drawings"])
def test_deep_and_broken_pages_take_time_by_their_length(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 20
