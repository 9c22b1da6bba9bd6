"""Main text: against the article of the table's pages, and made pages."""

import html
import random
import re

import pytest

from livetable.llm import main_text as m
from livetable.llm.queries import QUERIES

from conftest import SF001


def article(page):
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body.replace("<br>", " ")))
    lines = (" ".join(html.unescape(x).split()) for x in blocks)
    return "\n".join(x for x in lines if x)


def test_query_gives_the_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = QUERIES["op7_main_text"](spark, SF001).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


MORE = " ".join(["goes on and on and ends"] * 6)
PAGE = f"""<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home page of the site</a></li></ul></nav>
<div class="cookie-notice">We use cookies to make this better for all of you.</div>
<div id="content"><h1>Head &amp; line</h1><p>First   words of <b>the</b> story
go on here for a while.<script>var x = "<p>no</p>"</script><p>Second &lt;block&gt; with more words in it.
<div class="ad">Buy this thing now please</div><p>Third block {MORE}.</p></div>
<section class="comments"><p>I think this is wrong, said a reader.</p></section>
<aside>Related stories here</aside><form><p>Sign up to our letter</p></form><!-- <p>hidden</p> -->
<footer>All rights reserved by us.</footer></body></html>"""


def test_boilerplate_is_left_out():
    text = "Head & line\nFirst words of the story go on here for a while.\nSecond <block> with more words in it.\nThird block " + MORE + "."
    assert m.main_text(PAGE, {}) == text
    weights = m.weigh(m.count_types(PAGE.replace('<div id="content">', "<article>").replace("</p></div>", "</p></article>")))
    assert m.main_text(PAGE, weights) == text


BLOCKS = [f"Block {k} tells a part of the story in a dozen plain words or so." for k in range(9)]
NINE = "".join(f"<p>{b}</p>" for b in BLOCKS)


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "post no-comments", "story ad-free", "page-nav-top", "layout-search-results",
                                  "main-side-bar-left", "widget"])
@pytest.mark.parametrize("weights", [{}, None])
def test_a_name_does_not_take_an_article_away(spark, name, weights):
    weights = LEARNED(spark) if weights is None else weights
    page = f"<html><body><nav><a href=/>Home</a> <a href=/x>News</a></nav><div class='{name}'>{NINE}</div><footer>By us</footer></body></html>"
    assert m.main_text(page, weights) == "\n".join(BLOCKS)


def LEARNED(spark, cache={}):
    if not cache:
        cache.update(m.learn_weights(spark.read.parquet(f"{SF001}/pages.parquet")))
    return cache


@pytest.mark.parametrize("weights", [{}, None])
def test_what_is_left_out_does_not_cut_the_run(spark, weights):
    weights = LEARNED(spark) if weights is None else weights
    links = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(60))
    page = f"<body><article><p>one two three four five six</p><nav><ul>{links}</ul></nav><p>after the menu it goes on</p></article></body>"
    assert m.main_text(page, weights) == "one two three four five six\nafter the menu it goes on"
    cells = "".join(f"<tr><td>{k}</td><td>mean</td><td>{k * 3}</td></tr>" for k in range(12))
    page = f"<body><div><p>The table shows it all.</p><table>{cells}</table></div></body>"
    got = m.main_text(page, weights).split("\n")
    assert got[0] == "The table shows it all." and len(got) == 37
    page = f"<body><form id='aspnetForm'><div>{NINE}</div></form></body>"
    assert m.main_text(page, weights) == "\n".join(BLOCKS)


def test_comments_longer_than_the_article_stay_out():
    said = "".join(f"<p>Reader {k} says that this is all wrong and then some more.</p>" for k in range(15))
    page = f"<body><div id='story'>{NINE}</div><section class='comments'>{said}</section></body>"
    assert m.main_text(page, {}) == "\n".join(BLOCKS)


def test_best_run_against_all_runs():
    rng = random.Random(7)
    for _ in range(400):
        x = [rng.choice([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 3.0]) for _ in range(rng.randint(0, 14))]
        runs = [(sum(x[a:b]), a, b) for a in range(len(x)) for b in range(a + 1, len(x) + 1)]
        top = max((r[0] for r in runs), default=0.0)
        a, b = m.best_run(x)
        assert sum(x[a:b]) == max(top, 0.0) and (b == 0 or sum(x[a:b]) > 0)


def test_pages_against_all_runs():
    """The text is that of a run that no other run of tokens beats."""
    rng = random.Random(8)
    parts = ["<p>", "</p>", "<div>", "</div>", "<nav>", "</nav>", "<a href=x>", "</a>", "<li>", "some words here ", "more ", "<br>", "<div class=ad>", " "]
    for _ in range(200):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        p = m._Page(page)
        w = m.scores(p, {})
        top = max([sum(w[a:b]) for a in range(len(w)) for b in range(a + 1, len(w) + 1)] or [0])
        a, b = m.best_run(w)
        assert abs(sum(w[a:b]) - max(top, 0)) < 1e-9
        words = " ".join(x for x, o in zip(p.text[a:b], p.out[a:b]) if not o).split()
        assert m.main_text(page, {}).split() == words


def test_odd_pages():
    for page in (None, "", "   ", "<p></p>", "<html", "<!-- never closed", "<script>never closed", "<nav>a b c</nav>"):
        assert m.main_text(page, {}) == ""
    assert m.main_text("just words", {}) == "just words"
    assert m.main_text("<p a='>'>x &eacute;   y</P>z and<br>w more", {}) == "x é y\nz and w more"
    assert m.main_text("<p>a <i>b</i>c d e</p>" + "<p>w &amp; w</p>" * 3000, {}).count("\n") == 3000
    assert len(m.main_text("<p>" + "word " * 300_000, {}).split()) == 300_000


def test_quotes_that_never_close_take_linear_time():
    import time
    t = time.time()
    m.main_text('<a href="x' * 3000 + "<p>words of text</p>", {})
    assert time.time() - t < 20


def test_tables(spark):
    df = spark.createDataFrame([(1, None, "<p>a b c d</p>", "x"), (1, "u", None, "x"), (None, "u", "<article><p>q r s</p></article>", "x")],
                               "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in m.extract(df).collect()), key=str)
    assert got == sorted([(1, None, "a b c d"), (1, "u", ""), (None, "u", "q r s")], key=str)
    assert m.extract(df.limit(0)).collect() == []
