"""Main text of pages: markup by hand, templates of whole hosts, and the given pages by brute force."""

from __future__ import annotations

import html
import re

import pytest
from conftest import SMALL

from ticklake.llm import html_consensus as op

LONG = "The river rose in the night and the town below it was warned in time by a rider."


@pytest.mark.parametrize(
    "source, want",
    [
        ("", ""),
        ("no markup &amp; <3 at  all", "no markup & <3 at all"),
        ("<article><p>a&nbsp;b<br>c</p><p> </p><p>d&#x41;&lt;p&gt;</article>", "a b c\ndA<p>"),
        ("<article><p>one<p><b>two<br><p>three</article><p>out", "one\ntwo\nthree"),
        ("<head><title>t</title><p>head was not closed here</p>", "head was not closed here"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "a\nb\nc\nd\ne"),
        ('<article><p title="a > b" data-x=\'</p>\'>in <span class="ad">buy</span>side</article>', "in side"),
        ("<article><p>a</p><!-- <p>b</p> --><script>var x='</article><p>c';</script><p>d</article>", "a\nd"),
        ("<article>x<!-- never closed <p>y</p></article>", "x"),
        ("<article><p>text</p><script>never closed <p>y</p></article>", "text"),
        ("<nav><a href=x>home</a></nav><footer>only a frame</footer>", ""),
        ("<article><header><h1>Title</h1></header><p>body</p><footer>by me</footer></article>", "Title\nbody"),
        ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
        ("<article><p>a</div></p>b</span></article>", "a\nb"),
        ("<article><p>in&shy;side <a href='x'>linked words</a> stay.</p></article>", "in­side linked words stay."),
        ("<article><p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p>yes</article>", "yes"),
        ("<" * 50 + "p>x", "<" * 49 + "\nx"),
    ],
)
def test_markup(source, want):
    assert op.main_text(source) == want


FRAME = """<html><head><title>T</title></head><body class="with-sidebar single-post">
<div class="cookie-notice">We use cookies on this site, read all about our partners and about your many choices.</div>
<header class="site-header"><h2>The Site</h2><div class="menu"><a href="/">Home</a></div></header>
<div id="wrap"><div class="post post-{n}"><header class="entry-header"><h1>Title {n}</h1></header>{body}
<div class="share-buttons">Share this with all of your friends</div>
<section id="comments"><article class="comment">A reader says a good deal about it here.</article></section></div>
<div class="sidebar"><p>Popular today in our other sections, a list of many things.</p></div>
<div class="x7">{junk}</div></div>
<form><label>Mail</label><p>Write to us about anything at all.</p></form><footer><p>Copyright</p></footer></body></html>"""


def page(n, body, junk=""):
    return FRAME.replace("{n}", str(n)).replace("{body}", body).replace("{junk}", junk)


def test_host_outvotes_a_page(spark):
    """A short article beside long unmarked text is found where the host's other pages have theirs."""
    junk = f"<p>{LONG} {LONG} {LONG}</p>"
    rows = [(i, f"https://user@News.example.com:80/{i}", page(i, f"<p>{LONG}</p>" * 3), 1) for i in range(9)]
    rows += [(20, "http://news.example.com/20", page(20, "<p>Short.</p>", junk), 1)]
    rows += [(21, "no url", page(21, "<p>Short.</p>", junk), 1), (22, None, None, 1), (None, "", "", 1)]
    rows += [(23, "http://news.example.com/23", "<div class='other'><p>Another template.</p></div>", 1)] * 2
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, host int, path string")
    found = op.main_texts(pages.repartition(4))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = [tuple(r) for r in found.collect()]
    texts = {r[0]: r[2] for r in got}
    assert texts[3] == "Title 3\n" + "\n".join([LONG] * 3)
    assert texts[20] == "Title 20\nShort." and texts[21] == f"{LONG} {LONG} {LONG}"
    assert texts[22] == texts[None] == "" and texts[23] == "Another template."
    assert len(got) == len(rows) and all(r[3] == len(r[2]) for r in got)
    assert sorted((r[0] or -1, r[1] or "") for r in got) == sorted((r[0] or -1, r[1] or "") for r in rows)
    winners = {r.host: r.path for r in op.host_paths(pages.select(op.host_of(pages.url).alias("host"), "html")).collect()}
    assert winners == {"news.example.com": ">html>body.single-post.with-sidebar>div>div.post.post-#"}


def test_votes_do_not_depend_on_partitions(spark):
    rows = [(f"h{i % 3}", page(i, f"<p>{LONG * (i % 4)}</p><section><p>{LONG}</p></section>")) for i in range(60)]
    made = [
        sorted(map(tuple, op.host_paths(spark.createDataFrame(rows[::step], "host string, html string").repartition(n)).collect()))
        for step, n in ((1, 1), (-1, 7))
    ]
    assert made[0] == made[1] and len(made[0]) == 3


def test_ties_go_to_the_deeper_container():
    source = f"<div class=a><div class=b><p>{LONG}</p></div></div>"
    scores = op.Page(source).scores()
    assert op.best_path(scores) == ">div.a>div.b" and scores[">div.a"][0] == scores[">div.a>div.b"][0]


def test_long_and_deep_pages():
    text = f"<article>{f'<p>{LONG}</p>' * 20_000}</article>"
    assert op.main_text(text).count("\n") == 19_999
    deep = "<div class='layer'>" * 3000 + LONG
    assert op.main_text(deep) == LONG
    assert max(map(len, op.Page(deep).paths)) <= op.PATH


def test_given_pages(spark):
    """Every page of the test table has one article of headings and paragraphs."""

    def brute(source):
        article = source[source.index("<article>") + 9 : source.index("</article>")]
        blocks = re.split("</?(?:p|h1)>", article)
        texts = (" ".join(html.unescape(re.sub("</?b>", "", b).replace("<br>", " ")).split()) for b in blocks)
        return "\n".join(t for t in texts if t)

    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    want = {r.page_id: brute(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in op.main_texts(pages).collect()} == want


def test_empty_table(spark):
    assert op.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
