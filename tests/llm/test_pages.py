"""Main text of pages: the given tables by their own template, and pages of other shapes."""

import html
import re
import time

import pytest
from support import result, rows  # noqa: F401

from ledgerlens.llm.pages import extract_pages, main_text

JUNK = """<header><h1>Site</h1></header><nav><ul><li><a href=/>Home, sweet home</a></ul></nav><div class="cookie-notice"><p>We use
cookies, as all do.</p></div><aside><p>Read, too, this</p></aside><div id="sidebar"><p>Weather, news, and sport</p></div>"""
TAIL = """<div class="ad-slot"><p>Buy, buy, buy</p></div><form><p>Search, please</p><input></form><section id="comments"><article>
<p>I agree, fully, and with all of it, more than with anything, ever, truly, really.</p></article></section><footer><p>(c)</p></footer>"""
BODY = """<h2>A title</h2><p>One, two <a href=x>link</a> &amp; th&eacute;n.<p>Four<br>  five\n six.<ul><li>item a<li>item b</ul>
<blockquote>Quoted, well</blockquote><pre>x\n  y</pre><p>.</p>"""
WANT = "A title\n\nOne, two link & thén.\n\nFour five six.\n\nitem a\n\nitem b\n\nQuoted, well\n\nx y\n\n."


def test_op12(rows, result):
    want = {}
    for page_id, url, text in rows("pages", "page_id", "url", "html"):
        inside = re.search("<article>(.*?)</article>", text, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inside)]
        told = "\n\n".join(filter(None, blocks))
        want[page_id] = (url, told, len(told))
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in result("op12_extract_pages")}
    assert got == want


@pytest.mark.parametrize("shape", [
    "<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', '<div id=wrap><div class="post-body">{}</div></div>',
    '<div class="with-sidebar"><section>{}</section></div>', '<div><div role="main">{}</div></div>', "<center><table><tr><td>{}</table></center>"])
def test_shapes(shape):
    page = f"<!DOCTYPE html><html><head><title>T, u</title><style>p{{}}</style></head><body>{JUNK}{shape.format(BODY)}{TAIL}</body></html>"
    assert main_text(page) == WANT


def test_parts_of_an_article():
    assert main_text("<article><header><h1>T</h1><p>by me</p></header><p>A<p>B, <i>c</i>d<div class=share>x</div></article>") == "T\n\nA\n\nB, cd"
    assert main_text("<body><h1>T</h1><div><p>One, two.</p></div><div><p>Three, four.</p></div>") == "T\n\nOne, two.\n\nThree, four."
    assert main_text("<p>a<script>var x = '</p><p>no';</script> b<!-- <p>no --> c") == "a b c"
    assert main_text("<p title='a > b' hidden>no</p><p data-x=it's>yes &lt;b&gt; &am &amp") == "yes <b> &am &"
    assert main_text("<div class=nav>only this</div>") == "only this"
    assert main_text("plain, text") == "plain, text" and main_text("") == "" and main_text("<p") == ""


@pytest.mark.parametrize("part", ["<!-- x ", "<a ", '<a href="', "<![CDATA[ x ", "<div>a, b", "<p><b>a", "<b><li>a</i>", "</", "&#", "<"])
def test_long_odd_pages_take_linear_time(part):
    start = time.perf_counter()
    main_text(part * 50_000)
    assert time.perf_counter() - start < 30


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, HTML string, text int"
    df = spark.createDataFrame([(1, "u", None, "x", 0), (None, None, "<p>a</p>", "x", 0), (1, "u", "", "x", 0), (2, "v", "<p>é", "x", 0),
                                (2, "v", "<p>é", "x", 0), (3, "w", "<p>" + "word, " * 500_000, "x", 0)], schema)
    got = [(r["page_id"], r["url"], r["n_chars"]) for r in extract_pages(df).collect()]
    assert sorted(got, key=str) == sorted([(1, "u", 0), (None, None, 1), (1, "u", 0), (2, "v", 1), (2, "v", 1), (3, "w", 2_999_999)], key=str)
    assert extract_pages(df.limit(0)).collect() == []
