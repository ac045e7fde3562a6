import html
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamarack.llm.maintext import main_text, with_main_text
from tamarack.llm.queries import op13_html_extraction


def of_template(page):
    """The article of the tables' pages, which have one template, by its tags."""
    inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)[1]
    parts = re.sub(r"</?(?:p|h1)>", "\x01", inner).replace("<br>", " ")
    texts = (" ".join(html.unescape(re.sub("<[^>]*>", "", t)).split()) for t in parts.split("\x01"))
    return "\n".join(t for t in texts if t)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_query_on_the_tables(spark, folder):
    folder = f"/root/testdata/{folder}"
    got = op13_html_extraction(spark, folder)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, of_template(pages[r.page_id].html), len(r.text))


LONG = "This sentence is a part of the article, and there are words enough in it to be told from a menu. "
AROUND = [
    ("<nav><a href=/a>Home</a> <a href=/b>News</a></nav>", "<footer>Imprint and terms</footer>"),
    ("<div id='top-menu'><ul><li><a href=1>one<li><a href=2>two</ul></div>", "<div class='siteFooter'>All rights reserved</div>"),
    (f"<header><h1>The Site</h1></header><aside>{LONG}</aside>", f"<section id=comments><article class=comment><p>{LONG}<p>{LONG}</article></section>"),
    (f"<div class='cookie-notice'>{LONG}</div>", f"<form action=x><label>{LONG}</label><input name=q><select><option>{LONG}</select></form>"),
    (f"<!-- {LONG} --><script>var a = '<p>{LONG}</p>';</script>", f"<style>p > a {{}}</style><noscript>{LONG}</noscript><div hidden>{LONG}</div>"),
    (f"<div role='navigation'>{LONG}</div><div style='display: none'>{LONG}</div>", "<ul>" + "<li><a href='x'>Some other story of the day</a></li>" * 9 + "</ul>"),
]
ARTICLES = [
    (f"<article><h1>A title</h1><p>{LONG}<p>Short.</p><p>{LONG}{LONG}</article>", f"A title\n{LONG}\nShort.\n{LONG}{LONG}"),
    (f"<main class='page with-sidebar'><div><h1>A <i>title</i></h1></div><div><p>{LONG}</p><ul><li>{LONG}<li>two</ul><p>{LONG}</p></div></main>", f"A title\n{LONG}\n{LONG}\ntwo\n{LONG}"),
    (f"<div id=wrap><div class=content><section><h2>One</h2><p>{LONG}</p><p>{LONG}</p></section><section><h2>Two</h2><p>{LONG}</p><p>{LONG}</p></section></div></div>", f"One\n{LONG}\n{LONG}\nTwo\n{LONG}\n{LONG}"),
    (f"<div><p>{LONG}<b>bold <a href=x>a link</b></a> &amp; more &lt;tags&gt; caf&eacute;&nbsp;x<br>line<table><tr><td>cell {LONG}<td>next</table></div>", f"{LONG}bold a link & more <tags> café x line\ncell {LONG}\nnext"),
]


@pytest.mark.parametrize("before, after", AROUND)
@pytest.mark.parametrize("article, text", ARTICLES)
def test_layouts(before, after, article, text):
    page = f"<!DOCTYPE html><html><head><title>Title</title><body class='post no-sidebar'>{before}{article}{after}</body></html>"
    assert main_text(page) == "\n".join(" ".join(t.split()) for t in text.split("\n"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad", "'>", '"', "<a href=x>", "</a>", "<!--", "-->", "<script>", "</script>", "<b", ">", "</", "<td>", "&amp", "&#x;", "word ", "<li>", "</ul>", "<article>", "</div>", "<![CDATA[", "<?x", "é "]), max_size=40))
def test_broken_markup(parts):
    text = main_text("".join(parts))
    assert all(line and line == " ".join(line.split()) for line in text.split("\n")) or text == ""


def test_long_pages_take_no_more_time_a_byte():
    for part in ("<div>", "<b>", "<p><i>x", "<a title='", "<!-- ", "</b>", "<b><p>x</b>", "<li>x<ul>", "&", "<"):
        started = time.time()
        main_text(part * (200_000 // len(part)))
        assert time.time() - started < 8


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p></p>"), (None, "u", "plain text"), (4, "u", f"<p>{LONG * 20_000}"), (4, "u", f"<p>{LONG * 20_000}")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_text", F.lit("clash")).withColumn("text", F.lit(1))
    got = with_main_text(pages)
    assert got.columns == ["page_id", "url", "html", "text", "_text"]
    assert sorted((r.page_id or 0, r._text) for r in got.collect()) == [(0, "plain text"), (1, ""), (2, ""), (3, ""), *[(4, (LONG * 20_000).strip())] * 2]
