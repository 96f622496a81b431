"""Main text of pages: the given ones against a retelling of how they are made, and odd ones by hand."""

from __future__ import annotations

import html
import re
import time

import pytest

from turnmill.llm import main_text, queries
from turnmill.llm.main_text import extract
from turnmill.plans.inputs import table

FOLDER = "/root/testdata/sf0.01"


def plain(page):
    """The blocks of the article of a given page."""
    body = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    blocks = [html.unescape(re.sub(r"</?b>|<br>", " ", b)) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(" ".join(b.split()) for b in blocks if b.strip())


def test_given(spark):
    pages = {r.page_id: r.html for r in table(spark, FOLDER, "pages").collect()}
    found = queries.op11_main_text(spark, FOLDER).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.text == plain(pages[r.page_id]) and r.n_chars == len(r.text)


LONG = "This is a sentence of the article that goes on for quite some time, as sentences of articles do. "
CASES = {
    "furniture around and inside an article": (
        "<html><head><title>T</title><script>if (a<b) {'</p>'}</script></head><body class='has-ads'>"
        "<header><h1>Site</h1><nav><a href=/>Home</a></nav></header><div class=cookie-notice>We use cookies. " + LONG + "</div>"
        "<div class='layout with-sidebar'><main><article><header><h1>Title</h1></header><p>One.<div class='ad'>Buy " + LONG + "</div>"
        "<p>Two <b>bold</b><span class=share>Share</span> text&nbsp;&eacute;&#233;&lt;<br>on.</p><form><label>Mail</label><input>"
        "<button>Send</button></form><ul><li>a<li>b</ul><footer>Posted</footer></article>"
        "<section id='comments'><article><p>" + LONG + LONG + LONG + LONG + "</p></article></section></main>"
        "<aside><p>" + LONG + "</p></aside></div><footer>&copy; me</footer></body></html>",
        "Title\n\nOne.\n\nTwo bold text éé< on.\n\na\n\nb",
    ),
    "no article": (
        "<body><div class=menu><a href=/a>A</a></div><div><a href=/b>B and some more words</a> <a href=/c>C and more</a></div>"
        f"<div id=content><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div><div><div>Short words.</div></div></div>"
        "<div><form>Search</form></div></body>",
        f"Title\n\n{LONG.strip()}\n\nShort.\n\n{LONG.strip()}",
    ),
    "short page": ("<p>Hi.</p>", "Hi."),
    "plain text": ("a < b &amp; c\n\n d", "a < b & c d"),
    "breaks off in a tag": (f"<article><p>{LONG}</p><p>End<a href='x", f"{LONG.strip()}\n\nEnd"),
    "breaks off in a comment": ("<p>One<!-- two", "One"),
    "breaks off in a reference": ("<p>One &am", "One &am"),
    "menu that is never closed": (f"<nav><ul><li><a>Home</a></ul><article><p>{LONG}</article>", LONG.strip()),
    "head that is never closed": ("<html><head><title>x</title><p>One", "One"),
    "main": (f"<div>{LONG}</div><main><p>One</p></main>", "One"),
    "table": ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b\n\nc"),
    "quotes in attributes": ("<article><p data-x=it's title='a>b' x=\"c>d\">One</p><p x=\"a>Two</p></article>", "One\n\nTwo"),
    "bold across blocks": ("<article><b><p>One</b> two</p><p>Three</p></article>", "One two\n\nThree"),
    "only furniture": ("<nav>Home</nav><footer>Foot</footer><script>x</script>", ""),
    "two articles": (f"<article><p>{LONG}</p></article><article class=ad>{LONG}</article><article><p>{LONG}!</p></article>",
                     f"{LONG.strip()}\n\n{LONG}!"),
    "null": (None, ""), "empty": ("", ""), "blank": (" \n\t ", ""), "markup": ("<p><br></p><!---->", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    page, want = CASES[name]
    assert extract(page) == want


def test_column(spark):
    """Null, empty and repeated rows, and columns whose names the operator might use."""
    rows = [(i, p, "x", 1) for i, (p, _) in enumerate(CASES.values())]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "page_id long, html string, text string, run int").repartition(3)
    out = df.select("*", main_text.main_text(df["html"]).alias("found")).collect()
    assert len(out) == len(rows)
    assert all(r.found == extract(r.html) and r.text == "x" and r.run == 1 for r in out)
    empty = df.where("page_id < 0")
    assert empty.select(main_text.main_text(empty["html"]).alias("found")).collect() == []


@pytest.mark.parametrize("part", ["<div>a", "<a ", "</p>", "<b>", "<p class='ad", "<a href='", "<!--", "&amp", "<ul><li>x", "<", "<b><p></b>",
                                  "<article>", "<table><tr><td>", "word "])
def test_very_long(part):
    """Time in proportion to the length."""
    start = time.time()
    extract(part * 60_000)
    assert time.time() - start < 20
