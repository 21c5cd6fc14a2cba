"""Main text against plain forms of the given pages and against written pages."""

import html
import random
import re

import numpy as np
import pytest

from lakestrata.llm import html_text
from lakestrata.llm.html_text import Lines, main_text, smoothed

from .helpers import rows_of

PAGES = "page_id long, url string, html string"
SF_DIR = "/root/testdata/sf0.001"


def plain(page):
    """The text of the only article of a given page, by its own tags."""
    article = re.search(r"<article>(.*)</article>", page, re.DOTALL).group(1)
    blocks = re.split(r"<h1>|</h1>|<p>|</p>", article)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r["page_id"]: r for r in rows_of(html_text.extract(pages))}
    rows = rows_of(pages)
    assert len(got) == len(rows)
    for r in rows:
        found = got[r["page_id"]]
        assert found["text"] == plain(r["html"])
        assert (found["url"], found["n_chars"]) == (r["url"], len(found["text"]))


LONG = "A sentence of the article that is long enough to be told from a menu. " * 4
SHORT = "Short."
BEFORE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="has-sidebar"><header><a href=/>Site</a></header><nav><ul><li><a href=/a>Menu</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to do many things that nobody wants to read about here.</p></div>"""
AFTER = """<aside><p>An aside about something else, quite long too, as asides can be now and then.</p></aside>
<form><p>Your name</p><input name=x><textarea>typed</textarea><button>Send</button></form>
<div id="comments"><h2>2 Comments</h2><p>I have read all of this and I do not agree with any of it at all.</p></div>
<div class="adSlot"><p>Buy this now, it is cheap and it is good and you need it.</p></div>
<footer>&copy; 2023 Site</footer><script>track(1)</script></body></html>"""


@pytest.mark.parametrize(
    ("start", "end"),
    [
        ("<article>", "</article>"),
        ("<main>", "</main>"),
        ("<div class='content'>", "</div>"),
        ("<div class='page-wrap'><div><article class='post hentry'>", "</article></div></div>"),
        ("<main><article>", "</article></main>"),
        ("<form id=all><article>", "</article></form>"),
        ("<div class='no-sidebar'><section>", "</section></div>"),
        ("", ""),
    ],
)
def test_layouts(start, end):
    body = f"<h1>Head &amp; line</h1><p>{LONG}<p>{SHORT}</p><ul><li>one<li>two  <b>bold</b>\n x</ul><p>{LONG}</p>"
    want = "\n\n".join(["Head & line", LONG.strip(), SHORT, "one", "two bold x", LONG.strip()])
    assert main_text(BEFORE + start + body + end + AFTER) == want


def test_parts_within_an_article():
    page = f"""<article><header><h1>Head</h1><p>By someone</p></header><p>{LONG}</p>
    <div class="share-buttons">Share</div><figure><img src=x><figcaption>Caption</figcaption></figure>
    <p hidden>no</p><p style="display: none">no</p><div role="complementary">no</div><!-- no --><svg><text>no</text></svg>
    <blockquote><p>Quote<br>two&nbsp;&#8212;&lt;i&gt;</p></blockquote><pre>a
      b</pre><table><tr><td>c<td>d<tr><th>e</table>
    <section><h3>Comments (12)</h3><p>reader</p><div>reader</div></section><footer>no</footer></article>
    <article class="related"><p>{LONG}{LONG}</p></article>"""
    want = ["Head", LONG.strip(), "Caption", "Quote two —<i>", "a b", "c d", "e"]
    assert main_text(page) == "\n\n".join(want)


def test_an_article_that_is_short_among_long_comments():
    page = f"<body><article><p>{SHORT}</p></article><div>{LONG * 9}</div>"
    assert main_text(page) == SHORT


def test_several_articles_and_a_larger_one():
    cards = "".join(f"<article><p>{LONG}</p></article>" for _ in range(3))
    assert main_text(f"<main>{cards}</main>").count(LONG.strip()) == 3
    assert main_text(f"<body><article><p>{LONG * 9}</p></article>{cards}") == (LONG * 9).strip()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("  \n ", ""),
        ("plain  words", "plain words"),
        ("<title>only</title>", ""),
        ("<p>a</p><![if x]><![CDATA[y]]><!bad><?pi x><p>b", "a\n\nb"),
        ("<p>cut &am", "cut &am"),
        ("<p>cut <a href='x", "cut"),
        ("<p>&#0;&#xD800;&notin;&unknown;", "��∉&unknown;"),
        ("</p></div></article>x</body>y", "xy"),
        ("<p>a<b>b<p>c</b>d", "ab\n\ncd"),
        ("<div><p>a</div>b", "a\n\nb"),
        ("<br/><p/>a<custom-tag>b</custom-tag>", "ab"),
    ],
)
def test_difficult_pages(page, text):
    assert main_text(page) == text


def test_nothing_in_an_article_is_dropped():
    rng = random.Random(4)
    for _ in range(100):
        blocks = [" ".join(rng.choices(["ab", "c", "defg", "é"], k=rng.choice([1, 2, 3, 80]))) for _ in range(rng.randrange(1, 30))]
        page = BEFORE + "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>" + AFTER
        assert main_text(page) == "\n\n".join(blocks)


def test_very_long_and_deep_pages():
    assert main_text(BEFORE + f"<article><p>{'word ' * 400_000}</p></article>").count("word") == 400_000
    assert main_text("<article>" + "<div>" * 20_000 + "deep" + "</div>" * 20_000 + "<p>end") == "deep\n\nend"
    assert len(main_text("<p>x" * 50_000).split("\n\n")) == 50_000


def test_ratios():
    assert smoothed(np.array([7.0])).tolist() == [7.0]
    assert np.allclose(smoothed(np.full(9, 3.0)), 3.0)
    page = Lines()
    page.feed("<div><a href=x>1</a> <b>2</b></div><p>345")
    page.close()
    page.line()
    assert (page.texts, page.tags, page.links) == (["1 2", "345"], [6, 1], [1, 0])


def test_rows(spark):
    rows = [(1, "u", f"<article>{LONG}</article>"), (1, "u", f"<article>{LONG}</article>"), (None, None, None), (2, None, "")]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS text", "2 AS n_chars")
    got = sorted((tuple(r.values()) for r in rows_of(html_text.extract(pages))), key=repr)
    said = LONG.strip()
    assert got == sorted([(1, "u", said, len(said))] * 2 + [(None, None, "", 0), (2, None, "", 0)], key=repr)
    assert html_text.extract(pages.limit(0)).count() == 0
