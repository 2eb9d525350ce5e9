from __future__ import annotations

import html
import re
import time

import pyarrow.parquet as pq
import pytest

from chainfold.llm.html_text import extract, main_text
from tests.conftest import CHECK_DIR

LONG = "This paragraph is long enough to be the body of a page, and it goes on for a while without any link in it."


def test_supplied_pages_against_their_article(spark):
    pages = spark.read.parquet(f"{CHECK_DIR}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    rows = pq.read_table(f"{CHECK_DIR}/pages.parquet").to_pylist()
    assert len(got) == len(rows)
    for row in rows:
        body = row["html"].split("<article>", 1)[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:h1|p|br)>", body)]
        assert got[row["page_id"]] == " ".join(b for b in blocks if b)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain  words\n only", "plain words only"),
        ("<p>a<p>b<script>if (a < b) x('</p>')</script>c", "a bc"),
        ("<article><header><h1>T</h1></header><p>x &amp;&lt;y&nbsp;z</p><aside>no</aside><div class='share-bar'>no</div></article><p>no</p>", "T x &<y z"),
        (f"<nav>menu menu</nav><div id=content><p>{LONG}</p><p>short<br>line</p></div><section class='comments'><p>{LONG}</p></section><footer>f</footer>", f"{LONG} short line"),
        (f"<ul><li><a href=x>one</a><li><a href=y>two</a></ul><p>{LONG}</p><p class=cookieNotice>{LONG}</p><form><p>{LONG}</p></form>", LONG),
        (f"<head><title>no</title><body><main><p>{LONG}</p></main><p>{LONG} no</p>", LONG),
        (f"<!-- <p>no</p> --><style>p{{}}</style><p hidden>no</p><div role=navigation>no</div><p>{LONG}</p><noscript>no</noscript>", LONG),
        ("<article><p>one</p></article><p>out</p><article><p>two</p></article>", "one two"),
        ("<p>unclosed <b>bold", "unclosed bold"),
        ("a < b and c > d &unknown; &#x41;", "a < b and c > d &unknown; A"),
        (f"<div class='side-by-side'><p>{LONG}</p></div><p>short</p>", f"{LONG} short"),
        (f"<div id='legal-news'><p>{LONG}</p></div><div class='legal-notice'>{LONG}</div>", LONG),
        (f"<p>{LONG}</p><p><a href=x>A paragraph of the article that is one link.</a></p><p>{LONG}</p>", f"{LONG} A paragraph of the article that is one link. {LONG}"),
        (f"<p>{LONG}</p><div class=share-bar>no</div><p>the short end</p>", f"{LONG} the short end"),
        (f"<ul><li><a href=a>one</a><li><a href=b>two</a></ul><p>{LONG}</p><ul><li><a href=a>one</a><li><a href=b>two</a></ul>", LONG),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_long_page_and_many_open_tags():
    page = "<div>" * 3000 + "<p>" + "word " * 200_000 + "</p>"
    assert len(main_text(page)) == 5 * 200_000 - 1
    assert main_text("<a " * 20_000).startswith("<a")
    started = time.monotonic()
    for broken in ("<div>" * 20_000 + "</x>" * 20_000, "<head>" * 20_000, "<b><i>" * 10_000 + "</b></u>" * 10_000, "<style>a</style>" * 20_000):
        assert main_text(broken + "<p>end") == "end"
    assert time.monotonic() - started < 10


def test_columns_and_empty_table(spark):
    rows = [(1, "u", "<p>x</p>", "old"), (1, "u", "<p>x</p>", "old"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, "u", "x"), (1, "u", "x"), (None, None, "")], key=repr)
    assert extract(pages.limit(0)).collect() == []


def test_supplied_pages_without_the_article_tag():
    for row in pq.read_table(f"{CHECK_DIR}/pages.parquet").to_pylist():
        page = row["html"]
        assert "<article>" in page
        assert main_text(page.replace("<article>", "<div>").replace("</article>", "</div>")) == main_text(page)


def test_article_elements_that_are_teasers_or_quotes():
    teasers = "".join(f"<article><a href=x{i}>Teaser number {i} with a line of text</a></article>" for i in range(8))
    body = f"<div><p>{LONG} One.</p><p>{LONG} Two.</p><p>{LONG} Three.</p></div>"
    assert main_text(teasers + body) == f"{LONG} One. {LONG} Two. {LONG} Three."
    plain = "".join(f"<article><p>Teaser number {i} without a link</p></article>" for i in range(8))
    assert f"{LONG} One. {LONG} Two. {LONG} Three." in main_text(plain + body)
    quoted = f"<div><p>{LONG} One.</p><article><p>A quoted post</p></article><p>{LONG} Two.</p></div>"
    assert main_text(quoted) == f"{LONG} One. A quoted post {LONG} Two."


def test_regions_against_a_plain_version():
    """Surge and dive points of the windows' sums, by trying every stretch."""
    import random

    from chainfold.llm.html_text import WINDOW, regions_of

    rnd = random.Random(3)
    for _ in range(300):
        sizes = [rnd.choice([0, 0, 0, 5, 60]) for _ in range(rnd.randint(0, 25))]
        counted = [i for i, n in enumerate(sizes) if n]
        groups: list[list[int]] = []
        for i in counted:
            if groups and i - groups[-1][-1] <= WINDOW:
                groups[-1].append(i)
            else:
                groups.append([i])
        sums = {i: sum(sizes[i : i + WINDOW]) for i in range(len(sizes))}
        want = [(g[0], g[-1] + 1, max(sums[i] for i in range(max(0, g[0] - WINDOW + 1), g[-1] + 1))) for g in groups]
        assert regions_of(sizes) == want
