"""Main text: the cut against all labellings, pages of many shapes, awkward rows."""

from __future__ import annotations

import time
from itertools import product

import numpy as np
import pytest

from cratebook.llm import extract

#: Looks say nothing: only markup and neighbours decide.
BLANK = [0.0] * 256

SHAPES = {
    "plain text, no markup &amp; more": "plain text, no markup & more",
    "<p>one<p>two<b>bold</b> x<br>y</p>": "one\n\ntwobold x y",
    "<title>T</title><nav><a href=/>Home</a></nav><article><h1>Head</h1><p>Text &lt;tag&gt;.</article><footer>&copy; x</footer>": "Head\n\nText <tag>.",
    "<article><header><h1>Head</h1></header><p>Text</p><aside>Read also</aside><form>Mail <input></form><p>End</p></article>": "Head\n\nText\n\nEnd",
    "<header><h1>Site</h1></header><main><p>Text</p></main>": "Text",
    "<main><p>Text</p><section id='comments'><h2>2 comments</h2><article class=comment><p>First!</p></article></section></main>": "Text",
    "<div class='cookie-notice'>We use cookies</div><div class=content><p>a</p><p>b</p><div class=adSlot>Buy</div><p>c</p></div>": "a\n\nb\n\nc",
    "<body class='has-sidebar'><div class='sidebar'><div class='content'>side</div></div><div id='mainContent'>text</div></body>": "text",
    "<form id=page><div class=menu>m</div><main><p>text</p></main></form>": "text",
    "<form id=page><article><p>text</p></article></form>": "text",
    "<article>a<script>var t='</p><p>no</p>';</script>b<style>p{}</style><!-- <p>no</p> -->c</article>": "abc",
    "<article><p>a &am <p>1 < 2 and 3 > 2 <p title=\"x > y\">q</p><p data-x='unclosed>z</p>": "a &am\n\n1 < 2 and 3 > 2\n\nq\n\nz",
    "<article><ul><li>one<li>two<ul><li>three</ul><li>four</ul><table><tr><td>x<td>y</table></article>": "one\n\ntwo\n\nthree\n\nfour\n\nx\n\ny",
    "<article><p>kept</p><div hidden>no</div><div style='display: none'>no</div><p aria-hidden=true>no</p><p>also</p></article>": "kept\n\nalso",
    "<article><p>\n a\t b&nbsp;c   d</p><p> </p></article>": "a b c d",
    "<article><textarea>no</textarea><button>no</button><p>yes</p><script>cut off": "yes",
    "<article><p>yes</p><p": "yes",
    "<article>a<!-- open": "a",
    "<!DOCTYPE html><?xml?></ x><article>日本語😀</article>": "日本語😀",
    "<ARTICLE><P CLASS=AD>no</P><P>yes</P></ARTICLE>": "yes",
    "<div class='siteHeader'>Site</div><div class='content has-sidebar'><div class='article-header'><h1>Head</h1></div><p>Text</p></div>": "Head\n\nText",
    "<div class='no-comments main'><p>Text</p><div class='commentlist'><p>First!</p></div></div>": "Text",
    "": "",
    " \n ": "",
    "<nav>only</nav>": "",
}


@pytest.mark.parametrize("page", SHAPES)
def test_shapes(page):
    assert extract.main_text(page, BLANK) == SHAPES[page]


def test_looks_and_neighbours_decide_where_markup_is_silent():
    odds = list(BLANK)
    link = extract.blocks_of("<div><a href=/>Home page</a></div>")[0]
    prose = extract.blocks_of("<p>Some words that end with a full stop.</p>")[0]
    odds[extract.look(link)], odds[extract.look(prose)] = -2.0, 2.0
    short = "<p>Yes</p>"
    page = f"<div><a href=/>Home page</a></div><div>{'<p>Some words that end with a full stop.</p>' + short}</div><div><a href=/>Next pages</a></div>"
    assert extract.main_text(page, odds) == "Some words that end with a full stop.\n\nYes"
    # A block slightly against content is kept between two that are content, and lost elsewhere.
    odds[extract.look(extract.blocks_of(short)[0])] = -0.5
    assert "Yes" in extract.main_text(page.replace(short, short + "<p>Some words that end with a full stop.</p>"), odds)
    assert extract.main_text("<div><a href=/>Home page</a></div>" + short, odds) == ""


def test_min_cut_equals_the_best_of_all_labellings():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 10))
        odds = rng.integers(-6, 7, n).tolist()
        edges = {(a, b): int(rng.integers(1, 6)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.4}

        def cost(side, odds=odds, edges=edges):
            own = sum(max(o, 0) if not s else max(-o, 0) for o, s in zip(odds, side, strict=True))
            return own + sum(c for (a, b), c in edges.items() if side[a] != side[b])

        sides = list(product((False, True), repeat=n))
        least = min(map(cost, sides))
        largest = [any(s[v] for s in sides if cost(s) == least) for v in range(n)]
        assert extract.min_cut(odds, edges) == largest


def test_long_pages_take_time_in_proportion():
    rng = np.random.default_rng(1)
    odds = rng.uniform(-2, 2, 256).tolist()
    page = "".join(f"<div><p>{'word ' * int(k)}</p>{'<a href=/>x</a>' * int(k % 3)}</div>" for k in rng.integers(1, 60, 20000))
    start = time.time()
    assert extract.main_text(page, odds)
    assert extract.main_text('<a b="' * 20000 + "<p" * 20000, odds) is not None
    assert extract.main_text("<div>" * 50000 + "deep" + "</p>" * 50000, odds) == "deep"
    assert time.time() - start < 30


def test_rows(spark):
    pages = [*SHAPES, "<nav>only</nav>", None, "<article><p>" + "long text, " * 200000 + "</article>"]
    schema = "html string, page_id long, url string, text string, n_chars string, id int, `a.b` int"
    rows = [(p, k if k % 5 else None, f"u{k}" if k % 7 else None, "x", "y", 1, 2) for k, p in enumerate(pages)]
    df = spark.createDataFrame(rows, schema)
    got = extract.main_texts(df, BLANK)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = [(r[1], r[2], t := extract.main_text(r[0] or "", BLANK), len(t)) for r in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    odds = extract.fit(df)
    assert len(odds) == 256 and odds[extract.look(extract.blocks_of(pages[-1])[0])] > 0 > odds[extract.look(extract.blocks_of("<nav>only</nav>")[0])]
    assert extract.main_texts(df.where("false"), extract.fit(df.where("false"))).count() == 0


def test_given_pages(spark, small):
    """The looks learned from these pages tell content from boilerplate without any markup."""
    pages = spark.read.parquet(f"{small}/pages.parquet")
    odds = extract.fit(pages)
    right = total = 0
    for (page,) in pages.select("html").collect():
        for block in extract.blocks_of(page):
            total += 1
            right += (odds[extract.look(block)] > 0) == (block[5] > 0)
    assert right / total > 0.9
