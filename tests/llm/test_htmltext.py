"""Blocks of pages, the network's gradient, labels on unseen pages and layouts, edge cases."""

import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from dailylake.llm import htmltext as H

SF = "/root/testdata/sf0.01"
STORY = [
    "The river rose quickly after three days of rain, and the town council closed the old bridge on Monday.",
    "Engineers said that the stone arches were sound, but that debris had piled up against the central pier.",
    "Shops on the east bank reported fewer visitors. One owner said she had sold two loaves all morning.",
    "The forecast is for dry weather until Friday.",
]
P = "".join(f"<p>{t}</p>" for t in STORY)
#: Pages in layouts of their own, and the text to be found.
PAGES = {
    "blog": (
        "<html><head><title>x</title><style>p{}</style></head><body class='home blog'><div id='page'><header id='masthead' class='site-header'><a href='/'>River Times</a>"
        "<p class='site-description'>News from the valley, every day.</p><nav id='site-navigation'><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav></header>"
        f"<main id='main'><article class='post-12 post'><header class='entry-header'><h1>Bridge closed</h1></header><div class='entry-content'>{P}</div></article>"
        "<div id='comments' class='comments-area'><h2>2 thoughts on this</h2><ol class='comment-list'><li><p>I crossed it on Sunday and it felt quite shaky to me, to be honest.</p></li></ol></div></main>"
        "<aside id='secondary' class='widget-area'><h2>Recent Posts</h2><ul><li><a href='/a'>Market moves indoors</a></li></ul></aside><footer id='colophon'><p>Powered by pens</p></footer></div></body></html>"),
    "divs": (
        "<body><div class='cookie-bar'>We use cookies to give you the best experience. <button>OK</button></div><div class='nav'><a href=a>Home</a> <a href=b>World</a></div>"
        f"<div class='article'><h2>Bridge closed</h2>{P.replace('</p>', '')}</div><div class='comments'><p>I crossed it on Sunday and it felt shaky.<p>They should have cleared it.</div>"
        "<form action=/s><label>Search the archive</label><input><p>Find any story since 1950.</p></form><div class='footer'>Copyright 2021 River Times. All rights reserved.</div></body>"),
    "bare": f"<h2>Bridge closed</h2>{P}",
}


@pytest.fixture(scope="module")
def weights(spark):
    return H.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def texts(page):
    return [b.text for b in H.blocks(page)]


def read(page, w):
    found = H.blocks(page)
    return [b.text for b, main in zip(found, H.label([H.inputs(found, w)], w)[0]) if main]


def test_blocks():
    assert texts("") == [] and texts(" \n ") == [] and texts("plain  text") == ["plain text"]
    assert texts("<p>a<b>b</b> c<br>d<p>e\n\t f&nbsp;g</p>h") == ["ab c d", "e f g", "h"]
    assert texts("<p>&lt;p&gt; &amp;amp; &#233;&eacute &am &#x1F600;</p>") == ["<p> &amp; éé &am \U0001f600"]
    assert texts('<p title="a > b">x</p><p class=it\'s>y</p><a href=\'>\'>z</a>') == ["x", "y", "z"]
    assert texts('<script>var t="</p>";</script>a<!-- <p>no</p> -->b<style>c</style><STYLE >d</style >e<noscript>f</noscript>') == ["abe"]
    assert texts("a < b <3 </> c</ d>e<!DOCTYPE x><?xml y?>f") == ["a < b <3 cef"]
    assert texts("x<script>never closed <p>y") == ["x"] and texts("x<!-- open <p>y") == ["x"] and texts("x<p clas") == ["x"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul>d</ul>e</div></p>f") == ["a", "b", "c", "d", "e", "f"]
    assert texts("<div>a<button>b</button>c<select><option>d<option>e</select>f</div>") == ["a", "c", "f"]
    assert texts("<table><tr><td>a<td>b<tr><th>c</table><dl><dt>d<dd>e</dl><h1>f<h2>g<hr>h") == list("abcdefgh")


def test_paths_and_links():
    a, b = H.blocks("<div class='Side-bar x1'><p>t <a href=u>link</a></div><p>u")
    assert set(a.path) == {H._slot("tag", "div", H.PATH_SLOTS), H._slot("tag", "p", H.PATH_SLOTS), *(H._slot("name", n, H.PATH_SLOTS) for n in ("side", "bar", "x", "1"))}
    assert abs(a.linked - 4 / 5) < 1e-9 and a.tag == "p" and b.path == (H._slot("tag", "p", H.PATH_SLOTS),) and b.linked == 0


def test_deep_and_long_pages(weights):
    deep = H.blocks("<div>" * 50_000 + "x" + "</div>" * 50_000 + "y")
    assert [b.text for b in deep] == ["x", "y"] and len(deep[0].path) == H.PATH_MARKS
    long = "<nav><ul><li><a href=/>Home</a></ul></nav><article>" + P * 10_000 + "</article><footer>All rights reserved.</footer>"
    assert read(long, weights) == STORY * 10_000


@pytest.mark.parametrize("way", ["ahead", "back"])
def test_gradient_equals_differences(way):
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in H.initial(rng).items()}
    x, aim = rng.normal(size=(5, 3, 2 * H.VECTOR + H.MEASURES)), rng.normal(size=(5, 3, H.HIDDEN))
    states, backward = H.lstm_gradient(x, w, way)
    assert np.allclose(H.lstm(x, w, way), states, atol=1e-5)
    dx, grad = backward(aim)
    loss = lambda: float((H.lstm_gradient(x, w, way)[0] * aim).sum())
    for name, part, g in [("x", x, dx), *((k, w[k], grad[k]) for k in grad)]:
        for at in [tuple(rng.integers(0, n) for n in part.shape) for _ in range(6)]:
            kept = part[at]
            part[at] = kept + 1e-3
            up = loss()
            part[at] = kept - 1e-3
            down = loss()
            part[at] = kept
            assert abs((up - down) / 2e-3 - g[at]) < 1e-3, (name, at)


def test_labels_do_not_depend_on_the_batch(weights):
    rng = random.Random(2)
    pages = [H.inputs(H.blocks(H.lay_out(rng, STORY[:rng.randint(1, 4)], STORY)), weights) for _ in range(40)] + [np.zeros((0, 2 * H.VECTOR + H.MEASURES), np.float32)]
    together = H.label(pages, weights)
    assert all((a == H.label([p], weights)[0]).all() for a, p in zip(together, pages))


def test_unseen_layouts(weights):
    """Layouts of another seed with text that the fit hasn't seen: nearly all blocks are right."""
    rng, good, n = random.Random(99), 0, 0
    for _ in range(200):
        page = H.blocks(H.lay_out(rng, STORY[:rng.randint(1, 4)], STORY), marked=True)
        got = H.label([H.inputs(page, weights)], weights)[0]
        good += sum(bool(b.main) == bool(g) for b, g in zip(page, got))
        n += len(page)
    assert n > 2000 and good / n > 0.97


@pytest.mark.parametrize("name", PAGES)
def test_other_sites(weights, name):
    got = read(PAGES[name], weights)
    assert [t for t in got if t not in STORY] in ([], ["Bridge closed"]) and [t for t in got if t in STORY] == STORY


def test_registered_query_equals_the_articles(spark):
    """The generated pages mark their articles; the labeller isn't told which of the tags counts."""
    def article(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", inner)
        cut = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in parts]
        return "\n\n".join(x for x in cut if x)

    rows = H.main_text(spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    wrong = [r["page_id"] for r in rows if r["text"] != article(pages[r["page_id"]])]
    assert len(rows) == len(pages) and len(wrong) <= 1, wrong
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_odd_rows(spark, weights):
    rows = [(1, "u", None), (None, None, ""), (2, "v", "<nav><a href=/>Home</a></nav>"), (3, None, f"<article>{P}</article>"), (3, None, f"<article>{P}</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("blocks", F.lit(1))
    got = sorted((tuple(r) for r in H.extract(df, weights).collect()), key=str)
    story = "\n\n".join(STORY)
    assert got == sorted([(1, "u", ""), (None, None, ""), (2, "v", ""), (3, None, story), (3, None, story)], key=str)
    assert H.extract(df.limit(0)).count() == 0
    assert H.extract(df.where("page_id = 1")).collect()[0]["text"] == ""
