"""Blocks of pages, the labeller against numeric gradients, and articles of held-out pages."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from feedlake.llm import op11_html_extraction as op
from feedlake.llm.block_labeller import Labeller, features
from feedlake.llm.html_blocks import blocks
from feedlake.llm.page_layouts import by_markup, training_pages
from frames import TESTDATA


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_end_where_elements_do():
    assert texts("<p>a <b>b</b>c<p>d<ul><li>e<li>f</ul>g<br>h") == ["a bc", "d", "e", "f", "g h"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("x</p>y</b>z") == ["x", "yz"]
    assert texts("<div><p><b>a<p>b</div>c</section>d") == ["a", "b", "c", "d"]
    assert [b.path for b in blocks("<main><p>a</main><p class='Big-x myAd'>b")] == [("main", "p"), ("p", ".big", ".x", ".my", ".ad")]


def test_what_has_no_text():
    page = "<!doctype html><!-- <p>no --><script>if (a < b) '</p>'</script><STYLE>p{}</STYLE>a<svg><text>no</text></svg>b<!-- rest"
    assert texts(page) == ["ab"]
    assert texts("a<script>never closed <p>x") == ["a"]
    assert texts(None) == texts("") == texts(" \n&nbsp;\t") == []


def test_references_and_white_space():
    assert texts("<p>a &amp; b &lt;i&gt; &#233;&eacute; &am &amp;lt;\n\t c &copy x</p>") == ["a & b <i> éé &am &lt; c © x"]
    assert texts("1 < 2 <3 <p title='>'>x<a href=\"<p>\">y") == ["1 < 2 <3", "xy"]
    assert texts("<p>a<b unclosed") == ["a"]
    assert blocks("<p>ab<a>cd</a></p>")[0].linked == 0.5


def test_hostile_markup_takes_linear_time():
    for piece in ("<a '", '<p "', "<!--", "<", "&", "<b>", "<div>", "</p>"):
        blocks(piece * 5_000)


def test_gradients():
    model = Labeller(3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x = features([blocks(p) for p in ("<title>a b</title><p>a b c.<p>d", "<nav><a>x</a></nav><article>y z</article>z<hr>q", "<p>1")])
    x.measures = x.measures.astype(np.float64)
    y = np.arange(len(x.measures)) % 2.0
    Labeller._read, kept = (lambda self, f: _double(kept, self, f)), Labeller._read
    try:
        loss, grad = model._gradients(x, y)
        r = np.random.default_rng(0)
        for name, g in grad.items():
            busy = np.flatnonzero(np.abs(g.ravel()) > 1e-6)
            for i in r.choice(busy, min(6, len(busy)), replace=False):
                old, step = model.p[name].ravel()[i], 1e-2
                values = []
                for sign in (1, -1):
                    model.p[name].ravel()[i] = old + sign * step
                    values.append(model._gradients(x, y)[0])
                model.p[name].ravel()[i] = old
                assert g.ravel()[i] == pytest.approx((values[0] - values[1]) / (2 * step), rel=0.05, abs=2e-4), name
    finally:
        Labeller._read = kept


def _double(read, model, f):
    return read(model, f).astype(np.float64)


@pytest.fixture(scope="module")
def labeller(spark):
    return op.train(spark.read.parquet(f"{TESTDATA}/sf0.01/pages.parquet"))


def test_laid_out_pages_tell_the_truth():
    pages, truths = training_pages([], 200)
    for page, truth in zip(pages, truths, strict=True):
        assert texts(page) == [t for t, _ in truth]


def test_pages_not_fitted_on(labeller):
    pages = pq.read_table(f"{TESTDATA}/sf0.1/pages.parquet")["html"].to_pylist()[:600]
    wanted = ["\n".join(b.text for b, mine in zip(page, by_markup(page), strict=True) if mine) for page in map(blocks, pages)]
    assert op.main_texts(labeller, pages) == wanted


def test_layouts_not_fitted_on(labeller):
    crawled = [blocks(p) for p in pq.read_table(f"{TESTDATA}/sf0.1/pages.parquet")["html"].to_pylist()[-100:]]
    pages, truths = training_pages(crawled, 300, seed=1234)
    right, whole, n = 0, 0, 0
    for page, truth in zip(pages, truths, strict=True):
        found = labeller.logits(features([blocks(page)])) > 0
        same = found == np.array([mine for _, mine in truth])
        right, whole, n = right + same.sum(), whole + same.all(), n + len(same)
    assert right / n > 0.99 and whole / len(pages) > 0.93


PAGE = """<html><head><title>Big news today</title></head><body>
<div id="cookie-banner"><p>We use cookies to improve this site.</p></div>
<header class="site-header"><h1>My Site</h1><form><label>Search</label></form></header>
<ul class="menu"><li><a href=/>Home</a><li><a href=/a>About us</a></ul>
<div class="content"><h1>Big news today</h1><p>The first thing that happened was long and winding.
<p>The <a href=x>second</a> thing was&nbsp;shorter.<div class="advert"><p>Buy now and save on everything we sell here.</p></div>
<p>It ended well for everyone, as far as is known.</p></div>
<aside><h3>Related articles</h3><a href=1>Older news</a></aside>
<section id="comments"><h3>3 comments</h3><div class="comment"><p>I do not think that this was a good article at all.</p></div></section>
<footer>© 2024 All rights reserved</footer></body></html>"""


def test_a_page_by_hand(labeller):
    assert op.main_texts(labeller, [PAGE])[0].split("\n") == [
        "Big news today",
        "The first thing that happened was long and winding.",
        "The second thing was shorter.",
        "It ended well for everyone, as far as is known.",
    ]


def test_edges(spark, labeller):
    rows = [(1, "u", PAGE, "x"), (None, None, None, "x"), (2, "u", "", "x"), (1, "u", PAGE, "x"), (3, None, "<nav><a>Home</a></nav>", "x")]
    rows.append((4, "u", "<article>" + "".join(f"<p>Paragraph {i} of a very long page.</p>" for i in range(20_000)) + "</article>", "y"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(2)
    got = sorted((r.page_id or 0, r.url, r.n_chars, r.text) for r in op.extract(df, labeller).collect())
    assert [(g[0], g[2]) for g in got[:2]] == [(0, 0), (1, len(op.main_texts(labeller, [PAGE])[0]))] and got[1] == got[2]
    assert got[3][2:] == (0, "") and got[4][0] == 3 and got[4][2] == 0
    assert got[5][3].count("\n") == 19_999 and got[5][2] == len(got[5][3])
    empty = df.where(F.lit(False))
    assert op.extract(empty, op.train(empty, laid_out=5)).collect() == []
