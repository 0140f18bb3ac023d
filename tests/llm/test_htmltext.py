"""HTML extraction: marginals against enumeration, unseen labelled pages, the test pages, odd markup."""

import html
import itertools
import re

import numpy as np
import pytest

from geoloom.llm import htmltext

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return htmltext.trained()


def test_marginals_are_exact():
    r = np.random.default_rng(0)
    parent, kind = np.array([-1, 0, 0, 1, 1, 2, -1, 6]), np.array([2, 0, 1, 3, 0, 0, 2, 1])
    levels = [np.array([1, 2, 7]), np.array([3, 4, 5])]
    u, pair = r.normal(size=8), r.normal(size=(4, 2, 2))
    weights = np.zeros((8, 2))
    for y in itertools.product((0, 1), repeat=8):
        w = np.exp(sum(u[i] * y[i] for i in range(8)) + sum(pair[kind[i], y[parent[i]], y[i]] for i in range(8) if parent[i] >= 0))
        for i in range(8):
            weights[i, y[i]] += w
    belief, edge = htmltext.marginals(u, pair, parent, kind, levels)
    assert np.allclose(belief, weights / weights.sum(axis=1, keepdims=True))
    assert np.allclose(edge[1:6].sum(axis=1), belief[1:6])


def test_unseen_labelled_pages(model):
    pages = htmltext.labelled_pages(150, seed=99)
    right = total = 0
    for s in pages:
        p = htmltext.parse(s)
        kept = set(htmltext.texts([re.sub(r' data-y="."', "", s)], model)[0].split("\n"))
        for node, text, _ in p.blocks:
            total += 1
            right += (text in kept) == p.label[node]
    assert right / total > 0.97, right / total


def expected(source):
    body = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(b for b in blocks if b)


def test_pages_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r.page_id: expected(r.html) for r in pages.collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in htmltext.extracted(pages).collect()}
    wrong = [k for k in want if got[k] != (want[k], len(want[k]))]
    assert not wrong, (len(wrong), want[wrong[0]][:300], got[wrong[0]][0][:300])


def test_odd_rows(spark, model):
    rows = [(1, "u", None), (1, "u", ""), (None, None, "<"), (3, "u", "<p>a < b &lt; c"), (4, "u", "<div " * 3000), (5, "u", "<body><nav>menu</nav><article><h1>Some title of it</h1><p>x&nbsp;&amp; y<br>z<script>if(a<b){}</script> w is what it says.<p>The next one follows here.</article>"), (6, "u", "<!-- open"), (7, "u", "<ul>" * 400 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as text", "1 as n_chars")
    got = [(r.page_id, r.text) for r in htmltext.extracted(df, model).collect()]
    assert len(got) == len(rows) and got[0][1] == got[1][1] == ""
    assert dict(got)[5] == "Some title of it\nx & y z w is what it says.\nThe next one follows here."
    assert htmltext.extracted(df.limit(0), model).count() == 0
