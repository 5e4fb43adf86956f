import html
import re
import time

import pytest
from pyspark.sql import functions as F

from sozmill.llm import extraction
from sozmill.llm.dom import assemble, parse


def all_text(source):
    page = parse(source)
    return assemble(page, [not h for h in page.hidden])


@pytest.mark.parametrize("source, text", [
    ("<p>a<p>b", "a b"), ("<p>a<b>b</b>c", "abc"), ("a<br>b", "a b"), ("<p>a &amp;lt; &copy;&nbsp;x</p>", "a &lt; © x"),
    ("<script>var t='</p>';</script>x<style>p{}</style>", "x"), ("<!-- <p>no</p> -->y", "y"), ("<p>a < b</p>", "a < b"),
    ("<p title='>'>q</p>", "q"), ("<ul><li>1<li>2</ul>3", "1 2 3"), ("<p>end <a hre", "end"), ("<P>up</P>", "up"),
    ("<div>a<p>b</div>c", "a b c"), ("</p></div>z", "z"), ("<td>1<td>2<tr><td>3", "1 2 3"), ("", ""),
    ("<textarea><p>t</p></textarea>v<title>w</title>", "v"), ("<p>tail &am", "tail &am"), ("<p a=\"x>y", ""),
    ("<i>a</i> <i>b</i>", "a b"), ("<head><meta></head><body>k", "k"), ("a<hr>b<img>c", "a b c"),
])
def test_parser(source, text):
    assert all_text(source) == text


@pytest.mark.parametrize("source, blocks", [
    ("<div>" * 200_000, 200_001), ("</div>" * 160_000, 1), ("<p>" * 300_000, 300_001), ("<td></p>" * 120_000, 120_001),
    ("<div>" * 50_000 + "</span></p></ul>" * 50_000, 50_001), ("<p title='" * 100_000, 1), ("<!--" * 250_000, 1),
    ("<li><ul>" * 100_000, 200_001), ("&amp;<b>" * 100_000, 1),
])
def test_a_megabyte_of_tags(source, blocks):
    begun = time.perf_counter()
    page = parse(source)
    assemble(page, [True] * len(page.tag))
    assert time.perf_counter() - begun < 10 and len(page.tag) == blocks


def test_references_end_at_tags():
    assert all_text("&am<b>p;</b> x &lt<i>;</i> &am<!-- -->p; &amp;<b>lt;</b>") == "&amp; x <; &amp; &lt;"


def article(source):
    body = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1]
    body = re.sub(r"</?(p|h1|br)\b[^>]*>", " ", body)
    return " ".join(html.unescape(re.sub(r"<[a-zA-Z/][^>]*(>|$)", "", body)).split())


def test_pages(session):
    pages = session.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = extraction.extract(pages.withColumn("given", F.col("html")), extraction.fit(pages)).collect()
    assert len(rows) == pages.count()
    for row in rows:
        assert row.text == article(row.given)
        assert row.n_chars == len(row.text)


UNSEEN = """<html><body><div class="site-header">The Site<ul><li><a href="/">Home</a></li></ul></div>
<div class="cookie-banner"><p>We use cookies, as all do. Fine?</p></div>
<div class="post-content"><h1>Head</h1><p>Some <b>bold</b> words, and then some more of them. It goes on.</p>
<aside class="related"><a href="/x">Read this too</a></aside><p>Last words.</p></div>
<section id="comments"><h2>Replies</h2><div class="comment"><p>I like it, and I say so at length. Thanks a lot.</p></div></section>
<footer>&copy; someone</footer></body></html>"""


def test_unseen_page(session):
    model = extraction.trained([])
    page = parse(UNSEEN)
    odds = model.marginals(page)
    text = assemble(page, [o > 0 for o in odds])
    assert text == "Head Some bold words, and then some more of them. It goes on. Last words."


def test_marginals_are_exact():
    """Messages against the sum over all labelings of a small tree."""
    import itertools
    import math

    page = parse("<div class=a><p>x, y.</p><ul><li>z</li></ul></div><p>w</p>")
    model = extraction.trained([])
    scores = [sum(model.unary.get(x, 0.0) for x in f) for f in extraction.features(page)]
    n, total, content = len(scores), 0.0, [0.0] * len(scores)
    for labels in itertools.product((0, 1), repeat=n - 1):
        labels = (0, *labels)
        weight = math.exp(sum(s * y for s, y in zip(scores, labels)) + sum(
            model.same[page.tag[i] in extraction.FLOW] * (labels[i] == labels[page.parent[i]]) for i in range(1, n)))
        total += weight
        content = [c + weight * y for c, y in zip(content, labels)]
    got = [1 / (1 + math.exp(-o)) for o in model.marginals(page)]
    assert all(abs(g - c / total) < 1e-6 for g, c in zip(got[1:], content[1:]))


def test_odd_pages(session):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "no markup at all"), (3, None, "no markup at all"),
            (None, "u", "<article>" + "<p>Some text, again.</p>" * 5000 + "</article>")]
    pages = session.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = extraction.extract(pages, extraction.fit(pages)).collect()
    assert [r.text for r in sorted(got, key=lambda r: (r.page_id or 9))][:2] == ["", ""]
    assert [r.n_chars for r in got if r.page_id is None] == [18 * 5000 - 1]
    assert extraction.extract(pages.limit(0), extraction.trained([])).count() == 0


def test_deep_page():
    page = parse("<div>" * 20000 + "x")
    assert len(extraction.trained([]).marginals(page)) == 20001
