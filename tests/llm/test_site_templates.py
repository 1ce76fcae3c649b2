"""Templates beside a plain counter, names that may not empty a page, and malformed pages."""

import time
from collections import defaultdict

import pytest

from clinlake.llm import site_text

SCHEMA = "page_id long, url string, html string, text string, `a.b` int"


def texts(spark, rows, **settings):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return {r["page_id"]: r["text"] for r in site_text.main_text(frame, **settings).collect()}


@pytest.mark.parametrize(
    "html, text",
    [
        ('<div class="page no-sidebar"><article><p>Body text</p></article></div>', "Body text"),
        ('<div class="has-sidebar"><main>Body</main></div>', "Body"),
        ('<article class="post comments-open"><p>Body</p></article>', "Body"),
        ('<p class="ad-hoc">kept</p><h2 class="header-anchor">Head</h2><p hidden>a</p><p aria-hidden="true">b</p>', "kept Head a b"),
        ('<div class="sidebar"><article>All of it</article></div><p>x</p>', "All of it x"),
        ('<div class="banner"><p>nearly all the text of this page</p></div><p>rest</p>', "nearly all the text of this page rest"),
        ('<article>Own<div class="comments"><article>said by a reader</article></div></article>', "Own"),
        ('<article><p>The body of the page</p><div class="site-notice">no</div><div id="comment_list">no</div></article>', "The body of the page"),
        ('<div role="navigation"><p>menu menu menu</p></div><p>x</p>', "x"),
        ("<p>a</p></nowhere><p>b", "a b"),
        ("a < b <c", "a < b <c"),
        ("<p>x<!-- never ends <p>y</p>", "x"),
    ],
)
def test_names_do_not_empty_a_page(spark, html, text):
    assert " ".join(t for t, _ in site_text.blocks(html) if t is not None) == text


@pytest.mark.parametrize("html", ['<a "' * 250_000, "<a " * 350_000, '<a "' * 250_000 + ">", "<!" * 500_000, "<div>" * 200_000 + "</p></x>" * 50_000, "<p>" * 100_000, "<" * 1_000_000])
def test_malformed_pages_of_a_megabyte(html):
    start = time.monotonic()
    site_text.Page(html).text(lambda trees: trees < 0)
    assert time.monotonic() - start < 10


SITE = (
    "<div class=x><p>Welcome, {s} readers</p><p>Since 1990</p></div><h2>References</h2><div><p>Story {i} of {s}</p>"
    "<ul><li>own {i}</li><li>shared</li></ul></div><section><p>Call us</p><p>or write</p></section>"
)


def test_templates_decide_on_sites_without_marks(spark):
    rows = [(100 * s + i, f"http://{s}.org/{i}", SITE.format(s=s, i=i)) for s in range(3) for i in range(50)]
    cut, whole = texts(spark, rows), texts(spark, rows, use_templates=False)
    assert all("Welcome" in t and "Call us" in t for t in whole.values())
    assert cut == {100 * s + i: f"Story {i} of {s} own {i}" for s in range(3) for i in range(50)}
    assert texts(spark, rows, max_keys=3) == cut


def test_a_lone_heading_on_few_pages_of_a_large_host_stays(spark):
    rows = [(i, f"http://a.org/{i}", f"<div><p>Story {i}</p></div>" + "<h2>References</h2>" * (i < 30)) for i in range(300)]
    got = texts(spark, rows)
    assert got == {i: f"Story {i}" + " References" * (i < 30) for i in range(300)}


def test_subtrees_beside_a_plain_counter(spark):
    """What the hashes count is what a count of the subtrees' own text and tags counts."""
    rows = [(i, f"http://h{i % 2}.org/{i}", f"<div><p>top {i % 4}</p><p>x</p></div><div><p>own {i}</p></div><section><p>end</p><p>{i % 8}</p></section>") for i in range(80)]
    pages = defaultdict(set)
    for i, url, _ in rows:
        h = url.split("/")[2]
        for tree in (("div", f"top {i % 4}", "x"), ("section", "end", str(i % 8))):
            pages[h, tree, True].add(url)
        for leaf in (f"top {i % 4}", "x", f"own {i}", "end", str(i % 8)):
            pages[h, ("p", leaf), False].add(url)
        pages[h, ("div", f"own {i}"), True].add(url)
    template = {(h, tree) for (h, tree, inner), urls in pages.items() if len(urls) >= 3 and len(urls) >= (min(20, 0.2 * 40) if inner else 0.2 * 40)}

    def left(i):
        h, out = f"h{i % 2}.org", []
        for tree in (("div", f"top {i % 4}", "x"), ("div", f"own {i}"), ("section", "end", str(i % 8))):
            if (h, tree) not in template:
                out += [leaf for leaf in tree[1:] if (h, ("p", leaf)) not in template]
        return " ".join(out)

    assert texts(spark, rows) == {i: left(i) for i, _, _ in rows}


def test_odd_tables(spark):
    assert texts(spark, []) == {}
    rows = [(None, None, "<p>a</p>"), (1, "no host", "<div><p>same</p><p>same</p></div>"), (2, "x", None), (3, "http:///", "")]
    rows += [(10 + i, "nowhere", "<div><p>same</p><p>text</p></div>") for i in range(30)]
    got = texts(spark, rows)
    assert got == {None: "a", 1: "same same", 2: "", 3: ""} | {10 + i: "same text" for i in range(30)}
