"""Main text of pages."""

import random
import time

import pytest

from isobar.llm.html_extraction import Matching, Reference, _shaped, main_text, page_blocks, parse, skeleton
from isobar.llm.queries import op2_html_extraction


def blocks(source):
    return [text for _, text in page_blocks(source, None)[0]]


def test_an_article_among_the_rest():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav><div id="cookie-notice">We use</div><!-- <p>no</p> -->
<main><article><header><h1>T &amp;&nbsp;x</h1></header><p>One<br>two <a href="x>y">li
nk</a> &lt;b&gt; &eacute;&#33;<p><b>Open<p>Next</b><ul><li>a<li>b</ul><table><tr><td>1<td>2</table>
<form>f</form><script>var a="</p>"</script><div class="ad">Buy</div><section class="comments"><p>c</p></section></article>
<aside>s</aside></main><footer>f</footer></body></html>"""
    assert blocks(page) == ["T & x", "One two li nk <b> é!", "Open", "Next", "a", "b", "1", "2"]


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ("", []), ("plain text", ["plain text"]), ("<p>", []), ("<<p>x", ["<", "x"]), ("a < b", ["a < b"]),
        ("<article><p>x<!-- open", ["x"]), ("<article><p>x<script>y", ["x"]), ("<p a='b>c</p>", ["c"]),
        ("<div>" * 5000 + "deep", ["deep"]), ("</p></div>x", ["x"]), ("<article></article><p>x", ["x"]),
    ],
)
def test_broken_markup(source, wanted):
    assert blocks(source) == wanted


def best_by_hand(one, other):
    """Simple tree matching as it is defined."""
    if one[0] != other[0]:
        return 0
    m, n = len(one) - 1, len(other) - 1
    table = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + best_by_hand(one[i], other[j]))
    return 1 + table[m][n]


def test_matching_is_the_largest(monkeypatch):
    pick = random.Random(8)

    def tree(depth):
        return [pick.choice(["p", "div"]), *(tree(depth - 1) for _ in range(pick.randrange(4) if depth else 0))]

    def markup(node):
        tag = "span" if node[0] == "p" else "b"
        return f"<{tag}>{''.join(map(markup, node[1:]))}</{tag}>"

    for _ in range(60):
        one, other = parse(markup(tree(3))), parse(markup(tree(3)))
        _shaped(one)
        reference = Reference(skeleton(other))
        matching = Matching(reference)
        size, pairs = matching.size(one, 0), {}
        matching.mapping(one, 0, pairs)
        assert size == best_by_hand(skeleton(one), skeleton(other)) == len(pairs) == len(set(pairs.values()))
        monkeypatch.setattr("isobar.llm.html_extraction.PAIRS", 0)
        quick = {}
        Matching(reference).mapping(one, 0, quick)
        assert len(quick) == len(set(quick.values())) <= size
        monkeypatch.setattr("isobar.llm.html_extraction.PAIRS", 250_000)


PAGE = "page_id bigint, url string, html string, text string, host string"


def test_slots_that_never_change_are_template(spark):
    rows = []
    for i in range(20):
        body = f"<div><p>Our shop</p><p>Story {i} is told</p><p>About {i}</p><p>Call us today</p></div>"
        rows.append((i, f"https://A.example/{i}", body, None, "x"))
    rows += [(100, "https://b.example/1", "<p>Our shop</p><p>Text</p>", None, "x")]
    found = {row.page_id: row.text for row in main_text(spark.createDataFrame(rows, PAGE).repartition(3)).collect()}
    assert found[3] == "Story 3 is told\nAbout 3" and found[100] == "Our shop\nText"


def test_odd_pages(spark):
    rows = [(1, None, None, "t", "h"), (1, None, "", "t", "h"), (2, "no url", "<p>é x", "t", "h"), (None, "http://h/", "<p>y", "t", "h")]
    rows += [(3, "http://h/1", "<article><p>same</p></article>", "t", "h")] * 12
    found = main_text(spark.createDataFrame(rows, PAGE)).collect()
    assert sorted((row.text, row.n_chars) for row in found) == [("", 0), ("", 0), ("same", 4)] * 1 + [("same", 4)] * 11 + [("y", 1), ("é x", 3)]
    assert main_text(spark.createDataFrame([], PAGE)).count() == 0


def test_the_query_returns_every_page(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = op2_html_extraction(spark, sf_dir).collect()
    assert sorted(row.page_id for row in found) == sorted(row.page_id for row in pages.collect())
    assert all(row.n_chars == len(row.text) > 0 and "<" not in row.text for row in found)


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ('<div class="content has-sidebar"><p>text</p></div><p>more of it</p>', ["text", "more of it"]),
        ('<div class="layout no-sidebar"><p>text</p></div>', ["text"]),
        ('<div id="sidebar-page"><main><p>text</p></main></div>', ["text"]),
        ('<article class="post related-post"><p>text</p></article>', ["text"]),
        ('<section id="discussion"><p>We discuss.</p></section><p>x</p>', ["We discuss.", "x"]),
        ('<div class="widget"><p>long text of the page</p></div><p>x</p>', ["long text of the page", "x"]),
        ('<div class="widget"><p>short</p></div><p>long text of the page</p>', ["long text of the page"]),
        ("<article><p>one</p></article><div><p>between</p></div><article><p>two is longer</p></article>", ["one", "two is longer"]),
        ("<main><p>before</p><article><p>text</p></article></main>", ["before", "text"]),
        ("<article><p>x is <math><mi>a</mi><mo>=</mo><mn>1</mn></math> here</p></article>", ["x is a=1 here"]),
        ("<p>a</p>" + "<div>" * 600 + "<nav>menu</nav><p>deep</p>" + "</div>" * 600 + "<p>end</p>", ["a", "deep", "end"]),
        ("<div>" * 600 + '<div class="ad"><div class="ad"><b>buy</b></div></div><p>deep and long</p>', ["deep and long"]),
    ],
)
def test_names_are_evidence_only(source, wanted):
    assert blocks(source) == wanted


@pytest.mark.parametrize(
    "source",
    [
        "<a " * 40_000, "<a " * 40_000 + ">", "<!" * 60_000, "<!-- " * 20_000, "<script></script " * 8_000, '<a "' * 30_000 + "'>",
        "<b>" * 30_000 + "<p>x" * 10_000, "<div>" * 40_000 + "t", "</b>" * 40_000 + "z", "<div class=ad>" * 20_000 + "t",
    ],
)
def test_broken_markup_is_scanned_once(source):
    began = time.process_time()
    blocks(source)
    assert time.process_time() - began < 5


def test_many_children_are_aligned():
    many = parse("<div>" + "<p>x</p><ul><li>y</li></ul>" * 3000 + "</div>")
    few = parse("<div>" + "<p>x</p>" * 200 + "<ul><li>y</li></ul>" * 200 + "</div>")
    for one, other in ((many, few), (few, many)):
        _shaped(one)
        pairs = {}
        Matching(Reference(skeleton(other))).mapping(one, 0, pairs)
        assert len(pairs) == len(set(pairs.values())) == Matching(Reference(skeleton(other))).size(one, 0) > 600


def site(spark, bodies, host="a.example"):
    rows = [(i, f"https://{host}/{i}", body, None, "x") for i, body in enumerate(bodies)]
    found = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, PAGE).repartition(3)).collect()}
    return [found[i] for i in range(len(bodies))]


def test_the_template_goes_without_telling_names(spark):
    """Two layouts on one host, half each, an empty page first; neither has articles or names."""
    one = "<div><div><p>Our shop</p><p>Home</p></div><div>{}</div><div><p>Call us today</p></div></div>"
    two = "<table><tr><td>Archive of all</td></tr><tr><td>{}</td></tr><tr><td>Imprint</td></tr></table>"
    bodies = ["<div></div>"]
    wanted, removed = [""], 0
    for i in range(24):
        texts = [f"Story {i}.{j} is told" for j in range(1 + i % 4)]
        inner = "".join(f"<p>{t}</p>" for t in texts)
        bodies.append((one if i % 2 else two).format(inner))
        wanted.append("\n".join(texts))
        removed += 3 if i % 2 else 2
    found = site(spark, bodies)
    assert found == wanted
    plain = sum(len(blocks(body)) for body in bodies)
    assert plain - sum(len(text.split("\n")) for text in found if text) == removed


def test_a_notice_on_some_pages_is_template_there(spark):
    """A slot that only some pages have is judged on these."""
    bodies = []
    for i in range(30):
        notice = "<section><p>We moved our office.</p></section>" if i % 3 == 0 else ""
        bodies.append(f"<div><h1>Title {i}</h1><p>Text {i}</p>{notice}<p>Bye {i}</p></div>")
    assert site(spark, bodies) == [f"Title {i}\nText {i}\nBye {i}" for i in range(30)]


def test_few_pages_prove_no_template(spark):
    same = "<div><p>Opening words</p><p>Text {}</p></div>"
    assert site(spark, [same.format(i) for i in range(4)]) == [f"Opening words\nText {i}" for i in range(4)]
    assert site(spark, [same.format(i) for i in range(9)], "b.example") == [f"Text {i}" for i in range(9)]


def test_one_very_long_page(spark):
    long = "<html><body><article>" + "".join(f"<p>Paragraph {i} &amp; more</p>" for i in range(40_000)) + "</article></body></html>"
    text = site(spark, [long, "<article><p>short</p></article>"])
    assert text[0].count("\n") == 39_999 and text[0].endswith("Paragraph 39999 & more") and text[1] == "short"
