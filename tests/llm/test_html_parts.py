"""Parts that belong to the article, broken markup, and linear time."""

import time

import pytest

from weirflow.llm.html import extract_text, main_text

LONG = "long text, with commas. " * 30

# Made by hand: page, and the blocks that are its article.
PAGES = [
    (f"<div id=content><section><p>{LONG}</p></section><section><h2>Two</h2><p>Brief.</p></section></div>", [LONG.strip(), "Two", "Brief."]),
    (f"<div><div><p>{LONG}</p></div><ul><li>first point</li><li>second point</li></ul></div>", [LONG.strip(), "first point", "second point"]),
    (f"<body><div><p>{LONG}</p></div><div>A closing note.</div></body>", [LONG.strip(), "A closing note."]),
    ("<body><div><p>Short one here.</p></div><div><p>Short two here.</p></div></body>", ["Short one here.", "Short two here."]),
    (
        f"<body><div class=menu><a href=/>Home</a><a href=/b>B</a></div><div><p>{LONG}</p><p>End.</p></div>"
        "<div><a href=1>More of this</a> <a href=2>And of that</a></div><div id=comments>Nice!</div></body>",
        [LONG.strip(), "End."],
    ),
    (f"<table><tr><td><p>{LONG}</p></td><td><p>Beside.</p></td></tr></table>", [LONG.strip(), "Beside."]),
    ("<p>one<p>two<div>three</div>four", ["one", "two", "three", "four"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><dl><dt>e<dd>f</dl>", ["a", "b", "c", "d", "e", "f"]),
    ("<b>bold<div>in</div></b> out", ["bold", "in", "out"]),
]


@pytest.mark.parametrize("page,blocks", PAGES)
def test_articles_without_an_article_element(page, blocks):
    assert main_text(page).split("\n") == blocks


def test_references_are_read_text_by_text():
    assert main_text("<p>q&<b>lt;x</b> &lt;b&gt; &#65;&nbsp;&eacute;</p>") == "q&lt;x <b> A é"


@pytest.mark.parametrize("page,text", [("tail <a href='x", "tail"), ("a < b and c <", "a < b and c <"), ("x<!-- y", "x"), ("x <p", "x"), ("<", "<"), ("x<script>y", "x")])
def test_cut_off_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 350_000,
        "<a b=\"'" * 120_000 + ">",
        "<div>some own text, that is long enough to count " * 20_000,
        "<i>" * 150_000 + "</b>" * 100_000 + "x",
        "<i>x" * 100_000 + "<hr>" * 100_000,
        "<b><div>" + "<i>" * 150_000 + "</b>" * 100_000,
        "<ul><li><a href=x>y</a>" * 40_000,
        "<table><tr><td>" * 60_000,
    ],
)
def test_time_is_linear(page):
    """A megabyte of broken markup takes seconds; twice as much takes about twice as long."""
    took = []
    for n in (2, 1):
        start = time.process_time()
        main_text(page[: len(page) // n])
        took.append(time.process_time() - start)
    assert took[1] < 12 and took[1] < 4 * took[0] + 0.5


def test_rows(spark):
    pages = spark.createDataFrame([(None, None, "<p>x"), (1, "u", None), (1, "u", "")], "page_id bigint, url string, html string")
    got = extract_text(pages).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == [("1", "", 0), ("1", "", 0), ("None", "x", 1)]
