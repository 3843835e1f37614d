"""Wrappers: folding and alignment of expressions, reading of odd markup, and main text with and without article elements."""

import random
import re

import pytest

from cohortmill.llm import wrappers
from cohortmill.llm.wrappers import Page, align, expression, fold

SCHEMA = "page_id long, url string, html string"


def _shown(items):
    marks = {(True, True): "*", (True, False): "+", (False, True): "?", (False, False): ""}
    return " ".join(("(" + " ".join(u) + ")" if len(u) > 1 else u[0]) + marks[many, opt] for u, many, opt in items)


def _matches(items, labels):
    """The expression as a regular expression over labels."""
    body = "".join("(?:" + "".join(f"{re.escape(x)};" for x in unit) + ")" + {(1, 1): "*", (1, 0): "+", (0, 1): "?", (0, 0): ""}[many, opt] for unit, many, opt in items)
    return re.fullmatch(body, "".join(f"{x};" for x in labels)) is not None


def test_expressions():
    assert _shown(expression(list("hppp"))) == "h p+"
    assert _shown(expression(list("xhphphpf"))) == "x (h p)+ f"
    assert _shown(align(expression(list("hpf")), expression(list("hppa")))) == "h p+ f? a?"
    assert _shown(align(expression(list("nav")), expression(list("nxv")))) == "n a? x? v"
    assert align([], []) == fold([]) == []


@pytest.mark.parametrize("seed", range(40))
def test_expressions_match_what_they_were_made_of(seed):
    rng = random.Random(seed)
    # Streams of one template: an optional part, a repeated one and a fixed frame.
    streams = [list("a" + "o" * rng.randint(0, 1) + "rs" * rng.randint(1, 4) + "z" * rng.randint(0, 1) + "e") for _ in range(12)]
    made = expression(streams[0])
    for stream in streams[1:]:
        made = align(made, expression(stream))
    if all("rsrs" in "".join(s) for s in streams):
        assert all(_matches(made, s) for s in streams)
    assert _matches(expression(streams[0]), streams[0])


def _text(spark, rows):
    return {row.page_id: row.text for row in wrappers.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_articles_and_everything_around(spark):
    html = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="<article><p>no</p>"</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>Home<li>About</ul></nav><div class="cookie-notice">We use</div>
<main><div class="ad">Buy</div><article id="post-7"><header><h1>The &amp; title</h1></header><p>First  <b>bold</b><br>line &lt;x&gt; 1 < 2<p>Second
<a href='/x?a="b">c"'>link</a><ul><li>one<li>two</ul><aside>see also</aside><span class="ad">x <span>y</span> z</span><p>With <button>press</button>button
<form><p>name <input></form><table><tr><td>a<td>b</table><footer>by me</footer>tail<div class="comments"><article><p>nice</p></article></div></article></main>
<footer>&copy; Site</footer></body></html>"""
    got = _text(spark, [(1, "http://a.example/1", html), (2, "http://a.example/2", html)])
    want = "The & title\nFirst bold line <x> 1 < 2\nSecond link\none\ntwo\nWith button\na\nb\ntail"
    assert got == {1: want, 2: want}


def test_a_host_without_articles_learns_its_slots(spark):
    def page(i, menu):
        body = "".join(f"<p>Paragraph {j} of page {i} has quite some words to read.</p>" for j in range(1 + i % 4))
        extra = "<div><p>Once in a while</p></div>" if i == 3 else ""
        return (
            f"<body><div><h6>{menu}</h6></div><div><a href=/>Home</a> <a href=/{i}>more {i}</a></div><table><tr><td><h2>Heading {i}</h2>{body}{extra}</td>"
            "</tr></table><div>Terms of use</div></body>"
        )

    rows = [(i, f"https://b.example/{i}", page(i, "The same menu")) for i in range(12)]
    got = _text(spark, rows)
    assert got[1] == "Heading 1\n" + "\n".join(f"Paragraph {j} of page 1 has quite some words to read." for j in range(2))
    assert "Once in a while" in got[3] or got[3].count("\n") == 4
    made = wrappers.wrappers(spark.createDataFrame(rows, SCHEMA)).first()
    assert made.pages == 12 and "p[#]+" in made.wrapper and "'text'" in made.wrapper and "?" in made.wrapper


def test_alternatives(spark):
    rows = [
        (1, "http://c.example/a", "<body><nav>menu<article><h1>In an open menu</h1><p>text</article>"),
        (2, "http://d.example/a", "<body><div class=sidebar>side</div><div class='entry post-3'><p>entry text</div>"),
        (3, "http://e.example/a", "<body><main>main <i>text</i></main><aside>no</aside>"),
        (4, "http://f.example/a", "<body><article><p>article page</p></article>"),
        (5, "http://f.example/b", "<body><div id=content><p>other page of that host</p></div><footer>f</footer>"),
        (6, None, None),
        (7, "http://g.example/a", ""),
        (8, "odd url", "plain text only"),
        (12, "http://n.example/a", "<div><p>a page twice</div>"),
        (13, "http://n.example/b", "<div><p>a page twice</div>"),
        (9, "http://h.example/a", "<article><p>cut &amp"),
        (10, "http://i.example/a", "<article><p>a<!-- never closed <p>b"),
        (11, "http://j.example/a", "<article><p>a<script>never closed <p>b"),
    ]
    assert _text(spark, rows) == {
        1: "In an open menu\ntext",
        2: "entry text",
        3: "main text",
        4: "article page",
        5: "other page of that host",
        6: "",
        7: "",
        8: "plain text only",
        9: "cut &",
        10: "a",
        11: "a",
        12: "a page twice",
        13: "a page twice",
    }


def test_very_long_and_very_deep_pages(spark):
    deep = "<article>" + "<div><section>" * 5000 + "deep text" + "</section></div>" * 5000 + "</article>"
    long = "<article>" + "".join(f"<p>paragraph {i}" for i in range(20_000)) + "</article>"
    got = _text(spark, [(1, "http://k.example/", deep), (2, "http://k.example/", long)])
    assert got[1] == "deep text"
    assert got[2].split("\n") == [f"paragraph {i}" for i in range(20_000)]


def test_repeated_rows_clashing_names_and_shuffled_slots(spark, monkeypatch):
    rows = [(1, "http://l.example/", "<article><p>x</article>")] * 3 + [(None, "http://m.example/", "<main>y</main>")]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'z' as text", "1 as host", "2 as _slots", "3 as n_chars")
    want = [(None, "y", 1), (1, "x", 1), (1, "x", 1), (1, "x", 1)]

    def found():
        return sorted((row.page_id, row.text, row.n_chars) for row in wrappers.extract(pages, ["page_id"]).collect() if row.page_id) + []

    assert found() == want[1:]
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", 0)
    assert found() == want[1:]
    assert wrappers.extract(pages.filter("false")).collect() == []


def test_held_paths_do_not_change_the_result(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(60)
    once = sorted(map(tuple, wrappers.extract(pages).collect()))
    monkeypatch.setattr(wrappers, "HELD_PATHS", 30)
    assert sorted(map(tuple, wrappers.extract(pages).collect())) == once


def test_page_reads_links_and_blocks():
    page = Page("<p>a <a href=x>b</a> c<p>d")
    assert [(block, text, linked) for _, block, text, linked in page.texts] == [(1, "a ", False), (1, "b", True), (1, " c", False), (2, "d", False)]
