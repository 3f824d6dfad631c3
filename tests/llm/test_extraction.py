import re

import pytest

from slatework.llm import extraction
from tests.llm import cases

ARTICLE = "<article><h1>Title &amp; more</h1><p>First  words\n of the &lt;text&gt;.</p><p>Second<br>block <b>bold</b>ly.</p></article>"
TEXT = "Title & more\nFirst words of the <text>.\nSecond block boldly."

PAGES = {
    "plain": (ARTICLE, TEXT),
    "menus": (
        "<html><head><title>T</title><style>p{}</style></head><body><header><h2>Site</h2></header><nav><ul><li><a href='/'>Home</a>"
        f"</li></ul></nav><aside>Aside words</aside>{ARTICLE}<div class='sidebar box'>Side</div><form><p>Name</p><input>"
        "</form><div id=comments><p>I do not agree at all with this text</p></div><footer>End &copy;</footer></body></html>",
        TEXT,
    ),
    "advert inside": (ARTICLE.replace("<p>Second", "<div class='ad'>Buy " * 1 + "this</div><p>Second"), TEXT),
    "cookie notice": ("<div class='cookie-notice'><p>We use cookies</p></div>" + ARTICLE, TEXT),
    "script with tags": ("<script>var t='</p><article>';</script>" + ARTICLE + "<script>unfinished", TEXT),
    "comment": ("<!-- <p>gone</p> -->" + ARTICLE + "<!-- unfinished", TEXT),
    "capitals": (re.sub(r"</?\w+", lambda m: m[0].upper(), ARTICLE), TEXT),
    "quoted bracket": (ARTICLE.replace("<p>First", "<p title='a > b'>First"), TEXT),
    "unfinished tag": (ARTICLE + "<p class='x", TEXT),
    "unclosed": ("<article><p>One<p>Two<ul><li>Three<li>Four</article>", "One\nTwo\nThree\nFour"),
    "references": ("<article><p>&#x110000; &#xD800;&#65;&nbsp;&#0000000066; &amp &bogus;</p></article>", "� �A B & &bogus;"),
    "none": (None, ""),
    "empty": ("", ""),
    "only menu": ("<nav><a href='/'>Home</a></nav>", ""),
    "brackets": ("<article><p>1 < 2 and 3 > 2 <3</p></article>", "1 < 2 and 3 > 2 <3"),
    "linked end": (
        "<article><p>See the links below.</p><p><a href='/1'>First linked reference title</a></p><ul><li><a href='/2'>Second</a></li></ul></article>",
        "See the links below.\nFirst linked reference title\nSecond",
    ),
    "heading ids": (
        "<article><h2 id='related-work'>Related work</h2><section id='search-algorithms'><p>Search</p></section><section id='sharing-data'>"
        "<p>Data</p></section><p id='notice'>Notice</p><pre><span class='hljs-comment'># code</span></pre></article>",
        "Related work\nSearch\nData\nNotice\n# code",
    ),
    "boilerplate inside": (
        "<article><p>Text.</p><div class='social-share'>Share</div><section id='comments'><p>I like it</p></section><p class='advert'>Buy</p>"
        "<ul class='comment-list'><li>Me too</li></ul><div id='newsletter'>Join</div><p role='alert'>Cookies</p><p>End.</p></article>",
        "Text.\nEnd.",
    ),
    "two articles": (
        "<main><article><p>One two three four.</p></article></main><p>Between</p><main><p>Five six seven eight.</p></main>",
        "One two three four.\nFive six seven eight.",
    ),
    "cells": ("<article>" + "<table><tr><td>x</td></tr></table>" * 50 + "<p>end</p></article>", "\n".join(["x"] * 50 + ["end"])),
    "long": ("<article>" + "<p>word</p>" * 20_000 + "</article>", "\n".join(["word"] * 20_000)),
    "deep": ("<div>" * 30_000 + ARTICLE, TEXT),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(k, name, source) for k, (name, (source, _)) in enumerate(PAGES.items())]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows + rows[:2]], "page_id bigint, url string, html string, text string, kind string")
    out = extraction.extract(pages).collect()
    assert len(out) == len(rows) + 2
    return {r.url: r for r in out}


@pytest.mark.parametrize("name", PAGES)
def test_page(found, name):
    assert found[name].text == PAGES[name][1]
    assert found[name].n_chars == len(PAGES[name][1])


def test_unmarked_page_by_scores():
    """Without article, roles or classes the run of text blocks wins over link lists."""
    links = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(20))
    body = "".join(f"<p>{'some words of prose ' * 6}number {k}.</p>" for k in range(5))
    source = f"<body><div><ul>{links}</ul></div><div>{body}</div><div><ul>{links}</ul></div></body>"
    weights = extraction.DEFAULT_WEIGHTS | {"li": -1.0, "a": -1.0, "ul": -1.0, "div": -0.5, "p": -0.1}
    text = extraction.Page(source).best_text(weights)
    assert text.splitlines() == [f"{'some words of prose ' * 6}number {k}." for k in range(5)]


def test_best_run_equals_all_runs():
    """The linear scan finds the text of the best of all runs: the first that ends, without a tail that adds nothing."""
    import random

    rng = random.Random(3)
    weights = {"word": 1.0, "linked word": -1.5, "p": -0.75, "li": -1.0, "hr": -2.0, "a": -0.5}
    lengths = set()
    for _ in range(300):
        names = iter(f"w{k}" for k in range(100))
        kinds = ["<p>{} {} {}</p>", "<li><a>{} {}</a></li>", "<hr>", "<p>{}</p>"]
        source = "".join(re.sub(r"\{\}", lambda m: next(names), rng.choice(kinds)) for _ in range(8))
        page = extraction.Page(source)
        totals, words = [], []
        for part in re.findall(r"<[^>]+>|[^<]+", source):
            tag = re.match(r"</?(\w+)>", part)
            if tag and tag[1] == "a":
                continue
            totals.append(weights[tag[1]] if tag else 0.0)
            words.append("" if tag else part)
            if not tag:
                linked = f"<a>{part}</a>" in source
                totals[-1] += len(part.split()) * weights["linked word" if linked else "word"] - linked * 1.0
        runs = [(sum(totals[i:j]), -j, i) for i in range(len(totals)) for j in range(i + 1, len(totals) + 1)]
        best, end, start = max(runs)
        lines = [w for w in words[start:-end] if w] if best > 0 else []
        assert page.best_text(weights).splitlines() == lines
        lengths.add(len(lines))
    assert len(lengths) > 3


def test_weights_from_removed_regions(spark):
    """Words and links of menus and footers are counted as outside, so the pages decide the weights."""
    page = "<nav>" + "<a href='/'>menu</a>" * 5 + f"</nav>{ARTICLE}<footer>A long foot of page</footer>"
    linked = page.replace("<p>First", "<p><a href='/'>" + "linked prose " * 50 + "</a></p><p>First")
    few, many = [
        extraction.fit_weights(spark.createDataFrame([(k, p) for k in range(4)], "id bigint, html string"), "id", "html")
        for p in (page, linked)
    ]
    assert few["linked word"] < -1 < 0 < many["linked word"]
    assert few["word"] < 3


def test_pages_table(spark):
    """The generated pages hold their text in h1 and p elements of one article."""
    import html

    data = "/root/testdata/sf0.01"
    pages = cases.table(spark, "pages", data)
    out = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        blocks = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
        lines = [" ".join(html.unescape(b).split()) for b in blocks]
        assert out[row.page_id] == "\n".join(x for x in lines if x)


def test_empty_table(spark):
    assert extraction.extract(cases.table(spark, "pages").where("false")).count() == 0
