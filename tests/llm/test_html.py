"""Main-text extraction: whole pages with known articles, the cut against brute force."""

import itertools
import random
import re
import time
from html import unescape

import pytest
from pyspark.sql import functions as F

from courtline.llm.html_extract import blocks, extract, main_blocks, source_side


def expected(page):
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)\b[^>]*>", found[1]) if found else []
    texts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
    return "\n\n".join(t for t in texts if t)


def test_articles_of_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = extract(pages).collect()
    assert len(rows) == pages.count()
    for r in rows:
        assert r.text == expected(r.html) and r.n_chars == len(r.text)


def test_boilerplate_around_and_inside_the_article():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
    <header><h1>The site</h1></header><nav><a href=/a>Home</a><a href=/b>News of the day, all of it.</a></nav>
    <div class="cookie-notice">We use cookies for many good reasons, as you surely know by now.</div>
    <div id="content"><h2>A   title &amp; more</h2><p>First paragraph,<br>of two lines.<p>Second &lt;one&gt;&nbsp;here.
    <script>var x = "<p>not text</p>";</script>
    <aside>Read also: another article of ours.</aside>
    <form><label>Name</label><input><button>Send it now.</button></form><ul><li>An item<li>Another item</ul>
    <div class="comments"><p>I liked the article a lot, thank you for it, it was a good read.</p></div></div>
    <!-- a comment <p>hidden</p> --><footer>&copy; 2024 The site. All rights reserved.</footer></body></html>"""
    assert main_blocks(page) == ["A title & more", "First paragraph, of two lines.", "Second <one> here.", "An item", "Another item"]


def test_pages_without_markers_keep_prose():
    text = "This is a long sentence of plain prose that a reader would want to read, as it goes on for a while."
    links = "".join(f"<a href=/{k}>link {k}</a> " for k in range(9))
    assert main_blocks(f"<body><div>{links}</div><div><div><p>{text}</p><p>{text}</p><p>Short.</p><p>{text}</p></div></div></body>") == [text, text, "Short.", text]


def test_odd_pages(spark):
    big = "<article>" + "<p>some words here.</p>" * 3000 + "</article>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", "no tags at all, only text that is long enough to count as prose."), (4, "u", "<p <<< > </nope> <a"), (5, "u", big), (5, "u", big), (None, None, "<div>" * 5000 + "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = extract(pages).collect()
    assert len(got) == 7 and all(r.n_chars == len(r.text) for r in got)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == texts[2] == "" and texts[3].startswith("no tags") and texts[5].count("\n\n") == 2999
    assert extract(pages.where("false")).count() == 0


def test_cut_is_minimal():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(1, 8)
        scores = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(i, i + 1, rng.uniform(0, 2)) for i in range(n - 1)] + [(0, n - 1, rng.uniform(0, 1))] * (n > 2)

        def cost(side):
            return sum((s if s > 0 else 0) if not x else (-s if s < 0 else 0) for s, x in zip(scores, side)) + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(cost(side) for side in itertools.product((False, True), repeat=n))
        assert abs(cost(source_side(scores, edges)) - best) < 1e-6


def test_unclosed_markup_ends():
    assert blocks("<script>never closed") == [] and blocks("<!-- never closed") == []
    assert [b[0] for b in blocks("<p title='a>b'>x</p>y<br>z")] == ["x", "y z"]


def page_text(page):
    return "\n\n".join(main_blocks(page))


@pytest.mark.parametrize("page", ['<a "' * 250_000, '<a ">"' * 150_000, '<a "' * 250_000 + ">", "<svg>" * 200_000, "<!-- " * 200_000, "<a b='\">" * 150_000])
def test_broken_markup_takes_linear_time(page):
    began = time.process_time()
    page_text("<p>first words of it.</p>" + page)
    assert time.process_time() - began < 20


def test_broken_markup_keeps_the_text_around_it():
    long = "A sentence of the article that has quite a few words in it, and goes on. "
    assert page_text(f"<article><p>{long}</p><p>{long}x<!-- no end <p>gone</p>") == f"{long.strip()}\n\n{long}x"
    assert page_text(f"<article><p>{long}tail <!x") == f"{long}tail"
    assert page_text(f'<article><p>{long}</p><p title="a>b">{long}</p></article>') == f"{long.strip()}\n\n{long.strip()}"


def test_formulas_are_text():
    words = "The sum of the first numbers is told by this short formula here, as all know: "
    page = f"<article><p>{words}<math><mi>n</mi><mo>+</mo><mn>1</mn></math> and it holds for all of them.</p></article>"
    assert page_text(page) == f"{words}n+1 and it holds for all of them."
