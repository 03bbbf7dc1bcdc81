"""HTML extraction: blocks, the random field against enumeration, held-out layouts, planted pages, edge cases."""

from __future__ import annotations

import html
import itertools
import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from crystalflow.llm import html_extract, page_layouts, queries
from crystalflow.llm.html_blocks import blocks
from crystalflow.llm.page_layouts import Page

SMALL = driver.SMALL


def texts(page):
    return [b.text for b in blocks(page)]


@pytest.mark.parametrize(
    "page, expected",
    [
        (None, []),
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]),
        ("<ul><li>one<li>two <b>three</ul>four", ["one", "two three", "four"]),
        ("<p>x&nbsp;&nbsp; y<br>z\n\n w</p>", ["x y z w"]),
        ("<script>if (a < b) '</p>'</script><style>p{}</style>t<title>no</title>", ["t"]),
        ("<SCRIPT>x</script >a<textarea>b</textarea><select><option>c</select>d<noscript><p>e</p></noscript>f", ["adf"]),
        ("a < b and 1 <2 </> <!-- <p>gone --> c<!DOCTYPE x><?php y ?>", ["a < b and 1 <2 c"]),
        ("<p title='a > b' data-x=\"it's\">t</p><p class=x'>u'</p>", ["t", "u'"]),
        ("<p>kept</p><div class=\"never closed", ["kept"]),
        ("text <!-- open", ["text"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("</div></p><p>a</span></p></article>b", ["a", "b"]),
        ("a<svg><text>no</text></svg>b<template><p>no</p></template>", ["ab"]),
    ],
)
def test_blocks(page, expected):
    assert texts(page) == expected


def test_long_pages_are_linear():
    assert len(blocks("<p>" * 50_000 + "x")) == 1
    assert len(blocks("<div>" * 20_000 + "x" + "</div>" * 20_000)) == 1
    assert len(blocks("<" * 200_000)) == 1
    assert len(blocks('<a href="' * 20_000)) <= 1
    assert len(blocks("<p>word word</p>" * 30_000)) == 30_000


def test_field_against_all_labellings():
    scores = [0.3, -1.2, 2.0, 0.1, -0.4]
    edges = [[0.5, -0.3, 0.2, 0.9], [0.0, 1.0, -1.0, 0.4], [-0.7, 0.3, 0.6, -0.2], [0.1, 0.0, 0.3, 0.8]]

    def value(labels):
        return sum(s for s, y in zip(scores, labels) if y) + sum(e[2 * a + b] for e, a, b in zip(edges, labels, labels[1:]))

    every = {y: math.exp(value(y)) for y in itertools.product((0, 1), repeat=5)}
    total = sum(every.values())
    ones, pairs, log_total = html_extract.marginals(scores, edges)
    assert log_total == pytest.approx(math.log(total))
    for k in range(5):
        assert ones[k] == pytest.approx(sum(p for y, p in every.items() if y[k]) / total)
    for k in range(4):
        for a, b in itertools.product((0, 1), repeat=2):
            assert pairs[k][2 * a + b] == pytest.approx(sum(p for y, p in every.items() if y[k : k + 2] == (a, b)) / total)
    assert html_extract.best_labels(scores, edges) == list(max(every, key=every.get))
    assert html_extract.best_labels([], []) == [] and html_extract.best_labels([0.0], []) == [0]


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    more = docs.crossJoin(spark.range(6).withColumnRenamed("id", "k")).select((F.col("doc_id") * 10 + F.col("k")).alias("doc_id"), "text")
    return html_extract.fit(page_layouts.labelled_pages(more, 1_000))


def test_held_out_layouts(field):
    given = duckdb.sql(f"SELECT text FROM '{SMALL}/documents.parquet'").fetchall()
    labeller = html_extract.Labeller(field)
    made = [Page((t or "").split("\n"), 10_000_000 + k).render() for k, (t,) in enumerate(given)]
    right = sum(labeller.main_text(page) == text for page, text in made)
    assert right >= 0.9 * len(made)


PLANTED = """<!doctype html><html><head><title>T</title><style>x</style></head><body class="home">
<header class="site-header"><h1>The Site</h1><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav></header>
<div id="cookie-notice"><p>We use cookies to make this site work as it should for all of you.</p><button>OK</button></div>
{open}<h1>A &lt;title&gt; of note</h1><p>First   paragraph of the text, which is <b>bold</b> in
places &amp; long enough to read.</p><div class="ad">Buy a thing today, it is on sale for a short while only.</div>
<p>Second one.</p><ul><li>an item</li><li>another item of the list</li></ul>
<aside class="sidebar"><h3>Related</h3><ul><li><a href=/x>Other story</a></ul></aside>
<p>The last paragraph ends here.</p>{close}
<section id="comments" class="comments"><h2>3 comments</h2><article class="comment"><p>I do not agree with what was said here at all, and I have my reasons.</p></article>
<form action=/c><label>Your name</label><input name=n><textarea>say</textarea></form></section>
<footer>&copy; 2024 The Site. <a href=/p>Privacy</a></footer></body></html>"""
MAIN = ["A <title> of note", "First paragraph of the text, which is bold in places & long enough to read.", "Second one.", "an item",
        "another item of the list", "The last paragraph ends here."]


@pytest.mark.parametrize("pair", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>"), ('<main><article class="entry">', "</article></main>")])
def test_planted_page(field, pair):
    page = PLANTED.replace("{open}", pair[0]).replace("{close}", pair[1])
    assert html_extract.Labeller(field).main_text(page) == "\n\n".join(MAIN)


def test_query(spark):
    pages = {k: (u, p) for k, u, p in duckdb.sql(f"SELECT page_id, url, html FROM '{SMALL}/pages.parquet'").fetchall()}
    rows = queries.QUERIES["op12_html"](spark, SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        url, page = pages[r["page_id"]]
        inside = page[page.index("<article>") + 9 : page.index("</article>")].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inside)]
        assert (r["url"], r["text"], r["n_chars"]) == (url, "\n\n".join(filter(None, parts)), len(r["text"]))


def test_edges(spark, field):
    page = PLANTED.replace("{open}", "<article>").replace("{close}", "</article>")
    long = "<article>" + "<p>word word word, and a full sentence.</p>" * 30_000 + "</article>"
    rows = [(1, None), (2, ""), (3, page), (3, page), (None, page), (4, long)]
    given = spark.createDataFrame(rows, "page_id long, html string").withColumns({"text": F.lit("clash"), "id": F.lit(1), "n_chars": F.lit(2)})
    out = [(r["page_id"], r["text"]) for r in html_extract.extract(given, field).collect()]
    assert sorted(map(str, out)) == sorted(map(str, [(1, ""), (2, ""), *[(k, "\n\n".join(MAIN)) for k in (3, 3, None)], (4, "\n\n".join(["word word word, and a full sentence."] * 30_000))]))
    assert html_extract.extract(given.limit(0), field).count() == 0
    nothing = html_extract.fit(given.limit(0).select("html", "text"))
    assert {r["text"] for r in html_extract.extract(given, nothing).collect()} == {""}
    odd = page_layouts.labelled_pages(spark.createDataFrame([(1, None), (None, "x"), (2, ""), (2, "")], "doc_id long, text string"))
    assert sorted(r["id"] for r in odd.collect()) == ["1", "2", "2"]


def test_ties_and_repeats_train_alike(spark, field):
    made = page_layouts.labelled_pages(spark.read.parquet(f"{SMALL}/documents.parquet"), 40)
    one = html_extract.fit(made.repartition(1), passes=1)
    other = html_extract.fit(made.repartition(7), passes=1)
    assert abs(one.weights - other.weights).max() < 1e-12
    assert html_extract.fit(made.unionByName(made), passes=1).weights.any()
