import itertools
import math
import time

import numpy as np
import pytest
from stillwell.llm.html_text import (
    FEATURES, Forest, built, html_text, main_texts, trained, training_pages)
from stillwell.llm.html_tree import Page

TEXT = ("The quick brown fox jumps over the lazy dog, and then it walks home to rest for a while. "
        "Nobody knows where it has been, but everybody has something to say about it.")


def page(article, before="", after=""):
    return (f"<!DOCTYPE html><html><head><title>Title</title><style>p{{}}</style></head><body>{before}"
            f"<article>{article}</article>{after}</body></html>")


GOOD = [
    (page(f"<h1>Head line</h1><p>{TEXT}</p><p>Short one.</p>", "<nav><ul><li><a href='/'>Home</a>"
          "<li><a>About</a></ul></nav><div class=\"ad\">Buy this thing now.</div>",
          "<footer>&copy; 2020 Somebody</footer>"), f"Head line {TEXT} Short one."),
    (page(f"<p><b>{TEXT}<br><p>A &amp; B &lt;x&gt; caf&eacute;</p>"
          "<script>var a = '</p><p>no';</script>"), f"{TEXT} A & B <x> café"),
    (page(f"<p>{TEXT}</p>", after="<aside><h3>More</h3><ul><li><a>One</a></ul></aside>"
          "<form><p>Your name</p><input></form>"), TEXT),
]


def tables(spark, sources):
    return spark.createDataFrame([(i, f"u{i}", h, "x", 1) for i, h in enumerate(sources)],
                                 "page_id long, url string, html string, text string, n_chars int")


def test_articles_are_found(spark):
    sources = [h for h, _ in GOOD] * 5 + [None, "", "plain", "<p", "<!-- open", "</p></div>",
                                          page(f"<p>{TEXT} " * 2000)]
    made = {r["page_id"]: r for r in html_text(tables(spark, sources)).collect()}
    assert len(made) == len(sources)
    for i, (_, want) in enumerate(GOOD):
        assert made[i]["text"] == want and made[i]["n_chars"] == len(want)
    assert made[15]["text"] == made[16]["text"] == "" and made[15]["n_chars"] == 0
    assert made[21]["n_chars"] > 2000 * len(TEXT)


def test_rows_without_ids(spark):
    rows = [(None, None, h, None, None) for h, _ in GOOD] + [(1, None, GOOD[0][0], "x", 1)] * 2
    table = spark.createDataFrame(
        rows, "page_id long, url string, html string, text string, n_chars int")
    made = html_text(table).collect()
    assert sorted(r["text"] for r in made) == sorted([w for _, w in GOOD] + [GOOD[0][1]] * 2)
    assert html_text(table.repartition(3)).exceptAll(html_text(table)).count() == 0


def test_empty_table(spark):
    assert html_text(tables(spark, [])).collect() == []


def test_layouts_without_article_marks():
    pages, labels = training_pages([h for h, _ in GOOD])
    model = trained(pages, labels)
    held = ("<div id=content><h1>A title of some length</h1><p>{0}</p><p>{0}</p></div>"
            "<div class=sidebar><ul><li><a>Link</a><li><a>Other</a></ul></div>"
            "<div class='cookie-notice'><p>We use cookies.</p></div>"
            "<div id=comments><div class=comment><p>I do not agree with it.</p></div></div>")
    text = main_texts([Page(held.format(TEXT))], *model)[0]
    assert text == f"A title of some length {TEXT} {TEXT}"
    more, marks = built([TEXT, "Some words.", "More."])
    right = [main_texts([p], *model)[0] == " ".join(
        t for n, t, _ in p.segments if m[n]) for p, m in zip(more, marks)]
    assert sum(right) >= 0.7 * len(right)


@pytest.mark.parametrize("source, segments", [
    ("<p>a<b>b</b> c\n d</p>e", ["ab c d", "e"]),
    ("<ul><li>a<li>b<ul><li>c</ul>d</ul>", ["a", "b", "c", "d"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("a<!-- <p>no --><script>no</SCRIPT>b", ["ab"]),
    ("<title>no</title>&nbsp;x&#33;<br>y", ["x! y"]),
    ("<div><p>one<div>two</div>three</div>", ["one", "two", "three"]),
    ("<a title='>'>x</a>", ["x"]),
    ("<select><option>no</select>yes", ["yes"]),
])
def test_reading(source, segments):
    assert [s[1] for s in Page(source).segments] == segments


@pytest.mark.parametrize("part", ["<a", "<a ", "if x<y and ", "<div>", "<div></p>", '<a "', "<a '\">",
                                  "<!--", "<!x", "<p><li>", '<a ">" ', "&amp", "<table><tr><td>"])
@pytest.mark.parametrize("tail", ["", ">", '">'])
def test_broken_markup_takes_linear_time(part, tail):
    began = time.process_time()
    pages = [Page(part * ((1 << 20) // len(part)) + tail)]
    main_texts(pages, np.zeros(len(FEATURES)), np.zeros((2, 2)))
    assert time.process_time() - began < 10


@pytest.mark.parametrize("source, segments", [
    ("a <b c", ["a <b c"]), ("if x<y and z", ["if x<y and z"]), ("<p title='it>x", ["x"]),
    ('<p title="a>b</p>', ["b"]), ("<p title=it's>x</p><p title='>'>y</p>", ["x", "y"]),
    ("x<!-- y", ["x"]), ("a<? b", ["a<? b"]), ("a<!-- b --><c", ["a<c"]),
    ("<div>" * 600 + "x" + "</div>" * 600 + "y", ["x", "y"]),
])
def test_reading_of_broken_markup(source, segments):
    assert [s[1] for s in Page(source).segments] == segments


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    pages = [Page("<div><p>a<ul><li>b<li>c</ul></div>"), Page("<p>x"), Page("<ul><li>a<li><p>b</ul>")]
    forest = Forest(pages)
    n = len(forest.parent)
    own, pair = rng.normal(size=n), rng.normal(size=(2, 2))
    total, node, pairs = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for state in itertools.product((0, 1), repeat=n):
        weight = math.exp(sum(own[i] for i in range(n) if state[i]) + sum(
            pair[state[p], state[i]] for i, p in enumerate(forest.parent) if p >= 0))
        total += weight
        for i, p in enumerate(forest.parent):
            node[i] += weight * state[i]
            if p >= 0:
                pairs[i, state[p], state[i]] += weight
    got, got_pairs = forest.marginals(own, pair)
    assert np.allclose(got, node / total) and np.allclose(got_pairs, pairs / total)
