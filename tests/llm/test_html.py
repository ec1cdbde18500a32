"""Main text: pages by hand, the given pages, marginals against full enumeration, odd markup."""

import itertools
import math
import re
import time
from html import unescape

import pytest
from conftest import SMALL

from tripworks.llm import html
from tripworks.llm.frames import prepare, read


@pytest.fixture(scope="module")
def model(spark):
    prepare(spark)
    return html.fit(read(spark, SMALL, "pages"))


def text_of(page, model):
    parsed = html.parse(page)
    return html.main_text(parsed, html.marginals(parsed, model))


def test_given_pages(spark, model):
    """The pages' articles, cut out by their one known design."""
    pages = read(spark, SMALL, "pages")
    wrong = 0
    for r in html.extract(pages, model=model).join(pages.select("page_id", "html"), "page_id").collect():
        article = r["html"].split("<article>")[1].split("</article>")[0]
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", article))
        expected = " ".join(t for t in (" ".join(unescape(b).split()) for b in blocks) if t)
        wrong += r["text"] != expected
        assert r["n_chars"] == len(r["text"])
    assert wrong == 0


@pytest.mark.parametrize("page", html.LABELLED)
def test_labelled_pages_are_learned(model, page):
    parsed = html.parse(page)
    labels, found = html.hand_labels(parsed), html.marginals(parsed, model)
    wrong = sum((p >= 0.5) != y for p, y, never in zip(found, labels, parsed.never) if not never)
    assert wrong <= 1


UNSEEN = """<!doctype html><html><head><title>T</title><style>p {}</style></head><body><header class=top><nav><a href=/>Home</a></nav></header>
<div class="cookie-banner">We use cookies, as all do. <button>OK</button></div><div class="wrap"><div id="main-content"><h1>On &amp; off</h1>
<p>First, a sentence with a <a href=/l>link</a> and&nbsp;more <i>words</i>.</p><div class="advertisement"><p>Buy now, pay later.</p></div>
<p>Second one, shorter.<br>And a line.</p><script>var x = "<p>no</p>";</script></div><div class="sidebar"><p>About us, and you.</p></div></div>
<div class="comments"><h2>Replies</h2><div class="reply"><p>Great text, I would say. Thanks.</p></div></div><footer><p>All rights reserved, always.</p></footer></body></html>"""


def test_a_design_that_was_not_labelled(model):
    assert text_of(UNSEEN, model) == "On & off First, a sentence with a link and more words. Second one, shorter. And a line."


def brute_marginals(page, model):
    """Sum over all labellings."""
    n, seen = len(page.tags), html.features(page)
    weights = [0.0] * n
    total = 0.0
    for labels in itertools.product((0, 1), repeat=n):
        if labels[0] or any(y and never for y, never in zip(labels, page.never)):
            continue
        weight = 1.0
        for k in range(1, n):
            yes = model.bonds[f"edge {html.edge(page, k)}"][labels[page.parents[k]]]
            weight *= yes if labels[k] else 1 - yes
            if labels[k]:
                weight *= math.exp(min(30.0, max(-30.0, sum(model.odds.get(w, 0.0) for w in seen[k]))))
        total += weight
        weights = [w + weight * y for w, y in zip(weights, labels)]
    return [w / total for w in weights]


@pytest.mark.parametrize(
    "page",
    ["<div><p>One, two.</p><p>x</p></div>", "<body><nav><a>l</a></nav><div class=post><p>A b, c. <b>d</b><p>e</div>", "<ul><li>a<li>b, c.<form>f</form></ul><p>g"],
)
def test_messages_give_the_marginals_of_full_enumeration(model, page):
    parsed = html.parse(page)
    assert html.marginals(parsed, model) == pytest.approx(brute_marginals(parsed, model), abs=1e-9)


def test_odd_markup(model):
    for page in ("<", "<p", "<p a='", "</", "<!--", "<!", "<script>", "<a><b><c></a></b>", "&#0;&bad;", "<p>" * 3 + "</div>" * 5, "\x00<\x00>"):
        text_of(page, model)
    assert text_of("", model) == "" and text_of("just &lt;text&gt;\n here", model) == "just <text> here"
    start = time.time()
    for page in ("<div>" * 30_000, "<p>a, b. " * 30_000, "<" * 100_000, "<a b='" * 20_000, "<!--" * 50_000, "<script>" * 2_000, "</p>" * 30_000):
        text_of(page, model)
    assert time.time() - start < 60


CLEAN = """<!doctype html><html><head><title>T</title></head><body><header><nav><a href=/>Home</a> <a href=/w>World</a></nav></header><article><h1>Rain</h1>
<p>Rain fell, all day, on the hills and in the town.</p><p>Then, at last, it stopped, and the sun came out.</p><p>Nobody knew why, or when.</p></article>
<footer><p>Copyright, all rights reserved.</p></footer></body></html>"""
BEFORE, AFTER = "<p>Then, at last", "<p>Nobody knew"
BROKEN = {
    "head without end": CLEAN.replace("</head>", ""),
    "head without end or body": CLEAN.replace("</head><body>", ""),
    "form around the page": CLEAN.replace("<body>", "<body><form id=aspnet action=/x>").replace("</body>", "</form></body>"),
    "forms in forms around the page": CLEAN.replace("<body>", "<body><form><form>").replace("</body>", "</form></form></body>"),
    "form in the article": CLEAN.replace(AFTER, "<form>Your mail<input></form>" + AFTER),
    "closed svg": CLEAN.replace(AFTER, '<svg class="i"/>' + AFTER),
    "svg in svg": CLEAN.replace(AFTER, "<svg><text>a</text><svg><text>b</text></svg><text>label</text></svg>" + AFTER),
    "closed svg in svg": CLEAN.replace(AFTER, "<svg><svg/><text>label</text></svg>" + AFTER),
    "template in template": CLEAN.replace(AFTER, "<template><p>a<template><p>b</template><p>label</template>" + AFTER),
    "quote in a bare value": CLEAN.replace(AFTER, "<img alt=Bob's src=x>" + AFTER),
    "quotes between values": CLEAN.replace(AFTER, '<img alt="a" " title=\'>\' src=x">' + AFTER),
    "sign in a quoted value": CLEAN.replace(AFTER, "<img alt = 'a > b' title=\"<p>c\">" + AFTER),
    "comment without content": CLEAN.replace(AFTER, "<!-->" + AFTER),
    "comment of a dash": CLEAN.replace(AFTER, "<!--->" + AFTER),
    "comment with an odd end": CLEAN.replace(AFTER, "<!-- a > <p>b --!>" + AFTER),
}


@pytest.mark.parametrize("name", sorted(BROKEN))
def test_ordinary_flaws_lose_no_text(model, name):
    text = text_of(CLEAN, model)
    assert text.startswith("Rain Rain fell") and text.endswith("or when.")
    assert text_of(BROKEN[name], model) == text


def test_markup_is_read_in_linear_time(model):
    for part in ("<form>", "<svg>", "<header>", "<!--", "<a b=", "<a b='", "<form><article>", "</svg><svg/>", "<template>x"):
        start = time.time()
        text_of(part * 30_000, model)
        assert time.time() - start < 30, part


def test_odd_pages(spark, model):
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "t", "c"), (None, "u", "", "t", None), (2, "u", UNSEEN, None, "c"), (2, "u", UNSEEN, None, "c"), (3, "u", "<p>long, long. " * 20_000, "", "")]
    pages = spark.createDataFrame(rows, schema)
    out = html.extract(pages, model=model)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == 5
    assert out.where("page_id = 1").first()["text"] == "" and out.where("page_id = 2").distinct().count() == 1
    empty = spark.createDataFrame([], schema)
    assert html.extract(empty).count() == 0
    assert html.extract(pages).count() == 5
