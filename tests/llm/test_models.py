"""Language identification, quality and page text."""

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from signalloom.llm import html_text, language_id, quality


def test_forward_sums_all_segmentations():
    vocabulary = sorted({b" ", b" a", b"a", b"b", b"ab", b"ba", b" ab", b"aba", b"c"})
    rng = np.random.default_rng(1)
    prob = rng.random((len(vocabulary), 2))
    lattice = language_id.Lattice(vocabulary)
    texts = [b" abab", b" aba", b" ab", b" c", b" bcab"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    end = np.cumsum([len(t) for t in texts])
    start = end - [len(t) for t in texts]
    order = np.argsort(start - end, kind="stable")
    arcs = lattice.arcs(data, start[order], end[order])
    alpha = language_id.forward(arcs, len(texts), 5, prob)

    def total(t, k):
        if not t:
            return 1.0
        return sum(prob[i, k] * total(t[len(p):], k) for i, p in enumerate(vocabulary) if t.startswith(p))

    for at, w in enumerate(order):
        for k in range(2):
            assert alpha[len(texts[w]), at, k] == pytest.approx(total(texts[w], k))


def test_expected_uses():
    vocabulary = [b" a", b"a", b"b", b" ", b"ab", b" ab"]
    prob = np.array([[0.2], [0.1], [0.3], [0.1], [0.2], [0.1]])
    word = b" abab"

    def segmentations(t):
        if not t:
            yield []
        for i, p in enumerate(vocabulary):
            if t.startswith(p):
                for rest in segmentations(t[len(p):]):
                    yield [i, *rest]

    ways = list(segmentations(word))
    weight = [math.prod(prob[i, 0] for i in w) for w in ways]
    want = np.zeros(len(vocabulary))
    for w, x in zip(ways, weight):
        for i in w:
            want[i] += 3 * x / sum(weight)
    arcs = language_id.Lattice(vocabulary).arcs(np.frombuffer(word, np.uint8), np.array([0]), np.array([5]))
    got = language_id.expected(arcs, np.array([5]), np.array([3.0]), prob)
    assert got == pytest.approx(want)


def speech(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


LANGS = {"en": ["the", "ing", "tion", "and"], "de": ["sch", "ung", "für", "ich"], "fr": ["eau", "ère", "oux", "qu"]}


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(4)
    rows = [(k, speech(rng, s, 60), lang) for k in range(30) for lang, s in LANGS.items()]
    rows += [(900, None, "en"), (901, "text without a language", None), (902, "", "de")]
    return language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_language(spark, model, docs, nothing):
    rng = random.Random(5)
    rows = [(k, speech(rng, s, n), lang) for k in range(20) for n in (5, 200) for lang, s in LANGS.items()]
    rows += [(800, None, "und"), (801, "", "und"), (802, " 12 !? ’", "und"), (803, "sch" * 40_000, "de"),
             (804, "THE ING TION " * 3, "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.predict(frame.repartition(3), model).collect()
    want = {}
    for i, _, lang in rows:
        want.setdefault(i, set()).add(lang)
    right = [r["lang_pred"] in want[r["doc_id"]] for r in got]
    assert np.mean(right) > 0.97
    odd = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got if r["doc_id"] >= 800}
    assert [odd[k][0] for k in (800, 801, 802, 803, 804)] == ["und", "und", "und", "de", "en"]
    assert odd[800][1] == odd[802][1] == 0 and all(0 <= r["score"] <= 1 for r in got)
    kept = language_id.confident(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert language_id.predict(nothing, model).count() == 0


def test_language_does_not_depend_on_batches(spark, model):
    rng = random.Random(6)
    rows = [(k, speech(rng, LANGS["fr"] + LANGS["de"], 8)) for k in range(50)]
    one = language_id.predict(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), model)
    many = language_id.predict(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(7), model)
    for a, b in zip(one.orderBy("doc_id").collect(), many.orderBy("doc_id").collect()):
        assert a["lang_pred"] == b["lang_pred"] and a["score"] == pytest.approx(b["score"], abs=1e-9)


def test_language_without_rows(spark, docs):
    empty = language_id.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in language_id.predict(docs, empty).collect()} == {"und"}


def test_quality(spark, docs, nothing):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(400):
        good = k % 3 != 0
        text = speech(rng, LANGS["en"], rng.choice([20, 80]))
        rows.append((k, text if good else " ".join(f"{w}!!" for w in text.upper().split())))
        labels.append((k, int(good), 0))
    labels += [(5000, 1, 0), (None, 0, 0), (3, None, 0)]
    frame = spark.createDataFrame(rows + [(700, None), (701, ""), (None, "A text")], "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights = quality.train(frame, table.where("doc_id % 5 != 0 OR doc_id IS NULL"))
    got = quality.score(frame, weights).collect()
    assert len(got) == len(rows) + 3 and all(0 < r["score"] < 1 for r in got)
    held = [(r["score"] >= 0.5) == (r["doc_id"] % 3 != 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 400
            and r["doc_id"] % 5 == 0]
    assert np.mean(held) > 0.97
    assert np.allclose(weights, quality.train(frame.repartition(2), table.where("doc_id % 5 != 0 OR doc_id IS NULL")))
    none = quality.train(frame, table.limit(0))
    assert {r["score"] for r in quality.score(frame, none).collect()} == {0.5}
    assert quality.score(docs, weights).count() == docs.count() and quality.score(nothing, weights).count() == 0


def test_quality_dot_products():
    texts = ["Aa bb bb", "", None, "x", "One TWO three. four"]
    w = np.random.default_rng(0).normal(size=(1 << quality.BITS) + 1)
    sparse = [w[number] @ value for number, value in quality.vectors(pa.array(texts))]
    total = np.zeros(len(texts))
    for i, j, views in quality.grams(pa.array(texts)):
        for of, number in views:
            total[i:j] += np.bincount(of, w[number], j - i) / np.maximum(1, np.bincount(of, minlength=j - i))
    assert np.allclose(sparse, total)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a><li>More</ul></nav><!-- <p>no</p> -->
<div class="ad-box">Buy</div><div id="cookie-notice"><p>We use</div>{body}
<aside>Side</aside><form>Name <input name=x value="a>b"></form><section id="comments"><p>First!</p></section>
<footer>&copy; 2024</footer></body></html>"""


@pytest.mark.parametrize("body,want", [
    ("<article><h1>A &amp; B</h1><p>One <b>two</b><br>three<p>four&nbsp;&eacute;</article>", "A & B\nOne two three\nfour é"),
    ("<main><div>Plain <span>text</span></div><div class='share-bar'>Share</div></main>", "Plain text"),
    ("<article><p>Text</p><article class=comment><p>me too</p></article><div class=related>x</div></article>", "Text"),
    ("<div class='entry-content'><p>In</p></div><div>Out</div>", "In"),
    ("<p>Loose &lt;b&gt; &#x41;</p>", "Loose <b> A"),
    ("<article><p>cut <b>off", "cut off"),
    ("<article><script>if (a<b) x()</script><p hidden>h</p><p style='display: none'>s</p></article>", ""),
])
def test_blocks(body, want):
    lines = html_text.blocks(PAGE.format(body=body))
    assert html_text.article(lines, []) == want


ARTICLE = "<article><h1>T</h1><p>Text</p></article>"


@pytest.mark.parametrize("body,want", [
    (f"<div class='page-with-sidebar'>{ARTICLE}</div>", "T\nText"),
    (f"<div class='layout-no-sidebar'>{ARTICLE}</div>", "T\nText"),
    (f"<div class='page-sidebar'>{ARTICLE}</div>", "T\nText"),
    ("<div class='layout-no-sidebar'><p>Text</p></div>", "Text"),
    ("<article class='post comments-open'><p>Text</p></article>", "Text"),
    (f"<form action='x.aspx'><div>Search</div>{ARTICLE}</form>", "T\nText"),
    ("<form action='x.aspx'><div class='content'><p>Text</p></div></form>", "Text"),
    ("<form action='x.aspx'><div><p>Text</p></div></form>", "Text"),
    (f"<main><form>{ARTICLE}</form></main>", "T\nText"),
    ("<div class='entry-content'><div class='entry-header'><h1>Title</h1></div><p>In</p></div>", "Title\nIn"),
    (f"<div><span class='text'>Loose</span><p class='body'>Other</p></div>{ARTICLE}", "T\nText"),
    ("<p class='body'>One</p><p>Two</p>", "One\nTwo"),
    (f"<div class='content'>Chrome</div>{ARTICLE}", "T\nText"),
    (f"{ARTICLE}<div class='related'><article><p>Teaser</p></article></div>", "T\nText"),
    (f"<div class='entry-content'><p>In</p></div><ol class='comments'><li>{ARTICLE}</ol>", "In"),
    (f"<div id='popup-wrapper'><div>x</div>{ARTICLE}<div class='related'><article>Teaser</article></div></div>", "T\nText"),
])
def test_names_do_not_drop_articles(body, want):
    assert html_text.article(html_text.blocks(PAGE.format(body=body)), []) == want


def test_differencing():
    loose = lambda *x: [(t, 0) for t in x]
    a, b = loose("Top", "Mine is this long line", "End"), loose("Top", "Another text entirely here", "End")
    assert html_text.article(a, [b]) == "Mine is this long line"
    assert html_text.article(a, [a, a]) == "Top\nMine is this long line\nEnd"
    inside = [("Title", 2), ("Share", 1), ("Own paragraph", 2)]
    assert html_text.article(inside, [[("Title", 2), ("Share", 1), ("Other paragraph", 2)]]) == "Title\nOwn paragraph"


def test_short_article_in_a_large_template():
    loose = lambda *x: [(t, 0) for t in x]
    chrome = [f"Menu entry number {k} of the template" for k in range(40)]
    a = loose(*chrome, "A short article about the first of all the subjects of this site", "End")
    b = loose(*chrome, "Another one that tells of what has happened elsewhere meanwhile", "End")
    edited = loose(*chrome, "A short article about the first of all the matters of this site", "End")
    assert html_text.article(a, [b]) == a[40][0]
    assert html_text.article(a, [edited]) == html_text.article(a, [a])


def pages_of(spark, bodies, partitions=3):
    frame = spark.createDataFrame(
        [(k, f"https://h.example/{k:04}", "<div>Menu</div><div>Top</div>" + x + "<div>Foot</div>")
         for k, x in enumerate(bodies)], "page_id long, url string, html string")
    return frame.repartition(partitions)


def test_copies_are_compared_with_others(spark):
    texts = [f"Text {k if k < 3 or k > 7 else 'of a copy'} {'x' * 60}" for k in range(11)]
    got = html_text.main_text(pages_of(spark, [f"<div>{x}</div>" for x in texts])).collect()
    assert {r["page_id"]: r["text"] for r in got} == dict(enumerate(texts))


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_texts_do_not_depend_on_blocks(spark, size):
    texts = [f"Text {min(k % 10, 6)} {k // 10} {'x' * 60}" for k in range(60)]
    frame = pages_of(spark, [f"<div>{x}</div>" for x in texts])
    got = html_text.main_text(frame, pages_per_block=size).collect()
    assert {r["page_id"]: r["text"] for r in got} == dict(enumerate(texts)) and len(got) == 60


def test_common_is_a_longest_subsequence():
    rng = random.Random(1)
    for _ in range(100):
        a, b = [rng.sample("abcdefghij", rng.randint(0, 10)) for _ in range(2)]
        best = max((n for n in range(len(a) + 1) for c in itertools.combinations(a, n)
                    if all(x in it for it in [iter(b)] for x in c)), default=0)
        got = html_text.common(a, b)
        assert len(got) == best and got == sorted(got)
    assert html_text.common(list("aab"), list("aba")) in ([0, 2], [0, 1])


def test_main_text(spark):
    rows = [(k, f"https://Host.example/{k % 3}/{k}.html?x=1#y", f"<body><div>Menu</div><p>Text of {k} {'x' * 60}</p><div>Foot</div>")
            for k in range(40)]
    rows += [(100, None, None), (101, "", ""), (102, "https://other.example/", "<p>Alone</p>"), (None, None, "<p>Unnumbered</p>"),
             (5, *rows[5][1:])]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, lines string")
    got = html_text.main_text(frame.repartition(4)).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert all(text[k] == f"Text of {k} {'x' * 60}" for k in range(40) if k not in (5, 4, 6))
    assert (text[100], text[101], text[102], text[None]) == ("", "", "Alone", "Unnumbered")
    again = html_text.main_text(frame.repartition(2)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert html_text.main_text(frame.limit(0)).count() == 0
