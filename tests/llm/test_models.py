"""Trained operators: held-out accuracy, and what they do with odd rows."""

from __future__ import annotations

import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import html, html_training, quality, toxicity
from quire.llm.common import mixed

from .conftest import collected, ordered

#: A table with enough labelled rows to measure on.
LABELLED = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{LABELLED}/documents.parquet")
    return docs, spark.read.parquet(f"{LABELLED}/labels.parquet")


@pytest.fixture(scope="module")
def toxic_model(labelled):
    return toxicity.learn(*labelled)


def test_toxicity_held_out(labelled, toxic_model):
    docs, labels = labelled
    scored = toxicity.toxicity(docs, toxic_model).join(labels, "doc_id").where("held_out and toxic is not null").select("score", "predicted", "toxic").collect()
    score, said, true = (np.array(c) for c in zip(*scored, strict=True))
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(len(score))
    n = true.sum()
    assert (rank[true == 1].mean() - (n - 1) / 2) / (len(true) - n) > 0.9
    hit = ((said == 1) & (true == 1)).sum()
    assert hit / n > 0.75
    assert hit / (said == 1).sum() > 0.8


def test_toxicity_rows(docs, none, texts, toxic_model):
    got = collected(toxicity.toxicity(docs, toxic_model))
    assert [(r[0], r[1]) for r in got] == [(r[0], r[1]) for r in ordered((i, i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in texts)]
    assert all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.3) for r in got)
    assert toxicity.toxicity(none, toxic_model).count() == 0


def test_toxicity_reads_whole_texts(toxic_model):
    plain = b"the thing is of that and in the other one " * 400
    ends = [plain, plain + b"you are a stupid worthless idiot moron scum, pathetic loser, disgusting trash " * 30]
    low, high = toxic_model.scores(ends)
    assert high > low


def test_toxicity_counts_every_window(toxic_model):
    """More toxic windows never score less, however many there are already; very long texts are no exception."""
    scores = [float(toxic_model.features([b"stupid " * k + b"the thing of that " * 500])[0] @ toxic_model.weights) for k in (0, 1, 5, 10, 50, 400)]
    assert scores == sorted(scores)
    assert len(set(scores)) == len(scores)


def test_scores_against_plain_python(toxic_model, docs):
    """Each word is compressed with either dictionary, the lengths are compared, and the model's sum is taken by hand."""
    import math
    import re

    import zstandard

    def length(content, word):
        data = zstandard.ZstdCompressionDict(content + toxicity.BEFORE, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packer = zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False)
        return len(packer.compress(toxicity.BEFORE + b" " + word + b" " + toxicity.AFTER))

    def score(text):
        gains = [length(toxic_model.ordinary, w) - length(toxic_model.toxic, w) for x in re.findall(rb"[^\x20\x09-\x0D]+", text.lower()) for w in (x[k : k + 24] for k in range(0, len(x), 24))]
        n = max(1, len(gains))
        x = [1.0] + [v for least in toxicity.THRESHOLDS for v in (math.log1p(sum(g >= least for g in gains)), math.sqrt(sum(g >= least for g in gains) / n))] + [math.log(n)]
        return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, toxic_model.weights, strict=True))))

    few = docs.where("length(text) < 300 or text is null")
    got = sorted(r.score for r in toxicity.toxicity(few, toxic_model).collect())
    assert got == pytest.approx(sorted(score((r.text or "").encode()) for r in few.collect()))


def test_long_labelled_texts_are_used(spark):
    """Labelled texts of any length train the model."""
    rng = np.random.default_rng(0)
    words = ["".join(chr(97 + int(c)) for c in str(k)) for k in range(1000, 1300)]
    text = lambda bad: " ".join(x for w in rng.choice(words, 5000) for x in ([w, "vileword"] if bad and rng.random() < 0.02 else [w]))
    rows = [(k, text(k % 2)) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, toxic int"))
    assert b"vileword" in model.toxic
    low, high = model.scores([text(0).encode(), text(1).encode()])
    assert high > 0.5 > low


def test_toxicity_without_labels(docs, none, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for table in (docs, none):
        model = toxicity.learn(table, labels)
        assert toxicity.toxicity(docs, model).count() == docs.count()


def test_quality_held_out(labelled):
    """A model and threshold from even ids judge the odd ones."""
    docs, labels = labelled
    even = labels.where("doc_id % 2 = 0")
    model = quality.learn(docs, even)
    got = quality.scored(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").select((F.col("per_word") >= model.threshold).alias("kept"), "quality").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert np.mean(good) > 0.99
    assert np.mean(bad) < 0.03


def test_quality_rows(docs, none, texts, spark):
    known = [(i, int(len(t or "") > 50)) for i, t in texts if i is not None]
    labels = spark.createDataFrame([*known, (None, 1), (5, None)], "doc_id long, quality int")
    got = quality.quality(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in texts)
    n = sum(r.accepted for r in got)
    keys = sorted((r.key for r in got), reverse=True)
    assert all(r.sampled == (r.key >= keys[n - 1]) for r in got)
    assert quality.accepted(docs, labels).columns == docs.columns
    assert quality.quality(none, labels).count() == 0
    assert quality.accepted(docs, labels.limit(0)).count() == docs.count()


def test_quality_scores_against_plain_counts(docs, texts, spark):
    """Ratios of the two models and log weights from counts that are made anew, n-gram by n-gram."""
    from collections import Counter
    from math import log

    from quire.llm.common import Words

    known = {i: int(len(t or "") > 50) for i, t in texts if i is not None}
    model = quality.learn(docs, spark.createDataFrame(list(known.items()), "doc_id long, quality int"))

    def buckets(text):
        words = Words([(text or "").encode()])
        code, shape, n = [int(c) for c in words.code], [int(x) for x in quality.shapes(words)], quality.BUCKETS
        mix = lambda v: int(mixed(np.array([v % 2**64], dtype=np.uint64))[0])
        pairs = range(len(code) - 1)
        return [mix(shape[k] * 4096 + shape[k + 1]) % n for k in pairs] + [n + mix(c) % n for c in code] + [n + mix(code[k] * 3 + mix(code[k + 1])) % n for k in pairs]

    raw, good = Counter(), Counter()
    for i, t in texts:
        raw.update(buckets(t))
        if known.get(i):
            good.update(buckets(t))
    n = quality.BUCKETS
    totals = [[sum(v for b, v in c.items() if b // n == part) for part in (0, 1)] for c in (raw, good)]

    def ratio(b):
        share = (raw[b] + 1) / (totals[0][b // n] + n)
        weight = 0.05 * max(1.0, totals[1][b // n]) / 100
        return log((good[b] + weight * share) / (totals[1][b // n] + weight)) - log(share)

    got = sorted(r.log_weight for r in quality.scored(docs, model).collect())
    assert got == pytest.approx(sorted(sum(map(ratio, buckets(t))) for _, t in texts), abs=1e-6)


def test_kth_largest(spark, monkeypatch):
    monkeypatch.setattr(quality, "FEW_ROWS", 20)
    values = [float(k % 37) / 3 - k % 5 for k in range(500)] + [7.0] * 200
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = sorted(values, reverse=True)
    for k in (1, 2, 50, 333, 700):
        assert quality.kth_largest(df, "v", k) == want[k - 1]
    assert quality.kth_largest(df, "v", 0) is None
    assert quality.kth_largest(df, "v", 9999) == want[-1]
    assert quality.kth_largest(df.limit(0), "v", 3) is None


PAGE = """<html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">More</a></li></ul></nav><div class="ad">Buy this thing now.</div>
<article><h1>The headline of it</h1><p>First  paragraph &amp; more\nof it with several words in a row, and then some.</p><!-- note --><p>Second <b>bold</b> words that go on for a while, as texts do.<br>After break.</p></article>
<div class="comments"><p>I like this.</p></div><form><label>Name</label></form><footer>© 2024 all rights</footer></body></html>"""


@pytest.fixture(scope="module")
def labeller():
    return html.trained()


def test_main_text(labeller):
    assert html.main_texts([PAGE, ""], labeller) == ["The headline of it\nFirst paragraph & more of it with several words in a row, and then some.\nSecond bold words that go on for a while, as texts do. After break.", ""]


NEUTRAL = """<body><div id="x1"><a href="/">Home</a> <a href="/n">News</a> <a href="/c">Contact</a></div><div id="x2"><h1>What the river brought</h1><p>After the long rain the
river rose for three days, and the people of the lower town carried what they could up the hill.</p><p>On the fourth day it fell again, and they found the bridge where it had always been.</p></div>
<div id="x3"><h3>Comments (2)</h3><p><b>ann</b> Great story, thanks!</p><p><b>bob</b> I was there, it was worse than this.</p></div><div id="x4">Copyright 2024 The Daily Example. All rights reserved.</div></body>"""


def test_page_without_telling_names(labeller):
    got = html.main_texts([NEUTRAL], labeller)[0].split("\n")
    assert got == ["What the river brought", "After the long rain the river rose for three days, and the people of the lower town carried what they could up the hill.", "On the fourth day it fell again, and they found the bridge where it had always been."]


def test_made_up_pages(labeller):
    assert html_training.accuracy(labeller) > 0.98


def plain_labels(page, model):
    """Labels of a page's blocks by the model's equations, number by number and without numpy's arrays of pages."""
    from math import exp, tanh

    w = {k: v.astype(float).tolist() for k, v in model.weights.items()}
    x, size = html.vectors(page).astype(float).tolist(), html.HIDDEN
    sigmoid = lambda v: 1 / (1 + exp(-v))
    shown = {}
    for d, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
        h, c = [0.0] * size, [0.0] * size
        for t in order:
            z = [w[f"c{d}"][j] + sum(v * w[f"x{d}"][i][j] for i, v in enumerate(x[t]) if v) + sum(v * w[f"h{d}"][i][j] for i, v in enumerate(h)) for j in range(4 * size)]
            c = [sigmoid(z[size + j]) * c[j] + sigmoid(z[j]) * tanh(z[3 * size + j]) for j in range(size)]
            h = [sigmoid(z[2 * size + j]) * tanh(c[j]) for j in range(size)]
            shown[d, t] = h
    return [sum(v * o[0] for v, o in zip(shown["f", t] + shown["b", t] + x[t], w["o"], strict=True)) + w["p"][0] >= 0 for t in range(len(x))]


def test_texts_against_plain_equations(spark, data, labeller):
    """The query's texts are the blocks that the model labels when its equations are followed one by one; on these pages they are those of the article."""
    import re

    pages = spark.read.parquet(f"{data}/pages.parquet").limit(12)
    for r in html.main_text(pages, model=labeller).join(pages.select("page_id", "html"), "page_id").collect():
        found = html.blocks(r.html)
        assert r.text == "\n".join(b.text for b, keep in zip(found, plain_labels(found, labeller), strict=True) if keep)
        inside = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)
        if inside:
            assert r.text == "\n".join(b.text for b in html.blocks(inside[1]))


def test_late_words_count(labeller):
    """A block is judged by all its words: those after hundreds of others change its vector."""
    first, second = (html.vectors(html.blocks(f"<p>{'word ' * 400}{end}</p>"))[0] for end in ("comment reply", "river bridge"))
    assert (first != second).any()


@pytest.mark.parametrize("page", ["<div>a " * 50_000, "<b><div></b>x" * 20_000, "<i>" * 30_000 + "</b>y" * 30_000 + "<b>", "<div><b>" * 20_000 + "z</b>" * 20_000, "<p class='" + "w " * 100_000 + "'>text", "<table><tr><td>q" * 10_000])
def test_deep_pages_take_linear_time(page):
    began = time.perf_counter()
    html.vectors(html.blocks(page))
    assert time.perf_counter() - began < 20


def test_gradients():
    model = html.Labeller(3)
    rng = np.random.default_rng(0)
    x, mask = rng.standard_normal((2, 4, html.SIZE)).astype(np.float64), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], dtype=bool)
    y = (rng.random((2, 4)) > 0.5).astype(float)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}

    def loss():
        p = model.scores(x, mask)
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    for name, g in html_training.gradients(model, x, mask, y).items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        held = model.weights[name][at]
        model.weights[name][at] = held + 1e-4
        up = loss()
        model.weights[name][at] = held - 1e-4
        assert (up - loss()) / 2e-4 == pytest.approx(g[at], rel=2e-2, abs=1e-5)
        model.weights[name][at] = held


def test_pages_table(spark, labeller):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "", "", "x"), (None, "u", "no tags at all", "x"), (1, "u", PAGE, "x"), (4, "u", "<div>" * 50_000 + "deep", "x"), (5, "u", "<", "x")], "page_id long, url string, html string, text string")
    got = html.main_text(pages, model=labeller)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = collected(got)
    assert len(rows) == 7
    assert all(r[3] == len(r[2]) for r in rows)
    assert rows[1][2] == rows[2][2]
    assert html.main_text(pages.limit(0), model=labeller).count() == 0


def article_lines(page: str) -> list[str]:
    """Lines of a page's article by the standard library's parser, without the package's cutter."""
    from html.parser import HTMLParser

    inline = set("a abbr b cite code em i mark q s small span strong sub sup time u".split())

    class Lines(HTMLParser):
        def __init__(self):
            super().__init__()
            self.inside, self.lines, self.held = 0, [], []

        def end_line(self):
            line = " ".join("".join(self.held).split())
            self.lines += [line] if line else []
            self.held = []

        def handle_starttag(self, tag, attrs):
            if tag == "br":
                self.held.append(" ")
            elif tag not in inline:
                self.end_line()
            self.inside += tag == "article"

        def handle_endtag(self, tag):
            if tag not in inline:
                self.end_line()
            self.inside -= tag == "article"

        def handle_data(self, data):
            if self.inside and self.cdata_elem is None:
                self.held.append(data)

    parser = Lines()
    parser.feed(page)
    parser.close()
    parser.end_line()
    return parser.lines


def test_articles_against_another_parser(spark, data, labeller):
    rows = spark.read.parquet(f"{data}/pages.parquet").where("html like '%<article>%'")
    got = html.main_text(rows, model=labeller).join(rows.select("page_id", "html"), "page_id").collect()
    assert len(got) > 10
    assert [r.page_id for r in got if r.text.split("\n") != article_lines(r.html)] == []


@pytest.mark.parametrize(
    "page,want",
    [
        ('<p>one</p><svg viewBox="0 0 1 1"/><p>two</p>', ["one", "two"]),
        ("<div><noscript>hidden<p>more</div><p>two", ["two"]),
        ("<div><svg><svg><path/></svg>in</svg>one</div><p>two", ["one", "two"]),
        ("<div><svg><g>in</div><p>two", ["two"]),
        ("<div><template>a<template>b</template>c</template>one</div>", ["one"]),
        ("<iframe src=x><p>after", ["after"]),
        ("<div><select><option>a</div>two", ["two"]),
        ("x<SCRIPT>if (a<b) '</p>'</script >y<style>p{}</style>z", ["xyz"]),
        ('<p title="a>b">one</p><p title="c>two</p><p>three', ["one", "two", "three"]),
        ("<p class='x\">one</p>", ["one"]),
    ],
)
def test_unclosed_and_self_closed_elements(page, want):
    """An element without text that nothing closes ends with its parent; nothing behind it is lost."""
    assert [b.text for b in html.blocks(page)] == want


@pytest.mark.parametrize("page", ["<a " * 350_000 + '"', "<a '" * 200_000 + "<p \"x", "<svg>" * 200_000 + "x", "<div><noscript><p>x" * 30_000, "<template>" * 50_000 + "</template>" * 40_000, "<a b='" * 150_000])
def test_odd_tags_take_linear_time(page):
    began = time.perf_counter()
    html.blocks(page)
    assert time.perf_counter() - began < 20


@pytest.mark.parametrize("times", [5, 40, 130])
def test_repeated_lines_of_an_article(labeller, times):
    """Short lines that an article repeats are main text, every one of them."""
    lines = ["Sa mera thori."] * times
    page = f"<html><body><nav><a href='/'>Home</a> <a href='/n'>News</a></nav><article><h1>Mera quothe</h1><p>Enthe morila quo sa thorimen, ve ti la mo.</p>{''.join(f'<p>{x}</p>' for x in lines)}</article><footer>© 2024 All rights reserved.</footer></body></html>"
    assert html.main_texts([page], labeller)[0].split("\n") == ["Mera quothe", "Enthe morila quo sa thorimen, ve ti la mo.", *lines]
