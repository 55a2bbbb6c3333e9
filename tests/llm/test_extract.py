import numpy as np
import pytest

from statlake.llm import extract as X
from statlake.llm.bilstm import BiLSTM, pad
from statlake.llm.html_blocks import blocks


def test_blocks_of_malformed_html():
    page = """<html><head><title>No</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
    <nav><ul><li><a href="/">Home</a><li>Two</ul></nav><!-- ad <p>no</p> --><article class='Main story'><h1>A &amp; B</h1>
    <p>One <b>two</b>\n three<br>four<p>Five &copy; a < b &amp c <p>caf&eacute;&#33; &am</article><footer>end"""
    got = blocks(page)
    assert [t for _, t, _ in got] == ["Home", "Two", "A & B", "One two three four", "Five © a < b & c", "café! &am", "end"]
    assert got[3][0] == ("html", "body", "article main story", "p") and got[0][2] == 4
    assert blocks("") == [] and blocks("<p></p><br>") == [] and [t for _, t, _ in blocks("plain")] == ["plain"]
    assert [t for _, t, _ in blocks("a<script>x")] == ["a"] and [t for _, t, _ in blocks("<p title='x")] == []
    assert len(blocks("<p>" * 3000 + "deep")) == 1 and len(blocks("<div>x" * 3000)) == 3000


def test_gradient_is_right():
    r = np.random.default_rng(0)
    m = BiLSTM(5, 3)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, mask = pad([r.normal(size=(4, 5)), r.normal(size=(2, 5))])
    y = np.array([[1, 0, 1, 0], [0, 1, 0, 0]], float)

    def loss():
        z = m.forward(x, mask)[0]
        return ((np.log1p(np.exp(z)) - y * z) * mask).sum() / mask.sum()
    _, g = m.gradient(x, mask, y)
    for k, p in m.p.items():
        for i in r.choice(p.size, min(4, p.size), replace=False):
            old = p.flat[i]
            p.flat[i] = old + 1e-5
            up = loss()
            p.flat[i] = old - 1e-5
            down = loss()
            p.flat[i] = old
            assert abs((up - down) / 2e-5 - g[k].flat[i]) < 1e-6, k


def test_padding_and_batches_do_not_matter():
    r = np.random.default_rng(1)
    m = BiLSTM(4, 3)
    seqs = [r.normal(size=(n, 4)).astype(np.float32) for n in (1, 7, 0, 3, 300)]
    many = m.predict(seqs)
    for s, p in zip(seqs, many):
        assert len(p) == len(s) and (not len(s) or np.allclose(p, m.predict([s])[0], atol=1e-5))


def _page(i, body):
    return (f"<!DOCTYPE html><html><head><title>t{i}</title></head><body><nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
            f"<div class='ad'>Buy now {i}</div><article><h1>Title {i}</h1>{body}</article><footer>&copy; site {i}</footer></body></html>")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"u{i}", _page(i, "".join(f"<p>Sentence {k} of page {i}, it goes on.</p>" for k in range(1 + i % 5))), "x", 1) for i in range(60)]
    rows += [(100, None, None, "x", 1), (101, "u", "", "x", 1), (102, "u", "<script>only", "x", 1), (None, "u", _page(0, "<p>No id.</p>"), "x", 1),
             (103, "u", _page(3, "<p>w " + "long " * 40000 + "</p>"), "x", 1), (5, "u5", _page(5, "<p>Again.</p>")[:-40], "x", 1),
             (104, "u", _page(1, "<p>Text &lt;b&gt; here.</p><aside class='sidebar'><p>Read more</p></aside><section class='comments'><p>Nice post</p></section>"), "x", 1)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")


def test_article_text(pages):
    got = X.op9_query(pages).collect()
    assert len(got) == pages.count()
    by = {r["page_id"]: r for r in got if r["page_id"] != 5}
    for i in range(60):
        if i != 5:
            want = [f"Title {i}"] + [f"Sentence {k} of page {i}, it goes on." for k in range(1 + i % 5)]
            assert by[i]["text"] == "\n".join(want) and by[i]["n_chars"] == len(by[i]["text"])
    assert [by[i]["text"] for i in (100, 101, 102)] == ["", "", ""]
    assert by[103]["n_chars"] == len("Title 3\nw " + "long " * 40000) - 1
    assert by[104]["text"] == "Title 1\nText <b> here." and by[None]["text"] == "Title 0\nNo id."


def test_real_pages_hold_out(spark):
    import re
    import html as H
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    model = X.train(pages, max_training=25)
    got = {r["page_id"]: r["text"] for r in X.extract(pages, model, ["page_id"]).collect()}
    wrong = 0
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [re.sub(r"[\x20\t-\r]+", " ", H.unescape(re.sub(r"<[^>]*>", "", x))).strip(" ") for x in re.split(r"</?(?:p|h1)[^>]*>", inner)]
        wrong += got[r["page_id"]] != "\n".join(x for x in parts if x)
    assert wrong <= 1


def test_no_pages(pages):
    assert X.op9_query(pages.filter("false")).count() == 0
    assert [r["text"] for r in X.extract(pages.filter("page_id = 1"), None, ["page_id"]).collect()][0].startswith("Title 1")


@pytest.mark.parametrize("body, wrapper", [("<body class='post has-sidebar'>", "<div id='page' class='header-fixed'>"), ("<body>", "<div class='site with-menu'>")])
def test_clutter_words_around_the_article(spark, body, wrapper):
    def wrapped(i, text):
        return _page(i, text).replace("<body>", body + wrapper).replace("</body>", "</div></body>")
    rows = [(i, f"u{i}", wrapped(i, "".join(f"<p>Sentence {k} of page {i}, it goes on.</p>" for k in range(1 + i % 5)))) for i in range(40)]
    rows += [(200 + i, "u", f"<html>{body}<div><p>Just {i} words</p></div></body></html>") for i in range(40)]  # no article container
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: "\n".join([f"Title {i}"] + [f"Sentence {k} of page {i}, it goes on." for k in range(1 + i % 5)]) for i in range(40)}
    for model in (X.train(frame), None):
        got = {r["page_id"]: r["text"] for r in X.extract(frame, model, ["page_id"]).collect()}
        assert {i: got[i] for i in want} == want
    assert X.train(frame.filter("page_id >= 200")) is None
    aside = "<article><p>Text.</p><aside class='sidebar'><p>More</p></aside><p>On.</p></article>"
    aside += "<div class='comments'><article class='comment'><p>Nice, and a longer text than the other.</p></article></div>"
    page = blocks(f"<html>{body}{wrapper}<header><p>Top</p></header>{aside}</div></body></html>")
    assert [b[1] for b, k in zip(page, X.markup_labels(page)) if k] == ["Text.", "On."]
