"""Main-text extraction by a recurrent block labeller (operator 9).

A page is read as its sequence of leaf blocks.  Each block becomes a vector:
its hashed tag path, its hashed words and a few lengths; a bidirectional LSTM
reads the sequence and labels every block as article or not, so a block is
judged with the whole page around it.

The labeller is trained here, on the driver, on at most ``max_training``
pages of at most 200,000 characters (those with the smallest hash; 200 by default).  Labels come
from the pages' own markup: blocks in an article or main element count as
article unless an enclosing element is a menu, header, footer, sidebar,
notice, advert, form or comment list.  Such names do not count on html, on body
and, if they would leave no article, on the elements around the largest one;
pages without an article are not trained on.  So that words, lengths and neighbours
are learned too, and kinds of clutter that the sample lacks, copies of the
pages are trained with clutter blocks put in and with renamed containers.

Defined cases: null, empty and markup-only html give an empty text; truncated
pages are read to their end; repeated rows give a row each; a page of any
length is labelled whole; without training pages the markup rule decides.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.llm import store
from statlake.llm import words as W
from statlake.llm.bilstm import BiLSTM
from statlake.llm.html_blocks import blocks

N_PATH, N_WORDS, N_MORE = 192, 32, 8
#: Element and attribute words that mark clutter and article.
CLUTTER = frozenset("nav header footer aside form menu sidebar side notice cookie cookies consent banner ad ads advert adverts "
                    "advertisement sponsored promo promotion comment comments commentlist reply replies disqus discussion "
                    "breadcrumb breadcrumbs navigation newsletter subscribe signup share social related recommended popup modal "
                    "alert hidden login search toolbar pagination copyright legal complementary contentinfo".split())
ARTICLE = frozenset("article main articlebody".split())


def by_markup(path: tuple[str, ...], free: set[tuple[str, ...]] = frozenset()) -> bool:
    """Whether the path alone says article: in one, and in no clutter.  Names of
    html, of body and of the elements at ``free`` paths are no clutter."""
    inside = False
    for i, e in enumerate(path):
        names = e.split(" ")
        if names[0] in ("html", "body"):
            continue
        if CLUTTER.intersection(names) and path[:i + 1] not in free:
            return False
        inside = inside or not ARTICLE.isdisjoint(names)
    return inside


def markup_labels(page) -> list[bool]:
    """``by_markup`` of a page's blocks.  If clutter names leave no article, they
    do not count on the elements around the one that holds the most text: first
    of articles without such a name, then of article and main elements with one."""
    out = [by_markup(b[0]) for b in page]
    if any(out):
        return out
    plain: dict[tuple[str, ...], int] = {}
    named: dict[tuple[str, ...], int] = {}
    for path, text, *_ in page:
        for i, e in enumerate(path):
            names = e.split(" ")
            if names[0] in ("html", "body") or ARTICLE.isdisjoint(names):
                continue
            to = plain if CLUTTER.isdisjoint(names) else named if names[0] in ("article", "main") else None
            if to is not None:
                to[path[:i + 1]] = to.get(path[:i + 1], 0) + len(text)
    for found in (plain, named):
        for best in sorted(found, key=lambda k: (-found[k], len(k))):
            free = {best[:k] for k in range(1, len(best) + 1)}
            out = [by_markup(b[0], free) for b in page]
            if any(out):
                return out
    return out


def _path_slots(path: tuple[str, ...], memo: dict) -> np.ndarray:
    got = memo.get(path)
    if got is None:
        slots = set()
        for i, e in enumerate(path):
            names = e.split(" ")
            for w in names:
                slots.add(zlib.crc32(f"e {w}".encode()) % N_PATH)
            if i >= len(path) - 2:
                slots.add(zlib.crc32(f"{len(path) - i} {names[0]}".encode()) % N_PATH)
        got = np.fromiter(slots, np.int64)
        if len(memo) > 50_000:
            memo.clear()
        memo[path] = got
    return got


def vectors(pages: list[list[tuple[tuple[str, ...], str, int]]], memo: dict) -> list[np.ndarray]:
    """One matrix (blocks, features) per page."""
    flat = [b for page in pages for b in page]
    n = len(flat)
    x = np.zeros((n, N_PATH + N_WORDS + N_MORE), np.float32)
    if n:
        raw = [t.encode("utf-8", "replace") for _, t, _ in flat]
        offsets = np.cumsum([0, *map(len, raw)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        n_words = np.zeros(n)
        for a, b in W.slices(offsets):
            doc, h, _, _ = W.words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            if len(doc):
                slot = (h % np.uint64(N_WORDS)).astype(np.int64)
                x[a:b, N_PATH:N_PATH + N_WORDS] = np.bincount(doc * N_WORDS + slot, minlength=(b - a) * N_WORDS).reshape(b - a, -1)
                n_words[a:b] = np.bincount(doc, minlength=b - a)
        x[:, N_PATH:N_PATH + N_WORDS] /= np.maximum(1, n_words)[:, None]
        for i, (path, text, linked) in enumerate(flat):
            x[i, _path_slots(path, memo)] = 1
            x[i, -N_MORE:] = (np.log1p(len(text)) / 5, np.log1p(n_words[i]) / 5, min(1.0, linked / len(text)), text[-1] in ".!?:;\"'",
                              text[0].isupper(), sum(map(text.count, ",.")) / (1 + n_words[i]), text[0] in "©|", len(path) / 10)
    out, at = [], 0
    for page in pages:
        out.append(x[at:at + len(page)])
        at += len(page)
    return out


#: Containers put into training pages, as (path end, what it holds).
_CLUTTER_PATHS = (("aside sidebar", "ul", "li"), ("aside", "p"), ("div sidebar", "p"), ("div cookie notice", "p"),
                  ("div cookie consent banner", "p"), ("header",), ("header", "p"), ("header site header", "div logo"),
                  ("form newsletter", "p"), ("form", "label"), ("section comments", "div comment", "p"),
                  ("div comments", "ol commentlist", "li comment", "p"), ("ul comments", "li"), ("div ad", "p"),
                  ("div advert",), ("div ads banner",), ("div related", "ul", "li"), ("nav breadcrumb",), ("nav", "ul", "li"),
                  ("footer", "p"), ("footer", "ul", "li"), ("div share social",), ("div menu", "ul", "li"), ("div notice",))


def _variant(page, r: random.Random):
    """A copy of a page with clutter put in and the article's container renamed."""
    page = list(page)
    rename = r.choice(({}, {}, {"article": "main"}, {"article": "div articlebody"}, {"article": "div content"}, {"article": "section"}))
    cut = lambda t: " ".join(t.split(" ")[:r.choice((2, 5, 12, 30, 80))])
    texts = [t for _, t, _ in page] or ["x"]
    out = [(tuple(rename.get(e, e) for e in path), text, linked, label)
           for (path, text, linked), label in zip(page, markup_labels(page), strict=True)]
    inside = [i for i, b in enumerate(out) if b[3]]
    for _ in range(r.randrange(5)):
        end = r.choice(_CLUTTER_PATHS)
        at = r.choice(inside) if inside and r.random() < 0.5 else r.choice((1, len(out)))
        base = out[at][0][:3] if at < len(out) and out[at][3] else ("html", "body")
        got = [((*base, *end), cut(r.choice(texts)), 0, False) for _ in range(r.choice((1, 1, 2, 6)))]
        out[at:at] = got
        inside = [i for i, b in enumerate(out) if b[3]]
    return out


def train(pages: DataFrame, max_training: int = 200, hidden: int = 16, epochs: int = 8, seed: int = 5,
          id_col: str = "page_id", html_col: str = "html") -> BiLSTM | None:
    """Fit the labeller on a bounded sample; the same sample and seed give the same weights."""
    fit = pages.select(F.col(id_col).cast("string").alias("i"), F.col(html_col).alias("t")).filter("length(t) between 1 and 200000")
    rows = store.sample(fit, F.xxhash64("i", "t", F.lit(seed)), max_training).collect()
    rows.sort(key=lambda r: (r["i"] or "", r["t"]))
    r = random.Random(seed)
    memo: dict = {}
    sequences, labels = [], []
    for row in rows:
        page = blocks(row["t"])
        if not any(markup_labels(page)):  # no article to learn from
            continue
        if len(page) > 120:  # for training only: both ends of a long page
            page = page[:60] + page[-60:]
        if page:
            for v in ([(*b, k) for b, k in zip(page, markup_labels(page), strict=True)], _variant(page, r), _variant(page, r)):
                sequences.append([b[:3] for b in v])
                labels.append(np.array([float(b[3]) for b in v]))
    if not sequences:
        return None
    x = vectors(sequences, memo)
    keep = np.random.default_rng(seed)
    for i in range(len(x)):  # path slots go missing at random, so that the rest is read too
        if i % 3:
            x[i] = x[i].copy()
            x[i][:, :N_PATH] *= keep.random((1, N_PATH)) > 0.1
    model = BiLSTM(x[0].shape[1], hidden, seed).fit(x, labels, epochs)
    return model


def extract(pages: DataFrame, model: BiLSTM | None, keep: list[str], html_col: str = "html", out: str = "text",
            cut: float = 0.5) -> DataFrame:
    """The columns ``keep`` and ``out``, the article's blocks joined by newlines."""
    names = [f"_c{i}" for i in range(len(keep))]
    slim = pages.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, names, strict=True)], F.col(html_col).alias("_html"))
    cast = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model, memo = cast.value, {}
        for b in batches:
            source, texts = b.column(b.num_columns - 1), []
            for at in range(0, b.num_rows, 256):
                parsed = [blocks(h.as_py() or "") for h in source.slice(at, 256)]
                if model is None:
                    chosen = [markup_labels(page) for page in parsed]
                else:
                    chosen = [p > cut for p in model.predict(vectors(parsed, memo))]
                texts += ["\n".join(t for (_, t, _), k in zip(page, c, strict=True) if k) for page, c in zip(parsed, chosen, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [*names, "_text"])
    schema = T.StructType([*slim.drop("_html").schema.fields, T.StructField("_text", T.StringType())])
    return slim.mapInArrow(run, schema).toDF(*keep, out)


def op9_query(pages: DataFrame, **options) -> DataFrame:
    text = extract(pages, train(pages, **options), ["page_id", "url"])
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
