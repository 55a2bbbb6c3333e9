"""Benchmark decontamination by SimHash windows (operator 10).

A document leaks an item if one of its windows of the item's length (in
words) has a weighted similarity of 0.8 or more with it: shingles of five
words, counted with repeats, sum of minima over sum of maxima.  Texts shorter
than five words are one shingle; a document shorter than the item is one window.

1. Windows.  A window that similar holds at least t / (1 + t) of its own and
   the item's shingles together (t: the threshold), in any order.  So all
   windows of the item's length are taken that hold so many places of shingles
   of the item: this loses none, also where parts of an item are swapped.
   Their number is at most 9/8 of the number of such places.
2. SimHash.  Each window and item gets 64 bits from its weighted shingles.
   A multi-index over 8 blocks of 8 bits looks up, in each block, all values
   within 2 bits: by the pigeonhole rule it meets every fingerprint within
   ``RADIUS`` (20) bits.  Windows at similarity 0.8 differ in 10 bits on average;
   one that differs in more than ``radius`` is not found (measured with random
   shingles at 0.8: 20 of 160,000).
3. Candidates are verified by their exact similarity.

Documents are scanned where they lie: no shuffle, no skew.  Items are read in
blocks of at most ``block_bytes`` of text, each broadcast, so the broadcast
is bounded for a benchmark of any size.

Defined cases: null or empty texts leak nothing and empty items are never
leaked; equal items are reported each; repeated rows give their own results.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.llm import store
from statlake.llm import words as W

RADIUS, BLOCKS, NEAR = 20, 8, 2
LEAKS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()),
                                  T.StructField("start_word", T.LongType()), T.StructField("n_words", T.LongType()),
                                  T.StructField("hamming", T.IntegerType())]))
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("start_word", pa.int64()),
                             ("n_words", pa.int64()), ("hamming", pa.int32())]))


def simhash(shingles: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the rows of a (windows, shingles) hash matrix.
    A repeated shingle votes each time."""
    k, n = shingles.shape
    out = np.empty(k, np.uint64)
    step = max(1, (8 << 20) // (64 * n))
    for a in range(0, k, step):
        rows = np.ascontiguousarray(shingles[a:a + step])
        bits = np.unpackbits(rows.view(np.uint8).reshape(len(rows), n, 8), axis=2)
        votes = 2 * bits.sum(1, dtype=np.int32) > n
        out[a:a + step] = np.packbits(votes, axis=1).view(np.uint64)[:, 0]
    return out


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _ball() -> np.ndarray:
    """(256, 256): whether two byte values differ in at most ``NEAR`` bits."""
    masks = [0] + [sum(1 << i for i in c) for r in range(1, NEAR + 1) for c in combinations(range(8), r)]
    out = np.zeros((256, 256), bool)
    for m in masks:
        out[np.arange(256), np.arange(256) ^ m] = True
    return out


def similarity(a: np.ndarray, values: np.ndarray, counts: np.ndarray) -> float:
    """Weighted Jaccard of shingles ``a`` and a counted multiset."""
    v, c = np.unique(a, return_counts=True)
    at = np.minimum(np.searchsorted(values, v), len(values) - 1)
    common = int(np.where(values[at] == v, np.minimum(c, counts[at]), 0).sum())
    return common / (len(a) + int(counts.sum()) - common)


class Items:
    """The index over one block of items: shingles, places and fingerprints."""

    def __init__(self, rows: list[tuple[int | None, str]], shingle: int, threshold: float, radius: int):
        self.shingle, self.threshold, self.radius = shingle, threshold, radius
        texts = pa.array([t for _, t in rows], pa.large_string())
        raw, offsets = W.text_bytes(texts)
        doc, h, _, _ = W.words(raw, offsets)
        n_words = np.bincount(doc, minlength=len(rows))
        at = np.cumsum([0, *n_words])
        self.ids, self.n_words, self.values, self.counts, prints, sizes = [], [], [], [], [], []
        keys, where = {}, {}
        for i, (item, _) in enumerate(rows):
            own = h[at[i]:at[i + 1]]
            if not len(own):
                continue
            size = min(shingle, len(own))
            g = W.grams(np.zeros(len(own), np.int64), own, size)[1]
            m = len(self.ids)
            self.ids.append(item)
            self.n_words.append(len(own))
            v, c = np.unique(g, return_counts=True)
            self.values.append(v)
            self.counts.append(c)
            prints.append(simhash(g[None, :])[0])
            sizes.append(size)
            keys.setdefault(size, []).append(v)
            where.setdefault(size, []).append(np.full(len(v), m))
        self.prints = np.array(prints, np.uint64)
        self.lookup = {}
        for size, g in keys.items():
            g, owner = np.concatenate(g), np.concatenate(where[size])
            order = np.argsort(g, kind="stable")
            bits = max(16, int(64 * len(g)).bit_length())
            mask = np.zeros(1 << bits, bool)
            mask[(g & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
            self.lookup[size] = (g[order], owner[order], mask, np.uint64((1 << bits) - 1))
        near = _ball()
        self.by_size: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}
        for n in set(self.n_words):
            members = np.array([i for i, k in enumerate(self.n_words) if k == n])
            parts = self.prints[members].view(np.uint8).reshape(-1, BLOCKS)
            self.by_size[n] = (members, [near[:, parts[:, b]] for b in range(BLOCKS)])

    def find(self, raw: np.ndarray, offsets: np.ndarray) -> list[dict[int, tuple]]:
        """Per document of a slice: item index -> (similarity, first word, words, distance)."""
        doc, h, _, _ = W.words(raw, offsets)
        n_docs = len(offsets) - 1
        found: list[dict[int, tuple]] = [{} for _ in range(n_docs)]
        first = np.searchsorted(doc, np.arange(n_docs + 1))
        for size, (keys, owner, mask, low) in self.lookup.items():
            d, g, at = W.grams(doc, h, size)
            some = np.flatnonzero(mask[(g & low).astype(np.int64)])
            if not len(some):
                continue
            lo, hi = np.searchsorted(keys, g[some], "left"), np.searchsorted(keys, g[some], "right")
            hit = hi > lo
            some, lo, hi = some[hit], lo[hit], hi[hit]
            if not len(some):
                continue
            n = hi - lo
            entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            self._windows(found, d, g, at, first, size, np.repeat(d[some], n), owner[entry], np.repeat(at[some], n))
        return found

    def _windows(self, found, d, g, at, first, size, hit_doc, item, place):
        """Windows with enough places of an item's shingles; ``place``: first words of shared shingles."""
        order = np.lexsort((place, item, hit_doc))
        hit_doc, item, place = hit_doc[order], item[order], place[order]
        n_words = np.array(self.n_words)[item]
        length = np.minimum(n_words, first[hit_doc + 1] - first[hit_doc])
        span = length - size + 1
        need = np.ceil((n_words - size + 1 + span) * self.threshold / (1 + self.threshold) - 1e-9).astype(np.int64)
        # a window holds ``need`` places if it holds this one and the one ``need - 1`` further on
        end = np.arange(len(place)) + np.maximum(need, 1) - 1
        some = end < len(place)
        end = np.minimum(end, len(place) - 1)
        lo = np.maximum(place[end] - span + 1, first[hit_doc])
        hi = np.minimum(place, first[hit_doc + 1] - length)
        some = np.flatnonzero(some & (hit_doc[end] == hit_doc) & (item[end] == item) & (lo <= hi))
        if not len(some):
            return
        hit_doc, item, n_words, lo, hi = hit_doc[some], item[some], n_words[some], lo[some], hi[some]
        same = (hit_doc[1:] == hit_doc[:-1]) & (item[1:] == item[:-1])
        lo[1:] = np.where(same, np.maximum(lo[1:], hi[:-1] + 1), lo[1:])  # both ends ascend: each start once
        n = np.maximum(0, hi - lo + 1)
        start = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        windows = np.unique(np.column_stack([np.repeat(n_words, n), np.repeat(hit_doc, n), start]), axis=0)
        begin = np.searchsorted(at, np.arange(0, (at[-1] if len(at) else 0) + 2))  # word -> its shingle
        for k in np.unique(windows[:, 0]):
            own = windows[windows[:, 0] == k]
            length = np.minimum(k, first[own[:, 1] + 1] - first[own[:, 1]])
            for m in np.unique(length):
                same_length, shift = own[length == m], np.arange(max(1, m - size + 1))
                step = max(1, (1 << 20) // len(shift))
                for a in range(0, len(same_length), step):
                    w = same_length[a:a + step]
                    self._verify(found, first, int(k), int(m), w[:, 1], w[:, 2], g[begin[w[:, 2]][:, None] + shift])

    def _verify(self, found, first, k, m, docs, starts, rows):
        prints = simhash(rows)
        members, tables = self.by_size[k]
        parts = prints.view(np.uint8).reshape(-1, BLOCKS)
        for a in range(0, len(prints), 4096):
            b = slice(a, a + 4096)
            near = np.zeros((len(prints[b]), len(members)), bool)
            for i, table in enumerate(tables):
                near |= table[parts[b, i]]
            w, c = np.nonzero(near)
            dist = distance(prints[b][w], self.prints[members[c]])
            keep = np.flatnonzero(dist <= self.radius)
            for j in keep[np.argsort(dist[keep], kind="stable")]:
                i, item, at = a + w[j], int(members[c[j]]), int(starts[a + w[j]])
                best = found[docs[i]].get(item)
                if best is not None and best[0] == 1.0:
                    if best[1] <= at - first[docs[i]]:
                        continue
                s = similarity(rows[i], self.values[item], self.counts[item])
                if s >= self.threshold - 1e-12:
                    got = (s, int(at - first[docs[i]]), m, int(dist[j]))
                    if best is None or (-got[0], got[1]) < (-best[0], best[1]):
                        found[docs[i]][item] = got


def find_leaks(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8, radius: int = RADIUS,
               block_bytes: int = 32 << 20, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
               keep: list[str] | None = None, out: str = "leaks") -> DataFrame:
    """The columns ``keep`` (all, by default) and ``out``: array of (item_id,
    similarity, start_word, n_words, hamming), one entry per leaked item with
    its best window, the first of equals."""
    names = list(docs.columns if keep is None else keep)
    spark = docs.sparkSession
    items = items.select(F.col(item_col).cast("long").alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-int(total) // block_bytes))
    kept = [f"_c{i}" for i in range(len(names))]
    found = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(names, kept, strict=True)],
                        F.array().cast(LEAKS).alias("_leaks"), F.col(text_col).alias("_text"))
    schema = found.schema
    for block in range(n_blocks):
        rows = [(r["i"], r["t"]) for r in items.filter(F.pmod(F.xxhash64("t"), F.lit(n_blocks)) == block).collect()]
        if not rows:
            continue
        cast = spark.sparkContext.broadcast(rows)

        def run(batches, cast=cast):
            index = Items(cast.value, shingle, threshold, radius)
            for b in batches:
                raw, offsets = W.text_bytes(b.column(b.num_columns - 1))
                got = []
                for a, e in W.slices(offsets):
                    got += index.find(raw[offsets[a]:offsets[e]], offsets[a:e + 1] - offsets[a])
                before = b.column(b.num_columns - 2)
                if any(got):
                    lists = before.to_pylist()
                    for i, hits in enumerate(got):
                        lists[i] = lists[i] + [dict(zip(("item_id", "similarity", "start_word", "n_words", "hamming"),
                                                        (index.ids[m], *hits[m]), strict=True)) for m in sorted(hits)]
                    before = pa.array(lists, _ARROW)
                yield pa.RecordBatch.from_arrays([*b.columns[:-2], before, b.column(b.num_columns - 1)], b.schema.names)
        found = found.mapInArrow(run, schema)
    return found.drop("_text").toDF(*names, out)


def op10_query(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per leak: document, item and the best window."""
    leaks = find_leaks(docs, items, keep=["doc_id"], **options)
    return leaks.select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.*")


def drop_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that leak no item; columns of any name are carried as they are."""
    d, at = store.renamed(docs)
    found = find_leaks(d, items, text_col=at[options.pop("text_col", "text")], out="_leaks", **options)
    return store.named_back(found.filter(F.size("_leaks") == 0), at)


def brute_force(text: str | None, item: str | None, shingle: int = 5) -> float:
    """The best similarity over all windows, for tests."""
    from collections import Counter
    low = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    split = lambda t: [w for w in (t or "").translate(low).replace("\t", " ").replace("\n", " ").replace("\v", " ")
                       .replace("\f", " ").replace("\r", " ").split(" ") if w]
    a, b = split(text), split(item)
    if not a or not b:
        return 0.0
    size = min(shingle, len(b))
    bag = lambda x: Counter(tuple(x[i:i + size]) for i in range(max(1, len(x) - size + 1)))
    n, want, best = min(len(a), len(b)), bag(b), 0.0
    for i in range(len(a) - n + 1):
        got = bag(a[i:i + n])
        best = max(best, sum((got & want).values()) / sum((got | want).values()))
    return best
