"""Ranked lexical search over norm buckets (operator 11).

A document's impact vector has, for each of its terms t, the integer impact
i(t) = (1000000000 * tf) div (1000 * tf + 8 * m); an item's vector has the
integer weight w(t) of its terms.  The score is their inner product.  With the
weight shared evenly, p(t) = sqrt(w) * i and q(t) = sqrt(w), search goes as LEMP:

1. Vectors are cut by length into bands, longest first; one Spark job a band.
   The k-th best scores of the bands before are the thresholds of the next.
2. In a task, vectors are sorted by length and cut into buckets.  By
   Cauchy-Schwarz a bucket has nothing for an item whose threshold exceeds
   the item's length times the bucket's largest length.
3. Inside a bucket an item's heaviest terms are its focus coordinates.  A
   vector's products there are summed; its other coordinates add at most the
   rest of the item's length times the rest of the vector's length.
   Vectors whose bound is below the threshold go.
4. Survivors are scored exactly in 64-bit integers and raise the threshold.

Bounds are floats with a margin and prune only what is strictly below a
threshold, so results are exact, ties included.  Terms are 64-bit hashes.

Items are taken in blocks of about ``BLOCK_BYTES`` of text, one block at a time
through a written table; the driver and the broadcast hold one block's terms,
never all items, and nothing of the documents but each item's k-th score.
Vectors hold the coordinates of the block's terms only: the others add nothing
to any score.  No row is shuffled but each task's best k of each item.

Defined cases: null texts and texts without terms match nothing; rows that
repeat a document id are each a document; a null document id ranks after others
of its score; rows that repeat an item_id, null or not, are one item with the
terms of all; items that match nothing have no rows; other columns are never
read; empty tables give an empty result.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm import store
from statlake.llm import words as W

BLOCK_BYTES = 8 << 20       # of item text searched for in one pass
BUCKET = 1024               # vectors of a bucket
ITEMS = 256                 # items whose bounds one bucket computes at a time
FOCUS = 8                   # focus coordinates of an item
BANDS = (1 / 64, 1 / 8)     # shares of the longest vectors that the first bands hold
_OTHER = np.zeros(256, bool)  # bytes between terms: ASCII but digits and letters
_OTHER[[c for c in range(128) if not chr(c).isalnum()]] = True


def terms(raw: np.ndarray, offsets: np.ndarray):
    """(document, hash) of each term of a slice; ``offsets`` are relative to ``raw``."""
    doc, h, _, _ = W.words(np.where(_OTHER[raw], np.uint8(32), raw), offsets)
    return doc, h


class Items(NamedTuple):
    """A block of items: item i has the terms ``term[start[i]:start[i + 1]]`` of
    the block's sorted ``vocabulary``, heaviest first."""
    ids: list
    start: np.ndarray
    term: np.ndarray
    vocabulary: np.ndarray
    weight: np.ndarray


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, terms array<long>, block)``, each item and each of its terms once."""
    def run(batches):
        for b in batches:
            raw, offsets = W.text_bytes(b.column(1))
            doc, h = terms(raw, offsets)
            cut = np.searchsorted(doc, np.arange(len(offsets)))
            found = [np.unique(h[cut[i]:cut[i + 1]]).view(np.int64) for i in range(len(offsets) - 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], ["item_id", "terms"])
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(run, "item_id long, terms array<long>")
    found = found.withColumn("term", F.explode("terms")).groupBy("item_id").agg(F.collect_set("term").alias("terms"))
    found = store.table(found, "items")
    total = found.agg(F.sum(8 * F.size("terms"))).first()[0] or 0
    blocks = math.ceil(total / BLOCK_BYTES)  # items are unique here, so a hash deals them evenly
    return store.table(found.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))), "item-blocks")


def _matches(docs: DataFrame, vocabulary) -> DataFrame:
    """``(doc_id, n, term array<int>, tf array<int>)``: term count and the vocabulary's terms of each document."""
    def run(batches):
        known = vocabulary.value
        for b in batches:
            raw, offsets = W.text_bytes(b.column(1))
            for a, e in W.slices(offsets):
                doc, h = terms(raw[offsets[a]:offsets[e]], offsets[a:e + 1] - offsets[a])
                n = np.bincount(doc, minlength=e - a)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = known[at] == h
                key, tf = np.unique(doc[hit] * len(known) + at[hit], return_counts=True)
                cut = np.searchsorted(key, np.arange(e - a + 1) * len(known)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, e - a), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(cut, pa.array((key % len(known)).astype(np.int32))),
                     pa.ListArray.from_arrays(cut, pa.array(tf.astype(np.int32)))], ["doc_id", "n", "term", "tf"])
    return docs.mapInArrow(run, "doc_id long, n long, term array<int>, tf array<int>")


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of an Arrow list column."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def _vectors(matches: DataFrame, block, n_docs: int, n_terms: int) -> DataFrame:
    """``(doc_id, length, term, impact)`` of the documents that hold a term of the block."""
    def run(batches):
        weight = block.value.weight.astype(float)
        for b in batches:
            term, cut = _flat(b.column("term"))
            tf = _flat(b.column("tf"))[0].astype(np.int64)
            m = 10 + 90 * b.column("n").to_numpy() * n_docs // n_terms
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(cut)))
            length = np.sqrt(np.add.reduceat(weight[term] * impact.astype(float) ** 2, cut[:-1])) if len(cut) > 1 else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(length), b.column("term"),
                                              pa.ListArray.from_arrays(cut.astype(np.int32), pa.array(impact.astype(np.int32)))],
                                             ["doc_id", "length", "term", "impact"])
    return matches.filter(F.size("term") > 0).mapInArrow(run, "doc_id long, length double, term array<int>, impact array<int>")


class Best:
    """The best k (score, document) of each item, and each item's threshold."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k = floor.copy(), k
        self.rows = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in floor]

    def add(self, i: int, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        keep = score >= self.floor[i]
        if keep.any():
            score, null, doc = (np.concatenate([old, new[keep]]) for old, new in zip(self.rows[i], (score, null, doc)))
            order = np.lexsort((doc, null, -score))[:self.k]
            self.rows[i] = score[order], null[order], doc[order]
            if len(order) == self.k:
                self.floor[i] = max(self.floor[i], score[order[-1]])


def search_bucket(items: Items, root: np.ndarray, sizes: np.ndarray, best: Best, doc: np.ndarray, null: np.ndarray,
                  length: np.ndarray, cut: np.ndarray, term: np.ndarray, impact: np.ndarray) -> int:
    """Offer every vector of a bucket that can reach an item's threshold to
    ``best``; returns how many pairs were scored.  ``root`` is the square root
    of the weights, ``sizes`` the items' lengths."""
    n, scored = len(doc), 0
    alive = np.flatnonzero(sizes * length.max() * (1 + 1e-9) >= best.floor)  # Cauchy-Schwarz
    if not len(alive):
        return 0
    row = np.repeat(np.arange(n), np.diff(cut))
    order = np.argsort(term, kind="stable")  # inverted lists
    listed = term[order]
    product = root[term] * impact
    weight = np.zeros(len(items.vocabulary), np.int64)
    for some in np.split(alive, range(ITEMS, len(alive), ITEMS)):
        known, known2, rest2 = np.zeros((len(some), n)), np.zeros((len(some), n)), sizes[some] ** 2
        for x, i in enumerate(some):  # focus coordinates
            focus = items.term[items.start[i]:items.start[i + 1]][:FOCUS]
            lo, hi = np.searchsorted(listed, focus, "left"), np.searchsorted(listed, focus, "right")
            for t, a, e in zip(focus, lo, hi):
                if a < e:
                    at = order[a:e]
                    known[x, row[at]] += root[t] * product[at]
                    known2[x, row[at]] += product[at] ** 2
            rest2[x] -= (root[focus] ** 2).sum()
        bound = known + np.sqrt(np.maximum(rest2, 0))[:, None] * np.sqrt(np.maximum(length ** 2 - known2, 0))
        near = bound * (1 + 1e-9) + 1 >= best.floor[some][:, None]
        for x, i in enumerate(some):  # exact scores of survivors
            rows = np.flatnonzero(near[x])
            if not len(rows):
                continue
            scored += len(rows)
            own = items.term[items.start[i]:items.start[i + 1]]
            weight[own] = items.weight[own]
            count = cut[rows + 1] - cut[rows]
            first = np.cumsum(count) - count
            at = np.repeat(cut[rows] - first, count) + np.arange(count.sum())
            score = np.add.reduceat(weight[term[at]] * impact[at], first)
            weight[own] = 0
            best.add(i, score, null[rows], doc[rows])
    return scored


def _search(vectors: DataFrame, block, floor: list[int], k: int) -> DataFrame:
    """``(item, doc_id, score)``: the best k of each item in each task."""
    def run(batches):
        items = block.value
        root = np.sqrt(items.weight.astype(float))
        sizes = np.sqrt(np.add.reduceat(np.append(root[items.term] ** 2, 0.0), items.start[:-1]))
        best = Best(np.array(floor, np.int64), k)
        for b in batches:
            ids = b.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            doc, length = ids.fill_null(0).to_numpy(), b.column("length").to_numpy()
            term, cut = _flat(b.column("term"))
            impact = _flat(b.column("impact"))[0].astype(np.int64)
            for a in range(0, len(doc), BUCKET):
                e = min(a + BUCKET, len(doc))
                s = slice(cut[a], cut[e])
                search_bucket(items, root, sizes, best, doc[a:e], null[a:e], length[a:e], cut[a:e + 1] - cut[a], term[s], impact[s])
        item = np.repeat(np.arange(len(best.rows)), [len(r[0]) for r in best.rows])
        score, null, doc = (np.concatenate([r[c] for r in best.rows]) for c in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc, mask=null), pa.array(score)], ["item", "doc_id", "score"])
    return (vectors.sortWithinPartitions(F.desc("length"))  # longest first; no shuffle
            .mapInArrow(run, "item long, doc_id long, score long"))


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 of each item."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    queries = _item_terms(items, item_col, item_text_col)
    out = []
    for number in sorted(r[0] for r in queries.select("block").distinct().collect()):
        rows = sorted(queries.filter(F.col("block") == number).collect(), key=lambda r: (r["item_id"] is None, r["item_id"]))
        hashes = np.array([t for r in rows for t in r["terms"]], np.int64).view(np.uint64)
        vocabulary, term = np.unique(hashes, return_inverse=True)
        matches = store.table(_matches(docs, spark.sparkContext.broadcast(vocabulary)), "matches")
        n_docs, n_terms = matches.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = matches.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        weights = df.select("term", F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).alias("w"))
        weight = np.zeros(len(vocabulary), np.int64)
        for r in weights.collect():  # the block's terms
            weight[r["term"]] = r["w"]
        start = np.cumsum([0] + [len(r["terms"]) for r in rows])
        for a, e in zip(start[:-1], start[1:]):
            term[a:e] = term[a:e][np.argsort(-weight[term[a:e]], kind="stable")]
        block = spark.sparkContext.broadcast(Items([r["item_id"] for r in rows], start, term, vocabulary, weight))
        if not n_terms:
            continue
        vectors = store.table(_vectors(matches, block, n_docs, n_terms), "vectors")
        cuts = sorted(set(vectors.approxQuantile("length", [1 - share for share in BANDS], 0.002)), reverse=True)
        edges = [math.inf, *cuts, -math.inf]
        floor, best = [1] * len(rows), None  # scores above 0
        for high, low in zip(edges, edges[1:]):
            band = vectors.filter((F.col("length") < high) & (F.col("length") >= low))
            found = _search(band, block, floor, k)
            best = store.table(_top(found if best is None else found.union(best.select(*found.columns)), k), "best")
            for r in best.filter(F.col("rank") == k).collect():  # one score an item of the block
                floor[r["item"]] = max(floor[r["item"]], r["score"])
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item long, item_id long")
        out.append(store.table(best.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    result = out[0]
    for part in out[1:]:
        result = result.union(part)
    return result


def op11_query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return ranked_search(docs, items)


ORACLE = r"""
with t as (select doc_id, row_number() over () as r, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
i as (select distinct item_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
s as (select cast(count(*) as bigint) as big_n, cast(sum(len(terms)) as bigint) as l from t where len(terms) > 0),
d as (select doc_id, r, cast(10 + (90 * len(terms) * big_n) // l as bigint) as m, terms from t, s where len(terms) > 0),
tf as (select doc_id, r, m, term, count(*) as tf from (select doc_id, r, m, unnest(terms) as term from d) group by all),
w as (select term, cast(floor(1000 * ln((2.0::double * big_n + 2) / (2.0::double * count(*) + 1))) as bigint) as w
      from tf, s group by term, big_n),
x as (select item_id, doc_id, r, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
      from i join tf using (term) join w using (term) group by item_id, doc_id, r),
o as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as integer) as rank, doc_id, score
      from x where score > 0)
select * from o where rank <= 10
"""
