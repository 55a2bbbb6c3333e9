"""Near-duplicates by circulant MinHash (operator 5).

One permutation scrambles the shingles; a second one, shifted circularly by
k = 1..63, gives the k-th signature coordinate.  Three coordinates make a
band, 21 bands a signature: two texts at the threshold of 0.8 share no band
with probability (1 - 0.8**3)**21 < 3e-7.

1. Texts with equal shingle sets are one class; only its smallest id goes on.
2. Each band bucket links its members to its smallest one.  The components of
   these links hold every pair that shares a bucket, without listing pairs.
3. Inside a component, classes are laid out by size: sets at 0.8 or more
   differ in size by a factor of 1.25 at most, so a class meets those of its
   own and the next size step only.  Such a cell is cut into blocks of
   bounded rows and bytes, every two blocks are one task's work, and full
   sets are compared there.  A task returns a spanning forest of the links it
   found, not the links: components need no more.
4. Components of the forests give each document its group.

A bucket, class or component of any size is thus spread over tasks, and no
pair is dropped.  Shingles are 64-bit hashes of word hashes.

Defined cases: texts without words, null or not, have 0 shingles and link
with nothing; rows without an id link with nothing, have a null component and
are kept; rows that repeat an id belong to one document; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm import store
from statlake.llm import words as W
from statlake.llm.components import components

ROWS, BANDS = 3, 21
N = ROWS * BANDS
SALTS = 16
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 2_000_000


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each document of a slice."""
    doc, h, _, _ = W.words(raw, offsets)
    d, g, _ = W.grams(doc, h, n)
    n_docs = len(offsets) - 1
    n_words = np.bincount(doc, minlength=n_docs)
    cut = np.searchsorted(d, np.arange(n_docs + 1))
    first = np.cumsum([0, *n_words])
    out = []
    for i in range(n_docs):
        if cut[i] < cut[i + 1]:
            out.append(np.unique(g[cut[i]:cut[i + 1]]))
        elif n_words[i]:
            out.append(np.array([W.whole(h[first[i]:first[i + 1]])], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _permute32(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit numbers."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, N) coordinates: min over a set of permutation 2 at (permutation 1 + k) mod 2**32."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros((len(sets), N), np.uint32)
    full = np.flatnonzero(sizes)
    at = 0
    while at < len(full):
        end, total = at, 0
        while end < len(full) and (end == at or total + sizes[full[end]] <= 65536):
            total += sizes[full[end]]
            end += 1
        ids = full[at:end]
        first = (W.mix64(np.concatenate([sets[i] for i in ids])) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *sizes[ids][:-1]])
        for k in range(N):
            out[ids, k] = np.minimum.reduceat(_permute32(first + np.uint32(k + 1)), starts)
        at = end
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """(sets, BANDS) 64-bit keys; equal only for equal coordinates of one band."""
    s = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = W.mix64(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :] + np.zeros((len(s), 1), np.uint64)
    for i in range(ROWS):
        key = W.mix64(key + s[:, :, i])
    return key.view(np.int64)


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    a = W.mix64(s)
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(W.mix64(a + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))


def _signature_table(docs: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for b in batches:
            raw, offsets = W.text_bytes(b.column(1))
            for a, e in W.slices(offsets):
                sets = shingle_sets(raw[offsets[a]:offsets[e]], offsets[a:e + 1] - offsets[a], n)
                prints = [_fingerprint(s) if len(s) else (0, 0) for s in sets]
                keys = bands(signatures(sets))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, e - a), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([x for x, _ in prints], pa.int64()), pa.array([x for _, x in prints], pa.int64()),
                     pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.ravel()))],
                    ["doc_id", "n", "k1", "k2", "bands"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, k1 long, k2 long, bands array<long>")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """``(rep, k1, k2, n, shingles)``: full sets, as bytes of sorted 64-bit numbers."""
    def run(batches):
        for b in batches:
            raw, offsets = W.text_bytes(b.column(1))
            for a, e in W.slices(offsets):
                sets = shingle_sets(raw[offsets[a]:offsets[e]], offsets[a:e + 1] - offsets[a], n)
                prints = [_fingerprint(s) if len(s) else (0, 0) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, e - a), pa.array([x for x, _ in prints], pa.int64()),
                     pa.array([x for _, x in prints], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "k1", "k2", "n", "shingles"])
    return docs.select("doc_id", "text").mapInArrow(run, "rep long, k1 long, k2 long, n long, shingles binary")


def forest(ids: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, lower: np.ndarray,
           percent: int) -> list[tuple[int, int]]:
    """Links that connect what the pairs left x right connect.  ``lower``
    marks the smaller size step; pairs without one are another cell's."""
    label = np.unique(ids, return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets], np.int64)
    _, dense = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.cumsum([0, *sizes])
    r_sets = np.concatenate([dense[at[j]:at[j + 1]] for j in right])
    r_sizes, r_at = sizes[right], np.cumsum([0, *sizes[right]])[:-1]
    flag = np.zeros(int(dense.max()) + 1, np.int64)
    out = []
    for i in left:
        fits = (label[right] != label[i]) & (lower[right] | lower[i]) & \
            (100 * np.minimum(r_sizes, sizes[i]) >= percent * np.maximum(r_sizes, sizes[i]))
        todo = np.flatnonzero(fits)
        if not len(todo):
            continue
        own = dense[at[i]:at[i + 1]]
        flag[own] = 1
        if 3 * len(todo) > len(right):
            common = np.add.reduceat(flag[r_sets], r_at)[todo]
        else:
            common = np.array([flag[dense[at[j]:at[j + 1]]].sum() for j in right[todo]])
        flag[own] = 0
        for j in right[todo[100 * common >= percent * (sizes[i] + r_sizes[todo] - common)]]:
            if label[j] != label[i]:
                out.append((int(ids[i]), int(ids[j])))
                label[label == label[j]] = label[i]
    return out


def _compare(cells: DataFrame, percent: int) -> DataFrame:
    """Links inside each (cell, i, j); the rows of one lie together, sorted."""
    def run(batches):
        key, rows = None, []

        def links():
            if not rows:
                return []
            ids = np.array([r[0] for r in rows])
            sets = [np.frombuffer(r[2], np.uint64) for r in rows]
            lower, block = np.array([r[1] for r in rows]), np.array([r[3] for r in rows])
            left, right = np.flatnonzero(block == key[2]), np.flatnonzero(block == key[3])
            return forest(ids, sets, left, right, lower, percent) if len(left) and len(right) and len(rows) > 1 else []

        def pack(found):
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                               pa.array([b for _, b in found], pa.int64())], ["a", "b"])
        for b in batches:
            found = []
            cols = [b.column(c).to_pylist() for c in ("cc", "cell", "i", "j", "rep", "lower", "block")]
            shingles = b.column("shingles")
            for k, (cc, cell, i, j, rep, lower, block) in enumerate(zip(*cols, strict=True)):
                if key != (cc, cell, i, j):
                    found += links()
                    key, rows = (cc, cell, i, j), []
                rows.append((rep, lower, shingles[k].as_py(), block))
            yield pack(found)
        yield pack(links())
    return cells.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sig = store.table(_signature_table(docs, words), "signatures")
    classes = store.table(
        sig.filter("n > 0 and doc_id is not null").groupBy("k1", "k2", "n")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("bands").alias("bands")), "classes")
    # candidate components: every bucket's members hang on its smallest one
    members = classes.select("rep", F.explode("bands").alias("bucket")).withColumn("salt", F.pmod("rep", F.lit(SALTS)))
    buckets = (members.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high")
               .select("bucket", "low", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")))
    candidates = members.join(buckets, ["bucket", "salt"]).filter("rep > low").select(F.col("low").alias("a"), F.col("rep").alias("b"))
    cc = store.table(components(candidates), "candidates")
    need = store.small(cc.select(F.col("node").alias("doc_id"), F.col("component").alias("cc")))
    step = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent)) + F.lit(1e-9))
    sets = store.table(_sets(docs.join(need.select("doc_id"), "doc_id"), words).filter("n > 0").dropDuplicates(["rep", "k1", "k2"])
                       .join(need.withColumnRenamed("doc_id", "rep"), "rep").withColumn("step", step), "sets")
    slim = sets.select("rep", "k1", "k2", "n", "cc", "step").withColumn("cell", F.explode(F.array(F.col("step"), F.col("step") - 1)))
    layout = (slim.groupBy("cc", "cell").agg(F.count(F.lit(1)).alias("_rows"), F.sum("n").alias("_n"), F.min("step").alias("_low"))
              .filter((F.col("_rows") > 1) & (F.col("_low") == F.col("cell")))
              .select("cc", "cell", F.greatest(F.ceil(F.col("_rows") / BLOCK_ROWS), F.ceil(F.col("_n") / BLOCK_SHINGLES)).alias("blocks")))
    at = slim.join(layout, ["cc", "cell"]).withColumn("block", F.pmod(F.xxhash64("rep", "k1"), "blocks"))
    first, last = F.sequence(F.lit(0).cast("long"), F.col("block")), F.sequence(F.col("block"), F.col("blocks") - 1)
    pairs = F.array_distinct(F.concat(F.transform(first, lambda x: F.struct(x.alias("i"), F.col("block").alias("j"))),
                                      F.transform(last, lambda x: F.struct(F.col("block").alias("i"), x.alias("j")))))
    at = (at.withColumn("p", F.explode(pairs))
          .select("cc", "cell", "p.i", "p.j", "rep", "k1", "k2", "block", (F.col("step") == F.col("cell")).alias("lower")))
    cells = at.join(sets.select("rep", "k1", "k2", "shingles"), ["rep", "k1", "k2"])
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.repartition(n, "cc", "cell", "i", "j").sortWithinPartitions("cc", "cell", "i", "j", "rep")
    links = _compare(cells, percent)
    groups = components(links)
    named = classes.drop("bands").join(groups, classes["rep"] == groups["node"], "left").select(
        "k1", "k2", "n", "copies", "rep", F.coalesce("component", "rep").alias("_component"))
    named = named.filter("copies > 1 or _component < rep").select(
        "k1", "k2", "n", "_component", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    out = sig.drop("bands").withColumn("salt", F.pmod("doc_id", F.lit(SALTS))).join(named, ["k1", "k2", "n", "salt"], "left")
    component = F.coalesce("_component", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its group; columns
    of any name are carried as they are."""
    d, at = store.renamed(docs)
    options |= {"id_col": at[options.get("id_col", "doc_id")], "text_col": at[options.get("text_col", "text")]}
    gone = store.table(near_duplicates(d, **options).filter("not kept").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    return store.named_back(d.join(store.small(gone), F.col(options["id_col"]) == F.col("gone"), "left_anti"), at)


def op5_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, words=4)
