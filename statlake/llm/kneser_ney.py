"""Interpolated modified Kneser-Ney scores (operator 7).

A bigram model of lower-cased words, each text ended by an end token.

1. Words are counted: tasks pre-count slices of text and send sorted hashes by
   bucket; a bucket becomes one file of sorted 64-bit word hashes and one of
   counts.  A word's number is its place in these files.
2. Pairs (previous, word) are counted alike, as 64-bit keys made of both
   numbers.  A bucket holds whole contexts, but for contexts that make up a
   large share of all words: their pairs are dealt out by the pair.
3. From the pair files, each context's total and back-off weight and each
   word's continuation probability are summed into files that lie beside the
   word hashes.  Discounts come from the counts of counts of all pairs.
4. Every text is scored by tasks that memory-map these files and look up
   sorted runs of words and pairs.

Files lie in the shared folder; the number of buckets grows with the text, so
a bucket stays near ``BUCKET_BYTES`` of text.  The driver holds bucket paths,
offsets, hot contexts (fewer than 8 a bucket, chosen in Spark) and a dozen sums.

Defined cases: null and empty texts have the end token only; a row without an
id is scored but not learned from; repeated rows count and are scored each;
without training rows every probability is that of the one unknown word.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm import store
from statlake.llm import words as W

BUCKET_BYTES = 32 << 20
FLUSH = 24 << 20  # bytes of text that a task counts before it sends
END = np.uint64(0xE1D5)  # the end token's place among word hashes
TAKEN = 255  # a count of this or more stands in the overflow file


def pack(sorted_keys: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as compressed byte planes of their differences."""
    d = np.diff(sorted_keys, prepend=np.uint64(0)).astype(np.uint64)
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T)
    return len(d).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True) if len(d) else b""


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], n * 8, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64)[:, 0], dtype=np.uint64)


def pack_small(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values.astype(np.int64)).tobytes(), "zstd", asbytes=True) if len(values) else b""


def unpack_small(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), np.int64) if n else np.zeros(0, np.int64)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their values (rows of a matrix or numbers)."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(values[order], starts, axis=0)


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Buckets in the order of the hashes."""
    return (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def by_bucket(bucket: np.ndarray):
    """(bucket, places) of the buckets that occur, however many there are."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else np.zeros(0, np.int64)
    for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(b)], strict=True) if len(b) else ():
        yield int(b[i]), order[i:j]


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the words of a slice, each document closed by END."""
    doc, h, _, _ = W.words(raw, offsets)
    n = len(offsets) - 1
    at = np.searchsorted(doc, np.arange(n), "right")
    return np.insert(doc, at, np.arange(n)), np.insert(h, at, END)


def _put(folder: str, name: str, *arrays: np.ndarray) -> list[str]:
    """Write arrays to files of their own, under names no other attempt uses."""
    from pyarrow import fs
    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    paths = []
    for a in arrays:
        file = f"{name}-{uuid.uuid4().hex}.bin"
        with system.open_output_stream(f"{base}/{file}") as f:
            f.write(np.ascontiguousarray(a).tobytes())
        paths.append(f"{folder}/{file}")
    return paths


def _map(path: str, kind) -> np.ndarray:
    """A file as an array: memory-mapped where the shared folder is mounted."""
    from pyarrow import fs
    system, local = fs.FileSystem.from_uri(path)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(local, kind, "r") if system.get_file_info(local).size else np.zeros(0, kind)
    with system.open_input_file(local) as f:
        return np.frombuffer(f.read(), kind)


class Vocabulary:
    """Sorted word hashes in bucket files; numbers run through the buckets."""

    def __init__(self, files: list[list[str]], sizes: list[int]):
        self.files, self.n = files, len(files)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.size = int(self.offsets[-1])
        self.maps: dict = {}

    def column(self, bucket: int, which: int, kind) -> np.ndarray:
        got = self.maps.get((bucket, which))
        if got is None:
            got = self.maps[bucket, which] = _map(self.files[bucket][which], kind)
        return got

    def number(self, sorted_hashes: np.ndarray) -> np.ndarray:
        """Numbers of sorted distinct hashes; -1 for unknown ones."""
        out = np.full(len(sorted_hashes), -1, np.int64)
        for b, places in by_bucket(bucket_of(sorted_hashes, self.n)) if self.n else ():
            have = self.column(b, 0, np.uint64)
            if len(have):
                part = sorted_hashes[places]
                at = np.minimum(np.searchsorted(have, part), len(have) - 1)
                out[places] = np.where(have[at] == part, at + self.offsets[b], -1)
        return out

    def bucket(self, numbers: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, numbers, "right") - 1

    def values(self, sorted_numbers: np.ndarray, which: int, kind) -> np.ndarray:
        """Column ``which`` for sorted known numbers."""
        out = np.empty(len(sorted_numbers), kind)
        for b, places in by_bucket(self.bucket(sorted_numbers)):
            out[places] = self.column(b, which, kind)[sorted_numbers[places] - self.offsets[b]]
        return out


def pair_bucket(keys: np.ndarray, hot: np.ndarray, n: int) -> np.ndarray:
    """A pair goes with its context; pairs of hot contexts go by themselves."""
    context = keys >> np.uint64(32)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
        context = np.where(hot[at] == context, keys, context)
    return (W.mix64(context) % np.uint64(n)).astype(np.int64)


def _send(keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray):
    """Rows (bucket, n, keys, counts) of sorted distinct keys."""
    return _rows([(b, len(at), pack(keys[at]), pack_small(counts[at])) for b, at in by_bucket(bucket)])


def _rows(rows):
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["bucket", "n", "keys", "counts"])


def _count(docs: DataFrame, keys_of, bucket_fn, start) -> DataFrame:
    """Pre-counted keys of all texts, as rows of ``_send``."""
    def run(batches):
        state = start()
        held, size = [], 0

        def flush():
            k, c = summed(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
            return _send(k, c, bucket_fn(k))
        for batch in batches:
            raw, offsets = W.text_bytes(batch.column(0))
            for a, e in W.slices(offsets):
                k = keys_of(state, raw[offsets[a]:offsets[e]], offsets[a:e + 1] - offsets[a])
                held.append(np.unique(k, return_counts=True))
                size += int(offsets[e] - offsets[a]) + 16 * (e - a)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return docs.mapInArrow(run, "bucket int, n long, keys binary, counts binary")


def _merged(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([unpack(k) for k in pdf["keys"]])
    counts = np.concatenate([unpack_small(c, n) for c, n in zip(pdf["counts"], pdf["n"], strict=True)])
    return summed(keys, counts)


def discounts(n: list[int]) -> np.ndarray:
    """D for counts 0, 1, 2 and 3 or more, from the numbers of keys that occur 1 to 4 times."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d = [0.0]
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d.append(min(max(k - (k + 1) * y * b / a if a else k * 0.5, 0.05 * k), 0.95 * k))
    return np.array(d)


class Model:
    """What the driver holds; workers open the files behind it."""

    def __init__(self, vocabulary: Vocabulary, pairs: list[list[str]], hot: np.ndarray, total: int, n_docs: int,
                 d2: np.ndarray, d1: np.ndarray, types: int, back: float, start: tuple[float, float], taken: int = TAKEN):
        self.taken = taken
        self.vocabulary, self.pairs, self.hot = vocabulary, pairs, hot
        self.total, self.n_docs, self.d2, self.d1, self.types, self.back, self.start = total, n_docs, d2, d1, types, back, start
        self.unknown = back / (vocabulary.size + 1)

    def pair_counts(self, sorted_keys: np.ndarray, maps: dict) -> np.ndarray:
        out = np.zeros(len(sorted_keys), np.int64)
        n = len(self.pairs)
        if not n or not len(sorted_keys):
            return out
        for b, at in by_bucket(pair_bucket(sorted_keys, self.hot, n)):
            if not self.pairs[b]:
                continue
            if b not in maps:
                maps[b] = tuple(_map(p, k) for p, k in zip(self.pairs[b], (np.uint64, np.uint8, np.uint64, np.int64), strict=True))
            keys, counts, over, over_counts = maps[b]
            if not len(keys):
                continue
            want = sorted_keys[at]
            i = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            c = np.where(keys[i] == want, counts[i], 0).astype(np.int64)
            big = np.flatnonzero(c == self.taken)
            if len(big):
                c[big] = over_counts[np.searchsorted(over, want[big])]
            out[at] = c
        return out

    def score(self, raw: np.ndarray, offsets: np.ndarray, maps: dict):
        """(tokens, known tokens, base score, score) of each text of a slice."""
        v = self.vocabulary
        doc, h = tokens(raw, offsets)
        n_docs = len(offsets) - 1
        distinct, place = np.unique(h, return_inverse=True)
        number = v.number(distinct)
        known = number >= 0
        count = np.zeros(len(distinct), np.int64)
        lower = np.full(len(distinct), self.unknown)
        weight = np.ones(len(distinct))
        total = np.zeros(len(distinct))
        if known.any():
            count[known] = v.values(number[known], 1, np.int64)
            lower[known] = v.values(number[known], 2, np.float64)
            total[known] = v.values(number[known], 3, np.float64)
            weight[known] = v.values(number[known], 4, np.float64)
        base = np.log10((count + 0.1) / (self.total + 0.1 * (v.size + 1)))
        first = np.empty(len(doc), bool)
        first[0] = True
        first[1:] = doc[1:] != doc[:-1]
        before = np.roll(place, 1)
        context = np.where(first, v.size, number[before])
        c_total = np.where(first, self.start[0], total[before])
        c_weight = np.where(first, self.start[1], weight[before])
        word = number[place]
        p = c_weight * lower[place]
        real = np.flatnonzero((word >= 0) & (context >= 0) & (c_total > 0))
        if len(real):
            keys = (context[real].astype(np.uint64) << np.uint64(32)) | word[real].astype(np.uint64)
            u, inverse = np.unique(keys, return_inverse=True)
            c = self.pair_counts(u, maps)[inverse]
            p[real] += (c - self.d2[np.minimum(c, 3)]) / c_total[real]
        add = lambda x: np.bincount(doc, x, minlength=n_docs)
        return np.bincount(doc, minlength=n_docs), add(known[place]).astype(np.int64), add(base[place]), add(np.log10(p))


def fit(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, text_col: str = "text", taken: int = TAKEN) -> Model:
    """Count the texts of ``docs`` and write the model's files."""
    spark = docs.sparkSession
    folder = store.new_path(spark, "kneser-ney")
    docs = docs.select(F.col(text_col).alias("text"))
    facts = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    n_docs, size = facts[0], facts[1] or 0
    n = max(24, -(-size // bucket_bytes))

    def words_of(_, raw, offsets):
        return tokens(raw, offsets)[1]

    def words_done(pdf):
        keys, counts = _merged(pdf)
        top = np.argsort(-counts, kind="stable")[:8 * n]  # candidates for hot contexts
        return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "size": [len(keys)], "total": [int(counts.sum())],
                             "files": [_put(folder, "words", keys, counts)], "places": [top.tolist()], "counts": [counts[top].tolist()]})
    rows = (_count(docs, words_of, lambda k: bucket_of(k, n), lambda: None).groupBy("bucket")
            .applyInPandas(words_done, "bucket int, size long, total long, files array<string>, places array<long>, counts array<long>"))
    rows = store.table(rows, "words")
    made = {r["bucket"]: r for r in rows.select("bucket", "size", "total", "files").collect()}
    if not made:
        return Model(Vocabulary([], []), [], np.zeros(0, np.uint64), 0, 0, np.zeros(4), np.zeros(4), 0, 1.0, (0.0, 1.0))
    sizes = [made[b]["size"] if b in made else 0 for b in range(n)]
    none = _put(folder, "none", np.zeros(0))[0]
    vocabulary = Vocabulary([list(made[b]["files"]) if b in made else [none, none] for b in range(n)], sizes)
    total = sum(r["total"] for r in made.values())
    offsets, start = vocabulary.offsets, vocabulary.size
    large = (rows.select("bucket", F.explode(F.arrays_zip("places", "counts")).alias("x"))
             .filter(F.col("x.counts") * F.lit(8 * n).cast("long") > F.lit(total).cast("long")).select("bucket", F.col("x.places").alias("place")))
    hot = [int(offsets[r["bucket"]]) + r["place"] for r in large.collect()]
    hot = np.array(sorted([*hot, start]), np.uint64)

    def pairs_of(v, raw, offs):
        doc, h = tokens(raw, offs)
        distinct, place = np.unique(h, return_inverse=True)
        word = v.number(distinct)[place].astype(np.uint64)
        before = np.roll(word, 1)
        first = np.empty(len(doc), bool)
        first[0] = True
        first[1:] = doc[1:] != doc[:-1]
        before[first] = start
        return (before << np.uint64(32)) | word

    def pairs_done(pdf):
        """The bucket's files, its counts of counts, and sums by context and by word, sent to their word buckets."""
        keys, counts = _merged(pdf)
        big = counts >= taken
        files = _put(folder, "pairs", keys, np.minimum(counts, taken).astype(np.uint8), keys[big], counts[big])
        out = [(-1, int(pdf["bucket"].iloc[0]), files, [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [len(keys)], b"", b"", 0)]
        context, word = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
        k, sums = summed(context, np.column_stack([counts, counts == 1, counts == 2, counts > 2]).astype(np.int64))
        w, ones = summed(word, np.ones(len(word), np.int64))
        for kind, key, value in ((0, k, sums), (1, w, ones[:, None])):
            for b, at in by_bucket(vocabulary.bucket(key.astype(np.int64))):
                if b < n:  # the start of a text is no word
                    out.append((b, kind, [], [], pack(key[at]), pack_small(value[at].ravel()), len(at)))
            if kind == 0 and len(key) and key[-1] == start:
                out.append((-2, 0, [], [int(x) for x in value[-1]], b"", b"", 0))
        return pd.DataFrame(out, columns=["bucket", "kind", "files", "sums", "keys", "counts", "n"])
    pair_rows = store.table(
        _count(docs, pairs_of, lambda k: pair_bucket(k, hot, n), lambda: Vocabulary(vocabulary.files, sizes)).groupBy("bucket")
        .applyInPandas(pairs_done, "bucket int, kind int, files array<string>, sums array<long>, keys binary, counts binary, n long"), "pairs")
    pairs: list[list[str]] = [[] for _ in range(n)]
    counts_of, types, begin = np.zeros(4, np.int64), 0, np.zeros(4, np.int64)
    for r in pair_rows.filter("bucket < 0").select("bucket", "kind", "files", "sums").collect():
        if r["bucket"] == -1:
            pairs[r["kind"]] = list(r["files"])
            counts_of += np.array(r["sums"][:4])
            types += r["sums"][4]
        else:
            begin += np.array(r["sums"])
    d2 = discounts([int(x) for x in counts_of])

    def added(pdf, kind, width, b):
        part = pdf[pdf["kind"] == kind]
        out = np.zeros((sizes[b], width), np.int64)
        for k, c, m in zip(part["keys"], part["counts"], part["n"], strict=True):
            out[unpack(k).astype(np.int64) - offsets[b]] += unpack_small(c, m * width).reshape(m, width)
        return out

    def sides(pdf):
        """A word bucket's context sums and continuation counts."""
        b = int(pdf["bucket"].iloc[0])
        ctx, cont = added(pdf, 0, 4, b), added(pdf, 1, 1, b)[:, 0]
        weight = np.where(ctx[:, 0] > 0, (ctx[:, 1:] @ d2[1:]) / np.maximum(1, ctx[:, 0]), 1.0)
        files = _put(folder, "sides", cont, ctx[:, 0].astype(np.float64), weight)
        return pd.DataFrame({"bucket": [b], "files": [files], "sums": [[int((cont == k).sum()) for k in (1, 2, 3, 4)] + [int((cont > 2).sum())]]})
    side = store.table(pair_rows.filter("bucket >= 0").groupBy("bucket").applyInPandas(sides, "bucket int, files array<string>, sums array<long>"), "sides")
    side = {r["bucket"]: r for r in side.collect()}
    sums = np.sum([r["sums"] for r in side.values()], axis=0)
    d1 = discounts([int(x) for x in sums[:4]])
    back = float(d1[1] * sums[0] + d1[2] * sums[1] + d1[3] * sums[4]) / types
    unknown = back / (vocabulary.size + 1)

    def lower(batches):
        for batch in batches:
            for b, path in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                cont = _map(path, np.int64)
                p = (cont - d1[np.minimum(cont, 3)]) / types + unknown
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array(_put(folder, "lower", p))], ["bucket", "file"])
    todo = spark.createDataFrame([(b, r["files"][0]) for b, r in side.items()], "bucket int, path string").repartition(len(side))
    for r in store.table(todo.mapInArrow(lower, "bucket int, file string"), "lower").collect():
        vocabulary.files[r["bucket"]] += [r["file"], *side[r["bucket"]]["files"][1:]]
    first = (float(begin[0]), float(begin[1:] @ d2[1:]) / begin[0])
    vocabulary.maps = {}
    return Model(vocabulary, pairs, hot, total, n_docs, d2, d1, types, back, first, taken)


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep``, ``n_tokens, n_known, base_score, score``."""
    names = [f"_c{i}" for i in range(len(keep))]
    slim = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, names, strict=True)], F.col(text_col).alias("_text"))
    cast = docs.sparkSession.sparkContext.broadcast(model)
    more = ["n_tokens", "n_known", "base_score", "score"]

    def run(batches):
        m, maps = cast.value, {}
        for b in batches:
            raw, offsets = W.text_bytes(b.column(b.num_columns - 1))
            for a, e in W.slices(offsets):
                got = m.score(raw[offsets[a]:offsets[e]], offsets[a:e + 1] - offsets[a], maps)
                yield pa.RecordBatch.from_arrays([*[c.slice(a, e - a) for c in b.columns[:-1]], *map(pa.array, got)], [*names, *more])
    from pyspark.sql import types as T
    schema = T.StructType([*slim.drop("_text").schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                           T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return slim.mapInArrow(run, schema).toDF(*keep, *more)


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(True))


def op7_query(docs: DataFrame, **options) -> DataFrame:
    model = fit(docs.filter(~held_out(F.col("doc_id"))), **options)
    s = score(docs, model, ["doc_id"])
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                    F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
