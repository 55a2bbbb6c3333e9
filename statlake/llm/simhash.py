"""Near-duplicates by SimHash, compared exactly tile by tile (operator 13).

A text's fingerprint has 64 bits: a bit is 1 if it is set in over half of the
XXH64 hashes of the text's word shingles.  Texts link if their fingerprints
differ in ``radius`` bits or fewer.

1. Documents with equal fingerprints are one class; classes are compared.
2. The population counts of a fingerprint's four 16-bit quarters name its
   cell: at most 17**4 cells, however many documents there are.  A cell is cut
   into tiles of about ``TILE`` fingerprints.  Fingerprints within the radius
   differ by at most the radius in the sum of their quarters' population
   counts, so a tile meets only tiles of cells that near; all other tile pairs,
   19 of 20 for random fingerprints, are skipped.
3. Two tiles are compared whole in numpy, by exclusive-or and bit counts.  A
   task returns a spanning forest of the links it found, not the links.
4. Components of the forests, and the smallest id in each, name the groups.

Work grows with the square of the number of different fingerprints, divided by
about 20; copies cost nothing.  A tile pair is the unit of work, so a cell of
any size is spread over tasks.

Defined cases: null texts and texts without words have the fingerprint 0 and
link like any other; rows that repeat an id are each a document of that id;
rows without an id link with nothing and have a null component; other columns
are never read; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm import store
from statlake.llm import words as W
from statlake.llm.components import components

SEED = 42
TILE = 4096
PAIRS = 1 << 20  # fingerprint pairs compared at a time
HELD = 1 << 15   # fingerprints of other tiles held at a time


def shingle_hashes(text: bytes, n: int) -> np.ndarray:
    """XXH64 of each run of ``n`` words, joined by one space; of all words if there are fewer."""
    words = text.lower().split()  # bytes: only A-Z fold, only 0x20 and 0x09-0x0D part
    if not words:
        return np.zeros(0, np.uint64)
    n = min(n, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    joined, count, digest = b" ".join(words), len(words) - n + 1, xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start[:count].tolist(), end[n - 1:].tolist())), np.uint64, count)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half of ``hashes``; 0 for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at:at + (1 << 16)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``(doc_id, fingerprint)``, the fingerprint as a long, for each row of ``docs (doc_id, text)``."""
    def run(batches):
        for b in batches:
            raw, offsets = W.text_bytes(b.column(1))
            found = [fingerprint(shingle_hashes(raw[s:e].tobytes(), words)) for s, e in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(found, np.uint64).view(np.int64))],
                                             ["doc_id", "fingerprint"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint long")


def forest(own: np.ndarray, others: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs own x others within the radius connect."""
    label = np.unique(np.concatenate([own, others]), return_inverse=True)[1]
    mine, theirs = label[:len(own)], label[len(own):]
    a, b = [], []
    step = max(1, PAIRS // max(len(others), 1))
    for at in range(0, len(own), step):
        near = np.bitwise_count(own[at:at + step, None] ^ others[None, :]) <= radius
        for i in np.flatnonzero(near.any(axis=1)):
            hits = np.flatnonzero(near[i])
            while len(hits := hits[theirs[hits] != mine[at + i]]):
                a.append(own[at + i])
                b.append(others[hits[0]])
                label[label == theirs[hits[0]]] = mine[at + i]
    return np.array(a, np.uint64), np.array(b, np.uint64)


def _compare(moved: DataFrame, radius: int) -> DataFrame:
    """Links of each (cell, tile) with the tiles sent to it; rows of one lie
    together, the tile itself first."""
    def run(batches):
        key, own, held = None, None, []

        def links():
            a, b = forest(own, np.concatenate(held), radius) if held else (np.zeros(0, np.uint64),) * 2
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
        for batch in batches:
            cell, tile, home = (batch.column(c).to_pylist() for c in ("cell", "tile", "home"))
            sets = batch.column("fingerprints")
            for k in range(batch.num_rows):
                if key != (cell[k], tile[k]):
                    yield links()
                    key, own = (cell[k], tile[k]), None
                values = sets[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                if home[k]:
                    own = values
                    held.append(own)  # pairs inside the tile
                else:
                    held.append(values)
                    if sum(map(len, held)) >= HELD:
                        yield links()
        yield links()
    return moved.mapInArrow(run, "a long, b long")


def links(prints: DataFrame, radius: int) -> DataFrame:
    """Links ``(a, b)`` of different fingerprints that connect all those within
    the radius of each other; ``prints (fingerprint)`` holds each once."""
    f = F.col("fingerprint")
    cell = F.lit(0).cast("long")
    for q in range(4):  # digits of 0 to 16 in base 64: steps of a small radius never carry into a valid cell
        cell = cell * 64 + F.bit_count(F.shiftrightunsigned(f, 16 * q).bitwiseAND(F.lit(0xFFFF).cast("long")))
    prints = prints.select("fingerprint", cell.alias("cell"))
    tiles = F.ceil(F.col("count") / TILE).cast("long")
    cells = store.table(prints.groupBy("cell").count().select("cell", tiles.alias("tiles")), "cells")
    bounded = F.broadcast(cells)  # 17**4 rows at most
    packed = (prints.join(bounded, "cell").withColumn("tile", F.pmod(F.xxhash64("fingerprint"), "tiles"))
              .groupBy("cell", "tile").agg(F.collect_list("fingerprint").alias("fingerprints")))
    packed = store.table(packed, "tiles")
    steps = [s for s in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, s)) <= radius and s >= (0,) * 4]
    steps = [((s[0] * 64 + s[1]) * 64 + s[2]) * 64 + s[3] for s in steps]
    away = (packed.withColumnsRenamed({"cell": "from", "tile": "nth"})
            .withColumn("step", F.explode(F.array(*[F.lit(s).cast("long") for s in steps])))
            .withColumn("cell", F.col("from") + F.col("step")).join(bounded, "cell")
            .withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
            .filter("step != 0 or nth > tile"))
    home = F.lit(True).alias("home")
    moved = packed.select("cell", "tile", home, "fingerprints").union(
        away.select("cell", "tile", F.lit(False), "fingerprints"))
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moved = moved.repartition(n, "cell", "tile").sortWithinPartitions("cell", "tile", F.desc("home"))
    return _compare(moved, radius)


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits)``, component_id, kept`` per row of ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = store.table(fingerprints(docs, words), "fingerprints")
    classes = store.table(prints.filter("doc_id is not null").groupBy("fingerprint")
                          .agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies")), "classes")
    linked = store.table(components(links(classes.select("fingerprint"), radius)).withColumnRenamed("node", "fingerprint"), "linked")
    members = store.table(linked.join(classes, "fingerprint").select("fingerprint", "component", "low"), "members")
    lowest = members.groupBy("component").agg(F.min("low").alias("component_id"))
    grouped = store.lookup(members, lowest, ["component"], "fingerprint").select("fingerprint", "component_id")
    alone = classes.filter("copies > 1").join(linked, "fingerprint", "left_anti").select("fingerprint", F.col("low").alias("component_id"))
    out = store.lookup(prints, grouped.union(alone), ["fingerprint"], "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op13_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
