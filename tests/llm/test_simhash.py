import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from statlake.llm import simhash as S
from tests.llm import helpers as H


def _print(text, n=3):
    w = H.words(text)
    shingles = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(prints, radius=3):
    """prints: [(doc_id, fingerprint)] -> component of each fingerprint."""
    u, low = H.UnionFind(), {}
    for i, f in prints:
        low[f] = min(low.get(f, i), i)
    for a, b in combinations(low, 2):
        if (a ^ b).bit_count() <= radius:
            u.join(a, b)
    best = {}
    for f in low:
        best[u.find(f)] = min(best.get(u.find(f), low[f]), low[f])
    return {f: best[u.find(f)] for f in low}


def test_awkward_rows(spark):
    rows = H.awkward(n=120)
    rows += [(i, rows[0][1]) for i in range(900, 960)] + [(7, "an id twice"), (7, "an id twice"), (None, None)]
    got = S.op13_query(H.documents(spark, rows)).collect()
    assert len(got) == len(rows)
    truth = _groups([(r[0], _print(r[1])) for r in rows if r[0] is not None])
    want = sorted(((i, f"{f:016x}", truth[f] if i is not None else None) for i, f in ((r[0], _print(r[1])) for r in rows)), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == want
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def test_hash_is_sparks(spark):
    texts = ["One two  THREE\tfour", "É x\x0by z", "a", ""]
    for t in texts:
        w = H.words(t)
        want = [" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, min(len(w), 1)))]
        df = spark.createDataFrame([(s,) for s in want], "s string").select(F.xxhash64("s").alias("h"))
        assert S.shingle_hashes(t.encode(), 3).view(np.int64).tolist() == [r["h"] for r in df.collect()]


@pytest.mark.parametrize("tile,held", [(4096, 1 << 15), (5, 7)])
def test_links_connect_exactly_what_is_near(spark, monkeypatch, tile, held):
    """Chains, a dense group, bits at the edges of quarters and random fingerprints, in few and in many tiles."""
    monkeypatch.setattr(S, "TILE", tile)
    monkeypatch.setattr(S, "HELD", held)
    r = random.Random(3)
    prints = {0, (1 << 64) - 1, 7, 15, 1 << 63, 0xFFFF, 0x1FFFF}
    centre = r.getrandbits(64)
    for _ in range(60):
        f = centre
        for _ in range(r.randrange(1, 4)):
            f ^= 1 << r.randrange(64)
        prints.add(f)
    at = r.getrandbits(64)
    for _ in range(30):
        for _ in range(3):
            at ^= 1 << r.randrange(64)
        prints.add(at)
    prints |= {r.getrandbits(64) for _ in range(200)}
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in prints], "fingerprint long")
    u, v = H.UnionFind(), H.UnionFind()
    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 3:
            u.join(a, b)
    for x in S.links(df, 3).collect():
        a, b = x["a"] % (1 << 64), x["b"] % (1 << 64)
        assert (a ^ b).bit_count() <= 3
        v.join(a, b)
    assert {f: u.find(f) for f in prints} == {f: v.find(f) for f in prints}


def test_no_rows(spark):
    docs = H.documents(spark, [(5, None)])
    assert S.op13_query(docs.filter("false")).count() == 0
    assert [tuple(r) for r in S.op13_query(docs).collect()] == [(5, "0" * 16, 5, True)]


def test_lookup_deals_hot_keys(spark):
    from statlake.llm import store
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    named = spark.createDataFrame([(0, "zero"), (1, "one")], "k long, name string")
    got = {(r["k"], r["name"]): r["n"] for r in store.lookup(rows, named, ["k"], "v").groupBy("k", "name").agg(F.count("*").alias("n")).collect()}
    assert got == {(0, "zero"): 334, (1, "one"): 333, (2, None): 333}
