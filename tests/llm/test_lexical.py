import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from statlake.llm import lexical as X
from tests.llm import helpers as H

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return TERM.findall((text or "").translate(H.LOW))


def truth(docs, items, k=10):
    counts = [(i, Counter(_terms(t))) for i, t, *_ in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(_terms(t))
    out = []
    for item, ts in wanted.items():
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in ts if df[t]}
        found = []
        for doc, c, n in counts:
            m = 10 + 90 * n * n_docs // n_terms
            s = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in w if t in c)
            if s > 0:
                found.append((-s, doc is None, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, doc) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k])]
    return sorted(out, key=str)


def tables():
    docs = H.awkward(n=300)
    r = random.Random(8)
    docs += [(2000 + i, docs[0][1], "s1") for i in range(30)]  # ties beyond k
    docs += [(3000, "_-= .,", "s1"), (3001, "The THE the_the,É é", "s1"), (3002, "only", "s2"), (3003, "only only", "s2"), (9, "twice only", "s1")]
    items = [(i, " ".join(r.choice(d[1].split()) for _ in range(r.randrange(1, 25)))) for i, d in enumerate(docs[:40]) if d[1] and d[1].split()]
    items += [(100, docs[0][1]), (101, None), (102, ""), (103, "nosuchword"), (104, "only É"), (104, "twice"), (None, "the only"),
              (105, H.prose(r, 3000)), (-7, "w1x w1x w2x")]
    return docs, items


def _frames(spark, docs, items):
    q = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("block", "term", "rank", "item", "doc_id")})
    return H.documents(spark, docs), q


def _rows(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block,bucket,focus,k", [(8 << 20, 1024, 8, 10), (900, 16, 2, 3)])
def test_equals_brute_force(spark, monkeypatch, block, bucket, focus, k):
    monkeypatch.setattr(X, "BLOCK_BYTES", block)
    monkeypatch.setattr(X, "BUCKET", bucket)
    monkeypatch.setattr(X, "FOCUS", focus)
    docs, items = tables()
    got = _rows(X.ranked_search(*_frames(spark, docs, items), k=k))
    assert got == truth(docs, items, k)


def test_sql_equals_brute_force(spark):
    docs, items = tables()
    con = duckdb.connect()
    d, q = _frames(spark, docs, items)
    con.register("documents", d.select("doc_id", "text").toArrow())
    con.register("benchmark", q.select("item_id", "text").toArrow())
    assert sorted(con.execute(X.ORACLE).fetchall(), key=str) == truth(docs, items)


def test_bounds_prune_and_lose_nothing():
    """Few pairs are scored once thresholds are known, and the best stay the best."""
    r = np.random.default_rng(1)
    vocabulary = np.arange(400, dtype=np.uint64)
    weight = np.sort(r.integers(1, 9000, 400))[::-1].copy()
    start = np.arange(0, 41, 8)
    term = np.concatenate([np.sort(r.choice(400, 8, replace=False)) for _ in range(5)])
    items = X.Items(list(range(5)), start, term, vocabulary, weight)
    docs = [np.sort(r.choice(400, 30, replace=False)) for _ in range(1000)]
    for i in range(5):
        docs[i] = np.unique(np.concatenate([docs[i], term[start[i]:start[i + 1]]]))
    impact = [r.integers(1000, 900_000, len(d)) for d in docs]
    root = np.sqrt(weight.astype(float))
    length = np.array([np.sqrt((weight[d] * x.astype(float) ** 2).sum()) for d, x in zip(docs, impact)])
    order = np.argsort(-length)
    sizes = np.sqrt(np.add.reduceat(root[term] ** 2, start[:-1]))
    best, scored = X.Best(np.ones(5, np.int64), 3), 0
    for at in range(0, 1000, 50):
        some = order[at:at + 50]
        cut = np.cumsum([0] + [len(docs[i]) for i in some])
        scored += X.search_bucket(items, root, sizes, best, some, np.zeros(50, bool), length[some], cut,
                                  np.concatenate([docs[i] for i in some]), np.concatenate([impact[i] for i in some]))
    for i in range(5):
        own = set(term[start[i]:start[i + 1]].tolist())
        scores = sorted(((-sum(int(weight[t]) * int(x) for t, x in zip(d, y) if t in own), j) for j, (d, y) in enumerate(zip(docs, impact))))
        assert [(-s, j) for s, j in scores[:3]] == list(zip(best.rows[i][0].tolist(), best.rows[i][2].tolist()))
    assert scored < 0.5 * 5 * 1000


def test_no_rows(spark):
    d, q = _frames(spark, [(1, "a b")], [(1, "a")])
    assert _rows(X.op11_query(d.filter("false"), q)) == [] and _rows(X.op11_query(d, q.filter("false"))) == []
    assert _rows(X.op11_query(d, q)) == truth([(1, "a b")], [(1, "a")])
