import random
from itertools import combinations

import numpy as np
import pytest

from statlake.llm import minhash as M
from statlake.llm.components import components
from tests.llm import helpers as H


def _truth(rows, n, percent=80):
    sets = {}
    for i, t, *_ in rows:
        w = H.words(t)
        s = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
        sets[i] = s
    u = H.UnionFind()
    for a, b in combinations(sets, 2):
        c = len(sets[a] & sets[b])
        if c and 100 * c >= percent * len(sets[a] | sets[b]):
            u.join(a, b)
    return {i: (len(s), u.find(i)) for i, s in sets.items()}


def _got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_awkward_rows(spark):
    rows = [r for r in H.awkward(n=120) if r[0] is not None]
    docs = H.documents(spark, rows + [(None, "no id here at all"), (None, rows[0][1])] + rows[:3])
    got = M.op5_query(docs)
    assert got.count() == len(rows) + 5
    by = _got(got.filter("doc_id is not null"))
    assert by == _truth(rows, 4)
    assert all(r["kept"] and r["component_id"] is None for r in got.filter("doc_id is null").collect())
    assert {r["doc_id"] for r in got.filter("kept and doc_id is not null").collect()} == {i for i, (_, c) in by.items() if i == c}
    kept = M.drop_near_duplicates(docs, words=4)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {None} | {i for i, (_, c) in by.items() if i == c}


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_and_spread_groups(spark, seed, monkeypatch):
    """Groups whose members differ by more than the threshold but hang together, cut into many small blocks."""
    monkeypatch.setattr(M, "BLOCK_ROWS", 7)
    r = random.Random(seed)
    rows, at = [], 0
    for _ in range(3):
        w = H.prose(r, 90).split(" ")
        for k in range(40):
            rows.append((at, " ".join(w)))
            at += 1
            w = list(w)
            for _ in range(r.choice((1, 1, 2, 3))):
                q = r.random()
                j = r.randrange(len(w))
                if q < 0.6:
                    w[j] = f"n{r.randrange(10**6)}"
                elif q < 0.8:
                    w.insert(j, "ins")
                else:
                    del w[j]
    r.shuffle(rows)
    assert _got(M.near_duplicates(H.documents(spark, rows), words=5)) == _truth(rows, 5)


def test_signature_estimates_similarity():
    r = np.random.default_rng(0)
    a = np.unique(r.integers(0, 1 << 62, 2000).astype(np.uint64))
    b = np.concatenate([a[:1600], np.unique(r.integers(0, 1 << 62, 400).astype(np.uint64))])
    s = M.signatures([a, b, a[:0]])
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((s[0] == s[1]).mean() - j) < 0.2 and (M.bands(s)[0] == M.bands(s)[1]).any()


def test_no_rows(spark):
    docs = H.documents(spark, [(1, "x")])
    assert M.op5_query(docs.filter("false")).count() == 0
    assert _got(M.op5_query(docs)) == {1: (1, 1)}


def test_components_match_union_find(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, k) for k in range(600, 700)] + [(r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(120)]
    edges += [(3, 3), (2, 1)]
    u = H.UnionFind()
    for a, b in edges:
        if a != b:
            u.join(a, b)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: u.find(x) for x in list(u.up)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
