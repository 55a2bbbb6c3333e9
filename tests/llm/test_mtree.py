import random

import numpy as np
import pytest

from statlake.llm import mtree as M


def _truth(rows, k=20, step=20):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.setdefault((i, tuple(int(np.floor(64 * float(x))) for x in v)))
    out = set()
    for i, q in good:
        if i % step == 0:
            scores = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i))[:k]
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)}
    return out


def _got(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(1)
    centres = [[r.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    out = [(i, [c + r.gauss(0, 0.2) for c in r.choice(centres)]) for i in range(400)]
    out += [(1000 + i, [0.5] * 8) for i in range(150)]  # one very common vector
    out += [(2000, None), (2020, [None] + [1.0] * 7), (2040, [float("nan")] + [1.0] * 7), (2060, [float("inf")] + [1.0] * 7), (None, [1.0] * 8),
            (2080, [0.0] * 8), (2100, [-1.0] * 8), (2101, [1e9] * 8)]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in out]


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 3, 4) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")


def test_all_neighbours(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "CELL", 60)
    monkeypatch.setattr(M, "QUERIES", 10)
    monkeypatch.setattr(M, "PAGE", 8)
    want = _truth(rows)
    assert _got(M.op1_query(_frame(spark, rows + rows[:5]))) == want


def test_few_and_none(spark, rows):
    assert _got(M.op1_query(_frame(spark, rows[:7]))) == _truth(rows[:7])
    assert _got(M.op1_query(_frame(spark, rows).filter("vec_id is null"))) == set()
    assert _got(M.op1_query(_frame(spark, [(20, [1.0])]))) == set()
    assert _got(M.op1_query(_frame(spark, [(20, [1.0, 2.0]), (21, [1.0]), (22, [])]))) == {(20, 1, 21, 4096), (20, 2, 22, 0)}


def test_tree_prunes_and_keeps_its_radii():
    r = np.random.default_rng(3)
    centres = r.normal(size=(20, 16)) * 60
    x = np.unique(np.floor(centres[r.integers(0, 20, 3000)] + r.normal(size=(3000, 16))).astype(np.int64), axis=0)
    space = M.Space(16, int((x ** 2).sum(1).max()))
    tree = M.MTree(space, x, 64)

    def rows_of(page):
        return list(page.entries) if page.children is None else [i for c in page.children for i in rows_of(c)]

    def check(page):
        if page.children is not None:
            for route, radius, child in zip(page.entries, page.radius, page.children):
                below = rows_of(child)
                assert np.sqrt(((tree.z[below] - tree.z[route]) ** 2).sum(1)).max() <= radius + 1e-6
                check(child)
    check(tree.root)
    assert sorted(rows_of(tree.root)) == list(range(len(x)))
    ids = [[i] for i in range(len(x))]
    tree.computed = 0
    for i in range(0, 200, 10):
        got = tree.search(x[i], i, 5, ids, -np.inf)
        s = x @ x[i]
        want = sorted(((-int(s[j]), j) for j in range(len(x)) if j != i))[:5]
        assert got == [(-a, j) for a, j in want]
    assert tree.computed < 20 * len(x) / 2  # most distances are never computed


def test_wide_vectors_take_part(spark):
    """Components and scores beyond what floats hold exactly, among ordinary ones."""
    r = random.Random(6)
    rows = [(i, [r.gauss(0, 1) for _ in range(3)]) for i in range(60)]
    rows += [(20, [1e8, 1.0, 0.0]), (101, [1.0, 0.0, 0.0]), (102, [2.0, 0.0, 0.0]), (140, [2e7, -2e7, 3.0]), (103, [2e7 + 1 / 64, -2e7, 3.0]),
             (104, [float(2 ** 24), 0.0, 0.0]), (160, [float(2 ** 24) + 1 / 64, 1 / 64, 0.0]), (105, [-1e200, 0.0, 0.0])]
    rows = [x for x in rows if x[0] not in (20, 40) or abs(x[1][0]) > 1e6]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _got(M.top_k(df.filter("vec_id != 105"), lambda i: i % 20 == 0, 5)) == _truth([x for x in rows if x[0] != 105], 5)
    only = df.filter("vec_id in (20, 101, 102)")
    assert _got(M.top_k(only, lambda i: i % 20 == 0, 5)) == {(20, 1, 102, 819200000000), (20, 2, 101, 409600000000)}
    assert M.top_k(df.filter("vec_id in (20, 101, 102, 105)"), lambda i: i == 20, 2).count() == 2  # too low to be returned
    with pytest.raises(Exception, match="64 bits"):
        M.top_k(df.filter("vec_id in (20, 101, 105)"), lambda i: i == 20, 2).collect()
