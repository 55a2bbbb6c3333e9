"""Nearest neighbours and the Euclidean silhouette against all pairs."""
import math

import numpy as np
import pytest

from statlake.operators import neighbours
from statlake.operators.neighbours import knn, silhouette

SCHEMA = "grp string, id long, a double, b double"


def _points(seed=3):
    g = np.random.default_rng(seed)
    rows = [("big" if i % 3 else None, i, float(g.normal()), float(g.normal())) for i in range(400)]
    rows += [("grid", 1000 + i, float(i % 9), float(i // 9)) for i in range(81)]         # many ties
    rows += [("grid", 2000 + i, 4.0, 4.0) for i in range(150)]                           # one hot place
    rows += [(f"s{i // 2}", 3000 + i, float(i), -0.0) for i in range(21)]                # small groups, one of a single row
    return rows


def _plain(rows, k):
    out = set()
    rows = set(rows)
    for g, i, a, b in rows:
        near = sorted(((a - c) ** 2 + (b - d) ** 2, j) for h, j, c, d in rows if h == g and j != i)[:k]
        out |= {(g, i, r + 1, j, round(math.sqrt(v), 9)) for r, (v, j) in enumerate(near)}
    return out


@pytest.mark.parametrize("k,leaf,slot", [(1, 4096, 16384), (4, 12, 5)])
def test_knn_equals_all_pairs(spark, k, leaf, slot):
    rows = _points()
    bad = [("big", None, 0.0, 0.0), ("big", 9001, None, 0.0), ("big", 9002, float("nan"), 0.0), ("big", 9003, float("inf"), 0.0)]
    df = spark.createDataFrame(rows + rows[:7] + bad, SCHEMA).repartition(5)
    got = knn(df, "grp", "id", ["a", "b"], k, leaf_rows=leaf, slot_rows=slot).collect()
    assert len(got) == len({tuple(r)[:3] for r in got})
    assert {(r["grp"], r["id"], r["rank"], r["neighbour"], round(r["distance"], 9)) for r in got} == _plain(rows, k)


def test_knn_from_a_sample_and_without_rows(spark):
    rows = [("all", i, a, b) for _, i, a, b in _points(8)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = knn(df, [], "id", ["a", "b"], 3, leaf_rows=20, sample_rows=100)
    assert {("all", r["id"], r["rank"], r["neighbour"], round(r["distance"], 9)) for r in got.collect()} == _plain(rows, 3)
    assert knn(df.limit(0), "grp", "id", ["a", "b"], 2).count() == 0


def _plain_silhouette(rows):
    out = {}
    for i, (g, *x) in enumerate(rows):
        d = {}
        for j, (h, *y) in enumerate(rows):
            if i != j:
                d.setdefault(h, []).append(math.dist(x, y))
        near = min((sum(v) / len(v) for h, v in d.items() if h != g), default=None)
        own = d.get(g)
        s = 0.0 if not own or near is None else (near - sum(own) / len(own)) / max(near, sum(own) / len(own))
        out.setdefault(g, []).append(s)
    return out


def test_silhouette_equals_all_pairs(spark):
    g = np.random.default_rng(1)
    rows = [(f"c{i % 3}", *(g.normal(size=3) + (i % 3) * 2).tolist()) for i in range(200)]
    rows += rows[:40] + [("one", 9.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows + [(None, 1.0, 1.0, 1.0), ("c0", None, 1.0, 1.0)], "grp string, a double, b double, c double")
    want = _plain_silhouette(rows)
    every = [v for s in want.values() for v in s]
    for block in (8192, 30):
        got = {r["grp"]: r for r in silhouette(df, ["a", "b", "c"], "grp", block_rows=block).collect()}
        assert got.keys() == want.keys() | {"__all__"}
        for c, s in [*want.items(), ("__all__", every)]:
            assert got[c]["n"] == len(s) and got[c]["error"] == 0
            assert got[c]["silhouette"] == pytest.approx(sum(s) / len(s), abs=1e-12)
    part = {r["grp"]: r for r in silhouette(df, ["a", "b", "c"], "grp", score_rows=100).collect()}["__all__"]
    assert part["error"] > 0 and abs(part["silhouette"] - np.mean(every)) < 5 * part["error"]
    assert silhouette(df.limit(0), ["a"], "grp").count() == 0
    assert [r["silhouette"] for r in silhouette(df.filter("grp = 'c1'"), ["a", "b", "c"], "grp").collect()] == [0.0, 0.0]


def test_distances_keep_their_digits():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(50, 8)), rng.normal(size=(70, 8))
    b[:20] = a[:20] + 1e-7 * rng.normal(size=(20, 8))
    b[20] = a[20]
    for shift in (0.0, 3.0):
        truth = np.sqrt((((a + shift)[:, None] - (b + shift)[None]) ** 2).sum(2))
        assert np.allclose(neighbours._distances(a + shift, b + shift), truth, rtol=1e-8, atol=0)
