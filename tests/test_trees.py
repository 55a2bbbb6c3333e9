"""The level-wise tree grower against a plain recursive one."""
import math

import numpy as np
import pytest

from statlake.operators import trees
from statlake.operators.trees import Forest, Spec

COLS = ["a", "b", "c"]


def _impurity(ys, kind, k):
    p = [ys.count(c) / len(ys) for c in range(k)]
    return 1 - sum(v * v for v in p) if kind == "gini" else -sum(v * math.log2(v) for v in p if v)


def _plain(rows, kind, leaf, k, depth=None, split=2, d=0):
    """rows: (features, class).  A nested (counts, feature, threshold, left, right)."""
    ys = [y for _, y in rows]
    counts = [ys.count(c) for c in range(k)]
    node = [counts, None, None, None, None]
    if len(set(ys)) < 2 or len(ys) < split or (depth is not None and d >= depth):
        return node
    best = None
    for f in range(len(rows[0][0])):
        vals = sorted({x[f] for x, _ in rows})
        for lo, hi in zip(vals, vals[1:]):
            t = (lo + hi) / 2
            lt, rt = [y for x, y in rows if x[f] <= t], [y for x, y in rows if x[f] > t]
            if min(len(lt), len(rt)) < leaf:
                continue
            cost = (len(lt) * _impurity(lt, kind, k) + len(rt) * _impurity(rt, kind, k)) / len(ys)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, t)
    if best:
        _, f, t = best
        node[1:] = [f, t, _plain([r for r in rows if r[0][f] <= t], kind, leaf, k, depth, split, d + 1),
                    _plain([r for r in rows if r[0][f] > t], kind, leaf, k, depth, split, d + 1)]
    return node


def _predict(node, x):
    while node[1] is not None:
        node = node[3] if x[node[1]] <= node[2] else node[4]
    return node[0].index(max(node[0]))


def _flat(node, path=""):
    out = {path: (node[0], None if node[1] is None else COLS[node[1]], node[2])}
    if node[1] is not None:
        out |= _flat(node[3], path + "L") | _flat(node[4], path + "R")
    return out


@pytest.fixture(scope="module")
def rows():
    g = np.random.default_rng(5)
    x = np.column_stack([g.integers(0, 12, 220), g.normal(size=220).round(1), g.integers(0, 3, 220)]).astype(float)
    y = (x[:, 0] + 3 * x[:, 1] + g.normal(scale=2, size=220) > 6).astype(int) + (x[:, 2] > 1) * (g.random(220) < 0.4)
    return [(int(i % 5) if i < 200 else -1, "xyz"[c], *map(float, v)) for i, (v, c) in enumerate(zip(x, y))]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "part int, kind string, a double, b double, c double")


def _split(rows, holdout):
    data = [(p, r, "xyz".index(c)) for p, c, *r in rows]
    return [(x, y) for p, x, y in data if p >= 0 and p != holdout], [(x, y) for p, x, y in data if p == holdout]


@pytest.mark.parametrize("local_rows", [10**6, 40, 0])
@pytest.mark.parametrize("kind,leaf", [("gini", 1), ("entropy", 3)])
def test_nodes_equal_the_plain_tree(frame, rows, kind, leaf, local_rows):
    f = Forest(frame.repartition(3), COLS, "kind", "part", [Spec(7, -1, kind, leaf)], [(None, 2)], local_rows=local_rows)
    got = {r["path"]: (r["counts"], r["feature"], r["threshold"]) for r in f.nodes().collect()}
    f.close()
    want = _flat(_plain(_split(rows, -1)[0], kind, leaf, 3))
    assert got.keys() == want.keys()
    for p in want:
        assert list(got[p][0]) == want[p][0] and got[p][1] == want[p][1]
        assert got[p][2] == pytest.approx(want[p][2], abs=1e-12) if want[p][2] is not None else got[p][2] is None


@pytest.mark.parametrize("local_rows", [10**6, 60])
def test_grid_equals_180_plain_fits(frame, rows, local_rows):
    out = trees.grid_scores(frame, COLS, "kind", "part", local_rows=local_rows)
    assert len(out) == 180 and sorted(r["rank"] for r in out) == list(range(1, 181))
    memo = {}
    for r in out:
        kind = "gini" if r["criterion"] == "gini" else "entropy"
        key = (kind, r["max_depth"], r["min_samples_leaf"], r["min_samples_split"])
        if key not in memo:
            accs = []
            for f in range(5):
                train, test = _split(rows, f)
                t = _plain(train, kind, key[2], 3, key[1], key[3])
                accs.append(sum(_predict(t, x) == y for x, y in test) / len(test))
            train, test = _split(rows, -1)
            t = _plain(train, kind, key[2], 3, key[1], key[3])
            memo[key] = (np.mean(accs), np.std(accs), sum(_predict(t, x) == y for x, y in test) / len(test))
        assert (r["mean_accuracy"], r["sd_accuracy"], r["test_accuracy"]) == pytest.approx(memo[key], abs=1e-12)
    best = min(out, key=lambda r: r["rank"])
    assert best["mean_accuracy"] == pytest.approx(max(r["mean_accuracy"] for r in out))


def test_partitions_bins_and_importances(spark, frame):
    seen = []
    for n in (1, 4, 9):
        f = Forest(frame.repartition(n), COLS, "kind", "part", [Spec(0, -1, "gini", 5)], [(4, 2)], max_bins=6, local_rows=50)
        d = f.nodes()
        seen.append(sorted(map(str, d.collect())))
        imp = {r["feature"]: r["importance"] for r in trees.importances(d).collect()}
        f.close()
        assert sum(imp.values()) == pytest.approx(1)
    assert seen[0] == seen[1] == seen[2]


def test_defined_cases(spark):
    schema = "part int, kind string, a double, b double, c double"
    f = Forest(spark.createDataFrame([], schema), COLS, "kind", "part", [Spec(0, -1)], [(None, 2)])
    assert f.nodes().count() == 0 and f.confusion().count() == 0
    f.close()
    nan = float("nan")
    rows = [(0, "x", 1.0, 2.0, 3.0)] * 30 + [(0, "y", 1.0, 2.0, 3.0)] * 10 + [(0, None, 1.0, 2.0, 3.0), (None, "x", 1.0, 2.0, 3.0),
            (0, "y", None, 2.0, 3.0), (0, "y", nan, 2.0, 3.0), (0, "y", float("inf"), 2.0, 3.0)] + [(-1, "y", 9.0, 9.0, 9.0)] * 3
    for local in (0, 1000):  # equal rows of both classes can't be split: one leaf, wherever it is made
        f = Forest(spark.createDataFrame(rows, schema), COLS, "kind", "part", [Spec(0, -1)], [(None, 2)], local_rows=local)
        assert [(r["path"], list(r["counts"]), r["feature"], r["pred"]) for r in f.nodes().collect()] == [("", [30, 10], None, 0)]
        assert [tuple(r) for r in f.confusion().collect()] == [(0, 0, 1, 0, 3)]
        f.close()
    out = trees.grid_scores(spark.createDataFrame(rows, schema), COLS, "kind", "part", grid={"criterion": ["gini"], "max_depth": [2]})
    assert len(out) == 12 and {(r["mean_accuracy"], r["test_accuracy"]) for r in out} == {(0.75, 0.0)}
