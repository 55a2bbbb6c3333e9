"""Batched logistic searches against plain Newton fits, one model at a time."""

import random

import numpy as np
import pytest

from statlake.operators import logit
from statlake.operators import select as sel


def _rows(seed=3, n=160, p=7, classes=3, shift=0.0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        y = i % classes
        x = [r.gauss(0, 1) for _ in range(p)]
        x[0] += 1.2 * y
        x[3] -= 0.8 * (y == 1)
        x[5] += 0.5 * (y == 2)
        out.append((f"c{y}", i // classes % 4 if i % 5 else -1, *[v + shift for v in x]))
    return out


def _newton(x, t, c=1.0):
    b = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ b))
        g = c * x.T @ (p - t) + b
        b -= np.linalg.solve(c * (x.T * (p * (1 - p))) @ x + np.eye(len(b)), g)
        if np.abs(g).max() < 1e-10:
            break
    return b


class Plain:
    def __init__(self, rows):
        self.y = np.array([int(r[0][1:]) for r in rows])
        self.fold = np.array([r[1] for r in rows])
        self.x = np.array([r[2:] for r in rows])
        self.k = self.y.max() + 1

    def accuracy(self, features, train, test):
        x = np.column_stack([self.x[:, features], np.ones(len(self.x))])
        b = np.array([_newton(x[train], (self.y[train] == c).astype(float)) for c in range(self.k)]).T
        return ((x[test] @ b).round(9).argmax(1) == self.y[test]).mean(), b

    def cv(self, features):
        return np.mean([self.accuracy(features, (self.fold >= 0) & (self.fold != f), self.fold == f)[0] for f in range(4)])

    def greedy(self, k, forward):
        p = self.x.shape[1]
        chosen = [] if forward else list(range(p))
        while len(chosen) != k:
            cand = [sorted([*chosen, j]) for j in range(p) if j not in chosen] if forward else [[x for x in chosen if x != j] for j in chosen]
            scores = [round(self.cv(s), 12) for s in cand]
            chosen = cand[int(np.argmax(scores))]
        return chosen

    def eliminate(self, k):
        keep = list(range(self.x.shape[1]))
        while len(keep) > k:
            b = self.accuracy(keep, self.fold >= 0, self.fold == -1)[1]
            keep.pop(int(np.argmin((b[:-1] ** 2).sum(1))))
        return keep


@pytest.fixture(scope="module")
def data(spark):
    rows = _rows()
    cols = [f"f{i}" for i in range(7)]
    df = spark.createDataFrame(rows, ["label", "fold", *cols]).repartition(5)
    return rows, df, cols


def test_searches_equal_plain_newton(data):
    rows, df, cols = data
    plain = Plain(rows)
    for direction in ("forward", "backward"):
        got = sel.sequential_select(df, cols, "label", 3, "fold", direction)
        assert got == [cols[j] for j in plain.greedy(3, direction == "forward")]
    assert sel.rfe(df, cols, "label", 3, fold_col="fold") == [cols[j] for j in plain.eliminate(3)]


def test_fits_and_holdout_equal_plain_newton(data):
    rows, df, cols = data
    plain = Plain(rows)
    subsets = [[0], [0, 3, 5], list(range(7)), []]
    with logit.Rows(df, cols, "label", "fold") as r:
        beta, batch = logit.fit_subsets(r, subsets)
        got = logit.holdout_accuracy(r, subsets)
    for i, s in enumerate(subsets):
        acc, b = plain.accuracy(s, plain.fold >= 0, plain.fold == -1)
        assert got[i] == pytest.approx(acc)
        assert beta[[*s, 7], 3 * i:3 * i + 3] == pytest.approx(b, abs=0.02)


def test_many_partitions_and_bad_rows(spark, data, monkeypatch):
    rows, df, cols = data
    monkeypatch.setattr(logit, "GATHER", 2)
    monkeypatch.setattr(logit, "TASK_ROWS", 10)
    bad = spark.createDataFrame([("c0", 0, float("nan"), *[0.0] * 6), (None, 0, *[0.0] * 7), ("c1", None, *[0.0] * 7)], df.schema)
    with logit.Rows(df.union(bad), cols, "label", "fold") as r, logit.Rows(df, cols, "label", "fold") as clean:
        assert r.n_train == clean.n_train and r.classes == ["c0", "c1", "c2"]
        assert logit.holdout_accuracy(r, [[0, 3]]) == logit.holdout_accuracy(clean, [[0, 3]])


def test_passes_read_what_they_use(data, monkeypatch):
    rows, df, cols = data
    passes, plain_sum = [], logit.Rows._sum

    def spy(self, run, beta, batch, folds, size):
        passes.append((beta, list(folds)))
        return plain_sum(self, run, beta, batch, folds, size)
    monkeypatch.setattr(logit.Rows, "_sum", spy)
    assert sel.sequential_select(df, cols, "label", 2, "fold") == [cols[j] for j in Plain(rows).greedy(2, True)]
    assert all(-1 not in folds for _, folds in passes)  # test rows take no part in a search
    bases = 4 * 3  # folds x classes
    assert all(beta.any() for beta, _ in passes if beta.shape[1] > bases)  # loss and gradient at the start are those of the base


def test_single_precision_equals_plain_newton(spark, data, monkeypatch):
    rows, df, cols = data
    plain = Plain(rows)
    monkeypatch.setattr(logit, "SINGLE_ROWS", 1)
    with logit.Rows(df, cols, "label", "fold") as r:
        assert r.single
        assert logit.sequential(r, 3) == plain.greedy(3, True)
        assert logit.sequential(r, 3, "backward") == plain.greedy(3, False)
        beta, _ = logit.fit_subsets(r, [list(range(7))])
    assert beta == pytest.approx(plain.accuracy(list(range(7)), plain.fold >= 0, plain.fold == -1)[1], abs=0.02)
    large = spark.createDataFrame([("c0", 0, 1e6, *[0.0] * 6)], df.schema)
    with logit.Rows(df.union(large), cols, "label", "fold") as r:
        assert not r.single
