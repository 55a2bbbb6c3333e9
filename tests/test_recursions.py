"""Recursions in chunks against plain loops."""
import numpy as np
import pytest

from statlake.operators.recursions import arma_innovations, smooth_additive


def _series():
    g = np.random.default_rng(11)
    return {"a": g.normal(size=157).cumsum().tolist(), None: g.normal(5, 2, 60).tolist(), "b": [3.0, 4.5], "c": [7.0]}


def _frame(spark):
    rows = [(k, t, v) for k, s in _series().items() for t, v in enumerate(s)]
    rows += [("a", 500, None), ("a", 501, float("nan")), ("b", 502, float("inf"))]
    return spark.createDataFrame(rows, "key string, t int, v double").repartition(4)


def _smooth(y, al, be, ga, s):
    if s:
        if len(y) < 2 * s:
            return []
        lv = sum(y[:s]) / s
        tr, se = (sum(y[s:2 * s]) / s - lv) / s, [v - lv for v in y[:s]]
    else:
        lv, tr, se = y[0], (y[1] - y[0] if len(y) > 1 else 0.0), [0.0]
    out = []
    for t, v in enumerate(y):
        si = se[t % len(se)]
        out.append(lv + tr + si)
        new = al * (v - si) + (1 - al) * (lv + tr)
        tr = be * (new - lv) + (1 - be) * tr
        lv = new
        if s:
            se[t % s] = ga * (v - new) + (1 - ga) * si
    return out


def _arma(y, ar, ma):
    e = []
    for t, v in enumerate(y):
        e.append(v - sum(a * y[t - i - 1] for i, a in enumerate(ar) if t > i) - sum(m * e[t - j - 1] for j, m in enumerate(ma) if t > j))
    return e


@pytest.mark.parametrize("season,chunk", [(0, None), (0, 10), (6, 7), (4, 1)])
def test_smoothing_equals_the_loop(spark, season, chunk):
    got = smooth_additive(_frame(spark), "key", "t", "v", 0.3, 0.1, 0.2, season, chunk=chunk).collect()
    want = {(k, t): f for k, y in _series().items() for t, f in enumerate(_smooth(y, 0.3, 0.1, 0.2, season))}
    assert {(r["key"], r["t"]) for r in got} == want.keys() and len(got) == len(want)
    for r in got:
        assert r["forecast"] == pytest.approx(want[r["key"], r["t"]], abs=1e-9)
        assert r["error"] == pytest.approx(r["v"] - r["forecast"])


@pytest.mark.parametrize("ar,ma", [([0.5], [0.3]), ([], [0.4, -0.2]), ([0.2, 0.1, -0.3], []), ([], [])])
def test_innovations_equal_the_loop(spark, ar, ma):
    got = arma_innovations(_frame(spark), "key", "t", "v", ar, ma, chunk=9).collect()
    want = {(k, t): e for k, y in _series().items() for t, e in enumerate(_arma(y, ar, ma))}
    assert len(got) == len(want) and all(r["resid"] == pytest.approx(want[r["key"], r["t"]], abs=1e-9) for r in got)


def test_without_key_and_without_rows(spark):
    d = _frame(spark).filter("key = 'a'").drop("key")
    want = _smooth(_series()["a"], 0.5, 0.2, 0.1, 12)
    got = smooth_additive(d, None, "t", "v", 0.5, 0.2, 0.1, 12, chunk=20).orderBy("t").collect()
    assert [r["forecast"] for r in got] == pytest.approx(want, abs=1e-9)
    assert smooth_additive(d.limit(0), None, "t", "v", 0.5, 0.2).count() == 0
    assert arma_innovations(d.limit(0), None, "t", "v", [0.5], [0.1]).count() == 0
