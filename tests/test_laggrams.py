"""Lag Grams against the explicit lag matrix, chunked and whole."""

import numpy as np
import pytest

from statlake.operators import tstests
from statlake.operators.laggrams import SHAPES, LagGram, lag_sums, nested_ssr
from statlake.operators.moments import ols_gram


def _explicit(u, columns, start):
    at = np.arange(start, len(u))
    x = np.column_stack([u[at - j, c] for c, j in columns])
    return len(x), x.mean(0), (x - x.mean(0)).T @ (x - x.mean(0))


@pytest.mark.parametrize("shape, chunk", [("as is", None), ("differences", 40), ("level and difference", 25)])
def test_gram_equals_the_lag_matrix(spark, shape, chunk):
    rng = np.random.default_rng(2)
    y = 1e6 + np.cumsum(rng.normal(size=(150, 2 if shape != "level and difference" else 1)), axis=0)
    names = ["a", "b"][:y.shape[1]]
    df = spark.createDataFrame([("k", i, *map(float, r)) for i, r in enumerate(y)], ["k", "t", *names]).repartition(5)
    row = lag_sums(df, ["k"] if chunk is None else [], "t", names, shape, lambda n: 7, chunk).toPandas().iloc[0]
    u = SHAPES[shape][1](y)
    sums = LagGram(row, shape, 7)
    columns = [(1, j) for j in range(1, 5)] + [(0, 0), (1, 0)]
    for start in (4, 7):
        n, m, c = sums.gram(columns, start=start)
        wn, wm, wc = _explicit(u, columns, start)
        assert n == wn and np.allclose(m + sums.centre[[q for q, _ in columns]], wm, rtol=1e-10) and np.allclose(c, wc, rtol=1e-7, atol=1e-6)


def test_nested_residual_sums(spark):
    x = np.random.default_rng(4).normal(size=(60, 6)) * [1, 100, 1, 1e-3, 1, 1]
    c = (x - x.mean(0)).T @ (x - x.mean(0))
    want = [ols_gram(60.0, x.mean(0), c, list(range(k)), 5)[1] for k in range(6)]
    assert np.allclose(nested_ssr(c), want, rtol=1e-9)
    x[:, 3] = x[:, 1]
    assert nested_ssr((x - x.mean(0)).T @ (x - x.mean(0))) is None


def test_chunks_do_not_change_the_tests(spark):
    rng = np.random.default_rng(6)
    v = np.cumsum(rng.normal(size=400))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(v, np.roll(v, 2) + rng.normal(size=400)))], "t long, y double, x double")
    for fn in (lambda **k: tstests.adf(df, [], "t", "y", **k), lambda **k: tstests.granger(df, [], "t", "y", "x", 4, **k)):
        a, b = fn().toPandas().select_dtypes("number"), fn(chunk=64).toPandas().select_dtypes("number")
        assert np.allclose(a, b, rtol=1e-8)


def test_short_empty_and_constant_series(spark):
    rows = [("one", 0, 1.0)] + [("flat", i, 2.0) for i in range(30)] + [("null", i, None) for i in range(5)] + [("two", i, float(i * i)) for i in range(2)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    got = {r["k"]: r for r in tstests.adf(df, ["k"], "t", "v").collect()}
    assert set(got) == {"one", "flat", "null", "two"} and got["flat"]["error"] == "constant series"
    assert all(got[k]["error"] == "too few rows" and got[k]["adf_stat"] is None for k in ("one", "null", "two"))
    assert tstests.adf(df.filter("false"), [], "t", "v").collect() == [] or tstests.adf(df.filter("false"), [], "t", "v").first()["error"]
    assert tstests.granger(df.withColumn("x", df.v), ["k"], "t", "v", "x").filter("k = 'one'").count() == 0
