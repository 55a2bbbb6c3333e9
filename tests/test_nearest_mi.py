"""Nearest-neighbour mutual information against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from statlake.operators.select import digamma_col, mutual_info_nearest


def _psi(x):
    if x < 6:
        return _psi(x + 1) - 1 / x
    return math.log(x) - 1 / (2 * x) - 1 / (12 * x ** 2) + 1 / (120 * x ** 4) - 1 / (252 * x ** 6) + 1 / (240 * x ** 8)


def _plain(v, c, k):
    keep = [i for i in range(len(v)) if v[i] is not None and np.isfinite(v[i]) and c[i] is not None]
    keep = [i for i in keep if sum(c[j] == c[i] for j in keep) > 1]
    total = 0.0
    for i in keep:
        same = sorted(abs(v[j] - v[i]) for j in keep if j != i and c[j] == c[i])
        kk = min(k, len(same))
        d = same[kk - 1]
        m = sum(abs(v[j] - v[i]) < d or v[j] == v[i] for j in keep)
        total += _psi(kk) - _psi(len(same) + 1) - _psi(m)
    return len(keep), max(0.0, _psi(len(keep)) + total / len(keep))


def test_digamma(spark):
    got = spark.range(1, 60).select("id", digamma_col(F.col("id").cast("double")).alias("p")).collect()
    assert all(math.isclose(r["p"], _psi(r["id"]), rel_tol=1e-8, abs_tol=1e-10) for r in got)


@pytest.mark.parametrize("k, chunk", [(3, None), (1, 40), (5, 16)])
def test_equals_all_pairs(spark, k, chunk):
    rng = np.random.default_rng(k)
    n = 220
    c = [["a", "b", "c"][i] for i in rng.integers(0, 3, n)]
    near = [float(rng.normal() + "abc".index(x)) for x in c]
    grid = [float(round(x * 2)) for x in near]  # many ties
    noise = [float(x) for x in rng.normal(size=n)]
    near[0], near[1], noise[2], c[3], c[4] = None, math.nan, math.inf, None, "lone"
    flat = [1.0] * n
    cols = {"near": near, "grid": grid, "noise": noise, "flat": flat}
    df = spark.createDataFrame([(*r, x) for *r, x in zip(*cols.values(), c)], "near double, grid double, noise double, flat double, c string").repartition(6)
    got = {r["feature"]: (r["n"], r["mi"]) for r in mutual_info_nearest(df, list(cols), "c", k, chunk).collect()}
    for name, v in cols.items():
        want = _plain(v, c, k)
        assert got[name][0] == want[0] and math.isclose(got[name][1], want[1], abs_tol=1e-7), name
    assert got["near"][1] > got["noise"][1] + 0.1


def test_empty_and_single_rows(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "v double, c string")
    assert mutual_info_nearest(df, ["v"], "c").collect() == []
    assert mutual_info_nearest(df.filter("false"), ["v"], "c").collect() == []
