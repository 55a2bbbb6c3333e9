"""Long series in chunks equal windows over the whole series, at the seams too."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statlake.operators import seams, tstests, windows
from statlake.operators import learn


@pytest.fixture(scope="module")
def series(spark):
    r = random.Random(4)
    rows = [(t, None if r.random() < 0.15 or t in (0, 1, 96) else round(r.gauss(10, 3), 3), round(r.gauss(5, 2) + t / 9, 3)) for t in range(97)]
    pdf = pd.DataFrame(rows, columns=["ts", "gap", "v"])
    return pdf, spark.createDataFrame(rows, "ts long, gap double, v double").repartition(6)


def _col(df, c):
    return np.array([float("nan") if r[c] is None else r[c] for r in df.select("ts", c).orderBy("ts").collect()], float)


@pytest.mark.parametrize("chunk", [7, 13, 1000])
def test_windows_without_a_key(series, chunk, monkeypatch):
    monkeypatch.setattr(seams, "CHUNK", chunk)
    pdf, df = series
    v = pdf["v"]
    assert _col(windows.lag_diff(df, None, "ts", "v", 2, "d"), "d") == pytest.approx((v - v.shift(2)).to_numpy(), nan_ok=True)
    assert _col(windows.lag_diff(df, None, "ts", "v", 12, "d"), "d") == pytest.approx((v - v.shift(12)).to_numpy(), nan_ok=True)
    want = (v - 2 * v.shift(1) + v.shift(2)).to_numpy()
    assert _col(windows.diff_order(df, None, "ts", "v", 2, out="d"), "d") == pytest.approx(want, nan_ok=True)
    want = v.rolling(12, min_periods=1, center=True).mean().to_numpy()
    assert _col(windows.rolling_mean_centered(df, None, "ts", "v", 12, "m"), "m") == pytest.approx(want, nan_ok=True)
    lags = windows.lag_matrix(df, None, "ts", "v", 9)
    for k in range(1, 10):
        assert _col(lags, f"lag{k}") == pytest.approx(v.shift(k).to_numpy(), nan_ok=True)
    want = pdf["gap"].interpolate(limit_direction="both").to_numpy()
    assert _col(windows.interpolate_linear(df, None, "ts", "gap", "g"), "g") == pytest.approx(want)
    assert (_col(windows.positions(df, None, "ts", "p"), "p") == np.arange(97)).all()


def test_keyed_series_in_chunks(spark, series):
    pdf, df = series
    two = df.withColumn("k", F.lit(None).cast("string")).union(df.withColumn("k", F.lit("b")).withColumn("v", F.col("v") * 2))
    got = windows.rolling_mean_centered(two, ["k"], "ts", "v", 12, "m", chunk=10)
    want = windows.rolling_mean_centered(two, ["k"], "ts", "v", 12, "m")
    key = lambda d: sorted(((r["k"] or "", r["ts"], round(r["m"], 9)) for r in d.collect()))
    assert key(got) == key(want)


@pytest.mark.parametrize("chunk", [11, 1000])
def test_lag_products_and_acf(series, chunk, monkeypatch):
    monkeypatch.setattr(seams, "CHUNK", chunk)
    pdf, df = series
    c = pdf["v"].to_numpy() - pdf["v"].mean()
    want = [(c[k:] * c[:len(c) - k]).sum() / (c * c).sum() for k in range(21)]
    got = {r["lag"]: r["acf"] for r in tstests.acf(df, None, "ts", "v", 20).collect()}
    assert [got[k] for k in range(21)] == pytest.approx(want)


@pytest.mark.parametrize("n,chunk", [(97, 8), (97, 1000), (33, 8), (2, 8), (1, 8), (9, 8), (10, 8)])
def test_hp_filter_in_chunks(spark, n, chunk, monkeypatch):
    monkeypatch.setattr(seams, "CHUNK", chunk)
    r = random.Random(n)
    y = np.array([r.gauss(100, 10) + t for t in range(n)])
    df = spark.createDataFrame([("a", t, float(y[t])) for t in range(n)] + [(None, t, float(2 * y[t])) for t in range(n)], "k string, ts long, v double")
    d = np.diff(np.eye(n), 2, axis=0) if n > 2 else np.zeros((0, n))
    want = np.linalg.solve(np.eye(n) + 1600 * d.T @ d, y)
    out = tstests.hp_filter(df, ["k"], "ts", "v", 1600.0)
    assert _col(out.filter("k = 'a'"), "trend") == pytest.approx(want, rel=1e-9)
    assert _col(out.filter("k is null"), "trend") == pytest.approx(2 * want, rel=1e-9)
    assert _col(out.filter("k = 'a'"), "cycle") == pytest.approx(y - want, abs=1e-7)
    assert _col(tstests.hp_filter(df.filter("k = 'a'").drop("k"), None, "ts", "v", 1600.0), "trend") == pytest.approx(want, rel=1e-9)


def test_split_does_not_depend_on_partitions(spark):
    """Repeated ids, repeated rows and a null class and id: the same rows for any partitioning."""
    r = random.Random(1)
    rows = [(r.randrange(60), r.choice(["a", "b", None]), r.randrange(3)) for _ in range(400)] + [(None, "a", 1)] * 5
    df = spark.createDataFrame(rows, "id long, label string, x long")
    seen = set()
    for parts in (1, 7, 13):
        d = df.repartition(parts, "x") if parts > 1 else df.orderBy(F.desc("x")).coalesce(1)
        both = learn.stratified_split_folds(d, "label", "id", 0.25, 5)
        one = learn.stratified_folds(learn.stratified_split(d, "label", "id", 0.25).filter("not is_test"), "label", "id", 5)
        seen.add((tuple(sorted(map(str, both.collect()))), tuple(sorted(map(str, one.collect())))))
    assert len(seen) == 1


def test_cumulative_share_with_repeated_rows(spark):
    from statlake.operators.ranks import cumulative_share
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 3, 1.0), ("a", 3, 1.0), ("a", 2, 4.0), ("b", 1, 5.0)], "k string, o long, w double")
    got = sorted((r["k"], round(r["cum_lo"], 9), round(r["cum_hi"], 9)) for r in cumulative_share(df, "w", ["o"], ["k"]).collect())
    assert got == [("a", 0.0, 0.25), ("a", 0.25, 0.75), ("a", 0.75, 0.875), ("a", 0.875, 1.0), ("b", 0.0, 1.0)]


def test_chain_on_places_numbers_once(spark):
    rows = [(i * 7 % 50, float(i), None if i % 4 else float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, v double, gap double")
    s = windows.positions(df, None, ["k"], "pos")
    slow = windows.interpolate_linear(windows.lag_diff(s, None, "pos", "v", 2, "d"), None, "pos", "gap", "filled", chunk=9)
    fast = windows.interpolate_linear(windows.lag_diff(s, None, "pos", "v", 2, "d", places=True), None, "pos", "gap", "filled", chunk=9, places=True)
    assert sorted(map(tuple, fast.select("k", "d", "filled").collect()), key=str) == sorted(map(tuple, slow.select("k", "d", "filled").collect()), key=str)
    plan = fast._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedfollowing" not in plan  # such a frame is read anew for every row
    assert plan.count("xxhash64") < slow._jdf.queryExecution().optimizedPlan().toString().lower().count("xxhash64")
