import math

import numpy as np
from pyspark.sql import functions as F

from statlake.operators import forecast as fc
from statlake.operators import tstests, windows
from tests.fixtures_solar import (ADF_P_AFTER, ADF_P_RAW, AR_S_L12_CSS, AR_S_L24_CSS, FORECAST_FIRST,
                                  FORECAST_LAST, SOLAR_START, SOLAR_VALUES)


def _solar(spark):
    rows = [("s", i, float(v)) for i, v in enumerate(SOLAR_VALUES)]
    df = spark.createDataFrame(rows, "series_key string, t long, value double")
    return df.withColumn("ts", F.add_months(F.to_date(F.lit(SOLAR_START)), F.col("t").cast("int")))


def test_adf_golden(spark):
    r = tstests.adf(_solar(spark), ["series_key"], "ts", "value").first()
    assert math.isclose(r["p_value"], ADF_P_RAW, rel_tol=1e-9)


def test_stationarize_golden(spark):
    r = tstests.stationarize(_solar(spark), ["series_key"], "ts", "value").first()
    assert r["log_applied"] and r["d"] == 1 and r["seasonal_d"] == 0
    assert math.isclose(r["adf_p_raw"], ADF_P_RAW, rel_tol=1e-9)
    assert math.isclose(r["adf_p_after"], ADF_P_AFTER, rel_tol=1e-6)


def test_sarima_css_and_forecast_golden():
    y = np.log(np.array(SOLAR_VALUES))
    o = dict(p=0, d=2, q=0, sp=2, sd=0, sq=0, s=12)
    f = fc.fit_css(y, o)
    assert math.isclose(f["theta"][0], AR_S_L12_CSS, abs_tol=1e-6)
    assert math.isclose(f["theta"][1], AR_S_L24_CSS, abs_tol=1e-6)
    assert f["n_eff"] == 73
    assert f["stderr"].shape == (2,) and np.all(f["stderr"] > 0)
    mean, lo, hi = fc.forecast_path(y, o, f["theta"], f["sigma2"], f["resid"], 10)
    assert math.isclose(math.exp(mean[0]), FORECAST_FIRST, rel_tol=1e-5)
    assert math.isclose(math.exp(mean[-1]), FORECAST_LAST, rel_tol=1e-5)
    assert np.all(lo < mean) and np.all(mean < hi)


def test_sarima_grid_keeps_failed_fits(spark):
    packed = fc.pack_series(_solar(spark).filter(F.col("t") < 20), ["series_key"], "ts", "value", log=True)
    fits = fc.sarima_grid(packed, ["series_key"], fc.order_grid(p=[0, 1], d=[1], q=[0], sp=[0, 2], sd=[1], sq=[0])).collect()
    assert len(fits) == 4
    assert any(not r["ok"] and r["error"] for r in fits)


def test_decomposition_adds_up(spark):
    d = tstests.seasonal_decompose(_solar(spark), ["series_key"], "ts", "value", 12).toPandas()
    assert np.allclose(d["trend"] + d["seasonal"] + d["resid"], d["value"])
    assert d["trend"].notna().all()


def test_acf_lag0_and_ljung_box(spark):
    a = tstests.acf(_solar(spark), ["series_key"], "ts", "value").toPandas().sort_values("lag")
    assert a["acf"].iloc[0] == 1.0 and len(a) == 37
    pa = tstests.pacf_yw(tstests.acf(_solar(spark), ["series_key"], "ts", "value"), ["series_key"]).toPandas()
    r1 = a["acf"].iloc[1]
    r2 = a["acf"].iloc[2]
    p2 = pa.sort_values("lag")["pacf"].iloc[2]
    assert math.isclose(p2, (r2 - r1 * r1) / (1 - r1 * r1), rel_tol=1e-9)


def test_regularize_and_interpolate(spark):
    rows = [("a", "2020-01-01", 1.0), ("a", "2020-02-01", None), ("a", "2020-04-01", 4.0), ("a", "2020-05-01", None)]
    df = spark.createDataFrame(rows, "k string, ts string, value double").withColumn("ts", F.to_date("ts"))
    g = windows.regularize_monthly(df.filter(F.col("value").isNotNull() | (F.col("ts") == F.to_date(F.lit("2020-05-01")))),
                                   ["k"], "ts", "value")
    out = windows.interpolate_linear(g, ["k"], "ts", "value").orderBy("ts").toPandas()
    assert list(out["value"]) == [1.0, 2.0, 3.0, 4.0, 4.0]


def test_path_length_square(spark):
    pts = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 1.0, 0.0), (1, 2, 1.0, 1.0), (1, 3, 0.0, 1.0)],
                                "route long, seq long, x double, y double")
    r = windows.path_length(pts, "route", "seq", ["x", "y"]).first()
    assert math.isclose(r["length"], 4.0) and r["legs"] == 4


def test_granger_detects_lead(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=200).cumsum()
    y = np.concatenate([[0.0], x[:-1]]) + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([("k", i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, x))],
                               "k string, t long, y double, x double")
    g = tstests.granger(df, ["k"], "t", "y", "x", maxlag=2).toPandas()
    assert (g["ssr_f_p"] < 1e-6).all()


def test_stl_adds_up_and_stays_in_range(spark):
    s = tstests.stl(_solar(spark), ["series_key"], "ts", "value", 12).toPandas()
    assert np.allclose(s["seasonal"] + s["trend"] + s["resid"], s["value"])
    spread = s["value"].max() - s["value"].min()
    assert s["trend"].between(s["value"].min() - spread, s["value"].max() + spread).all()


def test_stl_constant_outlier_and_wide_span():
    t = np.arange(60.0)
    flat = tstests.stl_numpy(np.full(60, 7.0), 12)
    assert np.allclose(flat[1], 7.0) and np.allclose(flat[0], 0) and np.allclose(flat[2], 0)
    y = 10 + 0.5 * t + 3 * np.sin(2 * np.pi * t / 12)
    clean = tstests.stl_numpy(y, 12)
    assert np.abs(clean[2]).max() < 0.5
    spiked = y.copy()
    spiked[30] += 500
    out = tstests.stl_numpy(spiked, 12)
    assert out[2][30] > 400 and np.abs(out[1] - clean[1]).max() < 2
    # a span beyond the series only widens the window
    line = tstests._loess(2 * t[:10] + 1, np.ones(10), 31)
    assert np.allclose(line, 2 * t[:10] + 1)


def test_hp_adds_up(spark):
    h = tstests.hp_filter(_solar(spark), ["series_key"], "ts", "value", 129600.0).toPandas().sort_values("ts")
    assert np.allclose(h["trend"] + h["cycle"], h["value"])
    # normal equations: (I + λKᵀK)τ = y, checked against a dense solve
    y = h["value"].to_numpy()
    n = len(y)
    k = np.zeros((n - 2, n))
    for i in range(n - 2):
        k[i, i:i + 3] = (1.0, -2.0, 1.0)
    dense = np.linalg.solve(np.eye(n) + 129600.0 * k.T @ k, y)
    assert np.allclose(dense, h["trend"].to_numpy(), rtol=1e-8, atol=1e-6)
    assert np.abs(np.diff(h["trend"].to_numpy(), 2)).max() < np.abs(np.diff(y, 2)).max()


def test_sarimax_recovers_exog_effect(spark):
    rng = np.random.default_rng(5)
    n = 120
    x = rng.normal(size=n).cumsum()
    y = 3.0 * x + rng.normal(scale=0.01, size=n).cumsum()
    df = spark.createDataFrame([("k", i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, x))],
                               "k string, t long, y double, x double")
    r = fc.sarimax_fit(df, ["k"], "t", "y", ["x"], dict(p=1, d=1, q=0, sp=0, sd=0, sq=0, s=12)).first()
    assert r["ok"] and abs(r["params"][-1] - 3.0) < 0.05


def test_missing_months_are_filled_before_lags(spark):
    from statlake.plans.common import regular_monthly
    solar = _solar(spark)
    gone = solar.filter("ts not in (date'2023-05-01', date'2024-11-01')")
    full = {r["ts"]: r["value"] for r in solar.collect()}
    got = {r["ts"]: r["value"] for r in regular_monthly(gone, ["series_key"], "ts", "value").collect()}
    assert got.keys() == full.keys()
    import datetime as d
    for t in (d.date(2023, 5, 1), d.date(2024, 11, 1)):
        before = (t.replace(day=1) - d.timedelta(days=1)).replace(day=1)
        after = (t + d.timedelta(days=31)).replace(day=1)
        assert abs(got[t] - (full[before] + full[after]) / 2) < 1e-9
    a = {r["lag"]: r["acf"] for r in tstests.acf(regular_monthly(gone, ["series_key"], "ts", "value"), ["series_key"], "ts", "value", 12).collect()}
    b = {r["lag"]: r["acf"] for r in tstests.acf(solar, ["series_key"], "ts", "value", 12).collect()}
    assert max(abs(a[k] - b[k]) for k in a) < 0.01
