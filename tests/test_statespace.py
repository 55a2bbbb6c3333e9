"""Kalman-filter likelihood against dense Gaussian densities, closed forms and
the recorded forecasting run."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from statlake.operators import forecast as fc
from statlake.operators import statespace as ss
from tests.fixtures_solar import FORECAST_FIRST, FORECAST_LAST, SOLAR_VALUES

# fixed values: parameters of the recorded run and the band of its first and last month
RECORDED = (0.7931110976314154, 0.020931898825195177, 2.3900093720460932e-08)
BANDS = {0: (605.0501840953644, 605.4186272292097), 9: (646.0012100652517, 653.7333780041369)}
SOLAR_ORDER = dict(p=0, d=2, q=0, sp=2, sd=0, sq=0, s=12)


def _dense(ar, ma, s2, w):
    """Gaussian log-density of an ARMA stretch from its autocovariances."""
    psi = np.zeros(3000)
    psi[0] = 1.0
    for j in range(1, len(psi)):
        psi[j] = (ma[j - 1] if j <= len(ma) else 0.0) + sum(a * psi[j - i] for i, a in enumerate(ar, 1) if j >= i)
    g = np.array([s2 * psi[:len(psi) - k] @ psi[k:] for k in range(len(w))])
    cov = g[np.abs(np.subtract.outer(np.arange(len(w)), np.arange(len(w))))]
    return -0.5 * (len(w) * math.log(2 * math.pi) + np.linalg.slogdet(cov)[1] + w @ np.linalg.solve(cov, w))


@pytest.mark.parametrize("o, theta", [
    (dict(p=1, d=1, q=1, sp=0, sd=0, sq=0, s=12), [0.5, 0.3]),
    (dict(p=2, d=0, q=2, sp=0, sd=0, sq=0, s=12), [0.5, -0.3, 0.4, 0.2]),
    (dict(p=1, d=1, q=0, sp=1, sd=1, sq=1, s=4), [0.4, 0.3, -0.5]),
])
def test_stationary_likelihood_is_the_gaussian_density(o, theta):
    y = np.cumsum(np.random.default_rng(3).normal(size=60))
    ar, ma = ss._arma(np.array(theta), o)
    want = _dense(ar, ma, 1.3, ss._difference(y, o))
    got = ss.loglike([theta + [1.3], theta + [-1.0], [5.0] + theta[1:] + [1.3]], y, o, "stationary")
    assert math.isclose(got[0], want, rel_tol=1e-8)
    assert got[1] == -np.inf and got[2] == -np.inf  # no variance; a root inside the circle


def test_diffuse_start_is_the_limit_of_a_wide_prior():
    """Conditional density of the later values under a wide normal prior on every state."""
    o = dict(p=1, d=1, q=1, sp=0, sd=1, sq=1, s=3)
    theta = np.array([[0.5, 0.4, -0.3]])
    y = np.cumsum(np.random.default_rng(5).normal(size=30))
    t, shock, z, _ = ss._system(theta, o, False)
    t, shock, r, n = t[0], shock[0], len(z), len(y)
    a, rows, noise = np.eye(r), [], np.zeros((n, n))
    for i in range(n):
        rows.append(z @ a)
        a = t @ a
    for j in range(n):  # the shock after value j reaches later values
        x = shock
        for i in range(j + 1, n):
            noise[i, j] = z @ x
            x = t @ x
    cov = 1e6 * np.array(rows) @ np.array(rows).T + 1.3 * noise @ noise.T

    def density(m):
        c = cov[:m, :m]
        return -0.5 * (m * math.log(2 * math.pi) + np.linalg.slogdet(c)[1] + y[:m] @ np.linalg.solve(c, y[:m]))

    got = ss.loglike([[*theta[0], 1.3]], y, o)[0]
    assert math.isclose(got, density(n) - density(r), rel_tol=1e-4)


def test_recorded_run():
    y = np.log(np.array(SOLAR_VALUES))
    resid, mean, se = ss.predict(y, SOLAR_ORDER, RECORDED[:2], RECORDED[2], 10)
    assert len(resid) == 73
    assert math.isclose(math.exp(mean[0]), FORECAST_FIRST, rel_tol=1e-6)
    # the recorded run carried a prior variance of 1e6 beside 2e-8, which costs it digits further ahead
    assert math.isclose(math.exp(mean[9]), FORECAST_LAST, rel_tol=4e-6)
    for i, (lo, hi) in BANDS.items():
        assert math.isclose(math.exp(mean[i] - 1.959963984540054 * se[i]), lo, rel_tol=1e-5)
        assert math.isclose(math.exp(mean[i] + 1.959963984540054 * se[i]), hi, rel_tol=1e-5)
    f = ss.fit_exact(y, SOLAR_ORDER)
    css = fc.fit_css(y, SOLAR_ORDER)  # pure AR: the diffuse likelihood is the conditional one
    assert np.allclose(f["theta"], css["theta"], atol=1e-6) and math.isclose(f["aic"], css["aic"], abs_tol=1e-4)
    # the recorded AIC, -1065.9973, is that of a fit with a finite prior variance: close, never better
    assert f["n_eff"] == 73 and -1065.9973 - 0.2 < f["aic"] < -1065.9973
    assert f["llf"] >= ss.loglike([RECORDED], y, SOLAR_ORDER)[0]


def test_fit_is_a_maximum_and_recovers_coefficients():
    rng = np.random.default_rng(11)
    e = rng.normal(size=900)
    w = np.zeros(900)
    for i in range(1, 900):
        w[i] = 0.6 * w[i - 1] + e[i] + 0.4 * e[i - 1]
    o = dict(p=1, d=1, q=1, sp=0, sd=0, sq=0, s=12)
    for start in ("stationary", "diffuse"):
        f = ss.fit_exact(np.cumsum(w), o, start)
        assert np.allclose(f["theta"], [0.6, 0.4], atol=0.12) and abs(f["sigma2"] - 1) < 0.15
        assert f["stderr"].shape == (2,) and np.all((f["stderr"] > 0.01) & (f["stderr"] < 0.1))
        at = np.r_[f["theta"], f["sigma2"]]
        near = at + 0.01 * np.vstack([np.eye(3), -np.eye(3)])
        assert np.all(ss.loglike(near, np.cumsum(w), o, start) < f["llf"])


def test_grid_forecast_and_residuals(spark):
    df = spark.createDataFrame([("a", i, math.log(v)) for i, v in enumerate(SOLAR_VALUES)] + [("short", i, float(i * i)) for i in range(9)],
                               "k string, t long, v double")
    packed = fc.pack_series(df, ["k"], "t", "v").cache()
    fits = fc.sarima_grid(packed, ["k"], [SOLAR_ORDER], method="exact").cache()
    rows = {r["k"]: r for r in fits.collect()}
    assert rows["a"]["ok"] and not rows["short"]["ok"] and rows["short"]["error"]
    best = fc.best_by_aic(fits, ["k"])
    f = fc.forecast(packed, best, ["k"], h=3, method="exact").orderBy("h_step").collect()
    assert math.isclose(math.exp(f[0]["forecast"]), FORECAST_FIRST, rel_tol=1e-6) and f[0]["lower"] < f[0]["forecast"] < f[0]["upper"]
    resid = fc.residual_frame(packed, best, ["k"], method="exact")
    s = resid.agg(F.count("*").alias("n"), F.min("t").alias("t0"), F.avg(F.col("resid") ** 2).alias("v")).first()
    assert s["n"] == 73 and s["t0"] == 26 and math.isclose(s["v"], rows["a"]["sigma2"], rel_tol=1e-4)
    with pytest.raises(ValueError):
        fc._fitter("other")
