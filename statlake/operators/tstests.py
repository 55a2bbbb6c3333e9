"""Time-series tests and decomposition on keyed regular series.

Input is a long frame ``(keys..., order, value)`` holding many series.
Regressions on lags come from sums of lag products
(:mod:`statlake.operators.laggrams`); the small solves run in ``mapInPandas``
over one row per series only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.functions import special
from statlake.functions.exprs import clean_numeric
from statlake.functions.safe import div, same_keys
from statlake.operators.laggrams import LagGram, lag_sums, nested_ssr
from statlake.operators.moments import ols_gram
from statlake.operators.seams import lag_products, smooth_penalised

# MacKinnon (1994/2010) response-surface constants for the
# ADF test with a constant and one series (p-value and critical values).
ADF_TAU_MAX = 2.74
ADF_TAU_MIN = -18.83
ADF_TAU_STAR = -1.61
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_CRIT = {"crit_1": (-3.43035, -6.5393, -16.786, -79.433),
            "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
            "crit_10": (-2.56677, -1.5384, -2.809, 0.0)}


def _k(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def mackinnon_p(tau: float) -> float:
    if not np.isfinite(tau):
        return float("nan")
    if tau > ADF_TAU_MAX:
        return 1.0
    if tau < ADF_TAU_MIN:
        return 0.0
    if tau <= ADF_TAU_STAR:
        c = ADF_SMALL_P
        z = c[0] + c[1] * tau + c[2] * tau ** 2
    else:
        c = ADF_LARGE_P
        z = c[0] + c[1] * tau + c[2] * tau ** 2 + c[3] * tau ** 3
    return float(special.norm_cdf(np.array([z]))[0])


def mackinnon_crit(nobs: float) -> dict:
    return {k: b[0] + b[1] / nobs + b[2] / nobs ** 2 + b[3] / nobs ** 3 for k, b in ADF_CRIT.items()}


def _series_w(keys, order):
    keys = _k(keys)
    return (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(order)


ADF_SCHEMA_FIELDS = ("adf_stat double, p_value double, used_lag long, nobs long, crit_1 double, "
                     "crit_5 double, crit_10 double, is_stationary boolean, error string")


def adf_lags(n: int) -> int:
    """The longest lag of the test on n values."""
    return max(min(math.ceil(12 * (max(n, 1) / 100) ** 0.25), n // 2 - 2), 0)


def adf(df: DataFrame, keys, order: str, value: str, alpha: float = 0.05, lags: int | None = None, chunk: int | None = None) -> DataFrame:
    """Augmented Dickey–Fuller (constant) per series, the lag by AIC or given
    by ``lags``.

    maxlag = min(⌈12 (n/100)^¼⌉, n//2 − 2); AIC compared on the common
    sample, the chosen lag refitted on its longest sample.  All regressions of
    a series come from its sums of lag products (:mod:`laggrams`), so a series
    without a key may be of any length.  A constant or too short series has
    null results and an ``error``; null, NaN and infinite values are left out
    first."""
    keys = _k(keys)
    d = clean_numeric(df.select(*keys, order, value), [value])
    longest = adf_lags if lags is None else (lambda n: lags)
    g = lag_sums(d, keys, order, [value], "level and difference", longest, chunk)
    names = keys + [f.split()[0] for f in ADF_SCHEMA_FIELDS.split(", ")]

    def solve(it):
        for pdf in it:
            out = []
            for _, row in pdf.iterrows():
                res = _adf_of(LagGram(row, "level and difference", longest(int(row["n"]))), lags is None)
                out.append({**{k: row[k] for k in keys}, **res,
                            "is_stationary": None if res["p_value"] is None else bool(res["p_value"] < alpha)})
            yield pd.DataFrame(out, columns=names)

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in g.schema.fields if f.name in keys)
    fitted = g.mapInPandas(solve, (kschema + ", " if kschema else "") + ADF_SCHEMA_FIELDS)
    if not keys:
        return fitted
    # series without any usable value keep a row that says so
    every = df.select(*keys).distinct()
    out = same_keys(every, fitted.withColumn("_found", F.lit(True)), keys, "left")
    return out.withColumn("error", F.when(F.col("_found").isNull(), F.lit("too few rows")).otherwise(F.col("error"))).select(*names)


def _adf_of(sums: LagGram, by_aic: bool) -> dict:
    """One series: lag by AIC on the common sample, then the refit."""
    none = {"adf_stat": None, "p_value": None, "used_lag": None, "nobs": None, "crit_1": None, "crit_5": None, "crit_10": None}
    most = sums.lags
    columns = [(0, 0)] + [(1, j) for j in range(1, most + 1)] + [(1, 0)]  # level, lagged differences, difference
    n, m, c = sums.gram(columns)
    if n < 2:
        return {**none, "error": "too few rows"}
    if c[0, 0] <= 1e-14 * max(1.0, (m[0] + sums.centre[0]) ** 2) * n:
        return {**none, "error": "constant series"}
    lag = most
    if by_aic:
        ssr = nested_ssr(c)
        best = None
        for j in range(0, most + 1):
            if n <= j + 2:
                break
            s = ols_gram(n, m, c, list(range(j + 1)), len(columns) - 1)[1] if ssr is None else ssr[j + 1]
            aic = n * (math.log(2 * math.pi) + math.log(s / n) + 1) + 2 * (j + 2)
            if best is None or aic < best[0]:
                best = (aic, j)
        if best is None:
            return {**none, "error": "too few rows"}
        lag = best[1]
    n, m, c = sums.gram(columns, start=lag)
    beta, ssr, inv, k = ols_gram(n, m, c, list(range(0, lag + 1)), len(columns) - 1)
    if n <= k:
        return {**none, "error": "too few rows"}
    s2 = ssr / (n - k)
    tau = float(beta[1] / math.sqrt(max(inv[1, 1] * s2, 1e-300)))
    return {"adf_stat": tau, "p_value": mackinnon_p(tau), "used_lag": lag, "nobs": int(n), "error": None, **mackinnon_crit(n)}


def stationarize(df: DataFrame, keys, order: str, value: str, season: int = 12) -> DataFrame:
    """Pick ln (if every value > 0 and it lowers the ADF p), then a lag-d
    difference d∈{0,1,2}, then a lag-``season`` difference D∈{0,1}, each by
    lowest ADF p.  All 12 candidate series are tested in one ADF job;
    the choice is made on the small result table.

    Output ``(keys, log_applied, d, seasonal_d, seasonal_periods, adf_p_raw, adf_p_after)``
    (``seasonal_d`` is the seasonal order D; Spark names are case-insensitive)."""
    keys = _k(keys)
    w = _series_w(keys, order)
    base = df.select(*keys, order, value).filter(F.col(value).isNotNull())
    allpos = F.min(value).over(Window.partitionBy(*keys) if keys else Window.partitionBy()) > 0
    base = base.withColumn("_pos", allpos)
    variants = []
    for tr in ("raw", "log"):
        y = F.col(value) if tr == "raw" else F.when(F.col("_pos"), F.log(value))
        for dd in (0, 1, 2):
            for bigd in (0, 1):
                variants.append(F.struct(F.lit(tr).alias("tr"), F.lit(dd).alias("d"), F.lit(bigd).alias("big_d"),
                                         y.alias("y")))
    v = base.select(*keys, order, F.explode(F.array(*variants)).alias("v")).select(
        *keys, order, "v.tr", "v.d", "v.big_d", F.col("v.y").alias("_y"))
    vk = keys + ["tr", "d", "big_d"]
    wv = Window.partitionBy(*vk).orderBy(order)
    dd_expr = F.when(F.col("d") == 0, F.col("_y")).when(
        F.col("d") == 1, F.col("_y") - F.lag("_y", 1).over(wv)).otherwise(F.col("_y") - F.lag("_y", 2).over(wv))
    v = v.withColumn("_yd", dd_expr)
    v = v.withColumn("_yds", F.when(F.col("big_d") == 0, F.col("_yd")).otherwise(
        F.col("_yd") - F.lag("_yd", season).over(wv)))
    res = adf(v.select(*vk, order, "_yds"), vk, order, "_yds")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        p = {(r.tr, int(r.d), int(r.big_d)): float("nan") if r.p_value is None else r.p_value for r in pdf.itertuples()}
        p_raw = p.get(("raw", 0, 0), np.nan)
        tr = "raw"
        lp = p.get(("log", 0, 0), np.nan)
        if np.isfinite(lp) and (not np.isfinite(p_raw) or lp < p_raw):
            tr = "log"
        best_d, best_p = 0, p.get((tr, 0, 0), np.nan)
        for dd in (1, 2):
            pv = p.get((tr, dd, 0), np.nan)
            if np.isfinite(pv) and (not np.isfinite(best_p) or pv < best_p):
                best_d, best_p = dd, pv
        best_big, best_p2 = 0, best_p
        pv = p.get((tr, best_d, 1), np.nan)
        if np.isfinite(pv) and (not np.isfinite(best_p2) or pv < best_p2):
            best_big, best_p2 = 1, pv
        row = {k: pdf.iloc[0][k] for k in keys}
        row.update({"log_applied": tr == "log", "d": best_d, "seasonal_d": best_big, "seasonal_periods": season,
                    "adf_p_raw": float(p_raw), "adf_p_after": float(p.get((tr, best_d, best_big), np.nan))})
        return pd.DataFrame([row])

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in res.schema.fields if f.name in keys)
    schema = (kschema + ", " if kschema else "") + (
        "log_applied boolean, d long, seasonal_d long, seasonal_periods long, adf_p_raw double, adf_p_after double")
    grp = res.groupBy(*keys) if keys else res.groupBy()
    return grp.applyInPandas(choose, schema)


# ---- T3-T5: ACF, PACF, Ljung-Box ------------------------------------------------

def acf(df: DataFrame, keys, order: str, value: str, nlags: int | None = None, chunk: int | None = None) -> DataFrame:
    """Biased ACF per series as long ``(keys, lag, acf)`` for lag 0..nlags;
    default nlags = min(36, max(10, n−1)) per series.  A constant series has
    autocorrelation 1 at lag 0 and null beyond."""
    keys = _k(keys)
    kmax = nlags if nlags is not None else 36
    d = clean_numeric(df.select(*keys, order, value), [value])
    products = lag_products(d, keys, order, value, kmax, chunk)
    per = Window.partitionBy(*keys, "n")  # one row a lag
    products = products.withColumn("_s0", F.max(F.when(F.col("lag") == 0, F.col("product"))).over(per))
    out = products.select(*keys, "n", "lag", F.when(F.col("_s0") != 0, F.col("product") / F.col("_s0")).alias("acf"))
    if nlags is None:
        out = out.filter(F.col("lag") <= F.least(F.lit(36), F.greatest(F.lit(10), F.col("n") - 1)))
    return out.withColumn("acf", F.when(F.col("lag") == 0, F.lit(1.0)).otherwise(F.col("acf")))


def pacf_yw(acf_df: DataFrame, keys) -> DataFrame:
    """T4: PACF by Durbin–Levinson on the (biased) ACF rows of each series
    (Yule–Walker, 'ywm'); runs per series over ≤ 37 ACF values."""
    keys = _k(keys)

    def dl(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        r = pdf["acf"].to_numpy(dtype=float)
        m = len(r) - 1
        out = [1.0]
        phi_prev = np.zeros(0)
        for k in range(1, m + 1):
            if k == 1:
                phi_kk = r[1]
                phi = np.array([phi_kk])
            else:
                num = r[k] - np.dot(phi_prev, r[1:k][::-1])
                den = 1.0 - np.dot(phi_prev, r[1:k])
                phi_kk = num / den if den != 0 else np.nan
                phi = np.concatenate([phi_prev - phi_kk * phi_prev[::-1], [phi_kk]])
            out.append(float(phi_kk))
            phi_prev = phi
        res = pd.DataFrame({"lag": np.arange(0, m + 1, dtype=np.int64), "pacf": out})
        for k in keys:
            res[k] = pdf.iloc[0][k]
        return res[keys + ["lag", "pacf"]]

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in acf_df.schema.fields if f.name in keys)
    schema = (kschema + ", " if kschema else "") + "lag long, pacf double"
    grp = acf_df.groupBy(*keys) if keys else acf_df.groupBy()
    return grp.applyInPandas(dl, schema)


def ljung_box(df: DataFrame, keys, order: str, value: str, lags: int | None = None) -> DataFrame:
    """T5: Q = n(n+2) Σ_{k≤L} r_k²/(n−k); default L = min(24, max(10, n//5));
    p from χ² with L degrees of freedom."""
    keys = _k(keys)
    a = acf(df, keys, order, value, nlags=lags if lags is not None else 24)
    lag_rule = F.lit(lags) if lags is not None else F.least(F.lit(24), F.greatest(F.lit(10), F.floor(F.col("n") / 5)))
    a = a.filter((F.col("lag") >= 1) & (F.col("lag") <= lag_rule))
    q = a.groupBy(*keys).agg(F.first("n").alias("n"), F.max("lag").alias("lags"),
                             F.sum(div(F.col("acf") * F.col("acf"), F.col("n") - F.col("lag"))).alias("_s"))
    q = q.withColumn("lb_stat", F.col("n") * (F.col("n") + 2) * F.col("_s")).drop("_s")
    return q.withColumn("lb_pvalue", special.chi2_sf_udf(F.col("lb_stat"), F.col("lags").cast("double")))


# ---- T6: classical additive decomposition ---------------------------------------------

def seasonal_decompose(df: DataFrame, keys, order: str, value: str, period: int = 12) -> DataFrame:
    """2×period centred moving-average trend (ends extrapolated linearly
    from the nearest ``period`` trend values), centred phase means as
    the seasonal part, residual = value − trend − seasonal."""
    keys = _k(keys)
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy()
    w = _series_w(keys, order)
    d = df.select(*keys, order, value).withColumn("_t", (F.row_number().over(w) - 1).cast("long"))
    d = d.withColumn("_n", F.count(F.lit(1)).over(wk))
    half = period // 2
    if period % 2 == 0:
        wts = {j: (0.5 if abs(j) == half else 1.0) / period for j in range(-half, half + 1)}
    else:
        wts = {j: 1.0 / period for j in range(-half, half + 1)}
    tr = None
    for j, c in wts.items():
        term = F.lit(c) * (F.col(value) if j == 0 else (F.lead(value, j).over(w) if j > 0 else F.lag(value, -j).over(w)))
        tr = term if tr is None else tr + term
    d = d.withColumn("_ma", tr)
    # linear fits through the first / last `period` available trend values
    lo = F.col("_t") < half + period
    # end fit uses the `period` trend values before the last available one
    hi = (F.col("_t") >= F.col("_n") - half - 1 - period) & (F.col("_t") < F.col("_n") - half - 1)
    fits = d.filter(F.col("_ma").isNotNull()).groupBy(*keys).agg(
        F.regr_slope(F.when(lo, F.col("_ma")), F.when(lo, F.col("_t"))).alias("_b0"),
        F.regr_intercept(F.when(lo, F.col("_ma")), F.when(lo, F.col("_t"))).alias("_a0"),
        F.regr_slope(F.when(hi, F.col("_ma")), F.when(hi, F.col("_t"))).alias("_b1"),
        F.regr_intercept(F.when(hi, F.col("_ma")), F.when(hi, F.col("_t"))).alias("_a1"))
    d = same_keys(d, fits, keys)
    trend = F.coalesce(F.col("_ma"), F.when(F.col("_t") < half, F.col("_a0") + F.col("_b0") * F.col("_t"))
                       .otherwise(F.col("_a1") + F.col("_b1") * F.col("_t")))
    d = d.withColumn("trend", trend).withColumn("_phase", F.col("_t") % period)
    ph = d.groupBy(*keys, "_phase").agg(F.avg(F.col(value) - F.col("trend")).alias("_pm"))
    ph = ph.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(wk)).drop("_pm")
    d = same_keys(d, ph, keys + ["_phase"])
    return d.select(*keys, order, value, "trend", "seasonal",
                    (F.col(value) - F.col("trend") - F.col("seasonal")).alias("resid"))


# ---- T9: Granger causality (ssr F, χ², LR) ------------------------------------------

def granger(df: DataFrame, keys, order: str, y: str, x: str, maxlag: int = 6,
            difference: bool = True, chunk: int | None = None) -> DataFrame:
    """Does ``x`` help predict ``y``?  For L = 1..maxlag compare
    y ~ const + y lags and y ~ const + y lags + x lags on the rows where all
    L lags exist.  All regressions of a series come from its sums of lag
    products.  The F test that all x coefficients are 0 (``params_f``) is the
    SSR F test for least squares.  Rows with a null, NaN or infinite value are
    left out first; a lag without a row is left out of the result."""
    keys = _k(keys)
    shape = "differences" if difference else "as is"
    lost = 1 if difference else 0
    lags_of = lambda n: max(min(maxlag, n - lost - 1), 0)
    g = lag_sums(clean_numeric(df.select(*keys, order, y, x), [y, x]), keys, order, [y, x], shape, lags_of, chunk)

    def solve(it):
        for pdf in it:
            out = []
            for _, row in pdf.iterrows():
                sums = LagGram(row, shape, lags_of(int(row["n"])))
                for L in range(1, sums.lags + 1):
                    columns = [(c, j) for c in (0, 1) for j in range(1, L + 1)] + [(0, 0)]
                    n, m, c = sums.gram(columns, start=L)
                    _, ssr_r, _, _ = ols_gram(n, m, c, list(range(L)), 2 * L)
                    _, ssr_u, _, ku = ols_gram(n, m, c, list(range(2 * L)), 2 * L)
                    dfd = n - ku
                    f = ((ssr_r - ssr_u) / L) / (ssr_u / dfd) if dfd > 0 else np.nan
                    rec = {k: row[k] for k in keys}
                    rec.update({"lag": L, "nobs": int(n), "ssr_f": f, "ssr_f_p": float(special.f_sf(f, L, dfd)),
                                "ssr_chi2": n * (ssr_r - ssr_u) / ssr_u,
                                "ssr_chi2_p": float(special.chi2_sf(n * (ssr_r - ssr_u) / ssr_u, L)),
                                "lr": n * math.log(ssr_r / ssr_u),
                                "lr_p": float(special.chi2_sf(n * math.log(ssr_r / ssr_u), L)),
                                "params_f": f, "params_f_p": float(special.f_sf(f, L, dfd))})
                    out.append(rec)
            yield pd.DataFrame(out, columns=keys + ["lag", "nobs", "ssr_f", "ssr_f_p", "ssr_chi2", "ssr_chi2_p",
                                                   "lr", "lr_p", "params_f", "params_f_p"])

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in g.schema.fields if f.name in keys)
    schema = (kschema + ", " if kschema else "") + (
        "lag long, nobs long, ssr_f double, ssr_f_p double, ssr_chi2 double, ssr_chi2_p double, lr double, lr_p double, "
        "params_f double, params_f_p double")
    return g.mapInPandas(solve, schema)


# ---- T7, T8: STL and Hodrick-Prescott (per series, bounded length) --------------------

def _loess(y, w_rob, span, deg=1, xs=None):
    """Local polynomial (tricube) smoother of y at positions xs (default the
    sample positions); robustness weights multiply in.  On a regular grid
    the ``span`` nearest points are a contiguous window, so each fit costs
    O(span) rather than a sort of all distances."""
    n = len(y)
    xs = np.arange(n) if xs is None else xs
    q = min(span, n)
    wider = (span - n) // 2 if span > n else 0
    out = np.empty(len(xs))
    for i, x0 in enumerate(xs):
        lo = int(min(max(int(round(x0)) - (q - 1) // 2, 0), n - q))
        t = np.arange(lo, lo + q, dtype=float)
        h = max(x0 - lo, lo + q - 1 - x0, 1e-12) + wider
        u = np.clip(np.abs(t - x0) / h, 0, 1)
        w = (1 - u ** 3) ** 3 * w_rob[lo:lo + q]
        yy = y[lo:lo + q]
        sw = w.sum()
        if sw <= 0:
            out[i] = y[int(np.clip(round(x0), 0, n - 1))]
            continue
        if deg == 0:
            out[i] = (w * yy).sum() / sw
            continue
        mx = (w * t).sum() / sw
        sxx = (w * (t - mx) ** 2).sum()
        # a slope only where the weights spread over the axis: when robustness leaves one point, its mean
        b = (w * (t - mx) * yy).sum() / sxx if math.sqrt(sxx / sw) > 0.001 * (n - 1) else 0.0
        out[i] = (w * yy).sum() / sw + b * (x0 - mx)
    return out


def _next_odd(v):
    v = int(math.ceil(v))
    return v if v % 2 else v + 1


def stl_numpy(y: np.ndarray, period: int, seasonal: int = 7, robust: bool = True):
    """Seasonal-trend decomposition by LOESS (inner/outer loops with
    bisquare robustness weights).  Returns (seasonal, trend, resid)."""
    y = np.asarray(y, float)
    n = len(y)
    n_s, n_l = seasonal, _next_odd(period + 1 if period % 2 == 0 else period)
    n_t = _next_odd(1.5 * period / (1 - 1.5 / n_s))
    inner, outer = (2, 15) if robust else (5, 0)
    trend = np.zeros(n)
    rob = np.ones(n)
    season = np.zeros(n)
    for _ in range(outer + 1):
        for _ in range(inner):
            detr = y - trend
            cyc = np.zeros(n + 2 * period)
            for p in range(period):
                idx = np.arange(p, n, period)
                sub = detr[idx]
                xs = np.arange(-1, len(idx) + 1)
                sm = _loess(sub, rob[idx], n_s, 1, xs)
                pos = np.arange(p, n + 2 * period, period)[:len(xs)]
                cyc[pos] = sm
            lp = np.convolve(cyc, np.ones(period) / period, mode="valid")
            lp = np.convolve(lp, np.ones(period) / period, mode="valid")
            lp = np.convolve(lp, np.ones(3) / 3, mode="valid")
            lp = _loess(lp, np.ones(len(lp)), n_l, 1)
            season = cyc[period:period + n] - lp[:n]
            trend = _loess(y - season, rob, n_t, 1)
        resid = y - season - trend
        h = 6 * np.median(np.abs(resid))
        u = np.clip(np.abs(resid) / max(h, 1e-12), 0, 1)
        rob = (1 - u ** 2) ** 2
    return season, trend, y - season - trend


def _per_series(df, keys, order, value, fn, out_cols, schema_tail):
    keys = _k(keys)
    d = df.select(*keys, order, value)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        res = fn(pdf[value].to_numpy(float))
        out = pdf[keys + [order, value]].copy()
        for c, v in zip(out_cols, res):
            out[c] = v
        return out

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema.fields if f.name in keys + [order, value])
    grp = d.groupBy(*keys) if keys else d.groupBy()
    return grp.applyInPandas(run, kschema + ", " + schema_tail)


def stl(df: DataFrame, keys, order: str, value: str, period: int = 12, robust: bool = True) -> DataFrame:
    """Robust STL per series (``applyInPandas``; one regular series per
    group).  Adds ``seasonal``, ``trend``, ``resid`` (they sum to the value)."""
    return _per_series(df, keys, order, value, lambda y: stl_numpy(y, period, robust=robust),
                       ["seasonal", "trend", "resid"], "seasonal double, trend double, resid double")


def hp_filter(df: DataFrame, keys, order: str, value: str, lamb: float = 129600.0) -> DataFrame:
    """Hodrick–Prescott split per series of any length: ``trend`` and
    ``cycle``.  The banded system is solved chunk by chunk."""
    d = smooth_penalised(df.select(*_k(keys), order, value), keys, order, value, lamb)
    return d.withColumn("cycle", F.col(value) - F.col("trend"))
