"""Seasonal ARIMA by conditional least squares, order search, forecasts
and Holt–Winters smoothing.

Each series (a regular monthly sequence, bounded by the calendar) is packed
into one sorted array; the candidate orders are exploded next to it, so
Spark spreads (series × order) fits over all executors.  A fit is a small
Levenberg–Marquardt loop on the conditional sum of squares, run in
``mapInPandas`` on that one row.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.functions import special
from statlake.functions.exprs import clean_numeric
from statlake.functions.safe import same_keys

ORDER_FIELDS = ["p", "d", "q", "sp", "sd", "sq", "s"]


def _k(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def pack_series(df: DataFrame, keys, order: str, value: str, log: bool | str = False) -> DataFrame:
    """``(keys, ts array, y array)`` sorted by ``order``; ``log`` may be a
    boolean column name (per-key log choice) or a constant."""
    keys = _k(keys)
    v = F.col(value)
    if isinstance(log, str):
        v = F.when(F.col(log), F.log(value)).otherwise(F.col(value))
    elif log:
        v = F.log(value)
    packed = (df.filter(F.col(value).isNotNull())
                .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("ts"), v.alias("y")))).alias("_s")))
    return packed.select(*keys, F.col("_s.ts").alias("ts"), F.col("_s.y").alias("y"))


def order_grid(p=range(3), d=(0, 1, 2), q=range(3), sp=range(3), sd=(0, 1), sq=range(3), s: int = 12):
    return [dict(zip(ORDER_FIELDS, o)) for o in itertools.product(p, d, q, sp, sd, sq, [s])]


# ---- polynomial helpers (numpy, per fit) -----------------------------------------

def _poly_ar(coefs, step):
    """1 − Σ c_i B^{i·step} as an array of coefficients."""
    out = np.zeros(len(coefs) * step + 1)
    out[0] = 1.0
    for i, c in enumerate(coefs, 1):
        out[i * step] = -c
    return out


def _poly_ma(coefs, step):
    out = np.zeros(len(coefs) * step + 1)
    out[0] = 1.0
    for i, c in enumerate(coefs, 1):
        out[i * step] = c
    return out


def _diff_poly(d, big_d, s):
    poly = np.array([1.0])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    for _ in range(big_d):
        sp = np.zeros(s + 1)
        sp[0], sp[s] = 1.0, -1.0
        poly = np.convolve(poly, sp)
    return poly


def _split(theta, o):
    p, q, sp, sq = o["p"], o["q"], o["sp"], o["sq"]
    i = 0
    ar = theta[i:i + p]; i += p
    sar = theta[i:i + sp]; i += sp
    ma = theta[i:i + q]; i += q
    sma = theta[i:i + sq]; i += sq
    beta = theta[i:]
    return ar, sar, ma, sma, beta


def _residuals(theta, w, o, xw=None):
    """Conditional residuals e_t of φ(B)Φ(B^s) z_t = θ(B)Θ(B^s) e_t with
    pre-sample e = 0: the AR side is one convolution, the MA side a short
    recursion over the series."""
    ar, sar, ma, sma, beta = _split(theta, o)
    a = np.convolve(_poly_ar(ar, 1), _poly_ar(sar, o["s"]))
    m = np.convolve(_poly_ma(ma, 1), _poly_ma(sma, o["s"]))
    z = w - (xw @ beta if xw is not None and len(beta) else 0.0)
    start = len(a) - 1
    u = np.convolve(z, a)[start:len(z)]
    if len(m) == 1:
        return u, start
    mm = m[1:]
    lm = len(mm)
    buf = np.zeros(lm + len(u))
    for t in range(len(u)):
        buf[t + lm] = u[t] - mm @ buf[t:t + lm][::-1]
    return buf[lm:], start


def _residuals_many(thetas, w, o, xw=None):
    """Residual rows of several parameter vectors: one recursion over the
    series moves all of them."""
    us, ms = [], []
    for theta in thetas:
        ar, sar, ma, sma, beta = _split(theta, o)
        a = np.convolve(_poly_ar(ar, 1), _poly_ar(sar, o["s"]))
        ms.append(np.convolve(_poly_ma(ma, 1), _poly_ma(sma, o["s"]))[1:])
        z = w - (xw @ beta if xw is not None and len(beta) else 0.0)
        us.append(np.convolve(z, a)[len(a) - 1:len(z)])
    u, mm = np.array(us), np.array(ms)
    lm = mm.shape[1]
    if not lm:
        return u
    back = mm[:, ::-1]
    buf = np.zeros((len(u), lm + u.shape[1]))
    for t in range(u.shape[1]):
        buf[:, t + lm] = u[:, t] - (back * buf[:, t:t + lm]).sum(1)
    return buf[:, lm:]


def _lm(theta0, many, max_iter=40, tol=1e-9):
    """Levenberg–Marquardt on a residual function of several parameter
    vectors; the numeric Jacobian takes one call."""
    theta = np.array(theta0, dtype=float)
    fun = lambda th: many([th])[0]
    r = fun(theta)
    cost = float(r @ r)
    lam = 1e-3
    for _ in range(max_iter):
        if theta.size == 0:
            break
        h = 1e-6
        jac = (many(theta + h * np.eye(theta.size)) - r).T / h
        g = jac.T @ r
        a = jac.T @ jac
        improved = False
        for _ in range(10):
            try:
                step = np.linalg.solve(a + lam * np.diag(np.diag(a) + 1e-12), -g)
            except np.linalg.LinAlgError:
                lam *= 10
                continue
            cand = theta + step
            rc = fun(cand)
            cc = float(rc @ rc)
            if np.isfinite(cc) and cc < cost:
                theta, r, cost = cand, rc, cc
                lam = max(lam / 3.0, 1e-12)
                improved = True
                break
            lam *= 3.0
        if not improved or np.max(np.abs(step)) < tol:
            break
    return theta, r, cost


def fit_css(y: np.ndarray, o: dict, x: np.ndarray | None = None) -> dict:
    """Conditional-least-squares SARIMA(X) fit on one series.

    The series (and exogenous columns) are differenced by (1−B)^d(1−B^s)^D;
    pure AR orders are linear least squares, MA terms enter through the
    recursive residuals.  Returns params, σ², n_eff, AIC and residuals."""
    y = np.asarray(y, dtype=float)
    dp = _diff_poly(o["d"], o["sd"], o["s"])
    nd = len(dp) - 1
    w = np.convolve(y, dp[::-1], mode="valid") if nd else y.copy()
    xw = None
    if x is not None and x.size:
        xw = np.column_stack([np.convolve(x[:, j], dp[::-1], mode="valid") if nd else x[:, j] for j in range(x.shape[1])])
    npar = o["p"] + o["sp"] + o["q"] + o["sq"] + (xw.shape[1] if xw is not None else 0)
    if len(w) - (o["p"] + o["s"] * o["sp"]) <= npar + 1:
        raise ValueError("series too short for this order")
    theta0 = np.zeros(npar)
    if xw is not None:
        theta0[npar - xw.shape[1]:] = np.linalg.lstsq(xw, w, rcond=None)[0]
    theta, _, _ = _lm(theta0, lambda ths: _residuals_many(ths, w, o, xw))
    e, start = _residuals(theta, w, o, xw)
    n_eff = len(e)
    ssr = float(e @ e)
    sigma2 = ssr / n_eff
    stderr = np.zeros(0)
    if npar:
        step = 1e-6 * np.maximum(1.0, np.abs(theta))
        jac = (_residuals_many(theta + np.diag(step), w, o, xw) - e).T / step
        stderr = np.sqrt(np.maximum(np.diag(sigma2 * np.linalg.pinv(jac.T @ jac)), 0.0))
    llf = -n_eff / 2.0 * (math.log(2 * math.pi * sigma2) + 1.0)
    k = npar + 1
    return {"theta": theta, "stderr": stderr, "sigma2": sigma2, "n_eff": n_eff, "aic": -2 * llf + 2 * k,
            "llf": llf, "resid": e, "start": start + nd}


def param_names(o: dict, exog: Sequence[str] = ()) -> list[str]:
    s = o["s"]
    return ([f"ar.L{i}" for i in range(1, o["p"] + 1)] + [f"ar.S.L{s * i}" for i in range(1, o["sp"] + 1)]
            + [f"ma.L{i}" for i in range(1, o["q"] + 1)] + [f"ma.S.L{s * i}" for i in range(1, o["sq"] + 1)]
            + list(exog) + ["sigma2"])


def forecast_path(y: np.ndarray, o: dict, theta: np.ndarray, sigma2: float, resid: np.ndarray, h: int,
                  alpha: float = 0.05, x: np.ndarray | None = None, x_future: np.ndarray | None = None):
    """Mean forecast and (1−α) interval on the model's own scale: the full
    AR polynomial includes the differencing, ψ-weights give the variance."""
    ar, sar, ma, sma, beta = _split(theta, o)
    a = np.convolve(np.convolve(_poly_ar(ar, 1), _poly_ar(sar, o["s"])), _diff_poly(o["d"], o["sd"], o["s"]))
    m = np.convolve(_poly_ma(ma, 1), _poly_ma(sma, o["s"]))
    y = np.asarray(y, dtype=float)
    reg = np.zeros(len(y))
    reg_f = np.zeros(h)
    if x is not None and len(beta):
        reg = x @ beta
        reg_f = x_future @ beta
    z = list(y - reg)
    n = len(y)
    e = np.zeros(n + h)
    e[n - len(resid):n] = resid
    for t in range(n, n + h):
        acc = 0.0
        for i in range(1, len(a)):
            acc -= a[i] * z[t - i]
        for j in range(1, len(m)):
            if t - j < n:
                acc += m[j] * e[t - j]
        z.append(acc)
    mean = np.array(z[n:]) + reg_f
    psi = np.zeros(h)
    psi[0] = 1.0
    for j in range(1, h):
        v = m[j] if j < len(m) else 0.0
        for i in range(1, min(j, len(a) - 1) + 1):
            v -= a[i] * psi[j - i]
        psi[j] = v
    se = np.sqrt(sigma2 * np.cumsum(psi ** 2))
    zq = float(special.norm_ppf(np.array([1 - alpha / 2]))[0])
    return mean, mean - zq * se, mean + zq * se


# ---- Spark operators -------------------------------------------------------------

_FIT_SCHEMA = ("p long, d long, q long, sp long, sd long, sq long, s long, ok boolean, aic double, "
               "sigma2 double, n_eff long, params array<double>, stderr array<double>, error string")


def _fitter(method: str):
    """The fit of one series: conditional least squares (``css``) or maximum
    likelihood by the Kalman filter (``exact``: diffuse start, differencing in
    the state; ``stationary``: the differenced series from its stationary start)."""
    if method == "css":
        return fit_css
    if method not in ("exact", "stationary"):
        raise ValueError(f"unknown method {method!r}")
    from statlake.operators.statespace import fit_exact
    start = "diffuse" if method == "exact" else method
    return lambda y, o: fit_exact(y, o, start)


def sarima_grid(packed: DataFrame, keys, orders: Sequence[dict], fixed_diff: bool = False, method: str = "css") -> DataFrame:
    """F1 + F2: fit every order in ``orders`` for every packed series by
    ``method``: ``css``, ``exact`` or ``stationary``.
    Failed fits keep ``ok=false`` and an ``error`` text (never dropped).
    With ``fixed_diff`` the packed frame carries ``d_fix``/``sd_fix`` (e.g.
    from :func:`stationarize`) and only orders with those d, D are fitted."""
    keys = _k(keys)
    lit_orders = F.array(*[F.struct(*[F.lit(int(o[f])).alias(f) for f in ORDER_FIELDS]) for o in orders])
    extra = ["d_fix", "sd_fix"] if fixed_diff else []
    work = packed.select(*keys, "y", *extra, F.explode(lit_orders).alias("o")).select(*keys, "y", *extra, "o.*")
    if fixed_diff:
        work = work.filter((F.col("d") == F.col("d_fix")) & (F.col("sd") == F.col("sd_fix"))).drop(*extra)
    # spread (series x order) fits over every core; hash on the order fields
    # keeps one series' fits apart even when there is a single series
    parts = max(1, packed.sparkSession.sparkContext.defaultParallelism * 2)
    work = work.repartition(parts, *keys, *ORDER_FIELDS)

    def run(it):
        fit_one = _fitter(method)
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                o = {f: int(getattr(r, f)) for f in ORDER_FIELDS}
                rec = {k: getattr(r, k) for k in keys}
                rec.update(o)
                try:
                    fit = fit_one(np.asarray(r.y, dtype=float), o)
                    rec.update(ok=True, aic=fit["aic"], sigma2=fit["sigma2"], n_eff=fit["n_eff"],
                               params=[float(v) for v in fit["theta"]], stderr=[float(v) for v in fit["stderr"]],
                               error=None)
                except Exception as ex:  # noqa: BLE001 - a failed fit is a result row
                    rec.update(ok=False, aic=None, sigma2=None, n_eff=None, params=None, stderr=None, error=str(ex)[:200])
                out.append(rec)
            yield pd.DataFrame(out, columns=keys + ORDER_FIELDS + ["ok", "aic", "sigma2", "n_eff", "params", "stderr",
                                                                   "error"])

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema.fields if f.name in keys)
    return work.mapInPandas(run, (kschema + ", " if kschema else "") + _FIT_SCHEMA)


def likelihood_grid(packed: DataFrame, keys, o: dict, points: Sequence[Sequence[float]]) -> DataFrame:
    """``(keys, point, params, llf, sigma2, aic)``: the exact likelihood of
    the differenced series at given coefficients, the variance at its maximum.
    The points of a series go through the filter together; inadmissible
    points (a root on or inside the unit circle) have null results."""
    keys = _k(keys)
    pts = np.asarray(points, float)
    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema.fields if f.name in keys)

    def run(it):
        from statlake.operators.statespace import concentrated
        for pdf in it:
            for r in pdf.itertuples(index=False):
                ll, s2 = concentrated(pts, r.y, o)
                ok = np.isfinite(ll)
                yield pd.DataFrame({**{k: [getattr(r, k)] * len(pts) for k in keys}, "point": np.arange(len(pts)), "params": list(pts),
                                    "llf": np.where(ok, ll, None), "sigma2": np.where(ok, s2, None),
                                    "aic": np.where(ok, -2 * ll + 2 * (pts.shape[1] + 1), None)})

    return packed.select(*keys, "y").mapInPandas(run, (kschema + ", " if kschema else "") + (
        "point long, params array<double>, llf double, sigma2 double, aic double"))


def best_by_aic(fits: DataFrame, keys) -> DataFrame:
    """Lowest-AIC successful fit per series (ties → first order in grid order)."""
    keys = _k(keys)
    ok = fits.filter(F.col("ok"))
    best = ok.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in fits.columns if c not in keys]),
                                          F.struct(F.col("aic"), *[F.col(f) for f in ORDER_FIELDS])).alias("b"))
    return best.select(*keys, "b.*")


def forecast(packed: DataFrame, models: DataFrame, keys, h: int = 10, alpha: float = 0.05,
             exp_back: bool | str = False, method: str = "css") -> DataFrame:
    """F4 + F8 inputs: ``(keys, h_step, forecast, lower, upper)`` from each
    series' chosen model; ``exp_back`` maps log-scale results back.  With
    ``method`` ``exact`` the mean and its variance come from the filter's state."""
    keys = _k(keys)
    j = same_keys(packed, models, keys)
    if isinstance(exp_back, str):
        j = j.withColumn("exp_flag", F.col(exp_back))
    else:
        j = j.withColumn("exp_flag", F.lit(bool(exp_back)))

    def run(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                o = {f: int(getattr(r, f)) for f in ORDER_FIELDS}
                y = np.asarray(r.y, dtype=float)
                theta = np.asarray(r.params, dtype=float)
                if method == "exact":
                    from statlake.operators.statespace import predict
                    _, mean, se = predict(y, o, theta, float(r.sigma2), h)
                    zq = float(special.norm_ppf(np.array([1 - alpha / 2]))[0])
                    lo, hi = mean - zq * se, mean + zq * se
                else:
                    e, _ = _residuals(theta, np.convolve(y, _diff_poly(o["d"], o["sd"], o["s"])[::-1], mode="valid"), o)
                    mean, lo, hi = forecast_path(y, o, theta, float(r.sigma2), e, h, alpha)
                if r.exp_flag:
                    mean, lo, hi = np.exp(mean), np.exp(lo), np.exp(hi)
                for i in range(h):
                    rec = {k: getattr(r, k) for k in keys}
                    rec.update(h_step=i + 1, forecast=float(mean[i]), lower=float(lo[i]), upper=float(hi[i]))
                    out.append(rec)
            yield pd.DataFrame(out, columns=keys + ["h_step", "forecast", "lower", "upper"])

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema.fields if f.name in keys)
    return j.mapInPandas(run, (kschema + ", " if kschema else "") + "h_step long, forecast double, lower double, upper double")


def residual_frame(packed: DataFrame, models: DataFrame, keys, drop_startup: bool = True, method: str = "css") -> DataFrame:
    """``(keys, t, resid)`` of each chosen model, for Spark-side diagnostics
    (Ljung–Box, Jarque–Bera).  Start-up residuals are conditioned away; with
    ``method`` ``exact`` they are the filter's one-step innovations."""
    keys = _k(keys)
    j = same_keys(packed, models, keys)

    def run(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                o = {f: int(getattr(r, f)) for f in ORDER_FIELDS}
                y = np.asarray(r.y, dtype=float)
                dp = _diff_poly(o["d"], o["sd"], o["s"])
                w = np.convolve(y, dp[::-1], mode="valid") if len(dp) > 1 else y
                if method == "exact":
                    from statlake.operators.statespace import predict
                    e = predict(y, o, r.params, float(r.sigma2), 0)[0]
                    first = len(y) - len(e)
                else:
                    e, start = _residuals(np.asarray(r.params, dtype=float), w, o)
                    first = start + len(dp) - 1
                for i, v in enumerate(e):
                    rec = {k: getattr(r, k) for k in keys}
                    rec.update(t=first + i, resid=float(v))
                    out.append(rec)
            yield pd.DataFrame(out, columns=keys + ["t", "resid"])

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema.fields if f.name in keys)
    return j.mapInPandas(run, (kschema + ", " if kschema else "") + "t long, resid double")


def param_table(models: DataFrame, keys) -> DataFrame:
    """long ``(keys, param, estimate, stderr)`` including σ² (no stderr)."""
    keys = _k(keys)

    def run(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                o = {f: int(getattr(r, f)) for f in ORDER_FIELDS}
                names = param_names(o)
                vals = list(r.params) + [r.sigma2]
                ses = list(r.stderr if r.stderr is not None else []) + [None]
                ses += [None] * (len(vals) - len(ses))
                for nme, v, se in zip(names, vals, ses):
                    rec = {k: getattr(r, k) for k in keys}
                    rec.update(param=nme, estimate=float(v), stderr=None if se is None else float(se))
                    out.append(rec)
            yield pd.DataFrame(out, columns=keys + ["param", "estimate", "stderr"])

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in models.schema.fields if f.name in keys)
    return models.mapInPandas(run, (kschema + ", " if kschema else "") + "param string, estimate double, stderr double")


# ---- F5: Holt-Winters (additive trend, multiplicative season) ----------------------

def _hw_sse(y, alpha, beta, gamma, s):
    n = len(y)
    if n < 2 * s or np.any(y <= 0):
        return np.inf, None
    level = y[:s].mean()
    trend = (y[s:2 * s].mean() - y[:s].mean()) / s
    season = y[:s] / level
    sse = 0.0
    for t in range(n):
        si = season[t % s]
        fc = (level + trend) * si
        err = y[t] - fc
        sse += err * err
        new_level = alpha * y[t] / si + (1 - alpha) * (level + trend)
        trend = beta * (new_level - level) + (1 - beta) * trend
        season[t % s] = gamma * y[t] / new_level + (1 - gamma) * si
        level = new_level
    return sse, (level, trend, season.copy(), n)


def _hw_refine(y, start, s, step=0.05, least=1e-4):
    """Pattern search on the SSE: the best of the steps along each weight,
    the step halved when none is better."""
    best = tuple(float(v) for v in start)
    sse = _hw_sse(y, *best, s)[0]
    while step >= least:
        tries = [tuple(min(max(v + (d if i == j else 0.0), 1e-4), 1 - 1e-4) for j, v in enumerate(best)) for i in range(3) for d in (-step, step)]
        scored = min((_hw_sse(y, *t, s)[0], t) for t in tries)
        if scored[0] < sse:
            sse, best = scored
        else:
            step /= 2
    return best


def holt_winters(packed: DataFrame, keys, s: int = 12, h: int = 10,
                 grid: Sequence[float] = (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9), refine: bool = True) -> DataFrame:
    """Smoothing weights by least SSE: an (α, β, γ) grid that Spark fans out
    as rows gives the start, a pattern search with shrinking steps then
    refines it per series within (0, 1) (``refine``); an h-step forecast
    follows.  ``(keys, alpha, beta, gamma, sse, h_step, forecast)``."""
    keys = _k(keys)
    params = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta"), F.lit(g).alias("gamma"))
                       for a in grid for b in grid for g in grid])
    work = packed.select(*keys, "y", F.explode(params).alias("pr")).select(*keys, "y", "pr.*")
    # every setting of a series is work of its own
    parts = max(1, packed.sparkSession.sparkContext.defaultParallelism * 2)
    work = work.repartition(parts, *keys, "alpha", "beta", "gamma")

    def sse_run(it):
        for pdf in it:
            sse = [(_hw_sse(np.asarray(r.y, float), r.alpha, r.beta, r.gamma, s)[0]) for r in pdf.itertuples(index=False)]
            yield pdf.drop(columns=["y"]).assign(sse=[float(v) if np.isfinite(v) else None for v in sse])

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema.fields if f.name in keys)
    ks = (kschema + ", " if kschema else "")
    scored = work.mapInPandas(sse_run, ks + "alpha double, beta double, gamma double, sse double")
    best = scored.filter(F.col("sse").isNotNull()).groupBy(*keys).agg(
        F.min_by(F.struct("alpha", "beta", "gamma", "sse"), F.struct("sse", "alpha", "beta", "gamma")).alias("b"))
    best = same_keys(best.select(*keys, "b.*"), packed, keys)

    def fc_run(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                y = np.asarray(r.y, float)
                a, b, g = (r.alpha, r.beta, r.gamma) if not refine else _hw_refine(y, (r.alpha, r.beta, r.gamma), s)
                sse, st = _hw_sse(y, a, b, g, s)
                level, trend, season, n = st
                for i in range(1, h + 1):
                    rec = {k: getattr(r, k) for k in keys}
                    rec.update(alpha=a, beta=b, gamma=g, sse=sse, h_step=i,
                               forecast=float((level + i * trend) * season[(n + i - 1) % s]))
                    out.append(rec)
            yield pd.DataFrame(out, columns=keys + ["alpha", "beta", "gamma", "sse", "h_step", "forecast"])

    return best.mapInPandas(fc_run, ks + "alpha double, beta double, gamma double, sse double, h_step long, forecast double")


def sarimax_fit(df: DataFrame, keys, order_col: str, y: str, exog: Sequence[str], o: dict,
                h: int = 0, future: DataFrame | None = None, alpha: float = 0.05) -> DataFrame:
    """regression with SARIMA errors by conditional least squares; the
    exogenous columns are differenced like the target.  One row per series
    with ``params`` (AR, seasonal AR, MA, seasonal MA, exog betas), σ², AIC.

    With ``h`` > 0 also ``forecast``, ``lower`` and ``upper``, arrays of h
    steps at level 1−α (F4).  ``future`` holds the exogenous columns known
    ahead: the first h rows of each series by ``order_col``; a series with
    fewer future rows fails with an error text."""
    keys = _k(keys)
    exog = list(exog)
    if h and future is None:
        raise ValueError("a forecast with exogenous columns needs their future values")
    df = clean_numeric(df.select(*keys, order_col, y, *exog), [y, *exog])
    packed = (df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("ts"), F.col(y).alias("y"),
                                                                         *[F.col(c).alias(c) for c in exog]))).alias("_s")))
    packed = packed.select(*keys, F.col("_s.y").alias("y"), *[F.col(f"_s.{c}").alias(c) for c in exog])
    if h:
        ahead = clean_numeric(future.select(*keys, order_col, *exog), exog).groupBy(*keys).agg(
            F.slice(F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("ts"), *[F.col(c).alias(c) for c in exog]))), 1, h).alias("_f"))
        packed = same_keys(packed, ahead.select(*keys, *[F.col(f"_f.{c}").alias(f"_f_{c}") for c in exog]), keys, "left")

    tail = ["forecast", "lower", "upper"] if h else []

    def run(it):
        for pdf in it:
            out = []
            for _, r in pdf.iterrows():
                rec = {k: r[k] for k in keys}
                try:
                    x = np.column_stack([np.asarray(r[c], float) for c in exog])
                    fit = fit_css(np.asarray(r["y"], float), o, x)
                    rec.update(ok=True, aic=fit["aic"], sigma2=fit["sigma2"], n_eff=fit["n_eff"],
                               params=[float(v) for v in fit["theta"]], names=param_names(o, exog)[:-1], error=None)
                    if h:
                        ahead = [r[f"_f_{c}"] for c in exog]
                        if any(a is None or len(a) < h for a in ahead):
                            raise ValueError("fewer future rows than steps")
                        mean, lo, hi = forecast_path(np.asarray(r["y"], float), o, fit["theta"], fit["sigma2"], fit["resid"], h, alpha,
                                                     x, np.column_stack([np.asarray(a, float) for a in ahead]))
                        rec.update(forecast=mean.tolist(), lower=lo.tolist(), upper=hi.tolist())
                except Exception as ex:  # noqa: BLE001
                    rec.update(ok=False, aic=None, sigma2=None, n_eff=None, params=None, names=None, error=str(ex)[:200])
                    if h:
                        rec.update(forecast=None, lower=None, upper=None)
                out.append(rec)
            yield pd.DataFrame(out, columns=keys + ["ok", "aic", "sigma2", "n_eff", "params", "names", "error"] + tail)

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema.fields if f.name in keys)
    return packed.mapInPandas(run, (kschema + ", " if kschema else "") + (
        "ok boolean, aic double, sigma2 double, n_eff long, params array<double>, names array<string>, error string"
        + "".join(f", {c} array<double>" for c in tail)))
