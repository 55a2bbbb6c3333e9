"""Registered queries: SARIMA order search, forecasts, diagnostics, smoothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators import forecast as fc
from statlake.operators import stats, tstests
from statlake.plans.common import monthly_series, rnd
from statlake.plans.q_series import FILLED_SQL
from statlake.plans.registry import register
from statlake.session import ensure_checkpoint_dir

KEY = ["series_key"]


def _prepared(spark, sf):
    """Monthly totals per priority with the stationarity choice (log, d, D)."""
    s = monthly_series(spark, sf)
    st = tstests.stationarize(s, KEY, "ts", "value").select(
        *KEY, "log_applied", F.col("d").alias("d_fix"), F.col("seasonal_d").alias("sd_fix"))
    packed = fc.pack_series(s, KEY, "ts", "value", log=False)
    # log choice applied per key on the packed arrays (Spark-side transform)
    packed = packed.join(st, KEY).withColumn(
        "y", F.when(F.col("log_applied"), F.transform("y", lambda v: F.log(v))).otherwise(F.col("y")))
    return packed


def _best(spark, sf, reuse: bool = True):
    """Packed series and chosen models; ``reuse`` freezes both (one row per
    series) in the checkpoint folder, so that several consumers of the plan
    don't run the search again."""
    packed = _prepared(spark, sf)
    fits = fc.sarima_grid(packed, KEY, fc.order_grid(), fixed_diff=True)
    best = fc.best_by_aic(fits, KEY)
    if not reuse:
        return packed, best
    ensure_checkpoint_dir(spark)
    return packed, best.checkpoint()


@register("sarima_best_orders")
def sarima_best_orders(spark, sf):
    """F1 + F2: SARIMA(p,d,q)x(P,D,Q,12) search by AIC per priority; d, D
    from the stationarity step, p, q, P, Q in 0..2 (81 fits per series)."""
    _, best = _best(spark, sf, reuse=False)
    return best.select(*KEY, *fc.ORDER_FIELDS, rnd("aic", 4).alias("aic"), "n_eff")


@register("sarima_forecast_orders")
def sarima_forecast_orders(spark, sf):
    """F4 + E8: 10-month forecast with 95 % interval, back on the original scale."""
    packed, best = _best(spark, sf)
    f = fc.forecast(packed.select(*KEY, "y", "log_applied"), best, KEY, h=10, alpha=0.05, exp_back="log_applied")
    return f.select(*KEY, "h_step", rnd("forecast", 2).alias("forecast"), rnd("lower", 2).alias("lower"),
                    rnd("upper", 2).alias("upper"))


@register("sarima_params_orders")
def sarima_params_orders(spark, sf):
    """parameter table of each chosen model with standard errors (incl. σ²)."""
    _, best = _best(spark, sf, reuse=False)
    return fc.param_table(best, KEY).select(*KEY, "param", rnd("estimate", 8).alias("estimate"),
                                            rnd("stderr", 8).alias("stderr"))


@register("sarima_diagnostics_orders")
def sarima_diagnostics_orders(spark, sf):
    """F8: residual Ljung–Box, Jarque–Bera, skewness and kurtosis of each
    chosen model, computed by Spark aggregates over the residual rows."""
    packed, best = _best(spark, sf)
    res = fc.residual_frame(packed.select(*KEY, "y"), best, KEY).checkpoint()
    lb = tstests.ljung_box(res, KEY, "t", "resid")
    jb = stats.jarque_bera(res, "resid", KEY)
    out = best.select(*KEY, *fc.ORDER_FIELDS, "aic").join(lb, KEY).join(
        jb.select(*KEY, "skew", "kurtosis", "jb", F.col("p_value").alias("jb_pvalue")), KEY)
    return out.select(*KEY, *fc.ORDER_FIELDS, rnd("aic", 4).alias("aic"), "n", "lags",
                      rnd("lb_stat", 4).alias("lb_stat"), rnd("lb_pvalue").alias("lb_pvalue"),
                      rnd("jb", 4).alias("jb"), rnd("jb_pvalue").alias("jb_pvalue"),
                      rnd("skew").alias("skew"), rnd("kurtosis").alias("kurtosis"))


@register("arima111_orders")
def arima111_orders(spark, sf):
    """ARIMA(1,1,1) on the raw monthly totals, AIC and parameters."""
    packed = fc.pack_series(monthly_series(spark, sf), KEY, "ts", "value")
    fits = fc.sarima_grid(packed, KEY, fc.order_grid(p=[1], d=[1], q=[1], sp=[0], sd=[0], sq=[0]))
    return fits.select(*KEY, "ok", rnd("aic", 4).alias("aic"),
                       F.transform("params", lambda v: F.round(v, 6)).alias("params"))


HW_GRID = (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)
HW_SQL = f"""
WITH RECURSIVE {FILLED_SQL},
y AS (SELECT series_key, value, row_number() OVER (PARTITION BY series_key ORDER BY ts) - 1 AS t,
             count(*) OVER (PARTITION BY series_key) AS n FROM s),
init AS (SELECT series_key, any_value(n) AS n, avg(value) FILTER (WHERE t < 12) AS l0,
                (avg(value) FILTER (WHERE t >= 12 AND t < 24) - avg(value) FILTER (WHERE t < 12)) / 12 AS b0,
                list(value ORDER BY t) FILTER (WHERE t < 12) AS first12
         FROM y GROUP BY series_key HAVING count(*) >= 24 AND min(value) > 0),
wt AS (SELECT unnest({list(HW_GRID)})::DOUBLE AS v),
p AS (SELECT a.v AS alpha, b.v AS beta, c.v AS gamma FROM wt a, wt b, wt c),
hw(series_key, alpha, beta, gamma, t, lvl, trd, sea, sse) AS (
  SELECT i.series_key, alpha, beta, gamma, 0::BIGINT, l0, b0, list_transform(first12, lambda x: x / l0), 0.0::DOUBLE FROM init i, p
  UNION ALL
  SELECT hw.series_key, alpha, beta, gamma, hw.t + 1,
         alpha * y.value / hw.sea[hw.t % 12 + 1] + (1 - alpha) * (hw.lvl + hw.trd),
         beta * ((alpha * y.value / hw.sea[hw.t % 12 + 1] + (1 - alpha) * (hw.lvl + hw.trd)) - hw.lvl) + (1 - beta) * hw.trd,
         list_transform(range(1, 13), lambda i: CASE WHEN i = hw.t % 12 + 1 THEN
              gamma * y.value / (alpha * y.value / hw.sea[hw.t % 12 + 1] + (1 - alpha) * (hw.lvl + hw.trd))
              + (1 - gamma) * hw.sea[hw.t % 12 + 1] ELSE hw.sea[i] END),
         hw.sse + (y.value - (hw.lvl + hw.trd) * hw.sea[hw.t % 12 + 1]) * (y.value - (hw.lvl + hw.trd) * hw.sea[hw.t % 12 + 1])
  FROM hw JOIN y ON y.series_key = hw.series_key AND y.t = hw.t),
fin AS (SELECT hw.* FROM hw JOIN init USING (series_key) WHERE hw.t = init.n),
best AS (SELECT series_key, min({{'sse': sse, 'a': alpha, 'b': beta, 'g': gamma}}) AS k FROM fin GROUP BY 1),
bs AS (SELECT fin.*, init.n FROM fin JOIN best ON fin.series_key = best.series_key AND fin.alpha = best.k.a
         AND fin.beta = best.k.b AND fin.gamma = best.k.g JOIN init ON init.series_key = fin.series_key)
SELECT series_key, alpha, beta, gamma, h::BIGINT AS h_step, round((lvl + h * trd) * sea[(n + h - 1) % 12 + 1], 2) AS forecast
FROM bs, range(1, 11) r(h)"""


@register("holt_winters_orders", HW_SQL)
def holt_winters_orders(spark, sf):
    """additive-trend, multiplicative-season smoothing (period 12) with
    weights chosen by SSE over a grid; 10-month forecast."""
    packed = fc.pack_series(monthly_series(spark, sf), KEY, "ts", "value")
    hw = fc.holt_winters(packed, KEY, s=12, h=10, grid=HW_GRID, refine=False)
    return hw.select(*KEY, "alpha", "beta", "gamma", "h_step", rnd("forecast", 2).alias("forecast"))


@register("holt_winters_refined_orders")
def holt_winters_refined_orders(spark, sf):
    """F5 with weights optimised per series from the grid's best."""
    packed = fc.pack_series(monthly_series(spark, sf), KEY, "ts", "value")
    hw = fc.holt_winters(packed, KEY, s=12, h=10, grid=HW_GRID)
    return hw.select(*KEY, rnd("alpha", 3).alias("alpha"), rnd("beta", 3).alias("beta"), rnd("gamma", 3).alias("gamma"), "h_step",
                     rnd("forecast", 0).alias("forecast"))


@register("sarimax_forecast_lineitem")
def sarimax_forecast_lineitem(spark, sf):
    """F3 + F4: the last 6 months of log shipped revenue per return flag
    forecast from the months before, with the known mean discount as
    regressor; 80 % band."""
    from pyspark.sql import Window
    from statlake.sources.tables import monthly_lineitem
    m = monthly_lineitem(spark, sf).withColumn("revenue", F.log("revenue"))
    last = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("ts")))  # months of one flag
    m = m.withColumn("_back", last)
    o = dict(p=1, d=1, q=1, sp=0, sd=0, sq=0, s=12)
    f = fc.sarimax_fit(m.filter("_back > 6"), KEY, "ts", "revenue", ["discount"], o, h=6, future=m.filter("_back <= 6"), alpha=0.2)
    step = F.posexplode(F.arrays_zip("forecast", "lower", "upper")).alias("h_step", "f")
    return f.select(*KEY, step).select(*KEY, (F.col("h_step") + 1).alias("h_step"), rnd("f.forecast", 4).alias("forecast"),
                                       rnd("f.lower", 4).alias("lower"), rnd("f.upper", 4).alias("upper"))


@register("stl_orders")
def stl_orders(spark, sf):
    """Robust STL (period 12) of monthly order totals per priority."""
    s = tstests.stl(monthly_series(spark, sf), KEY, "ts", "value", 12)
    return s.select(*KEY, F.date_format("ts", "yyyy-MM-dd").alias("ts"), rnd("value", 2).alias("value"),
                    rnd("seasonal", 2).alias("seasonal"), rnd("trend", 2).alias("trend"), rnd("resid", 2).alias("resid"))


HP_SQL = f"""
WITH RECURSIVE {FILLED_SQL},
v AS (SELECT series_key, ts, value, row_number() OVER o - 1 AS i, count(*) OVER (PARTITION BY series_key) AS n
      FROM s WINDOW o AS (PARTITION BY series_key ORDER BY ts)),
a AS (SELECT series_key, value::DOUBLE AS value, i,
        1 + 129600.0::DOUBLE * ((i <= n - 3)::INT + 4 * (i - 1 BETWEEN 0 AND n - 3)::INT + (i - 2 BETWEEN 0 AND n - 3)::INT) AS a0,
        -2 * 129600.0::DOUBLE * ((i <= n - 3)::INT + (i - 1 BETWEEN 0 AND n - 3)::INT) AS a1,
        129600.0::DOUBLE * (i <= n - 3)::INT AS a2 FROM v),
f(series_key, i, d, p, q, z, d1, q1, z1) AS (
  SELECT series_key, i, a0, a1 / a0, a2 / a0, value, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM a WHERE i = 0
  UNION ALL
  SELECT series_key, i, dd, (a1 - q * p * d) / dd, a2 / dd, value - p * z - q1 * z1, d, q, z FROM (
    SELECT a.series_key, a.i, a.a0 - f.p * f.p * f.d - f.q1 * f.q1 * f.d1 AS dd, a.a1, a.a2, a.value, f.p, f.q, f.d, f.z, f.q1, f.z1
    FROM f JOIN a ON a.series_key = f.series_key AND a.i = f.i + 1)),
b(series_key, i, x, x1) AS (
  SELECT f.series_key, f.i, f.z / f.d, 0.0::DOUBLE FROM f JOIN v ON v.series_key = f.series_key AND v.i = f.i AND v.i = v.n - 1
  UNION ALL
  SELECT f.series_key, f.i, f.z / f.d - f.p * b.x - f.q * b.x1, b.x FROM b JOIN f ON f.series_key = b.series_key AND f.i = b.i - 1)
SELECT v.series_key, strftime(v.ts, '%Y-%m-%d') AS ts, round(b.x, 1) AS trend, round(v.value - b.x, 1) AS cycle
FROM v JOIN b ON b.series_key = v.series_key AND b.i = v.i"""


@register("hp_filter_orders", HP_SQL)
def hp_filter_orders(spark, sf):
    """Hodrick–Prescott trend/cycle (λ = 129600, monthly) per priority."""
    s = tstests.hp_filter(monthly_series(spark, sf), KEY, "ts", "value", 129600.0)
    return s.select(*KEY, F.date_format("ts", "yyyy-MM-dd").alias("ts"), rnd("trend", 1).alias("trend"),
                    rnd("cycle", 1).alias("cycle"))


@register("sarimax_lineitem")
def sarimax_lineitem(spark, sf):
    """SARIMAX(1,1,1)x(1,1,1,12) of log monthly shipped revenue with the
    monthly mean discount as exogenous regressor, per return flag."""
    from statlake.sources.tables import monthly_lineitem
    m = monthly_lineitem(spark, sf).withColumn("revenue", F.log("revenue"))
    o = dict(p=1, d=1, q=1, sp=1, sd=1, sq=1, s=12)
    f = fc.sarimax_fit(m, KEY, "ts", "revenue", ["discount"], o)
    return f.select(*KEY, "ok", rnd("aic", 4).alias("aic"), "n_eff", "names",
                    F.transform("params", lambda v: F.round(v, 6)).alias("params"))


@register("sarima_search_orders")
def sarima_search_orders(spark, sf):
    """F2 as the reference runs it: all 486 orders (p,q,P,Q ∈ 0..2,
    d ∈ 0..2, D ∈ 0..1, s = 12) on the log series, lowest AIC per priority,
    with the number of successful fits."""
    packed = _prepared(spark, sf)
    fits = fc.sarima_grid(packed.select(*KEY, "y"), KEY, fc.order_grid())
    # one aggregate: the best successful fit and the counts
    order = F.when(F.col("ok"), F.struct("aic", *fc.ORDER_FIELDS))
    out = fits.groupBy(*KEY).agg(F.min_by(F.struct(*fc.ORDER_FIELDS, "aic"), order).alias("b"), F.count(F.lit(1)).alias("fits"),
                                 F.sum(F.col("ok").cast("long")).alias("fits_ok")).filter("fits_ok > 0")
    return out.select(*KEY, "b.*", "fits", "fits_ok").withColumn("aic", rnd("aic", 4))


@register("sarima_exact_orders")
def sarima_exact_orders(spark, sf):
    """F1 + F2 + F4 by exact likelihood: the lowest-AIC order of p, q, P, Q in
    0..1 per priority (d, D from the stationarity step) and its 10-month
    forecast from the filter's state."""
    packed = _prepared(spark, sf)
    fits = fc.sarima_grid(packed, KEY, fc.order_grid(p=range(2), q=range(2), sp=range(2), sq=range(2)), fixed_diff=True, method="exact")
    ensure_checkpoint_dir(spark)
    best = fc.best_by_aic(fits, KEY).checkpoint()
    f = fc.forecast(packed.select(*KEY, "y", "log_applied"), best, KEY, h=10, exp_back="log_applied", method="exact")
    return best.select(*KEY, *fc.ORDER_FIELDS, rnd("aic", 2).alias("aic"), "n_eff").join(
        f.select(*KEY, "h_step", rnd("forecast", 0).alias("forecast"), rnd("lower", 0).alias("lower"), rnd("upper", 0).alias("upper")), KEY)


@register("arima111_exact_orders")
def arima111_exact_orders(spark, sf):
    """F6 by exact likelihood: ARIMA(1,1,1) of the log monthly totals from the
    stationary start."""
    packed = fc.pack_series(monthly_series(spark, sf), KEY, "ts", "value", log=True)
    fits = fc.sarima_grid(packed, KEY, fc.order_grid(p=[1], d=[1], q=[1], sp=[0], sd=[0], sq=[0]), method="stationary")
    return fits.select(*KEY, "ok", rnd("aic", 3).alias("aic"), "n_eff", F.transform("params", lambda v: F.round(v, 3)).alias("params"))


ARMA_GRID = [round(-0.9 + 0.3 * i, 1) for i in range(7)]
LIKELIHOOD_SQL = f"""
WITH RECURSIVE {FILLED_SQL},
l AS (SELECT series_key, ts, ln(value) AS v FROM s),
w AS (SELECT series_key, v - lag(v) OVER o AS w, row_number() OVER o - 1 AS t, count(*) OVER (PARTITION BY series_key) - 1 AS n
      FROM l WINDOW o AS (PARTITION BY series_key ORDER BY ts)),
steps AS (SELECT unnest({ARMA_GRID})::DOUBLE AS v),
p AS (SELECT a.v AS ar, b.v AS ma FROM steps a, steps b),
k(series_key, ar, ma, t, n, w, ahead, r, ss, ld) AS (
  SELECT series_key, ar, ma, t, n, w, 0.0::DOUBLE, (1 + 2 * ar * ma + ma * ma) / (1 - ar * ar),
         w * w * (1 - ar * ar) / (1 + 2 * ar * ma + ma * ma), ln((1 + 2 * ar * ma + ma * ma) / (1 - ar * ar))
  FROM w, p WHERE t = 1
  UNION ALL
  SELECT series_key, ar, ma, t, n, w, ahead, r, ss + (w - ahead) * (w - ahead) / r, ld + ln(r) FROM (
    SELECT k.series_key, k.ar, k.ma, w.t, w.n, w.w, k.ar * k.w + k.ma / k.r * (k.w - k.ahead) AS ahead,
           1 + k.ma * k.ma - k.ma * k.ma / k.r AS r, k.ss, k.ld
    FROM k JOIN w ON w.series_key = k.series_key AND w.t = k.t + 1)),
e AS (SELECT series_key, ar, ma, ss / n AS s2, -n / 2.0 * (ln(2 * pi() * ss / n) + 1) - ld / 2 AS llf FROM k WHERE t = n)
SELECT series_key, ar, ma, round(llf, 6) AS llf, round(s2, 9) AS sigma2, round(6 - 2 * llf, 6) AS aic FROM e"""


@register("arima111_likelihood_orders", LIKELIHOOD_SQL)
def arima111_likelihood_orders(spark, sf):
    """exact likelihood of ARIMA(1,1,1) of the log monthly totals over a
    grid of coefficients, the variance at its maximum."""
    packed = fc.pack_series(monthly_series(spark, sf), KEY, "ts", "value", log=True)
    o = dict(p=1, d=1, q=1, sp=0, sd=0, sq=0, s=12)
    f = fc.likelihood_grid(packed, KEY, o, [(a, b) for a in ARMA_GRID for b in ARMA_GRID])
    return f.select(*KEY, F.col("params")[0].alias("ar"), F.col("params")[1].alias("ma"), rnd("llf").alias("llf"),
                    rnd("sigma2", 9).alias("sigma2"), rnd("aic").alias("aic"))
