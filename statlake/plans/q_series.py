"""Registered queries: windows, time-series tests and decomposition."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators import tstests, windows
from statlake.plans.common import monthly_series, rnd
from statlake.plans.registry import register
from statlake.sources.tables import daily_events, embedding_points, monthly_lineitem, monthly_order_totals, table

MONTHLY_SQL = """s AS (SELECT o_orderpriority AS series_key, date_trunc('month', o_orderdate)::DATE AS ts,
                       sum(o_totalprice) AS value FROM orders GROUP BY 1, 2)"""


FILLED_SQL = MONTHLY_SQL.replace("s AS", "s0 AS", 1) + """,
g AS (SELECT series_key, unnest(generate_series(min(ts)::TIMESTAMP, max(ts)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS ts
      FROM s0 GROUP BY 1),
r AS (SELECT g.series_key, g.ts, s0.value, row_number() OVER (PARTITION BY g.series_key ORDER BY g.ts) - 1 AS pos
      FROM g LEFT JOIN s0 USING (series_key, ts)),
i AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
            last_value(value IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
            first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
            first_value(value IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
      FROM r),
s AS (SELECT series_key, ts, coalesce(value, CASE WHEN pv IS NOT NULL AND nv IS NOT NULL THEN
          CASE WHEN np = pp THEN pv ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END END, pv, nv) AS value FROM i)"""  # the same on the full month grid, gaps interpolated


def _ds(c="ts"):
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


def monthly_clean(spark, sf):
    s = monthly_order_totals(spark, sf)
    s = windows.regularize_monthly(s, ["series_key"], "ts", "value")
    return windows.interpolate_linear(s, ["series_key"], "ts", "value")


@register("monthly_windows_orders", f"""
WITH {MONTHLY_SQL},
g AS (SELECT series_key, unnest(generate_series(min(ts)::TIMESTAMP, max(ts)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS ts
      FROM s GROUP BY 1),
r AS (SELECT g.series_key, g.ts, s.value, row_number() OVER (PARTITION BY g.series_key ORDER BY g.ts) - 1 AS pos
      FROM g LEFT JOIN s USING (series_key, ts)),
i AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
            last_value(value IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
            first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
            first_value(value IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
      FROM r),
f AS (SELECT series_key, ts, coalesce(value, CASE WHEN pv IS NOT NULL AND nv IS NOT NULL THEN
          CASE WHEN np = pp THEN pv ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END END, pv, nv) AS value FROM i),
w AS (SELECT series_key, ts, value,
        value - lag(value, 1) OVER o AS d1, value - lag(value, 2) OVER o AS d2lag, value - lag(value, 12) OVER o AS d12,
        1.0*value + -2.0*lag(value, 1) OVER o + 1.0*lag(value, 2) OVER o AS dd2,
        avg(value) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING) AS rm12,
        lag(value, 1) OVER o AS lag1, lag(value, 3) OVER o AS lag3
      FROM f WINDOW o AS (PARTITION BY series_key ORDER BY ts))
SELECT series_key, strftime(ts, '%Y-%m-%d') AS ts, round(value, 5) AS value, round(d1, 5) AS d1, round(d2lag, 5) AS d2lag,
       round(d12, 5) AS d12, round(dd2, 5) AS dd2, round(rm12, 5) AS rm12, round(lag1, 5) AS lag1, round(lag3, 5) AS lag3 FROM w""")
def monthly_windows_orders(spark, sf):
    """W1–W6, W12 on monthly order totals per priority: month grid, linear
    gap fill, lag-1/lag-2/lag-12 differences, true 2nd difference, centred
    12-month mean and a lag matrix."""
    k = ["series_key"]
    s = monthly_clean(spark, sf)
    s = windows.lag_diff(s, k, "ts", "value", 1, "d1")
    s = windows.lag_diff(s, k, "ts", "value", 2, "d2lag")
    s = windows.lag_diff(s, k, "ts", "value", 12, "d12")
    s = windows.diff_order(s, k, "ts", "value", 2, out="dd2")
    s = windows.rolling_mean_centered(s, k, "ts", "value", 12, "rm12")
    s = windows.lag_matrix(s, k, "ts", "value", 3)
    # gap-filled months are cents/k; 5 places avoid rounding ties for short gaps
    return s.select("series_key", _ds(), *[rnd(c, 5).alias(c)
                                           for c in ["value", "d1", "d2lag", "d12", "dd2", "rm12", "lag1", "lag3"]])


@register("long_windows_events", """
WITH e AS (SELECT event_id, ts, value, CASE WHEN event_type <> 'click' THEN value END AS gap,
             row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events),
i AS (SELECT *, last_value(CASE WHEN gap IS NOT NULL THEN pos END IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
        last_value(gap IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
        first_value(CASE WHEN gap IS NOT NULL THEN pos END IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
        first_value(gap IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv FROM e)
SELECT event_id, pos::BIGINT AS pos, round(value - lag(value, 1) OVER o, 6) AS d1, round(value - lag(value, 12) OVER o, 6) AS d12,
       round(value - 2*lag(value, 1) OVER o + lag(value, 2) OVER o, 6) AS dd2,
       round(avg(value) OVER (ORDER BY pos ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING), 6) AS rm12, round(lag(value, 3) OVER o, 6) AS lag3,
       round(coalesce(gap, CASE WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * (pos - pp) / (np - pp) END, pv, nv), 6) AS filled
FROM i WINDOW o AS (ORDER BY pos)""")
def long_windows_events(spark, sf):
    """W1–W4, W6, W12 on all events as one series without a key: chunks with
    halo rows, no task holds the series; clicks' values are filled in."""
    e = table(spark, sf, "events").select("event_id", "ts", "value", F.when(F.col("event_type") != "click", F.col("value")).alias("gap"))
    s = windows.positions(e, None, ["ts", "event_id"], "pos")
    s = windows.lag_diff(s, None, "pos", "value", 1, "d1", places=True)
    s = windows.lag_diff(s, None, "pos", "value", 12, "d12", places=True)
    s = windows.diff_order(s, None, "pos", "value", 2, out="dd2", places=True)
    s = windows.rolling_mean_centered(s, None, "pos", "value", 12, "rm12", places=True)
    s = windows.lag_matrix(s, None, "pos", "value", 3, places=True)
    s = windows.interpolate_linear(s, None, "pos", "gap", "filled", places=True)
    return s.select("event_id", "pos", *[rnd(c).alias(c) for c in ("d1", "d12", "dd2", "rm12", "lag3", "filled")])


@register("long_acf_events", """
WITH e AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS t, value - avg(value) OVER () AS c FROM events WHERE value IS NOT NULL),
p AS (SELECT l.lag, sum(a.c * b.c) AS s FROM e a CROSS JOIN (SELECT unnest(range(0, 25)) AS lag) l JOIN e b ON b.t = a.t - l.lag GROUP BY 1)
SELECT lag::BIGINT AS lag, round(s / (SELECT s FROM p WHERE lag = 0), 6) AS acf FROM p""")
def long_acf_events(spark, sf):
    """Autocorrelation of all events as one series without a key, lags 0 to 24."""
    e = windows.positions(table(spark, sf, "events").filter(F.col("value").isNotNull()).select("event_id", "ts", "value"),
                          None, ["ts", "event_id"], "pos")
    return tstests.acf(e, None, "pos", "value", 24).select("lag", rnd("acf").alias("acf"))


ACF_SQL = f"""
WITH {FILLED_SQL},
p AS (SELECT series_key, row_number() OVER (PARTITION BY series_key ORDER BY ts) - 1 AS t,
             value - avg(value) OVER (PARTITION BY series_key) AS c, count(*) OVER (PARTITION BY series_key) AS n FROM s),
lags AS (SELECT unnest(range(0, 37)) AS lag),
pr AS (SELECT a.series_key, l.lag, any_value(a.n) AS n, sum(a.c * b.c) AS sc
       FROM p a CROSS JOIN lags l JOIN p b ON b.series_key = a.series_key AND b.t = a.t - l.lag GROUP BY 1, 2),
z AS (SELECT series_key, sc AS s0 FROM pr WHERE lag = 0),
a AS (SELECT pr.series_key, lag, n, CASE WHEN lag = 0 THEN 1.0 ELSE sc / s0 END AS acf FROM pr JOIN z USING (series_key)
      WHERE lag <= least(36, greatest(10, n - 1)))"""


@register("acf_orders", ACF_SQL + """
SELECT series_key, lag::BIGINT AS lag, round(acf, 6) AS acf FROM a""")
def acf_orders(spark, sf):
    """Biased autocorrelation, lags 0..min(36, max(10, n−1)) per priority."""
    a = tstests.acf(monthly_series(spark, sf), ["series_key"], "ts", "value")
    return a.select("series_key", "lag", rnd("acf").alias("acf"))


@register("ljung_box_orders", ACF_SQL + """
SELECT series_key, any_value(n)::BIGINT AS n, max(lag)::BIGINT AS lags, round(any_value(n)*(any_value(n)+2)*sum(acf*acf/(n-lag)), 6) AS lb_stat
FROM a WHERE lag >= 1 AND lag <= least(24, greatest(10, n // 5)) GROUP BY series_key""")
def ljung_box_orders(spark, sf):
    """T5: Ljung–Box Q with the lag rule min(24, max(10, n//5))."""
    q = tstests.ljung_box(monthly_series(spark, sf), ["series_key"], "ts", "value")
    return q.select("series_key", F.col("n").cast("long").alias("n"), F.col("lags").cast("long").alias("lags"),
                    rnd("lb_stat").alias("lb_stat"))


@register("pacf_orders", ACF_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """,
l AS (SELECT series_key, list(acf ORDER BY lag) AS r, max(lag) AS kmax FROM a GROUP BY series_key),
dl(series_key, k, phi) AS (
  SELECT series_key, 1, [r[2]] FROM l
  UNION ALL
  SELECT dl.series_key, dl.k + 1,
         list_append(list_transform(range(1, dl.k + 1),
                       lambda j: dl.phi[j] - ((l.r[dl.k + 2] - list_sum(list_transform(range(1, dl.k + 1), lambda i: dl.phi[i] * l.r[dl.k + 2 - i])))
                                              / (1.0 - list_sum(list_transform(range(1, dl.k + 1), lambda i: dl.phi[i] * l.r[i + 1])))) * dl.phi[dl.k + 1 - j]),
                     (l.r[dl.k + 2] - list_sum(list_transform(range(1, dl.k + 1), lambda i: dl.phi[i] * l.r[dl.k + 2 - i])))
                       / (1.0 - list_sum(list_transform(range(1, dl.k + 1), lambda i: dl.phi[i] * l.r[i + 1]))))
  FROM dl JOIN l USING (series_key) WHERE dl.k < l.kmax)
SELECT series_key, k::BIGINT AS lag, round(phi[k], 6) AS pacf FROM dl
UNION ALL SELECT series_key, 0::BIGINT, 1.0 FROM l""")
def pacf_orders(spark, sf):
    """T4: Yule–Walker PACF (Durbin–Levinson) per priority."""
    a = tstests.acf(monthly_series(spark, sf), ["series_key"], "ts", "value")
    p = tstests.pacf_yw(a, ["series_key"])
    return p.select("series_key", "lag", rnd("pacf").alias("pacf"))


@register("adf_orders")
def adf_orders(spark, sf):
    """ADF (constant, AIC lag) per priority."""
    a = tstests.adf(monthly_series(spark, sf), ["series_key"], "ts", "value")
    return a.select("series_key", rnd("adf_stat").alias("adf_stat"), rnd("p_value").alias("p_value"),
                    "used_lag", "nobs", rnd("crit_5").alias("crit_5"), "is_stationary")


def _adf_sql(given: str) -> str:
    """ADF with 0 and 1 lags of the series ``y(series_key, t, v)``."""
    return given + """,
d AS (SELECT series_key, t, lag(v) OVER o AS l, v - lag(v) OVER o AS dy FROM y WINDOW o AS (PARTITION BY series_key ORDER BY t)),
e AS (SELECT *, lag(dy) OVER (PARTITION BY series_key ORDER BY t) AS d1 FROM d),
z AS (SELECT series_key, 0 AS lag, l, dy, 0.0::DOUBLE AS d1 FROM e WHERE dy IS NOT NULL
      UNION ALL SELECT series_key, 1, l, dy, d1 FROM e WHERE d1 IS NOT NULL),
m AS (SELECT series_key, lag, count(*) AS n, var_pop(l) AS ll, var_pop(dy) AS yy, covar_pop(l, dy) AS ly,
             var_pop(d1) AS dd, covar_pop(l, d1) AS ld, covar_pop(d1, dy) AS dy1 FROM z GROUP BY 1, 2),
q AS (SELECT series_key, lag, n, ll - CASE WHEN lag = 1 THEN ld * ld / dd ELSE 0 END AS a,
             ly - CASE WHEN lag = 1 THEN ld * dy1 / dd ELSE 0 END AS b, yy - CASE WHEN lag = 1 THEN dy1 * dy1 / dd ELSE 0 END AS c FROM m)
SELECT series_key, lag::BIGINT AS used_lag, n::BIGINT AS nobs, round(b / a / sqrt((c - b * b / a) * n / (n - 2 - lag) / n / a), 6) AS adf_stat,
       round(-2.86154 - 2.8903 / n - 4.234 / (n * n) - 40.040 / (n * n * n), 6) AS crit_5 FROM q"""


def _adf_two(df, keys, order, value):
    both = None
    for lag in (0, 1):
        a = tstests.adf(df, keys, order, value, lags=lag)
        both = a if both is None else both.unionByName(a)
    return both


@register("adf_fixed_orders", _adf_sql(f"WITH {FILLED_SQL}, y AS (SELECT series_key, ts AS t, value AS v FROM s)"))
def adf_fixed_orders(spark, sf):
    """T1 at 0 and 1 lags per priority."""
    a = _adf_two(monthly_series(spark, sf), ["series_key"], "ts", "value")
    return a.select("series_key", "used_lag", "nobs", rnd("adf_stat").alias("adf_stat"), rnd("crit_5").alias("crit_5"))


@register("long_adf_events", _adf_sql("WITH y AS (SELECT 'events' AS series_key, event_id AS t, value AS v FROM events WHERE value IS NOT NULL)"))
def long_adf_events(spark, sf):
    """T1 at 0 and 1 lags of the whole event table as one series, in chunks."""
    a = _adf_two(table(spark, sf, "events").select("event_id", "value"), [], "event_id", "value")
    return a.select(F.lit("events").alias("series_key"), "used_lag", "nobs", rnd("adf_stat").alias("adf_stat"), rnd("crit_5").alias("crit_5"))


@register("stationarize_orders")
def stationarize_orders(spark, sf):
    """Log / d / D choice by ADF p per priority."""
    s = tstests.stationarize(monthly_series(spark, sf), ["series_key"], "ts", "value")
    return s.select("series_key", "log_applied", "d", "seasonal_d", rnd("adf_p_raw").alias("adf_p_raw"),
                    rnd("adf_p_after").alias("adf_p_after"))


@register("decompose_orders", f"""
WITH {FILLED_SQL},
p AS (SELECT series_key, ts, value, row_number() OVER o - 1 AS t, count(*) OVER (PARTITION BY series_key) AS n,
        CASE WHEN count(value) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13 THEN
          (0.5*lag(value, 6) OVER o + lag(value, 5) OVER o + lag(value, 4) OVER o + lag(value, 3) OVER o
           + lag(value, 2) OVER o + lag(value, 1) OVER o + value + lead(value, 1) OVER o + lead(value, 2) OVER o
           + lead(value, 3) OVER o + lead(value, 4) OVER o + lead(value, 5) OVER o + 0.5*lead(value, 6) OVER o) / 12.0 END AS ma
      FROM s WINDOW o AS (PARTITION BY series_key ORDER BY ts)),
f AS (SELECT series_key,
        regr_slope(CASE WHEN t < 18 THEN ma END, CASE WHEN t < 18 THEN t END) AS b0,
        regr_intercept(CASE WHEN t < 18 THEN ma END, CASE WHEN t < 18 THEN t END) AS a0,
        regr_slope(CASE WHEN t >= n - 19 AND t < n - 7 THEN ma END, CASE WHEN t >= n - 19 AND t < n - 7 THEN t END) AS b1,
        regr_intercept(CASE WHEN t >= n - 19 AND t < n - 7 THEN ma END, CASE WHEN t >= n - 19 AND t < n - 7 THEN t END) AS a1
      FROM p WHERE ma IS NOT NULL GROUP BY 1),
tr AS (SELECT p.*, coalesce(ma, CASE WHEN t < 6 THEN a0 + b0*t ELSE a1 + b1*t END) AS trend, t % 12 AS phase
       FROM p JOIN f USING (series_key)),
ph AS (SELECT series_key, phase, avg(value - trend) AS pm FROM tr GROUP BY 1, 2),
phc AS (SELECT series_key, phase, pm - avg(pm) OVER (PARTITION BY series_key) AS seasonal FROM ph)
SELECT series_key, strftime(ts, '%Y-%m-%d') AS ts, round(value, 5) AS value, round(trend, 5) AS trend,
       round(seasonal, 5) AS seasonal, round(value - trend - seasonal, 5) AS resid
FROM tr JOIN phc USING (series_key, phase)""")
def decompose_orders(spark, sf):
    """Additive decomposition (period 12, trend ends extrapolated)."""
    d = tstests.seasonal_decompose(monthly_series(spark, sf), ["series_key"], "ts", "value", 12)
    # filled months are fractions of cents: 5 decimals keep clear of rounding ties
    return d.select("series_key", _ds(), *[rnd(c, 5).alias(c) for c in ["value", "trend", "seasonal", "resid"]])


GRANGER_SQL = """
WITH m AS (SELECT l_returnflag AS k, date_trunc('month', l_shipdate)::DATE AS ts, sum(l_extendedprice) AS y,
                  avg(l_discount) AS x FROM lineitem GROUP BY 1, 2),
d AS (SELECT k, ts, y - lag(y) OVER o AS y, x - lag(x) OVER o AS x FROM m WINDOW o AS (PARTITION BY k ORDER BY ts)),
e AS (SELECT k, ts, y, lag(y) OVER o AS y1, lag(x) OVER o AS x1 FROM d WHERE y IS NOT NULL
      WINDOW o AS (PARTITION BY k ORDER BY ts)),
c AS (SELECT * FROM e WHERE y1 IS NOT NULL),
mm AS (SELECT k, count(*) AS n, avg(y) AS my, avg(y1) AS m1, avg(x1) AS m2 FROM c GROUP BY k),
s AS (SELECT k, any_value(n) AS n, sum((y1-m1)*(y1-m1)) AS s11, sum((x1-m2)*(x1-m2)) AS s22, sum((y1-m1)*(x1-m2)) AS s12,
             sum((y1-m1)*(y-my)) AS s1y, sum((x1-m2)*(y-my)) AS s2y, sum((y-my)*(y-my)) AS syy
      FROM c JOIN mm USING (k) GROUP BY k),
r AS (SELECT k, n, syy - s1y*s1y/s11 AS ssr_r,
             syy - ((s22*s1y - s12*s2y)*s1y + (s11*s2y - s12*s1y)*s2y)/(s11*s22 - s12*s12) AS ssr_u FROM s)
SELECT k AS series_key, 1::BIGINT AS lag, n::BIGINT AS nobs, round((ssr_r - ssr_u) / (ssr_u / (n - 3)), 4) AS ssr_f,
       round(n * (ssr_r - ssr_u) / ssr_u, 4) AS ssr_chi2, round(n * ln(ssr_r / ssr_u), 4) AS lr FROM r"""


@register("granger_l1_lineitem", GRANGER_SQL)
def granger_l1_lineitem(spark, sf):
    """T9 at lag 1: does monthly mean discount help predict monthly revenue
    (first differences) per return flag?  F, χ² and LR statistics."""
    m = monthly_lineitem(spark, sf)
    g = tstests.granger(m, ["series_key"], "ts", "revenue", "discount", maxlag=1)
    return g.select("series_key", "lag", "nobs", rnd("ssr_f", 4).alias("ssr_f"),
                    rnd("ssr_chi2", 4).alias("ssr_chi2"), rnd("lr", 4).alias("lr"))


GRANGER_LAGS_SQL = """
WITH RECURSIVE m AS (SELECT l_returnflag AS k, date_trunc('month', l_shipdate)::DATE AS ts, sum(l_extendedprice) AS y,
                            avg(l_discount) AS x FROM lineitem GROUP BY 1, 2),
d AS (SELECT k, ts, y - lag(y) OVER o AS y, x - lag(x) OVER o AS x FROM m WINDOW o AS (PARTITION BY k ORDER BY ts)),
e AS (SELECT k, row_number() OVER o - 1 AS t, y::DOUBLE AS y,
             [lag(y, 1) OVER o, lag(y, 2) OVER o, lag(y, 3) OVER o, lag(y, 4) OVER o, lag(y, 5) OVER o, lag(y, 6) OVER o]::DOUBLE[] AS ly,
             [lag(x, 1) OVER o, lag(x, 2) OVER o, lag(x, 3) OVER o, lag(x, 4) OVER o, lag(x, 5) OVER o, lag(x, 6) OVER o]::DOUBLE[] AS lx
      FROM d WHERE y IS NOT NULL WINDOW o AS (PARTITION BY k ORDER BY ts)),
z AS (SELECT k, h AS lag, t, list_concat(ly[1:h], lx[1:h], [y]) AS z FROM e, range(1, 7) r(h) WHERE t >= h),
c AS (SELECT k, lag, t, unnest(z) AS v, unnest(range(1, len(z) + 1)) AS i FROM z),
g AS (SELECT a.k, a.lag, a.i, b.i AS j, count(*) AS n, corr(a.v, b.v) AS r FROM c a JOIN c b USING (k, lag, t) GROUP BY ALL),
w AS (SELECT k, lag, i, any_value(n) AS n, list(r ORDER BY j) AS r FROM g GROUP BY ALL),
s(k, lag, n, p, r) AS (
  SELECT k, lag, any_value(n), 0, list(r ORDER BY i) FROM w GROUP BY ALL
  UNION ALL
  SELECT k, lag, n, p + 1, list_transform(r, lambda a: list_transform(range(1, len(r) + 1), lambda j: a[j] - a[p + 1] * r[p + 1][j] / r[p + 1][p + 1]))
  FROM s WHERE p < 2 * lag),
f AS (SELECT k, lag, any_value(n) AS n, max(r[2 * lag + 1][2 * lag + 1]) FILTER (WHERE p = lag) AS ssr_r,
             max(r[2 * lag + 1][2 * lag + 1]) FILTER (WHERE p = 2 * lag) AS ssr_u FROM s GROUP BY ALL)
SELECT k AS series_key, lag, n AS nobs, round((ssr_r - ssr_u) / lag / (ssr_u / (n - 2 * lag - 1)), 4) AS ssr_f,
       round(n * (ssr_r - ssr_u) / ssr_u, 4) AS ssr_chi2, round(n * ln(ssr_r / ssr_u), 4) AS lr FROM f"""


@register("granger_lags_lineitem", GRANGER_LAGS_SQL)
def granger_lags_lineitem(spark, sf):
    """T9 for lags 1..6: F, χ² and LR statistics."""
    g = tstests.granger(monthly_lineitem(spark, sf), ["series_key"], "ts", "revenue", "discount", maxlag=6)
    return g.select("series_key", "lag", "nobs", rnd("ssr_f", 4).alias("ssr_f"), rnd("ssr_chi2", 4).alias("ssr_chi2"), rnd("lr", 4).alias("lr"))


@register("granger_lineitem")
def granger_lineitem(spark, sf):
    """T9 for lags 1..6 with F and χ² p-values."""
    m = monthly_lineitem(spark, sf)
    g = tstests.granger(m, ["series_key"], "ts", "revenue", "discount", maxlag=6)
    return g.select("series_key", "lag", "nobs", rnd("ssr_f", 4).alias("ssr_f"), rnd("ssr_f_p").alias("ssr_f_p"),
                    rnd("ssr_chi2_p").alias("ssr_chi2_p"), rnd("lr_p").alias("lr_p"))


@register("running_best_events", """
WITH d AS (SELECT event_type AS series_key, ts::DATE AS ts, sum(value) AS value FROM events GROUP BY 1, 2)
SELECT series_key, strftime(ts, '%Y-%m-%d') AS ts, round(value, 4) AS value,
       round(max(value) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS best_value,
       round(min(value) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS worst_value
FROM d""")
def running_best_events(spark, sf):
    """Best-so-far (max and min) of the daily event value per type."""
    d = daily_events(spark, sf)
    d = windows.running_best(d, ["series_key"], "ts", "value", "max", "best_value")
    d = windows.running_best(d, ["series_key"], "ts", "value", "min", "worst_value")
    return d.select("series_key", _ds(), rnd("value", 4).alias("value"), rnd("best_value", 4).alias("best_value"),
                    rnd("worst_value", 4).alias("worst_value"))


@register("cumulative_share_orders", """
SELECT o_orderkey, o_orderpriority,
  round(coalesce(sum(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        / sum(o_totalprice) OVER (PARTITION BY o_orderpriority), 6) AS cum_lo,
  round(sum(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        / sum(o_totalprice) OVER (PARTITION BY o_orderpriority), 6) AS cum_hi
FROM orders""")
def cumulative_share_orders(spark, sf):
    """Cumulative revenue share of each order within its priority, in
    date order — distributed prefix sums (bucketed offsets, no one-task window)."""
    from statlake.operators.ranks import cumulative_share
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    c = cumulative_share(o, "o_totalprice", ["o_orderdate", "o_orderkey"], ["o_orderpriority"])
    return c.select("o_orderkey", "o_orderpriority", rnd("cum_lo").alias("cum_lo"), rnd("cum_hi").alias("cum_hi"))


@register("path_length_embeddings", """
WITH p AS (SELECT label AS grp, vec_id, embedding::DOUBLE[] AS e, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos, count(*) OVER (PARTITION BY label) AS m
           FROM embeddings)
SELECT a.grp, round(sum(list_distance(a.e, b.e)), 6) AS length, count(*)::BIGINT AS legs
FROM p a JOIN p b ON a.grp = b.grp AND b.pos = (a.pos + 1) % a.m GROUP BY a.grp""")
def path_length_embeddings(spark, sf):
    """Closed tour length through each label's points in id order
    (all embedding dimensions)."""
    p = embedding_points(spark, sf, 64)
    out = windows.path_length(p, "grp", "id", [f"x{i}" for i in range(64)])
    return out.select("grp", rnd("length").alias("length"), F.col("legs").cast("long").alias("legs"))


@register("future_months_orders", f"""
WITH {MONTHLY_SQL}
SELECT series_key, h::BIGINT AS h_step, strftime(max_ts + to_months(h::INTEGER), '%Y-%m-%d') AS ts
FROM (SELECT series_key, max(ts) AS max_ts FROM s GROUP BY 1), range(1, 11) t(h)""")
def future_months_orders(spark, sf):
    """The next 10 month starts after each priority's last month."""
    f = windows.future_months(monthly_order_totals(spark, sf), ["series_key"], "ts", 10)
    return f.select("series_key", F.col("h_step").cast("long").alias("h_step"), _ds())
