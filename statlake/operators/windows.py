"""Window and sequence operators over keyed series.

Keyed series here are *regular* sequences (months, days, tour stops): a window
``partitionBy(key).orderBy(t)`` holds one series, whose length is bounded
by the calendar or the route, not by the data volume.  A series without a
key, and with ``chunk`` a keyed one of any length, is cut into chunks with halo
rows instead (:mod:`statlake.operators.seams`); values are the same.  Operators whose
input can be an arbitrarily large group (cumulative shares, running
extremes over raw rows, path lengths) avoid such windows and use the
bucketed prefix sums of :mod:`statlake.operators.ranks` or equi-joins on
(key, position) instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.functions.safe import same_keys
from statlake.operators import seams
from statlake.operators.ranks import keyed_prefix


def _k(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def _w(keys, order):
    keys = _k(keys)
    return (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(order)


def _over(df: DataFrame, keys, order: str, before: int, after: int, chunk: int | None, places: bool):
    """(rows, window, last step) for values that look that far back and ahead."""
    if _k(keys) and chunk is None:
        return df, _w(keys, order), lambda d: d
    return *seams.chunked(df, keys, order, before, after, chunk, places), seams.own_rows


def positions(df: DataFrame, keys, order: str, out: str = "t", chunk: int | None = None) -> DataFrame:
    """Dense 0-based position of each row within its series."""
    if not _k(keys) or chunk is not None:
        return seams.numbered(df, keys, order, out)
    return df.withColumn(out, (F.row_number().over(_w(keys, order)) - 1).cast("long"))


def lag_diff(df: DataFrame, keys, order: str, value: str, k: int = 1, out: str | None = None,
             chunk: int | None = None, places: bool = False) -> DataFrame:
    """y_t − y_{t−k} (k=2 is a lag-2 difference, not a second difference)."""
    d, w, finish = _over(df, keys, order, k, 0, chunk, places)
    return finish(d.withColumn(out or f"{value}_d{k}", F.col(value) - F.lag(value, k).over(w)))


def diff_order(df: DataFrame, keys, order: str, value: str, d: int, seasonal: int = 0,
               big_d: int = 0, out: str | None = None, chunk: int | None = None, places: bool = False) -> DataFrame:
    """(1−B)^d (1−B^s)^D y_t as one linear combination of lags."""
    coefs = {0: 1.0}
    for _ in range(d):
        coefs = _mul(coefs, {0: 1.0, 1: -1.0})
    for _ in range(big_d):
        coefs = _mul(coefs, {0: 1.0, seasonal: -1.0})
    d_, w, finish = _over(df, keys, order, max(coefs), 0, chunk, places)
    expr = None
    for lag, c in sorted(coefs.items()):
        term = F.lit(c) * (F.col(value) if lag == 0 else F.lag(value, lag).over(w))
        expr = term if expr is None else expr + term
    return finish(d_.withColumn(out or f"{value}_diff", expr))


def _mul(a: dict, b: dict) -> dict:
    out: dict = {}
    for i, x in a.items():
        for j, y in b.items():
            out[i + j] = out.get(i + j, 0.0) + x * y
    return {k: v for k, v in out.items() if v != 0}


def rolling_mean_centered(df: DataFrame, keys, order: str, value: str, window: int = 12,
                          out: str | None = None, chunk: int | None = None, places: bool = False) -> DataFrame:
    """Centred rolling mean with min_periods=1; for an even window the
    frame is t−w/2 … t+w/2−1 (same as pandas ``center=True``)."""
    lo = -(window // 2)
    hi = window - 1 + lo
    d, w, finish = _over(df, keys, order, -lo, max(hi, 0), chunk, places)
    return finish(d.withColumn(out or f"{value}_rm{window}", F.avg(value).over(w.rowsBetween(lo, hi))))


def regularize_monthly(df: DataFrame, keys, ts: str, value: str) -> DataFrame:
    """Complete month grid between each series' first and last month;
    missing months get a null value."""
    keys = _k(keys)
    m = df.withColumn(ts, F.trunc(F.col(ts).cast("date"), "month"))
    b = m.groupBy(*keys).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    grid = b.select(*keys, F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias(ts))
    return same_keys(grid, m.select(*keys, ts, value), keys + [ts], "left")


def interpolate_linear(df: DataFrame, keys, order: str, value: str, out: str | None = None,
                       chunk: int | None = None, places: bool = False) -> DataFrame:
    """Linear interpolation by position; leading/trailing gaps take the
    nearest observed value (``limit_direction='both'``)."""
    keys = _k(keys)
    observed = lambda at: F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("p"), F.col(value).alias("v")))
    if keys and chunk is None:
        d = positions(df, keys, order, "_pos")
        w, obs, finish = _w(keys, "_pos"), observed("_pos"), lambda x: x
        d = (d.withColumn("_prev", F.last(obs, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_next", F.last(obs, ignorenulls=True).over(_w(keys, F.desc("_pos")).rowsBetween(Window.unboundedPreceding, 0))))
    else:
        d, w = seams.chunked(df, keys, order, chunk=chunk, places=places)
        d, finish = seams.nearest_seen(d.withColumn("_seen", observed("_t")), keys, w, "_seen").drop("_seen"), seams.own_rows
        d = d.withColumn("_pos", F.col("_t"))
    frac = (F.col("_pos") - F.col("_prev.p")) / (F.col("_next.p") - F.col("_prev.p"))
    mid = F.when(F.col("_next.p") == F.col("_prev.p"), F.col("_prev.v")).otherwise(
        F.col("_prev.v") + (F.col("_next.v") - F.col("_prev.v")) * frac)
    filled = F.coalesce(F.col(value), F.when(F.col("_prev").isNotNull() & F.col("_next").isNotNull(), mid),
                        F.col("_prev.v"), F.col("_next.v"))
    return finish(d.withColumn(out or value, filled).drop("_pos", "_prev", "_next"))


def future_months(df: DataFrame, keys, ts: str, h: int) -> DataFrame:
    """The next ``h`` month starts after each series' last month,
    with step number ``h_step`` 1..h."""
    keys = _k(keys)
    last = df.groupBy(*keys).agg(F.max(ts).alias("_last"))
    return last.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(h))).alias("h_step"), "_last").select(
        *keys, "h_step", F.add_months(F.col("_last"), F.col("h_step")).alias(ts))


def lag_matrix(df: DataFrame, keys, order: str, value: str, lags: int, prefix: str = "lag",
               chunk: int | None = None, places: bool = False) -> DataFrame:
    """Columns lag1..lagL of ``value`` in one window pass."""
    d, w, finish = _over(df, keys, order, lags, 0, chunk, places)
    return finish(d.select("*", *[F.lag(value, i).over(w).alias(f"{prefix}{i}") for i in range(1, lags + 1)]))


def cumulative(df: DataFrame, keys, order: Sequence[str], weight: str, out: str = "cum") -> DataFrame:
    """Inclusive prefix sum of ``weight`` per key in ``order`` (unique
    per key), computed with bucketed offsets (no single-task window)."""
    pre = keyed_prefix(df, _k(keys), list(order), weight, out="_before")
    return pre.withColumn(out, F.col("_before") + F.col(weight)).drop("_before")


def running_best(df: DataFrame, keys, order: str, metric: str, mode: str = "min",
                 out: str | None = None) -> DataFrame:
    """Best-so-far of ``metric`` along ``order`` within each key."""
    fn = F.min if mode == "min" else F.max
    w = _w(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out or f"best_{metric}", fn(metric).over(w))


def path_length(points: DataFrame, route: str, seq: str, coords: Sequence[str], closed: bool = True) -> DataFrame:
    """Σ distance between consecutive stops of each route (and back to
    the first when ``closed``).  Dense stop positions come from bucketed
    prefix counts; each leg is an equi-join on (route, position), whose key
    is unique per row, so a very long route does not land in one task."""
    pos = keyed_prefix(points.withColumn("_one", F.lit(1)), [route], [seq], "_one", out="_p").drop("_one")
    m = points.groupBy(route).agg(F.count(F.lit(1)).alias("_m"))
    a = same_keys(pos, m, [route]).withColumn("_nxt", F.col("_p") + 1)
    if closed:
        a = a.withColumn("_nxt", F.col("_nxt") % F.col("_m"))
    b = pos.select(F.col(route).alias("_r2"), F.col("_p").alias("_p2"), *[F.col(c).alias(f"_b_{c}") for c in coords])
    legs = a.join(b, a[route].eqNullSafe(b["_r2"]) & (a["_nxt"] == b["_p2"]))
    d = F.sqrt(sum(((F.col(c) - F.col(f"_b_{c}")) ** 2 for c in coords), F.lit(0.0)))
    return legs.groupBy(route).agg(F.sum(d).alias("length"), F.count(F.lit(1)).alias("legs"))


def rank_within(df: DataFrame, keys, order: Column | str, out: str = "rank", method: str = "ordinal") -> DataFrame:
    """W8 for bounded groups: ordinal (row_number) or min rank."""
    fn = F.row_number() if method == "ordinal" else F.rank()
    return df.withColumn(out, fn.over(_w(keys, order)).cast("long"))
