"""Column-expression builders (projection, cleaning and scalar formulas).

Everything here returns a ``Column`` or a lazily transformed DataFrame so
it stays inside whole-stage codegen and composes with any plan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.safe import same_keys

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def require_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Raise if any column is absent (checked on the schema, no job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def is_finite(col) -> Column:
    c = _c(col)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def clean_numeric(df: DataFrame, cols: Sequence[str], positive_eps: float | None = None) -> DataFrame:
    """Keep rows whose ``cols`` are all finite (NaN/±Inf/null dropped);
    optionally also require ``col > positive_eps``."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & is_finite(c)
        if positive_eps is not None:
            cond = cond & (F.col(c) > positive_eps)
    return df.filter(cond)


def clip(col, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a column; nulls stay null (``greatest``/``least`` skip nulls)."""
    c = _c(col)
    out = c
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def bin_right(col, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins (e0,e1], (e1,e2], ...; values outside give null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need len(edges) - 1 labels")
    c = _c(col)
    expr = F.lit(None).cast("string")
    for lo, hi, lab in reversed(list(zip(edges[:-1], edges[1:], labels))):
        cond = c > F.lit(float(lo))
        if not math.isinf(hi):
            cond = cond & (c <= F.lit(float(hi)))
        expr = F.when(cond, F.lit(lab)).otherwise(expr)
    return expr


def log_if_positive(col, key_min: Column) -> Column:
    """``ln(x)`` when the whole series (``key_min`` = min over the key) is
    positive, else ``x`` unchanged."""
    return F.when(key_min > 0, F.log(_c(col))).otherwise(_c(col))


def stabilize_irradiance(g, t, gamma: float = 0.0045) -> Column:
    return _c(g) * (F.lit(1.0) - F.lit(gamma) * (_c(t) - F.lit(25.0)))


def cell_temperature(ta, g, wind) -> Column:
    return _c(ta) + (_c(g) / F.lit(800.0)) * F.lit(25.0) - F.lit(3.0) * _c(wind)


def pv_power(g, t_cell, cos_theta, eta: float = 0.18, gamma: float = 0.004,
             area: float = 1.6) -> Column:
    p = (F.lit(eta) * (F.lit(1.0) - F.lit(gamma) * (_c(t_cell) - F.lit(25.0)))
         * _c(g) * F.lit(area) * _c(cos_theta))
    return clip(p, lo=0.0)


def daily_profile(df: DataFrame, area: float, efficiency: float,
                  inverter: float = 0.96) -> DataFrame:
    """Explode 24 hours per row: irradiance max(sin(π(h−6)/12),0)·1000,
    DC = irr/1000·area·eff, AC = DC·inverter."""
    out = df.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    irr = F.greatest(F.sin(F.lit(math.pi) * (F.col("hour") - F.lit(6)) / F.lit(12.0)), F.lit(0.0)) * 1000.0
    dc = irr / 1000.0 * F.lit(area) * F.lit(efficiency)
    return (out.withColumn("irradiance", irr).withColumn("dc_kw", dc)
               .withColumn("ac_kw", F.col("dc_kw") * F.lit(inverter)))


# Strength cut points on |r| (lower bound inclusive upward).
STRENGTH_EDGES = (0.2, 0.4, 0.6, 0.8)
STRENGTH_LABELS = ("very weak", "weak", "moderate", "strong", "very strong")


def correlation_strength(r) -> Column:
    a = F.abs(_c(r))
    base = F.when(a < STRENGTH_EDGES[0], STRENGTH_LABELS[0])
    for edge, lab in zip(STRENGTH_EDGES[1:], STRENGTH_LABELS[1:-1]):
        base = base.when(a < edge, lab)
    base = base.otherwise(STRENGTH_LABELS[-1])
    sign = F.when(_c(r) >= 0, F.lit("positive")).otherwise(F.lit("negative"))
    return F.when(_c(r).isNull(), F.lit(None)).otherwise(F.concat_ws(" ", base, sign))


def significance_flag(p, alpha: float = 0.05) -> Column:
    return _c(p) < F.lit(alpha)


def minmax_scale(df: DataFrame, cols: Sequence[str], eps: float = 1e-6,
                 key: Sequence[str] | None = None, suffix: str = "") -> DataFrame:
    """(x − min)/(max − min), a zero range replaced by ``eps``.  Bounds come
    from one aggregate (per key if given) joined back."""
    key = list(key or [])
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"_mn_{c}"), F.max(c).alias(f"_mx_{c}")]
    if key:
        bounds = df.groupBy(*key).agg(*aggs)
        out = same_keys(df, bounds, key)
    else:
        # one-row frame: a broadcast of known size 1
        out = df.crossJoin(F.broadcast(df.agg(*aggs)))
    for c in cols:
        rng = F.col(f"_mx_{c}") - F.col(f"_mn_{c}")
        rng = F.when(rng == 0, F.lit(eps)).otherwise(rng)
        out = out.withColumn(c + suffix, (F.col(c) - F.col(f"_mn_{c}")) / rng)
    return out.drop(*[f"_mn_{c}" for c in cols], *[f"_mx_{c}" for c in cols])


def standardize(df: DataFrame, cols: Sequence[str], key: Sequence[str] | None = None,
                suffix: str = "") -> DataFrame:
    """(x − mean)/σ with the population σ (ddof = 0); a constant column gives 0."""
    key = list(key or [])
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}")]
    if key:
        out = same_keys(df, df.groupBy(*key).agg(*aggs), key)
    else:
        out = df.crossJoin(F.broadcast(df.agg(*aggs)))
    for c in cols:
        off = F.col(c) - F.col(f"_mu_{c}")
        out = out.withColumn(c + suffix, F.when(F.col(f"_sd_{c}") != 0, off / F.col(f"_sd_{c}")).otherwise(off * 0.0))
    return out.drop(*[f"_mu_{c}" for c in cols], *[f"_sd_{c}" for c in cols])


def dot(a: Sequence, b: Sequence) -> Column:
    """Row-wise dot product of two equally long column lists."""
    out = F.lit(0.0)
    for x, y in zip(a, b):
        out = out + _c(x) * _c(y)
    return out


def norm2(a: Sequence) -> Column:
    return F.sqrt(dot(a, a))


def array_dot(a, b) -> Column:
    """Dot product of two array columns (zip_with + aggregate, JVM side)."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def sq_dist(a: Sequence, b: Sequence) -> Column:
    out = F.lit(0.0)
    for x, y in zip(a, b):
        out = out + (_c(x) - _c(y)) * (_c(x) - _c(y))
    return out


def month_start(col) -> Column:
    return F.trunc(_c(col).cast("date"), "month")


def fisher_ci(r, n, z: float = 1.96) -> tuple[Column, Column]:
    """tanh(atanh r ± z/√(n−3))."""
    se = F.lit(z) / F.sqrt(_c(n) - F.lit(3.0))
    zr = F.atanh(_c(r))
    ok = _c(n) > 3
    return (F.when(ok, F.tanh(zr - se)), F.when(ok, F.tanh(zr + se)))


# ---- economics (C1-C6) --------------------------------------------------------

def annual_saving(kwh, tariff, opex) -> Column:
    return _c(kwh) * _c(tariff) - _c(opex)


def payback_years(capex, saving) -> Column:
    return _c(capex) / F.greatest(_c(saving), F.lit(1e-6))


# Payback classes (right-closed year bins).
PAYBACK_EDGES = (0.0, 5.0, 8.0, float("inf"))
PAYBACK_LABELS = ("fast", "mid", "slow")


def payback_class(payback) -> Column:
    return bin_right(payback, PAYBACK_EDGES, PAYBACK_LABELS)


def monthly_rate(r_annual: float) -> float:
    return (1.0 + r_annual) ** (1.0 / 12.0) - 1.0
