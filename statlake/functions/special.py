"""Distribution tails without scipy.

Vectorised numpy implementations of the regularised incomplete gamma and
beta functions (series / continued fractions, as in standard numerical
texts) and the tails built on them.  They are applied through Pandas UDFs
to *result* frames (one row per key or per test), never to raw data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_EPS = 1e-15
_TINY = 1e-300
_MAXIT = 400


def _gammainc_series(a, x):
    s = 1.0 / a
    term = s
    ap = a
    for _ in range(_MAXIT):
        ap += 1.0
        term *= x / ap
        s += term
        if abs(term) < abs(s) * _EPS:
            break
    return s * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gammaincc_cf(a, x):
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, _MAXIT):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = _TINY if abs(d) < _TINY else d
        c = b + an / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def gammaincc_scalar(a: float, x: float) -> float:
    """Upper regularised incomplete gamma Q(a, x)."""
    if x is None or a is None or not np.isfinite(x) or not np.isfinite(a) or a <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        return max(0.0, 1.0 - _gammainc_series(a, x))
    return _gammaincc_cf(a, x)


def _betacf(a, b, x):
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = 1.0
    d = 1.0 - qab * x / qap
    d = _TINY if abs(d) < _TINY else d
    d = 1.0 / d
    h = d
    for m in range(1, _MAXIT):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc_scalar(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if not (np.isfinite(a) and np.isfinite(b) and np.isfinite(x)) or a <= 0 or b <= 0:
        return float("nan")
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
           + a * math.log(x) + b * math.log1p(-x))
    bt = math.exp(lbt)
    if x < (a + 1.0) / (a + b + 2.0):
        return bt * _betacf(a, b, x) / a
    return 1.0 - bt * _betacf(b, a, 1.0 - x) / b


_betainc = np.vectorize(betainc_scalar, otypes=[float])
_gammaincc = np.vectorize(gammaincc_scalar, otypes=[float])
_erfc = np.vectorize(lambda v: math.erfc(v) if np.isfinite(v) else (0.0 if v > 0 else 2.0),
                     otypes=[float])


def norm_cdf(z):
    z = np.asarray(z, dtype=float)
    return 0.5 * _erfc(-z / math.sqrt(2.0))


def norm_sf(z):
    z = np.asarray(z, dtype=float)
    return 0.5 * _erfc(z / math.sqrt(2.0))


def norm_ppf(p):
    """Inverse normal CDF: rational start refined by Newton steps on erfc."""
    p = np.asarray(p, dtype=float)
    out = np.full(p.shape, np.nan)
    ok = (p > 0) & (p < 1)
    q = np.where(ok, p, 0.5)
    # Start: logistic-type approximation, then Newton iterations.
    t = np.sqrt(-2.0 * np.log(np.minimum(q, 1 - q)))
    z = t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (
        1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t ** 3)
    z = np.where(q < 0.5, -z, z)
    for _ in range(4):
        err = norm_cdf(z) - q
        z = z - err / (np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi))
    out[ok] = z[ok]
    out[p == 0] = -np.inf
    out[p == 1] = np.inf
    return out


def chi2_sf(x, k):
    x = np.asarray(x, dtype=float)
    k = np.asarray(k, dtype=float)
    return _gammaincc(k / 2.0, x / 2.0)


def t_sf(t, df):
    """Upper tail P(T > t) of Student's t."""
    t = np.asarray(t, dtype=float)
    df = np.asarray(df, dtype=float)
    x = df / (df + t * t)
    half = 0.5 * _betainc(df / 2.0, 0.5, x)
    return np.where(t >= 0, half, 1.0 - half)


def t_two_sided(t, df):
    t = np.asarray(t, dtype=float)
    df = np.asarray(df, dtype=float)
    return _betainc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f, d1, d2):
    f = np.asarray(f, dtype=float)
    d1 = np.asarray(d1, dtype=float)
    d2 = np.asarray(d2, dtype=float)
    x = d2 / (d2 + d1 * np.maximum(f, 0.0))
    return _betainc(d2 / 2.0, d1 / 2.0, x)


def kolmogorov_sf(lam):
    """Asymptotic Kolmogorov tail Σ 2(-1)^{k-1} exp(-2k²λ²)."""
    lam = np.asarray(lam, dtype=float)
    k = np.arange(1, 101, dtype=float)[:, None]
    terms = 2 * ((-1.0) ** (k - 1)) * np.exp(-2.0 * k * k * lam[None, :] ** 2)
    s = terms.sum(axis=0)
    return np.clip(np.where(lam < 0.2, 1.0, s), 0.0, 1.0)


# ---- Pandas UDF wrappers (applied to small result frames only) ---------------

def _nan_safe(s: pd.Series) -> np.ndarray:
    return s.astype(float).to_numpy()


@F.pandas_udf(DoubleType())
def t_two_sided_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided(_nan_safe(t), _nan_safe(df)))


@F.pandas_udf(DoubleType())
def f_sf_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(f_sf(_nan_safe(f), _nan_safe(d1), _nan_safe(d2)))


@F.pandas_udf(DoubleType())
def chi2_sf_udf(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series(chi2_sf(_nan_safe(x), _nan_safe(k)))


@F.pandas_udf(DoubleType())
def norm_cdf_udf(z: pd.Series) -> pd.Series:
    return pd.Series(norm_cdf(_nan_safe(z)))


@F.pandas_udf(DoubleType())
def kolmogorov_sf_udf(lam: pd.Series) -> pd.Series:
    return pd.Series(kolmogorov_sf(_nan_safe(lam)))
