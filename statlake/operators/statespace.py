"""Exact Gaussian likelihood of seasonal ARIMA models by the Kalman filter.

The filter runs for a whole batch of parameter vectors at once: one pass over
the series moves every state and covariance of the batch, so a gradient or a
line search is one pass.  Spark spreads (series x order) fits over the
executors (:func:`statlake.operators.forecast.sarima_grid`); a series is a
regular monthly sequence, bounded by the calendar.

Two starts are offered:

* ``diffuse``: the differencing is part of the state, nothing is known of any
  state before the first value (the limit of a growing prior variance, taken
  exactly: the unbounded part of the covariance is carried in a matrix of its
  own), and as many observations as there are states are left out of the
  likelihood.  Roots are not restricted.
* ``stationary``: the series is differenced first and its ARMA state starts in
  its stationary distribution; all differenced observations count.  Parameters
  outside the stationary and invertible region have likelihood -inf.
"""

from __future__ import annotations

import math

import numpy as np

from statlake.operators.forecast import _diff_poly, _poly_ar, _poly_ma, _split, fit_css

UNKNOWN = 1e-9
SETTLED = 1e-13


def _arma(theta: np.ndarray, o: dict) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of the multiplied AR polynomial (as lags of the series) and
    of the multiplied MA polynomial, both without the leading one."""
    ar, sar, ma, sma, _ = _split(theta, o)
    return (-np.convolve(_poly_ar(ar, 1), _poly_ar(sar, o["s"]))[1:], np.convolve(_poly_ma(ma, 1), _poly_ma(sma, o["s"]))[1:])


def _system(thetas: np.ndarray, o: dict, differenced: bool):
    """(transition [b, r, r], shock loading [b, r], observation row [r], number
    of differencing states).  The state holds the last level and its
    differences, the last season's values, then the ARMA state."""
    d, big_d, s = (0, 0, o["s"]) if differenced else (o["d"], o["sd"], o["s"])
    lags = [_arma(t, o) for t in thetas]
    size = max(len(lags[0][0]), len(lags[0][1]) + 1)
    first = d + big_d * s  # place of the ARMA state
    t = np.zeros((len(thetas), first + size, first + size))
    shock = np.zeros((len(thetas), first + size))
    seen = np.zeros(first + size)
    seen[:d] = 1.0
    seen[first] = 1.0
    if big_d:
        seen[[d + k * s + s - 1 for k in range(big_d)]] = 1.0
    for i in range(d):  # a difference grows by the higher ones and what comes in
        t[:, i] = seen
        t[:, i, :i] = 0.0
    for k in range(big_d):  # a season's values move on by one place
        a = d + k * s
        t[:, a, a + s - 1::s][:, :big_d - k] = 1.0
        t[:, a, first] = 1.0
        for i in range(1, s):
            t[:, a + i, a + i - 1] = 1.0
    for b, (ar, ma) in enumerate(lags):
        t[b, first:first + len(ar), first] = ar
        shock[b, first] = 1.0
        shock[b, first + 1:first + 1 + len(ma)] = ma
    for i in range(size - 1):
        t[:, first + i, first + i + 1] = 1.0
    return t, shock, seen, first


def _stationary_cov(t: np.ndarray, rr: np.ndarray) -> np.ndarray:
    """The sum of T^k R R' T'^k over all k, by doubling."""
    p, a = rr, t
    for _ in range(40):
        step = a @ p @ a.transpose(0, 2, 1)
        p = p + step
        a = a @ a
        if np.abs(step).max() <= 1e-15 * np.abs(p).max():
            break
    return p


def _stable(thetas: np.ndarray, o: dict) -> np.ndarray:
    """True where all roots of both polynomials lie outside the unit circle."""
    out = np.ones(len(thetas), bool)
    for i, theta in enumerate(thetas):
        ar, ma = _arma(theta, o)
        for c in (-ar, ma):
            out[i] &= bool(np.all(np.abs(np.roots(np.r_[1.0, c])) < 1 - 1e-8))
    return out


def _run(thetas: np.ndarray, variances: np.ndarray, y: np.ndarray, o: dict, differenced: bool):
    """One pass of the filter: (innovations, their variances) as [b, n], the
    predicted state and covariance after the last observation, the system."""
    t, shock, z, first = _system(thetas, o, differenced)
    b, r = shock.shape
    rr = shock[:, :, None] * shock[:, None, :] * variances[:, None, None]
    cov = _stationary_cov(t, rr) if differenced else np.zeros((b, r, r))
    free = np.zeros_like(cov) if differenced else np.broadcast_to(np.eye(r), (b, r, r)).copy()
    state = np.zeros((b, r))
    tt = t.transpose(0, 2, 1)
    v, f = np.empty((b, len(y))), np.empty((b, len(y)))
    settled, gain = False, None

    def outer(a, c):
        return a[:, :, None] * c[:, None, :]

    for i, x in enumerate(y):
        v[:, i] = x - state @ z
        if not settled:
            pz = cov @ z
            f[:, i] = pz @ z
            tpz = (t @ pz[:, :, None])[:, :, 0]
            moved = t @ cov @ tt + rr
            if i < r and not differenced:
                open_z = free @ z
                wide = open_z @ z
                unknown = wide > UNKNOWN
                top = (t @ open_z[:, :, None])[:, :, 0] / np.where(unknown, wide, 1.0)[:, None]
                plain = tpz / np.where(f[:, i] > 0, f[:, i], 1.0)[:, None]
                gain = np.where(unknown[:, None], top, plain)
                # with the limit gain the covariance keeps its whole quadratic form
                ahead = moved - outer(gain, tpz) - outer(tpz, gain) + outer(gain, gain) * f[:, i, None, None]
                free = t @ free @ tt - np.where(unknown, wide, 0.0)[:, None, None] * outer(gain, gain)
                free = (free + free.transpose(0, 2, 1)) / 2
            else:
                gain = tpz / f[:, i, None]
                ahead = moved - outer(gain, tpz)
            ahead = (ahead + ahead.transpose(0, 2, 1)) / 2
            settled = i >= r and bool(np.abs(ahead - cov).max() <= SETTLED * np.abs(ahead).max())
            cov = ahead
        else:
            f[:, i] = f[:, i - 1]
        state = (t @ state[:, :, None])[:, :, 0] + gain * v[:, i, None]
    return v, f, state, cov, (t, rr, z, r)


def _difference(y: np.ndarray, o: dict) -> np.ndarray:
    poly = _diff_poly(o["d"], o["sd"], o["s"])
    return np.convolve(y, poly, mode="valid") if len(poly) > 1 else y


def loglike(params: np.ndarray, y, o: dict, start: str = "diffuse") -> np.ndarray:
    """Log-likelihood of every row of ``params`` (coefficients, then the shock
    variance); -inf where a variance is not positive or a filter breaks down."""
    params = np.atleast_2d(np.asarray(params, float))
    y = np.asarray(y, float)
    out = np.full(len(params), -np.inf)
    differenced = start == "stationary"
    ok = (params[:, -1] > 0) & np.isfinite(params).all(1)
    if differenced:
        ok[ok] = _stable(params[ok, :-1], o)
        y = _difference(y, o)
    if ok.any():
        with np.errstate(all="ignore"):
            v, f, *_, (_, _, _, r) = _run(params[ok, :-1], params[ok, -1], y, o, differenced)
            burn = 0 if differenced else r
            ll = -0.5 * (math.log(2 * math.pi) + np.log(f[:, burn:]) + v[:, burn:] ** 2 / f[:, burn:]).sum(1)
        out[ok] = np.where(np.isfinite(ll), ll, -np.inf)
    return out


def concentrated(thetas: np.ndarray, y, o: dict) -> tuple[np.ndarray, np.ndarray]:
    """(log-likelihood, shock variance) of coefficient vectors under the
    stationary start, the variance at its maximum in closed form."""
    thetas = np.atleast_2d(np.asarray(thetas, float))
    w = _difference(np.asarray(y, float), o)
    ok, n = _stable(thetas, o), len(w)
    ll, s2 = np.full(len(thetas), -np.inf), np.full(len(thetas), np.nan)
    if ok.any():
        v, f, *_ = _run(thetas[ok], np.ones(int(ok.sum())), w, o, True)
        s2[ok] = (v ** 2 / f).mean(1)
        ll[ok] = -n / 2 * (np.log(2 * math.pi * s2[ok]) + 1) - 0.5 * np.log(f).sum(1)
    return ll, s2


def _climb(value, x: np.ndarray, steps: int = 60, tol: float = 1e-9):
    """Maximum of a batch function by BFGS.  A gradient is one batch of central
    differences, a line search one batch of step lengths."""
    k = len(x)
    best, h = float(value(x[None])[0]), np.eye(k)
    if not np.isfinite(best):
        raise ValueError("no finite likelihood at the start")
    width = 1e-5 * np.maximum(1.0, np.abs(x))

    def slope(at):
        both = value(np.vstack([at + np.diag(width), at - np.diag(width)]))
        return (both[:k] - both[k:]) / (2 * width)

    g = slope(x)
    lengths = 2.0 ** -np.arange(0, 24, 2)
    for _ in range(steps):
        if not np.isfinite(g).all():
            break
        way = h @ g
        if way @ g <= 0:
            h, way = np.eye(k), g
        reach = way * min(1.0, 2.0 / max(1e-300, np.abs(way).max()))
        found = value(x + lengths[:, None] * reach)
        i = int(np.argmax(found))
        gain = float(found[i]) - best
        if not gain > 0:
            if np.array_equal(h, np.eye(k)):
                break
            h = np.eye(k)
            continue
        move = lengths[i] * reach
        x, best = x + move, float(found[i])
        if gain < tol * (1 + abs(best)) * 1e-3 and np.abs(move).max() < 1e-6:
            break
        new = slope(x)
        turn, g = g - new, new
        sy = move @ turn
        if sy > 1e-12 * np.linalg.norm(move) * np.linalg.norm(turn):
            if np.array_equal(h, np.eye(k)):
                h = np.eye(k) * sy / (turn @ turn)
            left = np.eye(k) - np.outer(move, turn) / sy
            h = left @ h @ left.T + np.outer(move, move) / sy
    return x, best


def _curvature(value, x: np.ndarray) -> np.ndarray:
    """Second derivatives of a batch function, all points in one batch."""
    k = len(x)
    e = np.diag(1e-4 * np.maximum(1.0, np.abs(x)))
    places = [(i, j) for i in range(k) for j in range(i, k)]
    pts = [x + a * e[i] + b * e[j] for i, j in places for a, b in ((1, 1), (1, -1), (-1, 1), (-1, -1))]
    f = value(np.array(pts)).reshape(-1, 4)
    out = np.zeros((k, k))
    for (i, j), (pp, pm, mp, mm) in zip(places, f):
        out[i, j] = out[j, i] = (pp - pm - mp + mm) / (4 * e[i, i] * e[j, j])
    return out


def fit_exact(y, o: dict, start: str = "diffuse", errors: bool = True) -> dict:
    """Maximum-likelihood fit of one series, started from least squares.
    ``theta``, ``sigma2``, ``stderr`` (from the curvature; empty if not
    ``errors`` or where the maximum lies at the edge of the admitted region), ``llf``, ``aic`` (variance counted) and ``n_eff``."""
    y = np.asarray(y, float)
    css = fit_css(y, o)
    theta, s2 = np.asarray(css["theta"], float), max(css["sigma2"], 1e-300)
    if start == "stationary":
        while len(theta) and not _stable(theta[None], o)[0]:
            theta = theta * 0.9
        n_eff = len(_difference(y, o))
    else:
        n_eff = len(y) - _system(theta[None], o, False)[1].shape[1]
        if n_eff <= len(theta) + 1:
            raise ValueError("series too short for this order")

    def value(at):
        return loglike(np.column_stack([at[:, :-1], s2 * np.exp(at[:, -1])]), y, o, start)

    x, ll = _climb(value, np.r_[theta, 0.0])
    stderr = np.zeros(0)
    if errors and len(theta):
        with np.errstate(all="ignore"):
            bend = _curvature(value, x)
        if np.isfinite(bend).all():  # not at the edge of the admitted region
            stderr = np.sqrt(np.maximum(np.diag(np.linalg.pinv(-bend))[:-1], 0.0))
    return {"theta": x[:-1], "sigma2": float(s2 * math.exp(x[-1])), "stderr": stderr, "llf": ll,
            "aic": -2 * ll + 2 * len(x), "n_eff": n_eff}


def predict(y, o: dict, theta, sigma2: float, h: int):
    """(one-step innovations after the burn-in, mean and standard error of the
    next h values) of a model with the diffuse start."""
    v, _, state, cov, (t, rr, z, r) = _run(np.atleast_2d(np.asarray(theta, float)), np.array([sigma2]), np.asarray(y, float), o, False)
    mean, se = np.empty(h), np.empty(h)
    for i in range(h):
        mean[i], se[i] = state[0] @ z, math.sqrt(max(z @ cov[0] @ z, 0.0))
        state = (t @ state[:, :, None])[:, :, 0]
        cov = t @ cov @ t.transpose(0, 2, 1) + rr
    return v[0, r:], mean, se
