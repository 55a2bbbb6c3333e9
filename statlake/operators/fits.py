"""Iterative model fits on tables: one Spark aggregate per step.

Each step of Gauss–Newton / Levenberg–Marquardt, gradient descent
(plain, momentum, Nesterov, Adam) or nonlinear conjugate gradients needs
only sums over rows — JᵀJ, Jᵀr, rᵀr or a gradient — which one hash
aggregate computes with map-side combining.  The parameter vector (a few
numbers) lives on the driver and enters the next step as literals.  The
input is cached once; a model is a Column-expression builder
``model(params: list[Column], x: dict[str, Column]) -> Column``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.exprs import clean_numeric

Model = Callable[[Sequence[Column], dict], Column]


def _lits(theta) -> list[Column]:
    return [F.lit(float(t)) for t in theta]


def _xmap(cols: Sequence[str]) -> dict:
    return {c: F.col(c) for c in cols}


def saturating(params, x):
    """P = a·(1 − e^{−b·G}) + c."""
    a, b, c = params
    return a * (F.lit(1.0) - F.exp(-b * x["g"])) + c


def exp_curve(params, x):
    """y = a·e^{b·t} + c."""
    a, b, c = params
    return a * F.exp(b * x["t"]) + c


saturating.np = lambda p, x: p[0] * (1.0 - np.exp(-p[1] * x["g"])) + p[2]
exp_curve.np = lambda p, x: p[0] * np.exp(p[1] * x["t"]) + p[2]


def linear(params, x):
    out = params[0]
    for i, c in enumerate(sorted(k for k in x if k.startswith("x"))):
        out = out + params[i + 1] * x[c]
    return out


def _normal_eq_many(df: DataFrame, model: Model, thetas: Sequence[np.ndarray], y: str, cols: Sequence[str],
                    h: float = 1e-6, sse_only: bool = False):
    """One aggregate: JᵀJ, Jᵀr, rᵀr (and n) at every θ in ``thetas``
    (forward-difference Jacobian).  Parameter values travel in a one-row
    broadcast frame, not as literals, so the generated code is identical
    from one iteration to the next and Spark reuses the compiled class."""
    if hasattr(model, "np"):
        return _normal_eq_many_np(df, model.np, thetas, y, cols, h, sse_only)
    x = _xmap(cols)
    p = len(thetas[0])
    vals, names = [], []

    def param_cols(vec, tag):
        out = []
        for i, v in enumerate(vec):
            nm = f"_q{tag}_{i}"
            vals.append(float(v))
            names.append(nm)
            out.append(F.col(nm))
        return out

    aggs = [F.count(F.lit(1)).alias("n")]
    for t, theta in enumerate(thetas):
        theta = np.asarray(theta, dtype=float)
        base = model(param_cols(theta, f"{t}b"), x)
        r = F.col(y) - base
        aggs.append(F.sum(r * r).alias(f"rr_{t}"))
        if sse_only:
            continue
        jac = []
        for i in range(p):
            tp = theta.copy()
            step = h * max(1.0, abs(tp[i]))
            tp[i] += step
            inv_step = param_cols([1.0 / step], f"{t}s{i}")[0]
            jac.append((model(param_cols(tp, f"{t}d{i}"), x) - base) * inv_step)
        aggs += [F.sum(jac[i] * r).alias(f"g{i}_{t}") for i in range(p)]
        aggs += [F.sum(jac[i] * jac[k]).alias(f"h{i}_{k}_{t}") for i in range(p) for k in range(i, p)]
    pf = df.sparkSession.createDataFrame([tuple(vals)], names)
    row = df.crossJoin(F.broadcast(pf)).agg(*aggs).first()  # one-row frame: size known
    out = []
    for t in range(len(thetas)):
        rr = row[f"rr_{t}"]
        rr = float(rr) if rr is not None else math.inf
        if sse_only:
            out.append((None, None, rr, int(row["n"])))
            continue
        jtj = np.zeros((p, p))
        for i in range(p):
            for k in range(i, p):
                jtj[i, k] = jtj[k, i] = row[f"h{i}_{k}_{t}"]
        jtr = np.array([row[f"g{i}_{t}"] for i in range(p)])
        out.append((jtj, jtr, rr, int(row["n"])))
    return out


def _normal_eq_many_np(df: DataFrame, fn, thetas, y: str, cols: Sequence[str], h: float, sse_only: bool):
    """Same sums as the column path, for models that also carry a numpy form
    (``model.np``): one ``mapInPandas`` pass emits one partial-sum row per
    partition (bounded by the partition count), summed on the driver.  The
    plan is tiny, so a step costs one short job instead of planning a large
    expression tree."""
    import pandas as pd
    thetas = [np.asarray(t, dtype=float) for t in thetas]
    p = len(thetas[0])
    per = 1 if sse_only else 1 + p + p * (p + 1) // 2

    def run(it):
        acc = np.zeros(len(thetas) * per)
        n = 0
        for pdf in it:
            xs = {c: pdf[c].to_numpy(dtype=float) for c in cols}
            yy = pdf[y].to_numpy(dtype=float)
            n += len(yy)
            off = 0
            for theta in thetas:
                base = fn(theta, xs)
                r = yy - base
                acc[off] += r @ r
                off += 1
                if sse_only:
                    continue
                jac = []
                for i in range(p):
                    tp = theta.copy()
                    step = h * max(1.0, abs(tp[i]))
                    tp[i] += step
                    jac.append((fn(tp, xs) - base) / step)
                for i in range(p):
                    acc[off] += jac[i] @ r
                    off += 1
                for i in range(p):
                    for k in range(i, p):
                        acc[off] += jac[i] @ jac[k]
                        off += 1
        yield pd.DataFrame({"n": [n], "v": [acc.tolist()]})

    rows = df.mapInPandas(run, "n long, v array<double>").collect()
    n = int(sum(r["n"] for r in rows))
    tot = np.sum([np.asarray(r["v"], dtype=float) for r in rows], axis=0) if rows else np.zeros(len(thetas) * per)
    out = []
    for t in range(len(thetas)):
        blk = tot[t * per:(t + 1) * per]
        rr = float(blk[0]) if np.isfinite(blk[0]) else math.inf
        if sse_only:
            out.append((None, None, rr, n))
            continue
        jtr = blk[1:1 + p].copy()
        jtj = np.zeros((p, p))
        off = 1 + p
        for i in range(p):
            for k in range(i, p):
                jtj[i, k] = jtj[k, i] = blk[off]
                off += 1
        out.append((jtj, jtr, rr, n))
    return out


def _normal_eq(df, model, theta, y, cols, h: float = 1e-6):
    return _normal_eq_many(df, model, [theta], y, cols, h)[0]


def levenberg_marquardt(df: DataFrame, model: Model, y: str, cols: Sequence[str], theta0: Sequence[float],
                        lower: Sequence[float] | None = None, upper: Sequence[float] | None = None,
                        lam: float = 1e-2, max_iter: int = 100, step_tol: float = 1e-8, grad_tol: float = 1e-6):
    """Damped Gauss–Newton.  λ shrinks ×1/3 on an accepted step and
    grows ×3 on a rejected one; stops when |Δθ| < ``step_tol`` or
    |Jᵀr| < ``grad_tol``.  Steps are projected onto [lower, upper].
    Returns dict(theta, stderr, sse, n, rmse, r2, iterations, converged)."""
    data = clean_numeric(df.select(y, *cols), [y, *cols]).cache()
    try:
        theta = np.array(theta0, dtype=float)
        lo = np.array(lower if lower is not None else [-np.inf] * len(theta), dtype=float)
        hi = np.array(upper if upper is not None else [np.inf] * len(theta), dtype=float)
        theta = np.clip(theta, lo, hi)
        jtj, jtr, sse, n = _normal_eq(data, model, theta, y, cols)
        converged = False
        it = 0
        trials = 4  # damping values λ, 3λ, 9λ, ... tried in the same pass
        for it in range(1, max_iter + 1):
            if np.max(np.abs(jtr)) < grad_tol:
                converged = True
                break
            cands, lams = [], []
            for j in range(trials):
                lj = lam * 3.0 ** j
                a = jtj + lj * np.diag(np.diag(jtj) + 1e-12)
                try:
                    step = np.linalg.solve(a, jtr)
                except np.linalg.LinAlgError:
                    step = np.linalg.lstsq(a, jtr, rcond=None)[0]
                cands.append(np.clip(theta + step, lo, hi))
                lams.append(lj)
            res = _normal_eq_many(data, model, cands, y, cols)
            pick = next((j for j in range(trials) if res[j][2] < sse), None)
            if pick is None:
                lam *= 3.0 ** trials
                if lam > 1e12:
                    break
                continue
            delta = np.max(np.abs(cands[pick] - theta))
            theta = cands[pick]
            jtj, jtr, sse, n = res[pick]
            lam = max(lams[pick] / 3.0, 1e-12)
            if delta < step_tol:
                converged = True
                break
        p = len(theta)
        s2 = sse / max(n - p, 1)
        cov = s2 * np.linalg.pinv(jtj)
        var_y = data.agg(F.var_pop(y)).first()[0]
        return {"theta": theta, "stderr": np.sqrt(np.maximum(np.diag(cov), 0)), "sse": sse, "n": n,
                "rmse": math.sqrt(sse / n), "r2": (1 - sse / (var_y * n)) if var_y else float("nan"),
                "iterations": it, "converged": converged}
    finally:
        data.unpersist()


def _factor(df: DataFrame, fn, p: int, y: str, cols: Sequence[str]):
    """``(n, R)``: the triangular factor of (J, y − f(0)) for a model f(0) + Jθ
    (numpy form ``fn``), from one pass: each task folds its rows into a factor
    of p + 1 rows, the driver those of the tasks.  No squares are summed, so
    a residual sum read from R keeps its digits."""
    import pandas as pd

    def run(it):
        n, r = 0, np.zeros((0, p + 1))
        for pdf in it:
            xs = {c: pdf[c].to_numpy(dtype=float) for c in cols}
            base = np.broadcast_to(fn(np.zeros(p), xs), len(pdf))
            jac = [fn(e, xs) - base for e in np.eye(p)]
            r = np.linalg.qr(np.vstack([r, np.column_stack([*jac, pdf[y].to_numpy(dtype=float) - base])]), mode="r")
            n += len(pdf)
        if n:
            yield pd.DataFrame({"n": [n], "r": [r.ravel().tolist()]})
    rows = df.mapInPandas(run, "n long, r array<double>").collect()
    parts = [np.asarray(x["r"], dtype=float).reshape(-1, p + 1) for x in rows]
    return sum(x["n"] for x in rows), np.linalg.qr(np.vstack([np.zeros((1, p + 1)), *parts]), mode="r")


def _summing(df: DataFrame, model: Model, y: str, cols: Sequence[str], p: int):
    """``(thetas, sse_only) -> sums`` as :func:`_normal_eq_many` gives them.  For a
    model that says it is affine in its parameters (``model.affine``) the rows
    are read once: all later sums follow from their triangular factor."""
    if not getattr(model, "affine", False):
        return lambda thetas, sse_only=False: _normal_eq_many(df, model, thetas, y, cols, sse_only=sse_only)
    n, factor = _factor(df, model.np, p, y, cols)
    jac, rhs = factor[:, :p], factor[:, p]

    def sums(thetas, sse_only=False):
        out = []
        for theta in thetas:
            r = rhs - jac @ np.asarray(theta, dtype=float)
            rr = float(r @ r)
            out.append((None if sse_only else jac.T @ jac, None if sse_only else jac.T @ r, rr if math.isfinite(rr) else math.inf, n))
        return out
    return sums


def _grad_many(sums, thetas):
    """MSE gradients and losses at several θ in one aggregate."""
    out = []
    for jtj, jtr, sse, n in sums(thetas):
        out.append((-2.0 * jtr / n, sse / n))
    return out


def _step_state(method, theta, v, m, s, g, t, lr, beta1, beta2, momentum):
    if method == "gd":
        return theta - lr * g, v, m, s
    if method in ("momentum", "nesterov"):
        v = momentum * v + lr * g
        return theta - v, v, m, s
    m = beta1 * m + (1 - beta1) * g
    s = beta2 * s + (1 - beta2) * g * g
    mh = m / (1 - beta1 ** t)
    sh = s / (1 - beta2 ** t)
    return theta - lr * mh / (np.sqrt(sh) + 1e-8), v, m, s


def gradient_fit(df: DataFrame, model: Model, y: str, cols: Sequence[str], theta0: Sequence[float],
                 methods: dict | None = None, beta1: float = 0.9, beta2: float = 0.999, momentum: float = 0.9,
                 max_iter: int = 500, tol: float = 1e-6, clip: float = 100.0):
    """First-order fits of the mean squared error.  ``methods`` maps a
    name to (rule, learning rate) with rule in 'gd', 'momentum',
    'nesterov', 'adam'; all runs advance together, one aggregate per step
    computing every run's gradient (for an affine model one pass in all).  Gradient norm clipped at ``clip``; a
    run stops when its gradient norm < ``tol``.
    Returns {name: (theta, loss history)}."""
    methods = methods or {"adam": ("adam", 0.01)}
    data = clean_numeric(df.select(y, *cols), [y, *cols]).cache()
    try:
        sums = _summing(data, model, y, cols, len(theta0))
        st = {k: [np.array(theta0, float), np.zeros(len(theta0)), np.zeros(len(theta0)), np.zeros(len(theta0)), [], False]
              for k in methods}
        for t in range(1, max_iter + 1):
            live = [k for k in methods if not st[k][5]]
            if not live:
                break
            looks = [st[k][0] - momentum * st[k][1] if methods[k][0] == "nesterov" else st[k][0] for k in live]
            for k, (g, loss) in zip(live, _grad_many(sums, looks)):
                theta, v, m, s, hist, _ = st[k]
                hist.append(loss)
                gn = np.linalg.norm(g)
                if gn < tol:
                    st[k][5] = True
                    continue
                if gn > clip:
                    g = g * clip / gn
                rule, lr = methods[k]
                theta, v, m, s = _step_state(rule, theta, v, m, s, g, t, lr, beta1, beta2, momentum)
                st[k][:4] = [theta, v, m, s]
        return {k: (st[k][0], st[k][4]) for k in methods}
    finally:
        data.unpersist()


def cg_fit(df: DataFrame, model: Model, y: str, cols: Sequence[str], theta0: Sequence[float],
           rules: Sequence[str] = ("pr+",), max_iter: int = 200, tol: float = 1e-6, c1: float = 1e-4,
           alpha0: float = 1.0, shrink: float = 0.5, n_steps: int = 30,
           powell: float | None = None):
    """Nonlinear conjugate gradients on the MSE with Fletcher–Reeves
    ('fr'), Polak–Ribière+ ('pr+'), Hestenes–Stiefel+ ('hs+') or Dai–Yuan
    ('dy') β; ``powell`` (0.2 is usual) adds restarts when gradients stay that
    far from orthogonal.  The Armijo search scores every trial step
    α·τ^j of every rule in ONE aggregate; new gradients take a second.
    Returns {rule: (theta, loss history)}."""
    data = clean_numeric(df.select(y, *cols), [y, *cols]).cache()
    try:
        sums = _summing(data, model, y, cols, len(theta0))
        n = sums([np.array(theta0, float)], sse_only=True)[0][3]
        g0, l0 = _grad_many(sums, [np.array(theta0, float)])[0]
        st = {r: {"theta": np.array(theta0, float), "g": g0, "d": -g0, "loss": l0, "hist": [l0], "done": False}
              for r in rules}
        alphas = [alpha0 * shrink ** j for j in range(n_steps)]
        for _ in range(max_iter):
            live = [r for r in rules if not st[r]["done"] and np.linalg.norm(st[r]["g"]) >= tol]
            if not live:
                break
            for r in live:
                if st[r]["g"] @ st[r]["d"] >= 0:
                    st[r]["d"] = -st[r]["g"]
            pts = [st[r]["theta"] + a * st[r]["d"] for r in live for a in alphas]
            sses = [res[2] for res in sums(pts, sse_only=True)]
            moved = []
            for i, r in enumerate(live):
                s_ = st[r]
                chosen = None
                for j, a in enumerate(alphas):
                    if sses[i * n_steps + j] / n <= s_["loss"] + c1 * a * (s_["g"] @ s_["d"]):
                        chosen = a
                        break
                if chosen is None:
                    s_["done"] = True
                    continue
                s_["theta"] = s_["theta"] + chosen * s_["d"]
                moved.append(r)
            if not moved:
                break
            for r, (g_new, loss) in zip(moved, _grad_many(sums, [st[r]["theta"] for r in moved])):
                s_ = st[r]
                g, d = s_["g"], s_["d"]
                yv = g_new - g
                if r == "fr":
                    beta = (g_new @ g_new) / (g @ g)
                elif r == "hs+":
                    beta = max(0.0, (g_new @ yv) / (d @ yv)) if d @ yv != 0 else 0.0
                elif r == "dy":
                    beta = (g_new @ g_new) / (d @ yv) if d @ yv != 0 else 0.0
                else:
                    beta = max(0.0, (g_new @ yv) / (g @ g))
                if powell is not None and abs(g_new @ g) >= powell * (g_new @ g_new):  # Powell restart
                    beta = 0.0
                s_["d"] = -g_new + beta * d
                s_["g"], s_["loss"] = g_new, loss
                s_["hist"].append(loss)
        return {r: (st[r]["theta"], st[r]["hist"]) for r in rules}
    finally:
        data.unpersist()


def predict(df: DataFrame, model: Model, theta: Sequence[float], cols: Sequence[str], out: str = "fitted") -> DataFrame:
    return df.withColumn(out, model(_lits(theta), _xmap(cols)))


def residual_table(df: DataFrame, model: Model, theta, y: str, cols: Sequence[str], order: str) -> DataFrame:
    """Fitted values and residuals, ordered by ``order``."""
    return (predict(df, model, theta, cols).withColumn("residual", F.col(y) - F.col("fitted"))
              .orderBy(order))


def decision_grid(df: DataFrame, cols: Sequence[str], n: int, score: Callable[[dict], Column]) -> DataFrame:
    """An n×n mesh over the observed ranges of two features (bounds
    from one aggregate), scored by a column expression."""
    a, b = cols
    bounds = df.agg(F.min(a).alias("a0"), F.max(a).alias("a1"), F.min(b).alias("b0"), F.max(b).alias("b1"))
    g = bounds.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"), "a0", "a1", "b0", "b1")
    g = g.select("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("j"), "a0", "a1", "b0", "b1")
    g = g.select("i", "j", (F.col("a0") + (F.col("a1") - F.col("a0")) * F.col("i") / (n - 1)).alias(a),
                 (F.col("b0") + (F.col("b1") - F.col("b0")) * F.col("j") / (n - 1)).alias(b))
    return g.withColumn("score", score({a: F.col(a), b: F.col(b)}))


# ---- M19/M20: neuro-fuzzy (first-order Sugeno) regression -------------------------------

def anfis_predict(x: dict, cols: Sequence[str], centers: np.ndarray, sigmas: np.ndarray, conseq: np.ndarray) -> Column:
    """Σ_r w̄_r (a_r·x + b_r) with Gaussian memberships and product rules
    over every combination of one membership function per input (rule count
    = mf^inputs, small); pure column expression with 1e-12 guards."""
    import itertools
    n_in, n_mf = centers.shape
    rules = list(itertools.product(range(n_mf), repeat=n_in))
    mu = [[F.exp(-((x[c] - F.lit(float(centers[i, k]))) ** 2) / F.lit(2.0 * float(sigmas[i, k]) ** 2))
           for k in range(n_mf)] for i, c in enumerate(cols)]
    ws = []
    for r in rules:
        w = F.lit(1.0)
        for i, k in enumerate(r):
            w = w * mu[i][k]
        ws.append(w)
    total = sum(ws, F.lit(0.0)) + F.lit(1e-12)
    out = F.lit(0.0)
    for ri, w in enumerate(ws):
        lin = F.lit(float(conseq[ri, -1]))
        for i, c in enumerate(cols):
            lin = lin + F.lit(float(conseq[ri, i])) * x[c]
        out = out + w / total * lin
    return out


def anfis_fit(df: DataFrame, y: str, cols: Sequence[str], n_mf: int = 2, epochs: int = 30, lr: float = 0.01,
              seed: int = 0):
    """M19 (re-aimed to full-batch steps): consequents by least squares from
    one normalised-firing Gram aggregate per epoch; membership centres and
    widths by a gradient step from one more aggregate (finite differences
    of the loss as Column expressions).  Widths kept ≥ 0.05 on [0,1] inputs.
    Returns (centers, sigmas, consequents, loss history)."""
    import itertools
    cols = list(cols)
    data = clean_numeric(df.select(y, *cols), [y, *cols]).cache()
    try:
        n_in = len(cols)
        centers = np.tile(np.linspace(0, 1, n_mf), (n_in, 1))
        sigmas = np.full((n_in, n_mf), 0.5 / max(n_mf - 1, 1))
        rules = list(itertools.product(range(n_mf), repeat=n_in))
        nr = len(rules)
        conseq = np.zeros((nr, n_in + 1))
        x = _xmap(cols)
        hist = []
        for _ in range(epochs):
            mu = [[F.exp(-((x[c] - F.lit(float(centers[i, k]))) ** 2) / F.lit(2.0 * float(sigmas[i, k]) ** 2))
                   for k in range(n_mf)] for i, c in enumerate(cols)]
            ws = []
            for r in rules:
                w = F.lit(1.0)
                for i, k in enumerate(r):
                    w = w * mu[i][k]
                ws.append(w)
            tot = sum(ws, F.lit(0.0)) + F.lit(1e-12)
            feats = []
            for w in ws:
                wn = w / tot
                feats += [wn * x[c] for c in cols] + [wn]
            m = len(feats)
            aggs = [F.sum(feats[i] * feats[j]).alias(f"a{i}_{j}") for i in range(m) for j in range(i, m)]
            aggs += [F.sum(feats[i] * F.col(y)).alias(f"b{i}") for i in range(m)]
            row = data.agg(*aggs).first()
            a = np.zeros((m, m))
            for i in range(m):
                for j in range(i, m):
                    a[i, j] = a[j, i] = row[f"a{i}_{j}"]
            b = np.array([row[f"b{i}"] for i in range(m)])
            sol = np.linalg.lstsq(a + 1e-9 * np.eye(m), b, rcond=None)[0]
            conseq = sol.reshape(nr, n_in + 1)
            base = anfis_predict(x, cols, centers, sigmas, conseq)
            h = 1e-4
            trials = []
            for arr in ("c", "s"):
                for i in range(n_in):
                    for k in range(n_mf):
                        c2, s2 = centers.copy(), sigmas.copy()
                        (c2 if arr == "c" else s2)[i, k] += h
                        trials.append((arr, i, k, anfis_predict(x, cols, c2, s2, conseq)))
            aggs = [F.avg((F.col(y) - base) ** 2).alias("loss")]
            aggs += [F.avg((F.col(y) - t[3]) ** 2).alias(f"t{j}") for j, t in enumerate(trials)]
            row = data.agg(*aggs).first()
            loss = row["loss"]
            hist.append(loss)
            for j, (arr, i, k, _) in enumerate(trials):
                g = (row[f"t{j}"] - loss) / h
                if arr == "c":
                    centers[i, k] -= lr * g
                else:
                    sigmas[i, k] = max(0.05, sigmas[i, k] - lr * g)
        return centers, sigmas, conseq, hist
    finally:
        data.unpersist()
