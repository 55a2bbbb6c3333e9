"""Descriptive statistics and hypothesis tests (one aggregate per key).

Every operator takes an optional ``keys`` list so one job answers the same
question for many groups; aggregates are partial/final hash aggregates.
p-values that need incomplete beta/gamma tails are attached by Pandas
UDFs on the (one row per key) result, never per data row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions import special
from statlake.functions.exprs import clean_numeric, fisher_ci, correlation_strength
from statlake.functions.safe import div, norm_cdf, same_keys, sqrt_pos
from statlake.operators.ranks import average_ranks, exact_quantiles


def safe_corr(a: str, b: str) -> Column:
    """Pearson r as an aggregate that is null (not an ANSI divide-by-zero
    error, as ``corr`` raises) when either column is constant."""
    return div(F.covar_pop(a, b), F.sqrt(F.var_pop(a) * F.var_pop(b)))


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


# ---- A1, A11, A19: describe ----------------------------------------------------

def describe(df: DataFrame, cols: Sequence[str], keys=()) -> DataFrame:
    """Long ``(keys, column, n, mean, std, std_pop, var_pop, min, max)``; std has ddof=1."""
    keys = _keys(keys)
    aggs = []
    for c in cols:
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"), F.stddev_pop(c).alias("std_pop"),
            F.var_pop(c).alias("var_pop"), F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max")).alias(f"_d_{c}"))
    wide = df.groupBy(*keys).agg(*aggs)
    return (wide.select(*keys, F.explode(F.array(*[F.col(f"_d_{c}") for c in cols])).alias("d"))
                .select(*keys, "d.*"))


def quantiles(df: DataFrame, col: str, qs: Sequence[float], keys=()) -> DataFrame:
    """A2: exact linear-interpolated quantiles ``(keys, q, quantile)``."""
    return exact_quantiles(df, col, qs, _keys(keys))


# ---- A3: covariance matrix --------------------------------------------------------

def covariance_matrix(df: DataFrame, cols: Sequence[str], keys=(), ddof: int = 1) -> DataFrame:
    """Long ``(keys, col_i, col_j, cov)`` for every ordered pair (symmetric)."""
    keys = _keys(keys)
    fn = F.covar_samp if ddof == 1 else F.covar_pop
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(fn(a, b).alias(f"_c_{a}_{b}"))
    wide = df.groupBy(*keys).agg(*aggs)
    entries = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            src = f"_c_{a}_{b}" if i <= j else f"_c_{b}_{a}"
            entries.append(F.struct(F.lit(a).alias("col_i"), F.lit(b).alias("col_j"),
                                    F.col(src).alias("cov")))
    return wide.select(*keys, F.explode(F.array(*entries)).alias("e")).select(*keys, "e.*")


# ---- A9: D'Agostino-Pearson K² -------------------------------------------------

def k2_columns(n: Column, skew: Column, kurt_pearson: Column) -> dict[str, Column]:
    """Skewness and kurtosis z-scores and K² from n, population skewness
    and Pearson kurtosis (formulas of the normaltest)."""
    n = n.cast("double")
    y = skew * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.lit(-1.0) + F.sqrt(2.0 * (beta2 - 1))
    delta = 1.0 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2.0 / (w2 - 1))
    zs = delta * F.asinh(y / alpha)
    e = 3.0 * (n - 1) / (n + 1)
    v = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (kurt_pearson - e) / F.sqrt(v)
    b = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / b * (2.0 / b + F.sqrt(1.0 + 4.0 / (b * b)))
    d = 1.0 + x * F.sqrt(2.0 / (a - 4.0))
    term1 = 1.0 - 2.0 / (9.0 * a)
    term2 = F.signum(d) * F.cbrt((1.0 - 2.0 / a) / F.abs(d))
    zk = F.when(d != 0, (term1 - term2) / F.sqrt(2.0 / (9.0 * a)))
    k2 = F.pow(zs, F.lit(2.0)) + F.pow(zk, F.lit(2.0))
    return {"z_skew": zs, "z_kurt": zk, "k2": k2}


def normality_k2(df: DataFrame, col: str, keys=(), alpha: float = 0.05,
                 min_n: int = 8) -> DataFrame:
    """``(keys, n, skew, kurtosis, k2, p_value, is_normal)``.  NaN/Inf/null
    dropped first; n < ``min_n`` gives (is_normal=true, p=1)."""
    keys = _keys(keys)
    clean = clean_numeric(df.select(*keys, col), [col])
    m = clean.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.skewness(col).alias("skew"),
                                 (F.kurtosis(col) + 3.0).alias("kurtosis"))
    z = k2_columns(F.col("n"), F.col("skew"), F.col("kurtosis"))
    small = F.col("n") < min_n
    p = F.when(small, F.lit(1.0)).otherwise(F.exp(-z["k2"] / 2.0))  # χ²(2) tail
    return (m.withColumn("k2", F.when(small, F.lit(None).cast("double")).otherwise(z["k2"]))
             .withColumn("p_value", p)
             .withColumn("is_normal", F.coalesce(F.col("p_value") > alpha, F.lit(False))))


# ---- A4-A6, A10: correlations ----------------------------------------------------

def _pair_clean(df, x, y, keys):
    return clean_numeric(df.select(*keys, x, y), [x, y])


def pearson(df: DataFrame, x: str, y: str, keys=()) -> DataFrame:
    """``(keys, n, r, p_value)``; p from Student t with n−2 df."""
    keys = _keys(keys)
    d = _pair_clean(df, x, y, keys)
    out = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), safe_corr(x, y).alias("r"))
    return with_r_pvalue(out)


def with_r_pvalue(out: DataFrame) -> DataFrame:
    t = F.col("r") * sqrt_pos(div(F.col("n") - 2.0, 1.0 - F.col("r") * F.col("r")))
    return out.withColumn("p_value", F.when(F.abs(F.col("r")) >= 1.0, F.lit(0.0))
                          .otherwise(special.t_two_sided_udf(t, F.col("n") - 2.0)))


def rank_pairs(df: DataFrame, x: str, y: str, keys=(), buckets=None) -> DataFrame:
    """``(keys, rx, ry, w)``: joint cells of (x, y) with average ranks of
    each margin.  Duplicate pairs collapse to one weighted row first."""
    keys = _keys(keys)
    d = _pair_clean(df, x, y, keys)
    joint = d.groupBy(*keys, x, y).agg(F.count(F.lit(1)).alias("w"))
    plans = [None, None]
    if buckets is None:
        # one sampling pass plans the buckets of both margins
        from statlake.operators.ranks import plan_bounds_multi
        plans = plan_bounds_multi(d, [keys + [x], keys + [y]])
    rx = average_ranks(d, x, keys, out="rx", buckets=buckets, plan=plans[0]).drop("cnt")
    ry = average_ranks(d, y, keys, out="ry", buckets=buckets, plan=plans[1]).drop("cnt")
    j = same_keys(same_keys(joint, rx, keys + [x]), ry, keys + [y])
    return j.select(*keys, "rx", "ry", "w")


def weighted_corr(df: DataFrame, a: str, b: str, w: str, keys=()) -> DataFrame:
    """Pearson r of weighted rows in ONE aggregate from raw weighted sums.
    Used on ranks, whose mean/σ ratio is about √3, so the raw-moment form
    loses no meaningful precision."""
    keys = _keys(keys)
    wc, ac, bc = F.col(w).cast("double"), F.col(a), F.col(b)
    m = df.groupBy(*keys).agg(F.sum(wc).alias("n"), F.sum(wc * ac).alias("_sa"), F.sum(wc * bc).alias("_sb"),
                              F.sum(wc * ac * ac).alias("_saa"), F.sum(wc * bc * bc).alias("_sbb"),
                              F.sum(wc * ac * bc).alias("_sab"))
    n = F.col("n")
    cov = F.col("_sab") - F.col("_sa") * F.col("_sb") / n
    va = F.col("_saa") - F.col("_sa") * F.col("_sa") / n
    vb = F.col("_sbb") - F.col("_sb") * F.col("_sb") / n
    return m.select(*keys, n.cast("long").alias("n"), div(cov, F.sqrt(va * vb)).alias("r"))


def spearman(df: DataFrame, x: str, y: str, keys=(), buckets=None) -> DataFrame:
    """``(keys, n, r, p_value)``: Pearson on average ranks (ties averaged)."""
    keys = _keys(keys)
    rp = rank_pairs(df, x, y, keys, buckets)
    return with_r_pvalue(weighted_corr(rp, "rx", "ry", "w", keys))


def auto_correlation(df: DataFrame, x: str, y: str, keys=(), alpha: float = 0.05) -> DataFrame:
    """Both margins normal (K² p > α) → Pearson, else Spearman.

    ``(keys, method, n, r, p_value, p_x, p_y, ci_lo, ci_hi, strength, significant)``.
    Both coefficients are computed by keyed aggregates and the choice is a
    ``when`` per key, so one job covers any number of groups."""
    keys = _keys(keys)
    d = _pair_clean(df, x, y, keys)
    # one aggregate for both margins' moments and Pearson r (pairwise-clean rows)
    m = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.skewness(x).alias("_sx"), (F.kurtosis(x) + 3.0).alias("_kx"),
                             F.skewness(y).alias("_sy"), (F.kurtosis(y) + 3.0).alias("_ky"), safe_corr(x, y).alias("r_p"))
    small = F.col("n") < 8
    for tag in ("x", "y"):
        z = k2_columns(F.col("n"), F.col(f"_s{tag}"), F.col(f"_k{tag}"))
        m = m.withColumn(f"p_{tag}", F.when(small, F.lit(1.0)).otherwise(F.exp(-z["k2"] / 2.0)))
        m = m.withColumn(f"n{tag}", F.coalesce(F.col(f"p_{tag}") > alpha, F.lit(False)))
    pe = with_r_pvalue(m.withColumn("r", F.col("r_p"))).withColumnRenamed("p_value", "pv_p").drop("r")
    sp = spearman(d, x, y, keys).select(*keys, F.col("r").alias("r_s"), F.col("p_value").alias("pv_s"))
    j = _join_all([pe, sp], keys)
    use_p = F.col("nx") & F.col("ny")
    j = (j.withColumn("method", F.when(use_p, F.lit("pearson")).otherwise(F.lit("spearman")))
          .withColumn("r", F.when(use_p, F.col("r_p")).otherwise(F.col("r_s")))
          .withColumn("p_value", F.when(use_p, F.col("pv_p")).otherwise(F.col("pv_s"))))
    lo, hi = fisher_ci(F.col("r"), F.col("n"))
    return j.select(*keys, "method", F.col("n").cast("long").alias("n"), "r", "p_value", "p_x", "p_y",
                    lo.alias("ci_lo"), hi.alias("ci_hi"),
                    correlation_strength(F.col("r")).alias("strength"),
                    (F.col("p_value") < alpha).alias("significant"))


def _join_all(frames, keys):
    out = frames[0]
    for f in frames[1:]:
        out = same_keys(out, f, keys)
    return out


def correlation_matrix(df: DataFrame, cols: Sequence[str], method: str = "spearman", keys=()) -> DataFrame:
    """Long ``(keys, col_i, col_j, r)``; Spearman by ranked margins."""
    keys = _keys(keys)
    cols = list(cols)
    if method == "pearson":
        aggs = [safe_corr(a, b).alias(f"_r_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
        wide = df.groupBy(*keys).agg(*aggs)
    else:
        d = clean_numeric(df.select(*keys, *cols), cols)
        ranked = d
        for c in cols:
            rk = average_ranks(d, c, keys, out=f"_rk_{c}").drop("cnt")
            ranked = same_keys(ranked, rk, keys + [c])
        ranked = ranked.select(*keys, *[F.col(f"_rk_{c}").alias(c) for c in cols])
        aggs = [safe_corr(a, b).alias(f"_r_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
        wide = ranked.groupBy(*keys).agg(*aggs)
    entries = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = F.lit(1.0) if i == j else F.col(f"_r_{min(i, j)}_{max(i, j)}")
            entries.append(F.struct(F.lit(a).alias("col_i"), F.lit(b).alias("col_j"), v.alias("r")))
    return wide.select(*keys, F.explode(F.array(*entries)).alias("e")).select(*keys, "e.*")


# ---- A12: Kolmogorov-Smirnov against a normal --------------------------------------

def ks_test_norm(df: DataFrame, col: str, keys=(), mu: float | None = None,
                 sigma: float | None = None) -> DataFrame:
    """Two-sided one-sample KS against N(μ, σ); μ, σ default to the MLE
    (mean, population σ) per key.  ECDF steps come from distributed
    prefix counts of the distinct values, so no group is sorted in one task.
    ``(keys, n, mu, sigma, d_stat, p_value)`` (asymptotic p)."""
    from statlake.operators.ranks import keyed_prefix, value_cells
    keys = _keys(keys)
    d = clean_numeric(df.select(*keys, col), [col])
    fit = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                               (F.avg(col) if mu is None else F.lit(float(mu))).alias("mu"),
                               (F.stddev_pop(col) if sigma is None else F.lit(float(sigma))).alias("sigma"))
    cells = keyed_prefix(value_cells(d, col, keys), keys, [col], "cnt")
    j = same_keys(cells, fit, keys)
    # a constant group has no spread: its D stays null
    j = j.withColumn("_f", norm_cdf(div(F.col(col) - F.col("mu"), F.col("sigma"))))
    dd = j.groupBy(*keys).agg(
        F.first("n").alias("n"), F.first("mu").alias("mu"), F.first("sigma").alias("sigma"),
        F.max(F.greatest((F.col("before") + F.col("cnt")) / F.col("n") - F.col("_f"),
                         F.col("_f") - F.col("before") / F.col("n"))).alias("d_stat"))
    sq = F.sqrt(F.col("n").cast("double"))
    lam = (sq + 0.12 + 0.11 / sq) * F.col("d_stat")
    return dd.withColumn("p_value", special.kolmogorov_sf_udf(lam))


# ---- A13, A16, A17: regression summaries -------------------------------------------

def ols(df: DataFrame, y: str, xs: Sequence[str], keys=()) -> DataFrame:
    """OLS with intercept from one Gram aggregate per key; small solve per
    key in ``mapInPandas``.  Long ``(keys, term, coef, stderr)`` plus
    ``r2``, ``n``, ``sigma2`` on every row."""
    import numpy as np
    from statlake.operators.moments import gram_agg, gram_from_row, map_gram_rows, ols_gram
    keys = _keys(keys)
    cols = list(xs) + [y]
    d = clean_numeric(df.select(*keys, *cols), cols)
    g = gram_agg(d, cols, keys)
    p = len(xs)

    def fit(row):
        n, m, c = gram_from_row(row, cols)
        beta, ssr, inv, _ = ols_gram(n, m, c, range(p), p)
        sst = c[p, p]
        dof = n - (p + 1)
        s2 = ssr / dof if dof > 0 else float("nan")
        se = np.sqrt(np.maximum(np.diag(inv) * s2, 0))
        r2 = 1 - ssr / sst if sst > 0 else float("nan")
        names = ["const"] + list(xs)
        return [{**{k: row[k] for k in keys}, "term": names[i], "coef": float(beta[i]),
                 "stderr": float(se[i]), "r2": r2, "n": int(n), "sigma2": s2} for i in range(p + 1)]

    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in g.schema.fields if f.name in keys)
    schema = (kschema + ", " if kschema else "") + "term string, coef double, stderr double, r2 double, n long, sigma2 double"
    return map_gram_rows(g, fit, schema)


def linear_fit(df: DataFrame, x: str, y: str, keys=()) -> DataFrame:
    """Slope and intercept per key (``regr_slope``/``regr_intercept``)."""
    keys = _keys(keys)
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                                 F.regr_count(y, x).alias("n"))


def fit_metrics(df: DataFrame, y: str, yhat: str, keys=()) -> DataFrame:
    """RMSE and R² (R² null when the target is constant)."""
    keys = _keys(keys)
    df = clean_numeric(df.select(*keys, y, yhat), [y, yhat])
    m = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                              F.sum((F.col(y) - F.col(yhat)) ** 2).alias("sse"),
                              F.var_pop(y).alias("_vp"))
    return m.select(*keys, "n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
                    (1 - div(F.col("sse"), F.col("_vp") * F.col("n"))).alias("r2"))


# ---- A14: one-way ANOVA -------------------------------------------------------------

def anova_oneway(df: DataFrame, group: str, value: str, keys=()) -> DataFrame:
    """``(keys, k, n, ss_between, ss_within, f_stat, p_value)`` from per-group
    (n, mean, variance), centred at both steps: group means are taken about
    their average, so a large common mean costs no digits.  Null, NaN and
    infinite values take no part; F is null where a divisor is 0."""
    keys = _keys(keys)
    d = clean_numeric(df.select(*keys, group, value), [value])
    g = d.groupBy(*keys, group).agg(F.count(value).alias("_n"), F.avg(value).alias("_m"), F.var_pop(value).alias("_v"))
    g = same_keys(g, g.groupBy(*keys).agg(F.avg("_m").alias("_c")), keys)
    off = F.col("_m") - F.col("_c")
    t = g.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("n"),
                             F.sum(F.col("_n") * F.col("_v")).alias("_w"), F.sum(F.col("_n") * off).alias("_1"),
                             F.sum(F.col("_n") * off * off).alias("_2"))
    ssb = F.col("_2") - F.col("_1") * F.col("_1") / F.col("n")
    ssw = F.col("_w")
    f = div(div(ssb, F.col("k") - 1), div(ssw, F.col("n") - F.col("k")))
    out = t.select(*keys, "k", "n", ssb.alias("ss_between"), ssw.alias("ss_within"), f.alias("f_stat"))
    return out.withColumn("p_value", special.f_sf_udf(F.col("f_stat"), F.col("k") - 1.0, F.col("n") - F.col("k") * 1.0))


# ---- A15: skewness, kurtosis, Jarque-Bera ---------------------------------------------

def jarque_bera(df: DataFrame, col: str, keys=()) -> DataFrame:
    """``(keys, n, skew, kurtosis, jb, p_value)``; kurtosis is Pearson (normal = 3)."""
    keys = _keys(keys)
    m = clean_numeric(df.select(*keys, col), [col]).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.skewness(col).alias("skew"), (F.kurtosis(col) + 3.0).alias("kurtosis"))
    jb = F.col("n") / 6.0 * (F.col("skew") ** 2 + (F.col("kurtosis") - 3.0) ** 2 / 4.0)
    return m.withColumn("jb", jb).withColumn("p_value", F.exp(-F.col("jb") / 2.0))


# ---- A18, A20, A21 --------------------------------------------------------------------

def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def group_means(df: DataFrame, label: str, cols: Sequence[str], keys=()) -> DataFrame:
    keys = _keys(keys)
    return df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in cols])


def hamming_diversity(df: DataFrame, bits: str, keys=()) -> DataFrame:
    """Mean over loci of 2p(1−p) for an array<int> of 0/1 bits per row."""
    keys = _keys(keys)
    per_locus = (df.select(*keys, F.posexplode(bits).alias("pos", "bit"))
                   .groupBy(*keys, "pos").agg(F.avg("bit").alias("p")))
    return per_locus.groupBy(*keys).agg(F.avg(2.0 * F.col("p") * (1.0 - F.col("p"))).alias("diversity"),
                                        F.count(F.lit(1)).alias("loci"))


# ---- A7: Kendall tau-b (no pair enumeration) ------------------------------------------

def weighted_inversions(y, w) -> int:
    """Σ_{i<j, y_i > y_j} w_i·w_j for a sequence (bottom-up merge sort,
    vectorised per level: O(m log² m), exact integer result)."""
    import numpy as np
    y = np.asarray(y)
    w = np.asarray(w, dtype=np.int64)
    m = len(y)
    if m < 2:
        return 0
    _, y = np.unique(y, return_inverse=True)
    y = y.astype(np.int64)
    span = int(y.max()) + 1
    total = 0
    idx = np.arange(m)
    width = 1
    while width < m:
        run = idx // width
        pair = run // 2
        right = (run % 2) == 1
        left = ~right
        lkey = pair[left] * span + y[left]
        lw = w[left]
        cum = np.concatenate([[0], np.cumsum(lw)])
        lpair = pair[left]
        # left weight per pair and the cumulative offset where each pair starts
        n_pairs = int(pair.max()) + 1
        pair_tot = np.bincount(lpair, weights=lw, minlength=n_pairs).astype(np.int64)
        pair_start = np.concatenate([[0], np.cumsum(pair_tot)])[:-1]
        rp = pair[right]
        pos = np.searchsorted(lkey, rp * span + y[right], side="right")
        le = cum[pos] - pair_start[rp]  # left weight with y <= y_r in the same pair
        above = pair_tot[rp] - le
        total += int(np.sum((w[right] * above).astype(object)))
        order = np.lexsort((y, pair))
        y, w = y[order], w[order]
        width *= 2
    return total


PAIR_ROWS = 250_000  # cells that one Python task counts at a time


def _discordant(cells: DataFrame, keys: list[str], x: str, y: str, w: str, buckets: int | None,
                depth: int = 0) -> DataFrame:
    """``(keys, d)`` = Σ w_a·w_b over cell pairs with (x_a, y_a) < (x_b, y_b)
    lexicographically and y_a > y_b, per key (cells unique per key).

    Cells are cut into x-blocks (ranges of (x, y)) and y-buckets (ranges of
    (y, x-block)); pairs inside a block or a bucket are counted locally by a
    merge count, and pairs across both are exactly the same problem on the
    (x-block, y-bucket) histogram, which is solved by recursion."""
    from statlake.operators.ranks import MAX_BUCKETS, ROWS_PER_BUCKET, _bucket_expr, _range_buckets, plan_bounds
    import decimal
    import math as _m
    kschema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.schema.fields if f.name in keys)
    ks = (kschema + ", " if kschema else "")

    def local(sort_cols):
        def fn(pdf):
            import pandas as pd
            pdf = pdf.sort_values(sort_cols, kind="mergesort")
            v = weighted_inversions(pdf[y].to_numpy(), pdf[w].to_numpy())
            out = {kk: [pdf.iloc[0][kk]] for kk in keys}
            out["d"] = [decimal.Decimal(int(v))]
            return pd.DataFrame(out)
        return fn

    per = min(PAIR_ROWS, ROWS_PER_BUCKET)
    bx, n_est = ([], 0) if buckets == 1 else plan_bounds(cells, keys + [x, y], buckets, 17 + depth, True, per)
    want = buckets or _m.ceil(n_est / per)
    if want <= 1:
        grp = cells.groupBy(*keys) if keys else cells.groupBy()
        return grp.applyInPandas(local([x, y]), ks + "d decimal(38,0)")
    if buckets == -1 or want > MAX_BUCKETS:
        c = _range_buckets(cells, keys + [x, y], max(2, want)).withColumnRenamed("_bkt", "_xb")
        c = _range_buckets(c, keys + [y, "_xb"], max(2, want)).withColumnRenamed("_bkt", "_yb")
    else:
        c = cells.withColumn("_xb", _bucket_expr(keys + [x, y], bx) if bx else F.lit(0))
        by = plan_bounds(c, keys + [y, "_xb"], len(bx) + 1, 29 + depth) if bx else []
        c = c.withColumn("_yb", _bucket_expr(keys + [y, "_xb"], by) if by else F.lit(0))
    d1 = c.groupBy(*keys, "_xb").applyInPandas(local([x, y]), ks + "d decimal(38,0)")
    d2 = c.groupBy(*keys, "_yb").applyInPandas(local(["_xb", y]), ks + "d decimal(38,0)")
    hist = c.groupBy(*keys, "_xb", "_yb").agg(F.sum(w).alias("h"))
    # pairs in different x-blocks and different y-buckets: same problem on the histogram
    d3 = _discordant(hist.withColumnRenamed("_xb", "hx").withColumnRenamed("_yb", "hy"), keys, "hx", "hy", "h",
                     None if buckets in (None, -1) else 1, depth + 1)
    return d1.unionByName(d2).unionByName(d3).groupBy(*keys).agg(F.sum("d").cast("decimal(38,0)").alias("d"))


def kendall_tau_b(df: DataFrame, x: str, y: str, keys=(), buckets: int | None = None) -> DataFrame:
    """``(keys, n, concordant, discordant, tau_b, z, p_value)`` (z and p from
    the tie-corrected normal approximation of S = C − D).

    Pairs are never formed.  Rows collapse to weighted (x, y) cells; tie
    counts come from the margins; discordant pairs are the weighted strict
    inversions of y in (x, y) order, split three ways over range buckets
    taken from a bounded sample: inside one x-block (local merge count),
    across x-blocks inside one y-bucket (local merge count) and across
    both (the same problem on the block × bucket histogram, recursively).
    Every group is bounded by the bucket size, so a hot key or value never
    lands whole in one task.  ``buckets=-1`` forces the range-partitioner
    path used for very large inputs."""
    keys = _keys(keys)
    d = _pair_clean(df, x, y, keys)
    cells = d.groupBy(*keys, x, y).agg(F.count(F.lit(1)).alias("w"))
    disc = _discordant(cells, keys, x, y, "w", buckets).withColumnRenamed("d", "discordant")

    def pairs(w):  # w(w−1)/2 exactly; a decimal holds the pairs of more than 3e9 rows
        half = w % 2 == 0
        a = F.when(half, F.shiftright(w, 1)).otherwise(w).cast("decimal(19,0)")
        b = F.when(half, w - 1).otherwise(F.shiftright(w - 1, 1)).cast("decimal(19,0)")
        return (a * b).cast("decimal(38,0)")

    def ties(col, tag):
        t = F.col("t").cast("double")
        return cells.groupBy(*keys, col).agg(F.sum("w").alias("t")).groupBy(*keys).agg(
            F.sum(pairs(F.col("t"))).cast("decimal(38,0)").alias(f"n{tag}"), F.sum(t * (t - 1) * (2 * t + 5)).alias(f"_v{tag}"),
            F.sum(t * (t - 1)).alias(f"_a{tag}"), F.sum(t * (t - 1) * (t - 2)).alias(f"_b{tag}"))
    tx = ties(x, "1")
    ty = ties(y, "2")
    tot = cells.groupBy(*keys).agg(F.sum("w").alias("n"), F.sum(pairs(F.col("w"))).cast("decimal(38,0)").alias("n3"))
    j = _join_all([tot, tx, ty, disc], keys)
    n0 = pairs(F.col("n"))
    conc = n0 - F.col("n1") - F.col("n2") + F.col("n3") - F.col("discordant")
    j = j.withColumn("concordant", conc.cast("decimal(38,0)"))
    s = (F.col("concordant") - F.col("discordant")).cast("double")
    tau = div(s, F.sqrt((n0 - F.col("n1")).cast("double") * (n0 - F.col("n2")).cast("double")))
    # tie-corrected variance of S = C − D (normal approximation)
    n = F.col("n").cast("double")
    var = ((n * (n - 1) * (2 * n + 5) - F.col("_v1") - F.col("_v2")) / 18.0
           + div(F.col("_a1") * F.col("_a2"), 2.0 * n * (n - 1))
           + div(F.col("_b1") * F.col("_b2"), 9.0 * n * (n - 1) * (n - 2)))
    z = F.when((n > 2) & (var > 0), s / F.sqrt(var))
    j = j.withColumn("z", z).withColumn("p_value", F.when(F.col("z").isNotNull(), 2.0 * norm_cdf(-F.abs(F.col("z")))))
    return j.select(*keys, F.col("n").cast("long").alias("n"), "concordant", "discordant", tau.alias("tau_b"), "z", "p_value")
