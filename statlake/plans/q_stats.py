"""Registered queries: descriptive statistics, correlation and tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators import stats
from statlake.plans.common import rnd
from statlake.plans.registry import register
from statlake.plans.sqlfrag import avg_rank_sql, finite, k2_sql, norm_cdf_sql, strength_sql
from statlake.sources.tables import table


def _corr_choice_sql(tbl: str, key: str, x: str, y: str) -> str:
    return f"""
WITH d AS (SELECT {key} AS k, {x} AS x, {y} AS y FROM {tbl} WHERE {finite(x, y)}),
mu AS (SELECT k, count(*) AS n, avg(x) AS mx, avg(y) AS my FROM d GROUP BY k),
cm AS (SELECT d.k, any_value(n) AS n,
              avg(power(x-mx,2)) AS m2x, avg(power(x-mx,3)) AS m3x, avg(power(x-mx,4)) AS m4x,
              avg(power(y-my,2)) AS m2y, avg(power(y-my,3)) AS m3y, avg(power(y-my,4)) AS m4y,
              corr(x, y) AS r_p
       FROM d JOIN mu USING (k) GROUP BY d.k),
nt AS (SELECT k, n, r_p,
              CASE WHEN n < 8 THEN 1.0 ELSE exp(-{k2_sql('n', 'm3x/power(m2x,1.5)', 'm4x/(m2x*m2x)')}/2) END AS p_x,
              CASE WHEN n < 8 THEN 1.0 ELSE exp(-{k2_sql('n', 'm3y/power(m2y,1.5)', 'm4y/(m2y*m2y)')}/2) END AS p_y
       FROM cm),
rk AS (SELECT k, {avg_rank_sql('k', 'x')} AS rx, {avg_rank_sql('k', 'y')} AS ry FROM d),
sp AS (SELECT k, corr(rx, ry) AS r_s FROM rk GROUP BY k),
ch AS (SELECT nt.k, n, p_x, p_y,
              CASE WHEN coalesce(p_x > 0.05, false) AND coalesce(p_y > 0.05, false) THEN 'pearson' ELSE 'spearman' END AS method,
              CASE WHEN coalesce(p_x > 0.05, false) AND coalesce(p_y > 0.05, false) THEN r_p ELSE r_s END AS r
       FROM nt JOIN sp USING (k))
SELECT k AS {key}, method, n::BIGINT AS n, round(r, 6) AS r, round(p_x, 6) AS p_x, round(p_y, 6) AS p_y,
       round(CASE WHEN n > 3 THEN tanh(atanh(r) - 1.96/sqrt(n-3.0)) END, 6) AS ci_lo,
       round(CASE WHEN n > 3 THEN tanh(atanh(r) + 1.96/sqrt(n-3.0)) END, 6) AS ci_hi,
       {strength_sql('r')} AS strength,
       abs(r) * sqrt((n - 2) / (1 - r * r)) > 1.959964 AS significant
FROM ch"""


def _corr_choice(spark, sf, tbl, key, x, y):
    out = stats.auto_correlation(table(spark, sf, tbl), x, y, keys=[key])
    return out.select(key, "method", "n", rnd("r").alias("r"), rnd("p_x").alias("p_x"),
                      rnd("p_y").alias("p_y"), rnd("ci_lo").alias("ci_lo"), rnd("ci_hi").alias("ci_hi"),
                      "strength", "significant")


@register("corr_choice_lineitem",
          _corr_choice_sql("lineitem", "l_returnflag", "l_quantity", "l_extendedprice"))
def corr_choice_lineitem(spark, sf):
    """A10 (flagship): normality-gated Pearson/Spearman per return flag."""
    return _corr_choice(spark, sf, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice")


@register("corr_choice_events",
          _corr_choice_sql("events", "event_type", "user_id", "value"))
def corr_choice_events(spark, sf):
    """A10 on events: user id vs value per event type."""
    return _corr_choice(spark, sf, "events", "event_type", "user_id", "value")


# ---- A1 / A11 / A19 -------------------------------------------------------------------

_LI_SMALL = ["l_quantity", "l_discount", "l_tax"]


@register("describe_lineitem", " UNION ALL ".join(
    f"""SELECT l_returnflag, '{c}' AS "column", count({c})::BIGINT AS n, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(stddev_pop({c}), 6) AS std_pop, round(var_pop({c}), 6) AS var_pop,
       round(min({c})::DOUBLE, 6) AS min, round(max({c})::DOUBLE, 6) AS max FROM lineitem GROUP BY l_returnflag"""
    for c in _LI_SMALL))
def describe_lineitem(spark, sf):
    """Count, mean, σ (ddof 1 and 0), variance, range per flag."""
    d = stats.describe(table(spark, sf, "lineitem"), _LI_SMALL, keys=["l_returnflag"])
    return d.select("l_returnflag", "column", F.col("n").cast("long").alias("n"),
                    *[rnd(c).alias(c) for c in ["mean", "std", "std_pop", "var_pop", "min", "max"]])


_QS = [0.1, 0.25, 0.33, 0.5, 0.66, 0.75, 0.9]


@register("quantiles_lineitem", " UNION ALL ".join(
    f"SELECT l_returnflag, {q}::DOUBLE AS q, round(quantile_cont(l_extendedprice, {q}), 4) AS quantile "
    f"FROM lineitem GROUP BY l_returnflag" for q in _QS))
def quantiles_lineitem(spark, sf):
    """A2: exact linear-interpolated quantiles of price per flag."""
    q = stats.quantiles(table(spark, sf, "lineitem"), "l_extendedprice", _QS, keys=["l_returnflag"])
    return q.select("l_returnflag", "q", rnd("quantile", 4).alias("quantile"))


@register("covariance_lineitem", " UNION ALL ".join(
    f"SELECT l_linestatus, '{a}' AS col_i, '{b}' AS col_j, round(covar_samp({a}, {b}), 6) AS cov "
    f"FROM lineitem GROUP BY l_linestatus" for a in _LI_SMALL for b in _LI_SMALL))
def covariance_lineitem(spark, sf):
    """A3: sample covariance matrix (long form) per line status."""
    c = stats.covariance_matrix(table(spark, sf, "lineitem"), _LI_SMALL, keys=["l_linestatus"])
    return c.select("l_linestatus", "col_i", "col_j", rnd("cov").alias("cov"))


@register("pearson_fisher_part", """
WITH d AS (SELECT p_type, count(*) AS n, corr(p_size, p_retailprice) AS r FROM part
           WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL GROUP BY p_type)
SELECT p_type, n::BIGINT AS n, round(r, 6) AS r,
       round(CASE WHEN n > 3 THEN tanh(atanh(r) - 1.96/sqrt(n-3.0)) END, 6) AS ci_lo,
       round(CASE WHEN n > 3 THEN tanh(atanh(r) + 1.96/sqrt(n-3.0)) END, 6) AS ci_hi FROM d""")
def pearson_fisher_part(spark, sf):
    """A4 + A5: Pearson r with Fisher-z interval, size vs retail price per type."""
    from statlake.functions.exprs import fisher_ci
    p = stats.pearson(table(spark, sf, "part").withColumn("p_size", F.col("p_size").cast("double")),
                      "p_size", "p_retailprice", keys=["p_type"])
    lo, hi = fisher_ci(F.col("r"), F.col("n"))
    return p.select("p_type", F.col("n").cast("long").alias("n"), rnd("r").alias("r"),
                    rnd(lo).alias("ci_lo"), rnd(hi).alias("ci_hi"))


@register("spearman_lineitem", f"""
WITH rk AS (SELECT l_linestatus, {avg_rank_sql('l_linestatus', 'l_discount')} AS rx,
                   {avg_rank_sql('l_linestatus', 'l_tax')} AS ry FROM lineitem)
SELECT l_linestatus, count(*)::BIGINT AS n, round(corr(rx, ry), 6) AS r FROM rk GROUP BY l_linestatus""")
def spearman_lineitem(spark, sf):
    """Spearman ρ with averaged ties (discount vs tax) per line status."""
    s = stats.spearman(table(spark, sf, "lineitem"), "l_discount", "l_tax", keys=["l_linestatus"])
    return s.select("l_linestatus", F.col("n").cast("long").alias("n"), rnd("r").alias("r"))


def _normality_sql(tbl, key, col):
    return f"""
WITH d AS (SELECT {key} AS k, {col}::DOUBLE AS x FROM {tbl} WHERE {finite(col)}),
mu AS (SELECT k, count(*) AS n, avg(x) AS m FROM d GROUP BY k),
cm AS (SELECT d.k, any_value(n) AS n, avg(power(x-m,2)) AS m2, avg(power(x-m,3)) AS m3, avg(power(x-m,4)) AS m4
       FROM d JOIN mu USING (k) GROUP BY d.k),
z AS (SELECT k, n, m3/power(m2,1.5) AS skew, m4/(m2*m2) AS kurt,
             CASE WHEN n >= 8 THEN {k2_sql('n', 'm3/power(m2,1.5)', 'm4/(m2*m2)')} END AS k2 FROM cm)
SELECT k AS {key}, n::BIGINT AS n, round(skew, 6) AS skew, round(kurt, 6) AS kurtosis, round(k2, 4) AS k2,
       round(CASE WHEN n < 8 THEN 1.0 ELSE exp(-k2/2) END, 6) AS p_value,
       coalesce(CASE WHEN n < 8 THEN 1.0 ELSE exp(-k2/2) END > 0.05, false) AS is_normal FROM z"""


def _normality(spark, sf, tbl, key, col):
    n = stats.normality_k2(table(spark, sf, tbl).withColumn(col, F.col(col).cast("double")), col, keys=[key])
    return n.select(key, F.col("n").cast("long").alias("n"), rnd("skew").alias("skew"),
                    rnd("kurtosis").alias("kurtosis"), rnd("k2", 4).alias("k2"),
                    rnd("p_value").alias("p_value"), "is_normal")


@register("normality_orders", _normality_sql("orders", "o_orderpriority", "o_totalprice"))
def normality_orders(spark, sf):
    """D'Agostino–Pearson K² of order totals per priority."""
    return _normality(spark, sf, "orders", "o_orderpriority", "o_totalprice")


@register("normality_events", _normality_sql("events", "event_type", "value"))
def normality_events(spark, sf):
    """A9 on event values per type."""
    return _normality(spark, sf, "events", "event_type", "value")


@register("jarque_bera_orders", """
WITH mu AS (SELECT o_orderpriority AS k, count(*) AS n, avg(o_totalprice) AS m FROM orders GROUP BY 1),
cm AS (SELECT k, any_value(n) AS n, avg(power(o_totalprice-m,2)) AS m2, avg(power(o_totalprice-m,3)) AS m3,
              avg(power(o_totalprice-m,4)) AS m4 FROM orders JOIN mu ON o_orderpriority = k GROUP BY k),
z AS (SELECT k, n, m3/power(m2,1.5) AS s, m4/(m2*m2) AS ku FROM cm)
SELECT k AS o_orderpriority, n::BIGINT AS n, round(s, 6) AS skew, round(ku, 6) AS kurtosis,
       round(n/6.0*(s*s + (ku-3)*(ku-3)/4.0), 6) AS jb, round(exp(-(n/6.0*(s*s + (ku-3)*(ku-3)/4.0))/2), 6) AS p_value
FROM z""")
def jarque_bera_orders(spark, sf):
    """Skewness, Pearson kurtosis and Jarque–Bera per priority."""
    j = stats.jarque_bera(table(spark, sf, "orders"), "o_totalprice", keys=["o_orderpriority"])
    return j.select("o_orderpriority", F.col("n").cast("long").alias("n"), rnd("skew").alias("skew"),
                    rnd("kurtosis").alias("kurtosis"), rnd("jb").alias("jb"), rnd("p_value").alias("p_value"))


@register("ols_lineitem", """
WITH m AS (SELECT l_returnflag AS k, avg(l_discount) AS m1, avg(l_tax) AS m2, avg(l_quantity) AS my, count(*) AS n
           FROM lineitem GROUP BY 1),
s AS (SELECT k, any_value(n) AS n, any_value(m1) AS m1, any_value(m2) AS m2, any_value(my) AS my,
             sum((l_discount-m1)*(l_discount-m1)) AS s11, sum((l_tax-m2)*(l_tax-m2)) AS s22,
             sum((l_discount-m1)*(l_tax-m2)) AS s12, sum((l_discount-m1)*(l_quantity-my)) AS s1y,
             sum((l_tax-m2)*(l_quantity-my)) AS s2y, sum((l_quantity-my)*(l_quantity-my)) AS syy
      FROM lineitem JOIN m ON l_returnflag = k GROUP BY k),
b AS (SELECT *, (s22*s1y - s12*s2y)/(s11*s22 - s12*s12) AS b1, (s11*s2y - s12*s1y)/(s11*s22 - s12*s12) AS b2 FROM s),
f AS (SELECT *, my - b1*m1 - b2*m2 AS b0, 1 - (syy - b1*s1y - b2*s2y)/syy AS r2 FROM b)
SELECT k AS l_returnflag, t.term, round(t.coef, 6) AS coef, round(r2, 6) AS r2, n::BIGINT AS n
FROM f, LATERAL (SELECT unnest(['const', 'l_discount', 'l_tax']) AS term, unnest([b0, b1, b2]) AS coef) t""")
def ols_lineitem(spark, sf):
    """OLS quantity ~ discount + tax per flag from one Gram aggregate."""
    o = stats.ols(table(spark, sf, "lineitem"), "l_quantity", ["l_discount", "l_tax"], keys=["l_returnflag"])
    return o.select("l_returnflag", "term", rnd("coef").alias("coef"), rnd("r2").alias("r2"),
                    F.col("n").cast("long").alias("n"))


@register("anova_lineitem", """
WITH g AS (SELECT l_linestatus, l_returnflag, count(l_quantity) AS n, avg(l_quantity) AS m,
                  var_pop(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
c AS (SELECT l_linestatus, sum(n*m)/sum(n) AS c FROM g GROUP BY 1),
t AS (SELECT l_linestatus, count(*) AS k, sum(n) AS n, sum(n*(m - c)*(m - c)) AS b, sum(n*v) AS w
      FROM g JOIN c USING (l_linestatus) GROUP BY 1)
SELECT l_linestatus, k::BIGINT AS k, n::BIGINT AS n, round(b, 4) AS ss_between, round(w, 4) AS ss_within,
       round((b/(k-1)) / (w/(n-k)), 6) AS f_stat FROM t""")
def anova_lineitem(spark, sf):
    """One-way ANOVA of quantity across return flags, per line status."""
    a = stats.anova_oneway(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity", keys=["l_linestatus"])
    return a.select("l_linestatus", F.col("k").cast("long").alias("k"), F.col("n").cast("long").alias("n"),
                    rnd("ss_between", 4).alias("ss_between"), rnd("ss_within", 4).alias("ss_within"),
                    rnd("f_stat").alias("f_stat"))


@register("linear_fit_part", """
SELECT p_type, round(regr_slope(p_retailprice, p_size), 6) AS slope,
       round(regr_intercept(p_retailprice, p_size), 4) AS intercept, regr_count(p_retailprice, p_size)::BIGINT AS n
FROM part GROUP BY p_type""")
def linear_fit_part(spark, sf):
    """Least-squares line of retail price on size per type."""
    p = table(spark, sf, "part").withColumn("p_size", F.col("p_size").cast("double"))
    l = stats.linear_fit(p, "p_size", "p_retailprice", keys=["p_type"])
    return l.select("p_type", rnd("slope").alias("slope"), rnd("intercept", 4).alias("intercept"),
                    F.col("n").cast("long").alias("n"))


@register("fit_metrics_lineitem", """
WITH f AS (SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS b,
                  regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem GROUP BY 1),
p AS (SELECT l.l_returnflag, l_extendedprice AS y, a + b*l_quantity AS yhat FROM lineitem l JOIN f USING (l_returnflag))
SELECT l_returnflag, count(*)::BIGINT AS n, round(sqrt(sum((y-yhat)*(y-yhat))/count(*)), 4) AS rmse,
       round(1 - sum((y-yhat)*(y-yhat))/(var_pop(y)*count(*)), 6) AS r2 FROM p GROUP BY 1""")
def fit_metrics_lineitem(spark, sf):
    """A16 + A17: per-flag line fit, then RMSE and R² of its predictions."""
    li = table(spark, sf, "lineitem")
    line = stats.linear_fit(li, "l_quantity", "l_extendedprice", keys=["l_returnflag"])
    pred = li.join(line, "l_returnflag").withColumn(
        "yhat", F.col("intercept") + F.col("slope") * F.col("l_quantity"))
    m = stats.fit_metrics(pred, "l_extendedprice", "yhat", keys=["l_returnflag"])
    return m.select("l_returnflag", F.col("n").cast("long").alias("n"), rnd("rmse", 4).alias("rmse"),
                    rnd("r2").alias("r2"))


@register("value_counts_lineitem", """
SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2""")
def value_counts_lineitem(spark, sf):
    """Counts per cell."""
    return stats.value_counts(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@register("group_means_lineitem", """
SELECT l_returnflag, count(*)::BIGINT AS n, round(avg(l_quantity), 6) AS mean_l_quantity,
       round(avg(l_discount), 6) AS mean_l_discount FROM lineitem GROUP BY 1""")
def group_means_lineitem(spark, sf):
    """Class means."""
    g = stats.group_means(table(spark, sf, "lineitem"), "l_returnflag", ["l_quantity", "l_discount"])
    return g.select("l_returnflag", "n", rnd("mean_l_quantity").alias("mean_l_quantity"),
                    rnd("mean_l_discount").alias("mean_l_discount"))


@register("hamming_diversity_embeddings", """
WITH b AS (SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding) AS v FROM embeddings),
p AS (SELECT label, pos, avg(CASE WHEN v > 0 THEN 1 ELSE 0 END) AS p FROM b GROUP BY 1, 2)
SELECT label, round(avg(2*p*(1-p)), 10) AS diversity, count(*)::BIGINT AS loci FROM p GROUP BY 1""")
def hamming_diversity_embeddings(spark, sf):
    """Mean locus diversity 2p(1−p) of the sign bits of each embedding, per label."""
    e = table(spark, sf, "embeddings").select(
        "label", F.transform("embedding", lambda v: F.when(v > 0, 1).otherwise(0)).alias("bits"))
    h = stats.hamming_diversity(e, "bits", keys=["label"])
    # mean of 2p(1-p) over 64 loci is an exact short decimal: round past it
    return h.select("label", rnd("diversity", 10).alias("diversity"), F.col("loci").cast("long").alias("loci"))


@register("ks_norm_events", f"""
WITH v AS (SELECT event_type, value AS x FROM events WHERE value IS NOT NULL AND isfinite(value)),
f AS (SELECT event_type, count(*) AS n, avg(x) AS mu, stddev_pop(x) AS sd FROM v GROUP BY 1),
c AS (SELECT event_type, x, count(*) AS cnt FROM v GROUP BY 1, 2),
b AS (SELECT c.event_type, n, (x - mu) / sd AS z, cnt,
             coalesce(sum(cnt) OVER (PARTITION BY c.event_type ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM c JOIN f USING (event_type)),
e AS (SELECT event_type, n, cnt, before, {norm_cdf_sql('z')} AS p FROM b),
d AS (SELECT event_type, any_value(n) AS n, max(greatest((before + cnt)::DOUBLE / n - p, p - before::DOUBLE / n)) AS d FROM e GROUP BY 1),
l AS (SELECT *, (sqrt(n) + 0.12 + 0.11 / sqrt(n)) * d AS lam FROM d)
SELECT event_type, n::BIGINT AS n, round(d, 6) AS d_stat,
       round(least(greatest(2.0 * list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END
             * exp(-2.0 * k * k * lam * lam))), 0.0), 1.0), 6) AS p_value FROM l""")
def ks_norm_events(spark, sf):
    """KS distance of event values to a fitted normal per type (asymptotic p)."""
    k = stats.ks_test_norm(table(spark, sf, "events"), "value", keys=["event_type"])
    return k.select("event_type", F.col("n").cast("long").alias("n"), rnd("d_stat").alias("d_stat"),
                    rnd("p_value").alias("p_value"))


@register("correlation_matrix_lineitem", "WITH rk AS (SELECT l_linestatus, " + ", ".join(
    f"{avg_rank_sql('l_linestatus', c)} AS r_{c}" for c in _LI_SMALL) + " FROM lineitem) " + " UNION ALL ".join(
    [f"""SELECT l_linestatus, '{a}' AS col_i, '{b}' AS col_j,
        round({'1.0' if a == b else f'corr(r_{a}, r_{b})'}, 6) AS r FROM rk GROUP BY l_linestatus"""
     for a in _LI_SMALL for b in _LI_SMALL]))
def correlation_matrix_lineitem(spark, sf):
    """Spearman correlation matrix per line status (long form)."""
    c = stats.correlation_matrix(table(spark, sf, "lineitem"), _LI_SMALL, "spearman", keys=["l_linestatus"])
    return c.select("l_linestatus", "col_i", "col_j", rnd("r").alias("r"))


def _kendall_sql(tbl, key, x, y):
    return f"""
WITH c AS (SELECT {key} AS k, {x}::DOUBLE AS x, {y}::DOUBLE AS y, count(*) AS w FROM {tbl}
           WHERE {finite(x, y)} GROUP BY 1, 2, 3),
p AS (SELECT a.k, sum(CASE WHEN a.y < b.y THEN a.w*b.w ELSE 0 END) AS conc,
             sum(CASE WHEN a.y > b.y THEN a.w*b.w ELSE 0 END) AS disc
      FROM c a JOIN c b ON a.k = b.k AND a.x < b.x GROUP BY a.k),
tx AS (SELECT k, sum(t*(t-1)/2) AS n1, sum(t*(t-1)*(2*t+5)) AS v1, sum(t*(t-1)) AS a1, sum(t*(t-1)*(t-2)) AS b1
       FROM (SELECT k, x, sum(w)::DOUBLE AS t FROM c GROUP BY 1, 2) GROUP BY k),
ty AS (SELECT k, sum(t*(t-1)/2) AS n2, sum(t*(t-1)*(2*t+5)) AS v2, sum(t*(t-1)) AS a2, sum(t*(t-1)*(t-2)) AS b2
       FROM (SELECT k, y, sum(w)::DOUBLE AS t FROM c GROUP BY 1, 2) GROUP BY k),
t AS (SELECT k, sum(w)::DOUBLE AS n FROM c GROUP BY k)
SELECT t.k AS {key}, n::BIGINT AS n, conc::BIGINT AS concordant, disc::BIGINT AS discordant,
       round((conc - disc) / sqrt((n*(n-1)/2 - n1) * (n*(n-1)/2 - n2)), 6) AS tau_b,
       round((conc - disc) / sqrt((n*(n-1)*(2*n+5) - v1 - v2)/18.0 + a1*a2/(2.0*n*(n-1)) + b1*b2/(9.0*n*(n-1)*(n-2))), 6) AS z
FROM t JOIN p USING (k) JOIN tx USING (k) JOIN ty USING (k)"""


def _kendall(spark, sf, tbl, key, x, y):
    d = table(spark, sf, tbl).select(key, F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y))
    k = stats.kendall_tau_b(d, x, y, keys=[key])
    return k.select(key, "n", "concordant", "discordant", rnd("tau_b").alias("tau_b"), rnd("z").alias("z"))


@register("kendall_lineitem", _kendall_sql("lineitem", "l_linestatus", "l_quantity", "l_discount"))
def kendall_lineitem(spark, sf):
    """Kendall τ-b (heavy ties) of quantity vs discount per line status."""
    return _kendall(spark, sf, "lineitem", "l_linestatus", "l_quantity", "l_discount")


@register("kendall_events", _kendall_sql("events", "event_type", "user_id", "value"))
def kendall_events(spark, sf):
    """Kendall τ-b of user id vs value per event type (few ties)."""
    return _kendall(spark, sf, "events", "event_type", "user_id", "value")
