"""Large means, constant and one-row groups, null keys, NaN rows: no group is
lost and no group fails the others."""

import math

import numpy as np
import pytest

from statlake.functions.safe import norm_cdf
from statlake.operators import cluster, fits, learn, ranks, sampling, select, stats, tstests, windows
from pyspark.sql import functions as F


def _anova(v, g):
    groups = [v[g == k] for k in np.unique(g)]
    m = v.mean()
    b = sum(len(x) * (x.mean() - m) ** 2 for x in groups)
    w = sum(((x - x.mean()) ** 2).sum() for x in groups)
    return b, w, (b / (len(groups) - 1)) / (w / (len(v) - len(groups)))


def test_anova_and_f_scores_at_a_large_mean(spark):
    r = np.random.default_rng(0)
    v, g = r.normal(size=300), r.integers(0, 3, 300)
    rows = [("a", int(k), float(x) + 1e9, 5.0) for k, x in zip(g, v)] + [("const", k % 2, 3.0, 5.0) for k in range(6)]
    rows += [("a", 0, float("nan"), 5.0), ("a", 1, None, 5.0), (None, 0, 1.0, 5.0), (None, 1, 2.0, 5.0), ("one", 0, 1.0, 5.0)]
    df = spark.createDataFrame(rows, "kk string, g int, x double, c double")
    out = {x["kk"]: x for x in stats.anova_oneway(df, "g", "x", ["kk"]).collect()}
    b, w, f = _anova(v + 1e9 - 1e9, g)
    a = out["a"]
    assert a["n"] == 300 and abs(a["ss_within"] - w) < 1e-3 and abs(a["ss_between"] - b) < 1e-3 and abs(a["f_stat"] - f) < 1e-4
    assert out["const"]["f_stat"] is None and out["one"]["f_stat"] is None and set(out) == {"a", "const", None, "one"}
    s = {x["feature"]: x["f_stat"] for x in select.f_scores(df.filter("kk = 'a'"), ["x", "c"], "g").collect()}
    assert abs(s["x"] - f) < 1e-4 and s["c"] is None


def test_ols_and_class_moments_at_a_large_mean(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=200)
    y = 2 * x + r.normal(size=200) * 0.1
    df = spark.createDataFrame([(float(a) + 1e8, float(b) + 1e9, int(i % 2)) for i, (a, b) in enumerate(zip(x, y))], "x double, y double, c int")
    o = {t["term"]: t for t in stats.ols(df, "y", ["x"]).collect()}
    slope = np.polyfit(x, y, 1)[0]
    assert abs(o["x"]["coef"] - slope) < 1e-4 and 0.99 < o["x"]["r2"] <= 1
    n, m, c = learn.class_moments(df, "c", ["x", "y"])[0]
    xs = np.column_stack([x, y])[::2]
    assert n == 100 and np.allclose(c, (xs - xs.mean(0)).T @ (xs - xs.mean(0)), rtol=1e-4, atol=1e-3)


def test_wide_moments_and_predictions_match_the_narrow_path(spark, monkeypatch):
    r = np.random.default_rng(2)
    rows = [(int(i % 3), *[float(v) for v in r.normal(size=5) + i % 3]) for i in range(150)]
    cols = [f"x{i}" for i in range(5)]
    df = spark.createDataFrame(rows, "c int, " + ", ".join(f"{c} double" for c in cols))
    a = learn.lda_fit(df, "c", cols)
    pa = learn.lda_predict(df, a, cols).collect()
    monkeypatch.setattr(learn, "WIDE", 1)
    b = learn.lda_fit(df, "c", cols)
    assert np.allclose(a["cov"], b["cov"])
    assert [x["pred"] for x in pa] == [x["pred"] for x in learn.lda_predict(df, b, cols).collect()]
    centers = [[float(k)] * 5 for k in range(3)]
    near = cluster.nearest_center(df, cols, centers).collect()
    wide = cluster._nearest_wide(df, cols, centers, "cluster", "sqdist").collect()
    assert [(x["cluster"], round(x["sqdist"], 9)) for x in near] == [(x["cluster"], round(x["sqdist"], 9)) for x in wide]


def test_null_keys_keep_their_groups(spark):
    rows = [(k, float(i), float((i * 7) % 11)) for k in ("a", None) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    assert {r["k"] for r in ranks.exact_quantiles(df, "x", [0.5], ["k"]).collect()} == {"a", None}
    for out in (stats.spearman(df, "x", "y", ["k"]), stats.kendall_tau_b(df, "x", "y", ["k"]), stats.ks_test_norm(df, "x", ["k"]),
                stats.auto_correlation(df, "x", "y", ["k"])):
        assert {r["k"] for r in out.collect()} == {"a", None}
    p = sampling.selection_probabilities(df, "x", "x", ["k"]).collect()
    assert len(p) == 40 and all(abs(sum(r["p_rank"] for r in p if r["k"] == k) - 1) < 1e-9 for k in ("a", None))
    lab = spark.createDataFrame([(i, None if i % 4 == 0 else "x") for i in range(40)], "id long, c string")
    assert learn.stratified_split(lab, "c", "id").count() == 40 and learn.stratified_folds(lab, "c", "id").count() == 40
    w = windows.path_length(df.withColumn("s", F.col("x")), "k", "s", ["x"])
    assert {r["k"] for r in w.collect()} == {"a", None}


def test_kendall_counts_are_exact_and_small_groups_have_no_p(spark):
    df = spark.createDataFrame([("two", 1.0, 1.0), ("two", 2.0, 2.0), ("one", 1.0, 1.0)], "k string, x double, y double")
    out = {r["k"]: r for r in stats.kendall_tau_b(df, "x", "y", ["k"]).collect()}
    assert out["two"]["p_value"] is None and out["one"]["p_value"] is None and out["two"]["concordant"] == 1
    big = spark.range(3).selectExpr("cast(id as double) x", "cast(id as double) y", "4000000000 as w")
    n0 = big.selectExpr("sum(w) as n").first()["n"]
    assert n0 * (n0 - 1) // 2 > 2 ** 63
    w = F.col("w")
    a = F.when(w % 2 == 0, F.shiftright(w, 1)).otherwise(w).cast("decimal(19,0)")
    b = F.when(w % 2 == 0, w - 1).otherwise(F.shiftright(w - 1, 1)).cast("decimal(19,0)")
    assert int(big.select((a * b).alias("p")).first()["p"]) == 4000000000 * 3999999999 // 2


def test_constant_series_and_short_series(spark):
    rows = [("const", i, 5.0) for i in range(40)] + [("short", i, float(i)) for i in range(2)]
    r = np.random.default_rng(3)
    rows += [("walk", i, float(v)) for i, v in enumerate(r.normal(size=120).cumsum())]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    a = {x["k"]: x for x in tstests.adf(df, ["k"], "t", "v").collect()}
    assert a["const"]["p_value"] is None and a["const"]["error"] == "constant series" and a["short"]["error"]
    assert a["walk"]["error"] is None and 0 <= a["walk"]["p_value"] <= 1
    c = tstests.acf(df, ["k"], "t", "v", 3).collect()
    assert {x["lag"]: x["acf"] for x in c if x["k"] == "const"} == {0: 1.0, 1: None, 2: None, 3: None}
    assert {x["k"] for x in tstests.ljung_box(df, ["k"], "t", "v", 3).collect()} == {"const", "short", "walk"}


def test_adf_long_series_has_no_lag_cap(spark):
    r = np.random.default_rng(4)
    n = 20_000
    v = r.normal(size=n).cumsum()
    got = tstests.adf(spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "t long, v double"), [], "t", "v").first()
    ml = math.ceil(12 * (n / 100) ** 0.25)
    dy = np.diff(v)

    def reg(lag, first):
        y = dy[first:]
        x = np.column_stack([np.ones(len(y)), v[first:-1], *[dy[first - j:len(dy) - j] for j in range(1, lag + 1)]])
        beta = np.linalg.lstsq(x, y, rcond=None)[0]
        ssr = ((y - x @ beta) ** 2).sum()
        return y, x, beta, ssr
    best = min(range(ml + 1), key=lambda lag: len(dy[ml:]) * math.log(reg(lag, ml)[3] / len(dy[ml:])) + 2 * (lag + 2))
    y, x, beta, ssr = reg(best, best)
    se = math.sqrt(ssr / (len(y) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    assert got["used_lag"] == best and got["nobs"] == len(y) and abs(got["adf_stat"] - beta[1] / se) < 1e-6


def test_silhouette_of_coincident_points_and_standardised_constants(spark):
    from statlake.functions.exprs import standardize
    df = spark.createDataFrame([(0, 1.0, 2.0)] * 3 + [(1, 1.0, 2.0)] * 3 + [(2, 5.0, 5.0)], "g int, x double, y double")
    s = {r["g"]: r["silhouette"] for r in cluster.silhouette_sq(df, ["x", "y"], "g").collect()}
    assert s["0"] == 0.0 and s["2"] == 0.0
    assert cluster.silhouette_sq(df.filter("g = 0"), ["x", "y"], "g").count() == 2
    assert {r["x"] for r in standardize(df.filter("g = 0"), ["x"]).collect()} == {0.0}


def test_one_row_groups_in_selection(spark):
    df = spark.createDataFrame([("a", 1, 3.0), ("b", 1, 2.0), ("b", 2, 4.0)], "k string, id long, f double")
    p = {(r["k"], r["id"]): r["p"] for r in sampling.rank_linear(df, "f", "id", ["k"]).collect()}
    assert p["a", 1] == 1.0 and abs(p["b", 1] + p["b", 2] - 1) < 1e-12


def test_cumulative_share_closes_at_one(spark):
    r = np.random.default_rng(5)
    df = spark.createDataFrame([(k, i, float(w)) for k in ("a", None) for i, w in enumerate(r.random(3000))], "k string, id long, w double")
    c = ranks.cumulative_share(df, "w", ["id"], ["k"])
    tops = c.filter("cum_hi = 1.0").groupBy("k").agg(F.max("id").alias("id")).collect()
    assert {(x["k"], x["id"]) for x in tops} == {("a", 2999), (None, 2999)}


@pytest.mark.parametrize("buckets", [None, 1, 64])
def test_weighted_sample_draws_all(spark, buckets):
    r = np.random.default_rng(6)
    w = r.random(500) ** 3
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(w)] + [(900, 0.0), (901, None), (902, float("nan"))], "id long, w double")
    n = 20_000
    got = sampling.weighted_sample(df, "w", "id", n, seed=3, buckets=buckets).toPandas()
    assert len(got) == n and got.draw.nunique() == n and got.id.max() < 500
    share = got.groupby("id").size().reindex(range(500), fill_value=0) / n
    assert np.abs(share - w / w.sum()).max() < 0.005


def test_fits_drop_unusable_rows(spark):
    rows = [(float(g), 3 * (1 - math.exp(-0.5 * g)) + 1) for g in np.linspace(0.1, 8, 60)] + [(float("nan"), 1.0), (2.0, float("inf")), (None, 2.0)]
    df = spark.createDataFrame(rows, "g double, y double")
    theta = fits.levenberg_marquardt(df, fits.saturating, "y", ["g"], [1.0, 1.0, 0.5])["theta"]
    assert np.allclose(theta, [3, 0.5, 1], atol=1e-3)
    m = stats.fit_metrics(df.withColumn("f", F.col("y")), "y", "f").first()
    assert m["n"] == 62 and m["rmse"] == 0.0


def test_normal_cdf_column(spark):
    z = [-40.0, -8.0, -7.1, -3.0, -0.5, 0.0, 0.5, 3.0, 8.0, 40.0]
    got = [r["p"] for r in spark.createDataFrame([(x,) for x in z], "z double").select("z", norm_cdf(F.col("z")).alias("p")).orderBy("z").collect()]
    assert np.allclose(got, [0.5 * math.erfc(-x / math.sqrt(2)) for x in sorted(z)], rtol=1e-9, atol=1e-14)


def test_weighted_sample_reaches_tiny_weights_beside_a_large_one(spark):
    """Many weights next to one that holds nearly all, and draws finer than 2^-28."""
    df = spark.range(3000).select("id", F.when(F.col("id") == 1500, 1e6).otherwise(1.0).alias("w"))
    got = sampling.weighted_sample(df, "w", "id", 4000, seed=5, buckets=8).toPandas()
    w = np.where(np.arange(3000) == 1500, 1e6, 1.0)
    hi = np.cumsum(w) / w.sum()
    u = np.array([r["u"] for r in spark.range(4000).select("id", sampling.uniform(5, "id").alias("u")).orderBy("id").collect()])
    want = np.searchsorted(hi, u, side="right")
    assert len(got) == 4000 and (got.sort_values("draw")["id"].to_numpy() == want).mean() > 0.999
    scaled = u * 2 ** 28
    assert (scaled != np.floor(scaled)).all()
