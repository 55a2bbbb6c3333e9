import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from statlake.operators import ranks, stats


def test_covariance_4x3_closed_form(spark):
    rows = [(1.0, 2.0, 3.0), (2.0, 3.0, 5.0), (3.0, 4.0, 7.0), (2.0, 4.0, 6.0)]
    df = spark.createDataFrame(rows, ["c1", "c2", "c3"])
    got = {(r.col_i, r.col_j): r.cov for r in stats.covariance_matrix(df, ["c1", "c2", "c3"]).collect()}
    x = np.array(rows)
    exp = np.cov(x.T, ddof=1)
    for i, a in enumerate(["c1", "c2", "c3"]):
        for j, b in enumerate(["c1", "c2", "c3"]):
            assert math.isclose(got[(a, b)], exp[i, j], abs_tol=1e-12)
            assert got[(a, b)] == got[(b, a)]


def test_spearman_with_ties_matches_pandas(spark):
    # fixed ranked pairs with ties
    x = [1, 1, 2, 3, 3, 4, 5, 5, 6]
    y = [2, 3, 1, 2, 4, 5, 4, 6, 7]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], ["x", "y"])
    r = stats.spearman(df, "x", "y").first()["r"]
    assert math.isclose(r, 0.817028674, abs_tol=1e-8)
    assert math.isclose(r, pd.Series(x).rank().corr(pd.Series(y).rank()), abs_tol=1e-12)


def test_kendall_tau_b_fixture(spark):
    x = [1, 1, 2, 3, 3, 4, 5, 5, 6]
    y = [2, 3, 1, 2, 4, 5, 4, 6, 7]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], ["x", "y"])
    for buckets in (1, 3):
        r = stats.kendall_tau_b(df, "x", "y", buckets=buckets).first()
        assert r["concordant"] == 27 and r["discordant"] == 4
        assert math.isclose(r["tau_b"], 0.686643649, abs_tol=1e-8)


def test_kendall_matches_bruteforce(spark):
    rng = np.random.default_rng(3)
    n = 400
    x = rng.integers(0, 30, n).astype(float)
    y = (x + rng.integers(0, 25, n)).astype(float)
    k = rng.choice(["p", "q"], n)
    pdf = pd.DataFrame({"k": k, "x": x, "y": y})
    got = stats.kendall_tau_b(spark.createDataFrame(pdf), "x", "y", keys=["k"], buckets=4).toPandas().set_index("k")
    big = stats.kendall_tau_b(spark.createDataFrame(pdf), "x", "y", keys=["k"], buckets=-1).toPandas().set_index("k")
    for key, g in pdf.groupby("k"):
        assert big.loc[key, "discordant"] == got.loc[key, "discordant"]
        a, b = g["x"].to_numpy(), g["y"].to_numpy()
        sx = np.sign(a[:, None] - a[None, :])
        sy = np.sign(b[:, None] - b[None, :])
        c = int(((sx * sy) > 0).sum() // 2)
        d = int(((sx * sy) < 0).sum() // 2)
        assert got.loc[key, "concordant"] == c and got.loc[key, "discordant"] == d


def test_normality_small_sample_is_normal(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 5, 2, 8, 3]], ["v"])
    r = stats.normality_k2(df, "v").first()
    assert r["is_normal"] and r["p_value"] == 1.0


def test_normality_drops_nan_and_inf(spark):
    vals = [float(v) for v in range(1, 40)] + [float("nan"), float("inf")]
    df = spark.createDataFrame([(v,) for v in vals], ["v"])
    assert stats.normality_k2(df, "v").first()["n"] == 39


def test_jarque_bera_relation(spark):
    rng = np.random.default_rng(0)
    v = rng.standard_t(3, 99)
    df = spark.createDataFrame([(float(a),) for a in v], ["v"])
    r = stats.jarque_bera(df, "v").first()
    assert math.isclose(r["jb"], 99 / 6 * (r["skew"] ** 2 + (r["kurtosis"] - 3) ** 2 / 4), rel_tol=1e-12)


def test_ols_recovers_plane(spark):
    df = spark.range(200).select((F.col("id") / 10.0).alias("x1"), F.sin("id").alias("x2"))
    df = df.withColumn("y", 3.0 + 2.0 * F.col("x1") - 1.5 * F.col("x2"))
    got = {r.term: r.coef for r in stats.ols(df, "y", ["x1", "x2"]).collect()}
    assert math.isclose(got["const"], 3.0, abs_tol=1e-9) and math.isclose(got["x1"], 2.0, abs_tol=1e-9)
    assert math.isclose(got["x2"], -1.5, abs_tol=1e-9)


def test_spearman_shared_plan_many_buckets(spark, monkeypatch):
    from statlake.operators import ranks
    monkeypatch.setattr(ranks, "ROWS_PER_BUCKET", 40)
    rng = np.random.default_rng(9)
    n = 2000
    pdf = pd.DataFrame({"k": rng.choice(["a", "b"], n, p=[0.8, 0.2]),
                        "x": rng.integers(0, 60, n).astype(float), "y": rng.normal(size=n).round(2)})
    got = stats.spearman(spark.createDataFrame(pdf), "x", "y", ["k"]).toPandas().set_index("k")
    for key, g in pdf.groupby("k"):
        exp = g["x"].rank().corr(g["y"].rank())
        assert math.isclose(got.loc[key, "r"], exp, abs_tol=1e-10)


def test_kendall_counts_in_small_pieces(spark, monkeypatch):
    rng = random.Random(5)
    rows = [("a" if i % 3 else "b", rng.randrange(40), rng.randrange(40)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, x long, y long")
    monkeypatch.setattr(stats, "PAIR_ROWS", 50)
    most, bounds = [], ranks.plan_bounds

    def spy(*a, **k):
        most.append(a[5] if len(a) > 5 else k.get("per_bucket"))
        return bounds(*a, **k)
    monkeypatch.setattr(ranks, "plan_bounds", spy)
    got = {r["g"]: (int(r["concordant"]), int(r["discordant"])) for r in stats.kendall_tau_b(df, "x", "y", ["g"]).collect()}
    assert 50 in most
    for g in "ab":
        p = [(x, y) for k, x, y in rows if k == g]
        s = [(a[0] - b[0]) * (a[1] - b[1]) for i, a in enumerate(p) for b in p[:i]]
        assert got[g] == (sum(v > 0 for v in s), sum(v < 0 for v in s))
