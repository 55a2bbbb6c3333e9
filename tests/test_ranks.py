import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from statlake.operators.ranks import average_ranks, cumulative_share, exact_quantiles, keyed_prefix


def _frame(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1]),
                        "v": rng.integers(0, 200, n).astype(float)})
    return spark.createDataFrame(pdf), pdf


def test_keyed_prefix_multi_bucket_matches_bruteforce(spark):
    df, pdf = _frame(spark)
    cells = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("w"))
    for buckets in (1, 7):
        got = keyed_prefix(cells, ["k"], ["v"], "w", buckets=buckets).toPandas()
        c = pdf.groupby(["k", "v"]).size().rename("w").reset_index().sort_values(["k", "v"])
        c["exp"] = c.groupby("k")["w"].cumsum() - c["w"]
        m = got.merge(c, on=["k", "v"])
        assert len(m) == len(c)
        assert (m["before"] == m["exp"]).all()


def test_average_ranks_match_pandas(spark):
    df, pdf = _frame(spark)
    got = average_ranks(df, "v", ["k"], buckets=5).toPandas()
    pdf["r"] = pdf.groupby("k")["v"].rank(method="average")
    exp = pdf.groupby(["k", "v"])["r"].first().reset_index()
    m = got.merge(exp, on=["k", "v"])
    assert np.allclose(m["rank"], m["r"])


def test_exact_quantiles_match_numpy(spark):
    df, pdf = _frame(spark)
    qs = [0.0, 0.1, 0.33, 0.5, 0.66, 0.99, 1.0]
    got = exact_quantiles(df, "v", qs, ["k"], buckets=4).toPandas()
    for _, r in got.iterrows():
        exp = np.quantile(pdf.loc[pdf.k == r["k"], "v"], r["q"])
        assert abs(r["quantile"] - exp) < 1e-9


def test_cumulative_share_closes_at_one(spark):
    df = spark.range(500).withColumn("w", (F.col("id") % 7 + 1).cast("double"))
    out = cumulative_share(df, "w", ["id"], buckets=3).orderBy("id").toPandas()
    assert out["cum_hi"].iloc[-1] == 1.0
    assert np.allclose(out["cum_lo"].iloc[1:].to_numpy(), out["cum_hi"].iloc[:-1].to_numpy())


def test_partition_invariance(spark):
    df, _ = _frame(spark)
    a = average_ranks(df.repartition(1), "v", ["k"]).orderBy("k", "v").toPandas()
    b = average_ranks(df.repartition(8), "v", ["k"], buckets=3).orderBy("k", "v").toPandas()
    assert a.equals(b)


def test_range_partitioner_path_matches(spark):
    df, pdf = _frame(spark)
    cells = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("w"))
    got = keyed_prefix(cells, ["k"], ["v"], "w", buckets=-1).toPandas()
    c = pdf.groupby(["k", "v"]).size().rename("w").reset_index().sort_values(["k", "v"])
    c["exp"] = c.groupby("k")["w"].cumsum() - c["w"]
    m = got.merge(c, on=["k", "v"])
    assert len(m) == len(c) and (m["before"] == m["exp"]).all()


def test_null_keys_rank_without_error(spark):
    rows = [(None if i % 7 == 0 else ("a" if i % 2 else "b"), float(i % 13)) for i in range(700)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = average_ranks(df, "v", ["k"], buckets=6).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "v"]).dropna(subset=["k"])
    pdf["r"] = pdf.groupby("k")["v"].rank(method="average")
    exp = pdf.groupby(["k", "v"])["r"].first().reset_index()
    m = got.dropna(subset=["k"]).merge(exp, on=["k", "v"])
    assert len(m) == len(exp) and np.allclose(m["rank"], m["r"])
    nulls = got[got["k"].isna()].sort_values("v")
    raw = pd.DataFrame(rows, columns=["k", "v"])
    nv = raw[raw["k"].isna()]["v"]
    assert len(nulls) == nv.nunique()
    exp_null = nv.rank(method="average").groupby(nv).first()
    assert np.allclose(nulls.set_index("v")["rank"].sort_index(), exp_null.sort_index())


def test_cumulative_share_null_key_group(spark):
    rows = [(None if i < 5 else "a", i, 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, id long, w double")
    out = cumulative_share(df, "w", ["id"], ["k"], buckets=2).toPandas()
    assert len(out) == 10
    assert sorted(out[out["k"].isna()]["cum_hi"].round(9)) == [0.2, 0.4, 0.6, 0.8, 1.0]
