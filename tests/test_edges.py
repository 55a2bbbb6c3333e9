import math

import numpy as np
from pyspark.sql import functions as F

from statlake.operators import econ, learn, stats, tstests


def test_constant_column_is_not_normal_and_has_null_r(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(20)], ["c", "v"])
    n = stats.normality_k2(df, "c").first()
    assert n["is_normal"] is False
    r = stats.auto_correlation(df, "c", "v").first()
    assert r["r"] is None and r["strength"] is None


def test_single_row_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0)], ["k", "x", "y"])
    r = stats.auto_correlation(df, "x", "y", ["k"]).first()
    assert r["n"] == 1 and r["method"] in ("pearson", "spearman")
    d = stats.describe(df, ["x"], ["k"]).first()
    assert d["n"] == 1 and d["std"] is None


def test_nan_and_inf_dropped_pairwise(spark):
    rows = [(float(i), float(2 * i)) for i in range(30)] + [(float("nan"), 1.0), (1.0, float("inf")), (None, 2.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    p = stats.pearson(df, "x", "y").first()
    assert p["n"] == 30 and math.isclose(p["r"], 1.0)


def test_payback_non_viable(spark):
    df = spark.createDataFrame([(1000.0, 10.0, 0.1, 5.0)], ["capex", "kwh", "tariff", "opex"])
    r = econ.payback(df, "capex", "kwh", "tariff", "opex").first()
    assert r["annual_saving"] < 0 and not r["is_viable"] and r["payback_class"] == "slow"


def test_log_gate_with_negative_values(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=60).cumsum()
    df = spark.createDataFrame([("k", i, float(x)) for i, x in enumerate(v)], "k string, t long, value double")
    r = tstests.stationarize(df, ["k"], "t", "value").first()
    assert r["log_applied"] is False


def test_confusion_matrix_keeps_empty_cells(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "a"), ("b", "a")], ["label", "pred"])
    cm = {(r["label"], r["pred"]): r["n"] for r in learn.confusion_matrix(df, "label", "pred").collect()}
    assert cm == {("a", "a"): 2, ("a", "b"): 0, ("b", "a"): 1, ("b", "b"): 0}
    rep = {r["label"]: r for r in learn.classification_report(df, "label", "pred").collect()}
    assert rep["b"]["precision"] == 0.0 and rep["b"]["f1"] == 0.0


def test_flagship_partition_invariance(spark):
    from statlake.sources.tables import table
    li = table(spark, "/root/testdata/sf0.001", "lineitem")
    a = stats.auto_correlation(li.repartition(1), "l_quantity", "l_extendedprice", ["l_returnflag"])
    b = stats.auto_correlation(li.repartition(7), "l_quantity", "l_extendedprice", ["l_returnflag"])
    ra = {r["l_returnflag"]: (r["method"], round(r["r"], 12)) for r in a.collect()}
    rb = {r["l_returnflag"]: (r["method"], round(r["r"], 12)) for r in b.collect()}
    assert ra == rb


def test_kendall_single_bucket_equals_many(spark):
    from statlake.sources.tables import table
    ev = table(spark, "/root/testdata/sf0.001", "events").select("event_type", F.col("user_id").cast("double").alias("u"), "value")
    a = {r["event_type"]: (r["concordant"], r["discordant"]) for r in stats.kendall_tau_b(ev, "u", "value", ["event_type"], buckets=1).collect()}
    b = {r["event_type"]: (r["concordant"], r["discordant"]) for r in stats.kendall_tau_b(ev, "u", "value", ["event_type"], buckets=6).collect()}
    assert a == b
