import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from statlake.functions.exprs import payback_class, clip, correlation_strength
from statlake.operators import cluster, fits, learn, sampling, text
from statlake.sources import synthetic

# The six-sentence Ukrainian corpus of the text example
CORPUS_6 = [
    "Машинне навчання допомагає будувати моделі та робити прогнози.",
    "Глибоке навчання використовує нейронні мережі для складних задач.",
    "Оптимізація параметрів покращує якість моделі і узагальнення.",
    "Нейронні мережі та регуляризація зменшують перенавчання.",
    "Відбір ознак і нормалізація впливають на стабільність і точність.",
    "Енсамблеві методи, як випадковий ліс, підвищують надійність.",
]


def test_payback_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (5.1,), (8.0,), (9.0,)], ["y"])
    got = [r[0] for r in df.select(payback_class("y")).collect()]
    assert got == [None, "fast", "mid", "mid", "slow"]


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.5,), (3.0,)], "v double")
    assert [r[0] for r in df.select(clip("v", 0.0, 1.0)).collect()] == [None, 0.0, 0.5, 1.0]


def test_strength_labels(spark):
    df = spark.createDataFrame([(0.1,), (-0.45,), (0.8,)], ["r"])
    assert [r[0] for r in df.select(correlation_strength("r")).collect()] == [
        "very weak positive", "moderate negative", "very strong positive"]


def test_tfidf_rows_unit_norm_and_cyrillic(spark):
    df = spark.createDataFrame(list(enumerate(CORPUS_6)), "doc_id long, text string")
    t = text.tfidf(df, "text", "doc_id").toPandas()
    norms = t.groupby("doc_id")["tfidf"].apply(lambda s: float(np.sqrt((s ** 2).sum())))
    assert np.allclose(norms, 1.0)
    assert "узагальнення" in set(t["term"]) and "і" not in set(t["term"])
    z = text.zipf_table(df, "text", "doc_id").orderBy("rank").toPandas()
    assert z["rank"].tolist() == list(range(1, len(z) + 1))
    assert (z["count"].diff().dropna() <= 0).all()


def test_selection_probabilities_sum_to_one(spark):
    df = spark.range(50).select(F.col("id"), (F.col("id") % 17 + 1.0).alias("f"))
    for frame in (sampling.proportional(df, "f"), sampling.rank_linear(df, "f", "id"),
                  sampling.tournament(df, "f", "id", 3), sampling.tournament(df, "f", "id", 3, replacement=False),
                  sampling.threshold(df, "f", 0.8)):
        assert math.isclose(frame.agg(F.sum("p")).first()[0], 1.0, rel_tol=1e-9)


def test_weighted_sample_shares(spark):
    df = spark.range(5).select("id", (F.col("id") + 1.0).alias("w"))
    draws = sampling.weighted_sample(df, "w", "id", 20000, seed=3, buckets=16)
    assert draws.count() == 20000
    share = {r["id"]: r["count"] / 20000 for r in draws.groupBy("id").count().collect()}
    for i in range(5):
        assert abs(share[i] - (i + 1) / 15) < 0.02


def test_lm_recovers_planted_curve(spark):
    df = synthetic.exp_curve(spark, 80, 2.0, 0.8, 0.5, noise=0.0)
    res = fits.levenberg_marquardt(df, fits.exp_curve, "y", ["t"], [1.0, 0.5, 0.0])
    assert np.allclose(res["theta"], [2.0, 0.8, 0.5], atol=1e-4)


def test_gradient_methods_reach_ols(spark):
    df = spark.range(300).select((F.col("id") / 300.0).alias("x1"))
    df = df.withColumn("y", 1.0 + 2.0 * F.col("x1"))
    model = lambda p, x: p[0] + p[1] * x["x1"]
    res = fits.cg_fit(df, model, "y", ["x1"], [0.0, 0.0], rules=("pr+", "fr"), max_iter=60)
    for th, _ in res.values():
        assert np.allclose(th, [1.0, 2.0], atol=1e-2)


def test_blobs_kmeans_and_silhouette(spark):
    df = synthetic.blobs(spark, [[0, 0], [8, 8], [0, 8]], 60, 0.5, seed=1)
    centers, cost = cluster.kmeans(df, ["x0", "x1"], 3, n_init=2)
    lab = cluster.nearest_center(df, ["x0", "x1"], centers)
    sizes = sorted(r["count"] for r in lab.groupBy("cluster").count().collect())
    assert sizes == [60, 60, 60]
    sil = cluster.silhouette_sq(lab, ["x0", "x1"], "cluster").filter(F.col("cluster") == "__all__").first()
    assert sil["silhouette"] > 0.9


def test_stratified_split_shares(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("label"))
    s = learn.stratified_split(df, "label", "id", 0.25).groupBy("label").agg(F.sum(F.col("is_test").cast("int")).alias("t"),
                                                                            F.count("*").alias("n")).collect()
    for r in s:
        assert abs(r["t"] - 0.25 * r["n"]) <= 1
    f = learn.stratified_folds(df, "label", "id", 5)
    assert f.select("fold").distinct().count() == 5


def test_som_fits_and_does_not_depend_on_partitions(spark):
    df = synthetic.blobs(spark, [[0, 0], [5, 5]], 100, 0.5, seed=2)
    w, hist = cluster.som_fit(df, ["x0", "x1"], 3, 3, epochs=6)
    # the start is a sample of the rows, so the error begins low and stays below the blobs' own variance
    assert len(hist) == 6 and hist[-1] < 2 * 0.5 ** 2
    again, _ = cluster.som_fit(df.repartition(7), ["x0", "x1"], 3, 3, epochs=6)
    assert abs(w - again).max() < 1e-9


def test_tournament_draws_follow_closed_form(spark):
    df = spark.range(10).select("id", (F.col("id") * 1.0).alias("f"))
    draws = sampling.tournament_draws(df, "f", "id", 3, 30000, seed=1)
    share = {r["id"]: r["count"] / 30000 for r in draws.groupBy("id").count().collect()}
    for r in range(1, 11):
        expect = (r ** 3 - (r - 1) ** 3) / 1000
        assert abs(share.get(r - 1, 0.0) - expect) < 0.01


def test_affine_models_read_the_rows_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 2))
    y = 5.0 + x @ [2.0, -1.0] + rng.normal(scale=0.3, size=300)
    df = spark.createDataFrame([(float(c), *map(float, r)) for c, r in zip(y, x)], "y double, x1 double, x2 double").repartition(40)

    def model(p, x):
        return p[0] + p[1] * x["x1"] + p[2] * x["x2"]
    model.np = model
    methods = {"gd": ("gd", 0.1), "adam": ("adam", 0.2)}
    slow = fits.gradient_fit(df, model, "y", ["x1", "x2"], [0.0] * 3, methods=methods, max_iter=12)
    slow_cg = fits.cg_fit(df, model, "y", ["x1", "x2"], [0.0] * 3, rules=("pr+", "fr"), max_iter=4)
    model.affine = True
    monkeypatch.setattr(fits, "_normal_eq_many", None)  # no pass a step
    fast = fits.gradient_fit(df, model, "y", ["x1", "x2"], [0.0] * 3, methods=methods, max_iter=12)
    fast_cg = fits.cg_fit(df, model, "y", ["x1", "x2"], [0.0] * 3, rules=("pr+", "fr"), max_iter=4)
    for a, b in ((slow, fast), (slow_cg, fast_cg)):
        for k in a:
            assert np.allclose(a[k][0], b[k][0], atol=1e-6) and np.allclose(a[k][1], b[k][1], atol=1e-6)


def test_wide_discriminant_on_empty_partitions(spark):
    rng = np.random.default_rng(1)
    cols = [f"x{i}" for i in range(20)]
    rows = [(i % 2, *map(float, rng.normal(i % 2, 1, size=20))) for i in range(60)]
    df = spark.createDataFrame(rows, "grp long, " + ", ".join(f"{c} double" for c in cols)).repartition(16, "grp")
    m = learn.lda_fit(df, "grp", cols, shrinkage="auto")
    assert m["classes"] == [0, 1] and learn.lda_predict(df, m, cols).filter("grp = pred").count() > 50


def test_grid_cuts_the_deepest_tree(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(240, 3))
    y = (x[:, 0] * x[:, 1] + 0.3 * x[:, 2] + rng.normal(scale=0.4, size=240) > 0).astype(float)
    df = learn.assemble(spark.createDataFrame([(*map(float, r), float(v), i % 3) for i, (r, v) in enumerate(zip(x, y))],
                                              "a double, b double, c double, label_idx double, fold int").coalesce(1), ["a", "b", "c"]).cache()
    grid = {"impurity": ["gini", "entropy"], "maxDepth": [8, 1, 3], "minInstancesPerNode": [1, 6]}
    fit, fits_ = learn.decision_tree, []
    monkeypatch.setattr(learn, "decision_tree", lambda *a, **k: fits_.append(1) or fit(*a, **k))
    got = learn.grid_search(df, grid=grid, folds=3)
    assert len(fits_) == 3 * 2 * 2 + 1
    truth = [learn.cross_val_score(df, lambda tr: fit(tr, max_depth=d, min_leaf=m, impurity=i), k=3)[0]  # noqa: B023
             for i in ("entropy", "gini") for d in grid["maxDepth"] for m in grid["minInstancesPerNode"]]
    assert got.avgMetrics == pytest.approx(truth)
    df.unpersist()


def test_lloyd_runs_together(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.6, size=(40, 3)) for c in (0.0, 2.0, 4.0)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").repartition(5)
    starts = [x[:2], x[[0, 50, 100]], np.vstack([x[:2], [[99.0, 99.0, 99.0]]])]
    for start, (centres, cost) in zip(starts, cluster._lloyd(df, ["a", "b", "c"], starts, 300, 1e-4)):
        c = start.copy()
        for _ in range(300):
            d = ((x[:, None] - c) ** 2).sum(2)
            own = d.argmin(1)
            new = np.array([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
            still, c = (((new - c) ** 2).sum(1) <= 1e-8).all(), new
            if still:
                break
        assert np.allclose(centres, c) and cost == pytest.approx(d.min(1).sum())


def test_tfidf_shuffles_twice_and_adds_up_repeated_ids(spark):
    rows = [(1, "aa bb aa"), (1, "bb cc"), (2, None), (None, "aa dd"), (3, "")]
    d = text.tfidf(spark.createDataFrame(rows, "doc_id long, text string"), "text", "doc_id")
    got = {(r["doc_id"], r["term"]): (r["tf"], r["df"]) for r in d.collect()}
    assert got == {(1, "aa"): (2, 2), (1, "bb"): (2, 1), (1, "cc"): (1, 1), (None, "aa"): (1, 2), (None, "dd"): (1, 1)}
    for doc in (1, None):
        w = {t: got[doc, t][0] * (np.log(6 / (1 + got[doc, t][1])) + 1) for k, t in got if k == doc}
        norm = sum(v * v for v in w.values()) ** 0.5
        for r in d.collect():
            if r["doc_id"] == doc:
                assert r["tfidf"] == pytest.approx(w[r["term"]] / norm)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and ", term" not in plan.split("hashpartitioning(doc_id")[1].split(")")[0]
