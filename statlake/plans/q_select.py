"""Registered queries: feature selection (all embedding dimensions, 10 classes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators import learn, logit
from statlake.operators import select as sel
from statlake.plans.common import rnd
from statlake.plans.registry import register
from statlake.sources.tables import table

NF = 64
FEATS = [f"f{i}" for i in range(NF)]
FEAT_SQL = "f AS (SELECT vec_id AS id, label, " + ", ".join(
    f"embedding[{i + 1}]::DOUBLE AS f{i}" for i in range(NF)) + " FROM embeddings)"


def _features(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("id"), "label", *[F.col("embedding")[i].cast("double").alias(f) for i, f in enumerate(FEATS)])


def _long_sql(val="v"):
    return ("l AS (SELECT id, label, unnest([" + ", ".join(f"'{f}'" for f in FEATS) + "]) AS feature, unnest(["
            + ", ".join(FEATS) + f"]) AS {val} FROM f)")


@register("variance_threshold_embeddings", f"""
WITH {FEAT_SQL}, {_long_sql()}
SELECT feature, round(var_pop(v), 9) AS variance, var_pop(v) > 0 AS keep FROM l GROUP BY feature""")
def variance_threshold_embeddings(spark, sf):
    """S1 + A19: variance per feature and the threshold-0 mask."""
    v = sel.variance_scores(_features(spark, sf), FEATS, 0.0)
    return v.select("feature", rnd("variance", 9).alias("variance"), "keep")


@register("chi2_embeddings", f"""
WITH {FEAT_SQL}, {_long_sql()},
mm AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM l GROUP BY 1),
s AS (SELECT l.feature, label, (v - lo) / CASE WHEN hi - lo = 0 THEN 1e-6 ELSE hi - lo END AS x FROM l JOIN mm USING (feature)),
o AS (SELECT feature, label, sum(x) AS obs, count(*) AS nc FROM s GROUP BY 1, 2),
t AS (SELECT feature, sum(obs) AS tot, sum(nc) AS n FROM o GROUP BY 1)
SELECT feature, round(sum(CASE WHEN tot*nc/n > 0 THEN (obs - tot*nc/n)*(obs - tot*nc/n)/(tot*nc/n) ELSE 0 END), 6) AS chi2
FROM o JOIN t USING (feature) GROUP BY feature""")
def chi2_embeddings(spark, sf):
    """χ² score of each [0,1]-scaled feature against the label."""
    c = sel.chi2_scores(_features(spark, sf), FEATS, "label")
    return c.select("feature", rnd("chi2").alias("chi2"))


@register("f_scores_embeddings", f"""
WITH {FEAT_SQL}, {_long_sql()},
g AS (SELECT feature, label, count(*) AS n, avg(v) AS m, var_pop(v) AS v FROM l GROUP BY 1, 2),
c AS (SELECT feature, sum(n*m)/sum(n) AS c FROM g GROUP BY 1),
t AS (SELECT feature, count(*) AS k, sum(n) AS n, sum(n*(m - c)*(m - c)) AS b, sum(n*v) AS w FROM g JOIN c USING (feature) GROUP BY 1)
SELECT feature, round((b/(k - 1)) / (w/(n - k)), 6) AS f_stat FROM t""")
def f_scores_embeddings(spark, sf):
    """S3: ANOVA F of each feature across labels."""
    f = sel.f_scores(_features(spark, sf), FEATS, "label")
    return f.select("feature", rnd("f_stat").alias("f_stat"))


@register("mutual_info_embeddings", f"""
WITH {FEAT_SQL}, {_long_sql()},
n AS (SELECT count(*) AS n FROM f),
r AS (SELECT feature, label, floor((row_number() OVER (PARTITION BY feature ORDER BY v, id) - 1) * 10 / n.n) AS bin FROM l, n),
j AS (SELECT feature, bin, label, count(*) AS nbc FROM r GROUP BY 1, 2, 3),
pb AS (SELECT feature, bin, sum(nbc) AS nb FROM j GROUP BY 1, 2),
pc AS (SELECT feature, label, sum(nbc) AS ncl FROM j GROUP BY 1, 2)
SELECT feature, round(sum(nbc / n.n * ln(nbc * n.n / (nb * ncl))), 6) AS mi
FROM j JOIN pb USING (feature, bin) JOIN pc USING (feature, label), n GROUP BY feature""")
def mutual_info_embeddings(spark, sf):
    """Mutual information of 10 equal-frequency bins with the label."""
    m = sel.mutual_info_binned(_features(spark, sf), FEATS, "label", "id", 10)
    return m.select("feature", rnd("mi").alias("mi"))


def _psi(x: str) -> str:
    return (f"(ln({x} + 8.0) - 0.5 / ({x} + 8.0) - 1.0 / 12 / ({x} + 8.0) ** 2 + 1.0 / 120 / ({x} + 8.0) ** 4 - 1.0 / 252 / ({x} + 8.0) ** 6"
            f" + 1.0 / 240 / ({x} + 8.0) ** 8" + "".join(f" - 1.0 / ({x} + {i}.0)" for i in range(8)) + ")")


@register("nearest_mutual_info_embeddings", f"""
WITH {FEAT_SQL}, {_long_sql()},
s AS (SELECT feature, label, v, count(*) OVER (PARTITION BY feature, label) AS nc,
             [lag(v, 1) OVER o, lag(v, 2) OVER o, lag(v, 3) OVER o, lead(v, 1) OVER o, lead(v, 2) OVER o, lead(v, 3) OVER o] AS near
      FROM l WINDOW o AS (PARTITION BY feature, label ORDER BY v)),
r AS (SELECT feature, v, nc, least(3, nc - 1) AS kk,
             list_sort(list_transform(list_filter(near, lambda x: x IS NOT NULL), lambda x: abs(x - v)))[least(3, nc - 1)] AS d FROM s WHERE nc > 1),
a AS (SELECT feature, list(v) AS vs FROM r GROUP BY 1),
m AS (SELECT r.feature, r.nc, r.kk, len(list_filter(a.vs, lambda x: abs(x - r.v) < r.d OR x = r.v)) AS m FROM r JOIN a USING (feature))
SELECT feature, count(*) AS n, round(greatest({_psi("count(*)")} + avg({_psi("kk")} - {_psi("nc")} - {_psi("m")}), 0), 6) AS mi
FROM m GROUP BY feature""")
def nearest_mutual_info_embeddings(spark, sf):
    """Nearest-neighbour mutual information (k = 3) of every dimension with the label."""
    m = sel.mutual_info_nearest(_features(spark, sf), FEATS, "label", 3)
    return m.select("feature", "n", rnd("mi").alias("mi"))


@register("selection_report_embeddings")
def selection_report_embeddings(spark, sf):
    """K=32 of 64 features by variance, χ², F, MI, RFE, forward and
    backward sequential selection, L1 and elastic-net masks and forest
    importance (400 trees); each subset scored by the held-out accuracy of
    an L2 logistic regression (C=1, one class against the rest) on a stratified
    30 % test split, best first.  Sequential search scores candidates by the
    5-fold accuracy of the same regression."""
    d = learn.stratified_split(_features(spark, sf), "label", "id", 0.3)
    d = learn.stratified_folds(d.filter(~F.col("is_test")), "label", "id", 5).unionByName(
        d.filter(F.col("is_test")).withColumn("fold", F.lit(-1)))
    d = d.withColumn("label_s", F.col("label").cast("string")).persist()
    train = d.filter(~F.col("is_test"))
    k = NF // 2
    with logit.Rows(d, FEATS, "label", "fold") as rows:
        names = lambda picked: [FEATS[i] for i in picked]
        picks = {
            "variance": sel.top_k(sel.variance_scores(train, FEATS), "variance", k),
            "chi2": sel.top_k(sel.chi2_scores(train, FEATS, "label"), "chi2", k),
            "anova_f": sel.top_k(sel.f_scores(train, FEATS, "label"), "f_stat", k),
            "mutual_info": sel.top_k(sel.mutual_info_binned(train, FEATS, "label", "id"), "mi", k),
            "sfs_forward": names(logit.sequential(rows, k, "forward")),
            "sfs_backward": names(logit.sequential(rows, k, "backward")),
            "rfe": names(logit.eliminate(rows, k)),
        }
        idx, _ = learn.index_label(train, "label_s")
        idx = learn.assemble(idx, FEATS).select("features", "label_idx").coalesce(rows.parts).persist()
        n = idx.count()
        for name in ("l1", "elasticnet"):
            weights = learn.logistic(idx, n, 1.0, name).coefficientMatrix.toArray()
            picks[name] = [f for f, z in zip(FEATS, (abs(weights) > 0).any(axis=0)) if z]
        rf = learn.random_forest(idx, n_trees=400, weight=None)
        idx.unpersist()
        picks["rf_importance"] = [r["feature"] for r in learn.feature_importances(rf, FEATS, spark).limit(k).collect()]
        scores = logit.holdout_accuracy(rows, [[FEATS.index(f) for f in p] for p in picks.values()])
    d.unpersist()
    out = [(name, ",".join(p), round(s, 6) if p else None) for (name, p), s in zip(picks.items(), scores)]
    rep = spark.createDataFrame(out, "method string, selected string, test_acc double")
    return rep.orderBy(F.desc_nulls_last("test_acc"), "method")
