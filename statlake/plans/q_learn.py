"""Registered queries: clustering, discriminants, classification, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators import cluster, learn
from statlake.plans.common import rnd
from statlake.plans.registry import register
from statlake.session import ensure_checkpoint_dir
from statlake.sources.tables import embedding_points, table

NDIM = 64  # all embedding dimensions
DIMS = [f"x{i}" for i in range(NDIM)]
EMB_SQL = f"""p AS (SELECT vec_id AS id, label AS grp, unnest(range({NDIM})) AS k, unnest(embedding)::DOUBLE AS v FROM embeddings),
c AS (SELECT grp AS g, k, avg(v) AS m, var_pop(v) AS s, count(*) AS n FROM p GROUP BY 1, 2)"""


def _centers(pts, spark):
    rows = cluster.centroids(pts, DIMS, "grp").orderBy("grp").collect()  # k rows
    return [[r[c] for c in DIMS] for r in rows]


@register("nearest_centroid_embeddings", f"""
WITH {EMB_SQL},
d AS (SELECT id, g, sum((v - m)*(v - m)) AS d FROM p JOIN c USING (k) GROUP BY 1, 2),
r AS (SELECT g, row_number() OVER (ORDER BY g) - 1 AS i FROM (SELECT DISTINCT g FROM c)),
b AS (SELECT id, min({{'d': d, 'i': i}}) AS b FROM d JOIN r USING (g) GROUP BY id)
SELECT b.i::BIGINT AS cluster, count(*)::BIGINT AS n, round(sum(b.d), 6) AS sse FROM b GROUP BY 1""")
def nearest_centroid_embeddings(spark, sf):
    """J2 + K2 + A21: assign every point to the nearest label centroid (all
    dimensions; ties → lowest index) and report cluster sizes and inertia."""
    pts = embedding_points(spark, sf, NDIM)
    i = cluster.inertia(pts, DIMS, _centers(pts, spark))
    return i.select("cluster", F.col("n").cast("long").alias("n"), rnd("sse").alias("sse"))


@register("silhouette_labels_embeddings", f"""
WITH {EMB_SQL},
m AS (SELECT id, grp, g, any_value(n) AS n, sum((v - m)*(v - m) + s) AS md FROM p JOIN c USING (k) GROUP BY 1, 2, 3),
ab AS (SELECT id, grp, max(CASE WHEN g = grp AND n > 1 THEN md*n/(n-1) END) AS a,
              min(CASE WHEN g <> grp THEN md END) AS b, max(CASE WHEN g = grp THEN n END) AS own_n FROM m GROUP BY id, grp),
r AS (SELECT grp, CASE WHEN own_n <= 1 OR b IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a)/greatest(a, b) END AS sil FROM ab)
SELECT grp::VARCHAR AS grp, count(*)::BIGINT AS n, round(avg(sil), 6) AS silhouette FROM r GROUP BY grp
UNION ALL SELECT '__all__', count(*)::BIGINT, round(avg(sil), 6) FROM r""")
def silhouette_labels_embeddings(spark, sf):
    """K3: squared-Euclidean silhouette of the label partition (all dimensions) from
    per-cluster sufficient statistics — O(n·k), no pairs."""
    s = cluster.silhouette_sq(embedding_points(spark, sf, NDIM), DIMS, "grp")
    return s.select(F.col("grp").cast("string").alias("grp"), F.col("n").cast("long").alias("n"),
                    rnd("silhouette").alias("silhouette"))


@register("pca_embeddings")
def pca_embeddings(spark, sf):
    """K4: explained-variance ratio of the two main components of all
    dimensions (MLlib PCA; the tests hold it against closed forms)."""
    p = cluster.pca_explained(embedding_points(spark, sf, NDIM), DIMS, 2)
    return p.select("component", rnd("ratio").alias("ratio"))


@register("kmeans_embeddings")
def kmeans_embeddings(spark, sf):
    """K1: k-means (k=10, 3 restarts, lowest cost) on all embedding dimensions;
    cluster sizes and inertia."""
    pts = embedding_points(spark, sf, NDIM)
    centers, _ = cluster.kmeans(pts, DIMS, 10, n_init=3)
    i = cluster.inertia(pts, DIMS, centers)
    return i.select("cluster", F.col("n").cast("long").alias("n"), rnd("sse").alias("sse"))


@register("kmeans_sweep_embeddings")
def kmeans_sweep_embeddings(spark, sf):
    """K3 sweep: k = 2..7, inertia and squared-Euclidean silhouette."""
    s = cluster.kmeans_sweep(embedding_points(spark, sf, NDIM), DIMS, range(2, 8), n_init=2)
    return s.select("k", rnd("inertia").alias("inertia"), rnd("silhouette").alias("silhouette"))


@register("som_embeddings")
def som_embeddings(spark, sf):
    """K5–K7: 6×6 batch SOM on all dimensions (10 epochs), then the five busiest units."""
    pts = embedding_points(spark, sf, NDIM)
    w, _ = cluster.som_fit(pts, DIMS, 6, 6, epochs=10)
    return cluster.som_hit_map(cluster.som_transform(pts, DIMS, w, 6), 5)


# ---- discriminants and evaluation ------------------------------------------------

F2 = ["l_quantity", "l_discount"]


def _lda_sql(quadratic: bool) -> str:
    if not quadratic:
        cov = """pc AS (SELECT sum(sxx) / (sum(n) - count(*)) AS a, sum(sxy) / (sum(n) - count(*)) AS b,
                   sum(syy) / (sum(n) - count(*)) AS c, sum(n) AS ntot FROM m),
mm AS (SELECT m.*, pc.a, pc.b, pc.c, pc.ntot FROM m, pc),"""
    else:
        cov = """mm AS (SELECT m.*, sxx/(n-1) AS a, sxy/(n-1) AS b, syy/(n-1) AS c, sum(n) OVER () AS ntot FROM m),"""
    if not quadratic:
        score = """(x*(ic_a*mx + ic_b*my) + y*(ic_b*mx + ic_c*my)) - 0.5*(mx*(ic_a*mx + ic_b*my) + my*(ic_b*mx + ic_c*my)) + ln(n/ntot)"""
    else:
        score = """-0.5*ln(a*c - b*b) - 0.5*((x-mx)*(x-mx)*ic_a + 2*(x-mx)*(y-my)*ic_b + (y-my)*(y-my)*ic_c) + ln(n/ntot)"""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, l_returnflag AS label, l_quantity AS x, l_discount AS y FROM lineitem),
m0 AS (SELECT label, count(*) AS n, avg(x) AS mx, avg(y) AS my FROM d GROUP BY label),
m AS (SELECT m0.label, any_value(m0.n) AS n, any_value(mx) AS mx, any_value(my) AS my,
             sum((x-mx)*(x-mx)) AS sxx, sum((x-mx)*(y-my)) AS sxy, sum((y-my)*(y-my)) AS syy
      FROM d JOIN m0 USING (label) GROUP BY m0.label),
{cov}
mi AS (SELECT *, c/(a*c - b*b) AS ic_a, -b/(a*c - b*b) AS ic_b, a/(a*c - b*b) AS ic_c,
              row_number() OVER (ORDER BY label) - 1 AS ci FROM mm),
sc AS (SELECT d.rid, d.label AS truth, d.x, d.y, mi.label AS cls, mi.ci, {score} AS s FROM d, mi),
pr AS (SELECT truth, arg_min(cls, {{'neg': -s, 'i': ci}}) AS pred FROM sc GROUP BY rid, truth)"""


def _lda_pairs(spark, sf, quadratic=False):
    li = table(spark, sf, "lineitem").select("l_returnflag", *F2)
    if quadratic:
        m = learn.qda_fit(li, "l_returnflag", F2)
        return learn.qda_predict(li, m, F2)
    m = learn.lda_fit(li, "l_returnflag", F2)
    return learn.lda_predict(li, m, F2)


CONF_TAIL = """,
labs AS (SELECT DISTINCT label FROM d),
g AS (SELECT a.label AS label, b.label AS pred FROM labs a, labs b),
c AS (SELECT truth AS label, pred, count(*) AS n FROM pr GROUP BY 1, 2)
SELECT g.label, g.pred, coalesce(c.n, 0)::BIGINT AS n FROM g LEFT JOIN c USING (label, pred)"""


@register("lda_confusion_lineitem", _lda_sql(False) + CONF_TAIL)
def lda_confusion_lineitem(spark, sf):
    """M10 + M13: linear discriminant (quantity, discount → return flag),
    confusion matrix over the full label grid."""
    p = _lda_pairs(spark, sf)
    return learn.confusion_matrix(p, "l_returnflag", "pred").select("label", "pred", F.col("n").cast("long").alias("n"))


@register("qda_confusion_lineitem", _lda_sql(True) + CONF_TAIL)
def qda_confusion_lineitem(spark, sf):
    """M11 + M13: quadratic discriminant, confusion matrix."""
    p = _lda_pairs(spark, sf, quadratic=True)
    return learn.confusion_matrix(p, "l_returnflag", "pred").select("label", "pred", F.col("n").cast("long").alias("n"))


@register("lda_report_lineitem", _lda_sql(False) + """,
labs AS (SELECT DISTINCT label FROM d),
per AS (SELECT l.label, (SELECT count(*) FROM pr WHERE truth = l.label AND pred = l.label) AS tp,
               (SELECT count(*) FROM pr WHERE truth = l.label) AS support, (SELECT count(*) FROM pr WHERE pred = l.label) AS npred
        FROM labs l),
r AS (SELECT label, CASE WHEN npred > 0 THEN tp/npred ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp/support ELSE 0.0 END AS recall, support FROM per),
r2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2*precision*recall/(precision + recall) ELSE 0.0 END AS f1 FROM r),
allr AS (SELECT label, precision, recall, f1, support FROM r2
         UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r2
         UNION ALL SELECT 'weighted avg', sum(precision*support)/sum(support), sum(recall*support)/sum(support),
                          sum(f1*support)/sum(support), sum(support) FROM r2
         UNION ALL SELECT 'accuracy', avg(CASE WHEN truth = pred THEN 1.0 ELSE 0.0 END), NULL, NULL, count(*) FROM pr)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM allr""")
def lda_report_lineitem(spark, sf):
    """Accuracy, per-class precision/recall/F1/support, macro and
    weighted averages of the linear discriminant."""
    p = _lda_pairs(spark, sf)
    rep = learn.classification_report(p, "l_returnflag", "pred")
    acc = learn.accuracy(p, "l_returnflag", "pred").select(
        F.lit("accuracy").alias("label"), F.col("accuracy").alias("precision"), F.lit(None).cast("double").alias("recall"),
        F.lit(None).cast("double").alias("f1"), F.col("n").cast("long").alias("support"))
    return rep.unionByName(acc).select("label", rnd("precision").alias("precision"), rnd("recall").alias("recall"),
                                       rnd("f1").alias("f1"), "support")


@register("lda_shrinkage_embeddings")
def lda_shrinkage_embeddings(spark, sf):
    """Ledoit–Wolf shrinkage LDA on all standardised embedding dimensions; the
    shrinkage intensity and training accuracy."""
    from statlake.functions.exprs import standardize
    cols = DIMS
    pts = standardize(embedding_points(spark, sf, NDIM), cols)
    m = learn.lda_fit(pts, "grp", cols, shrinkage="auto")
    acc = learn.accuracy(learn.lda_predict(pts, m, cols), "grp", "pred")
    return acc.select(F.lit(round(m["shrinkage"], 6)).alias("shrinkage"), rnd("accuracy").alias("accuracy"), "n")


SPLIT_SQL = """
WITH d AS (SELECT l_orderkey*10 + l_linenumber AS id, l_returnflag AS label,
                  md5(CAST(l_orderkey*10 + l_linenumber AS VARCHAR) || ':42') AS h FROM lineitem),
r AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY h, id) - 1 AS rk,
             count(*) OVER (PARTITION BY label) AS nc FROM d)"""


@register("stratified_split_lineitem", SPLIT_SQL + """
SELECT id, label, rk < round(nc * 0.25) AS is_test, (rk % 5)::INTEGER AS fold FROM r""")
def stratified_split_lineitem(spark, sf):
    """M1 + M2: deterministic stratified 25 % test split and 5 folds per
    return flag (md5 of id and seed orders rows inside each class)."""
    li = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_returnflag").alias("label"))
    return learn.stratified_split_folds(li, "label", "id", 0.25, 5).select("id", "label", "is_test", "fold")


@register("balanced_weights_lineitem", """
SELECT l_returnflag, count(*)::BIGINT AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 9) AS weight
FROM lineitem GROUP BY 1""")
def balanced_weights_lineitem(spark, sf):
    """M8 weights: n/(k·n_c) per class."""
    li = table(spark, sf, "lineitem").select("l_returnflag")
    w = learn.balanced_weights(li, "l_returnflag")
    return w.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), rnd(F.first("weight"), 9).alias("weight"))


def _doc_features(spark, sf):
    """Features of the labelled texts, written once: a fit reads its rows many times."""
    ensure_checkpoint_dir(spark)
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return d.select("doc_id", F.col("quality").cast("string").alias("quality"),
                    F.log1p(F.col("n_chars").cast("double")).alias("log_chars"),
                    (F.size(F.split("text", "\n")) * 1.0).alias("lines"),
                    (F.length(F.regexp_replace("text", "[^.,;:!?]+", "")) / F.greatest(F.length("text"), F.lit(1))).alias("punct"),
                    (F.length(F.regexp_replace("text", "[^0-9]+", "")) / F.greatest(F.length("text"), F.lit(1))).alias("digits"),
                    (F.length(F.regexp_replace("text", "[^A-Z]+", "")) / F.greatest(F.length("text"), F.lit(1))).alias("upper")).checkpoint()


DOC_F = ["log_chars", "lines", "punct", "digits", "upper"]


@register("decision_tree_documents")
def decision_tree_documents(spark, sf):
    """M5–M7: gini tree (depth 5, leaf ≥ 20) predicting document quality
    from length/punctuation features; importances (sum to 1)."""
    d, _ = learn.index_label(learn.assemble(_doc_features(spark, sf), DOC_F), "quality")
    m = learn.decision_tree(d)
    return learn.feature_importances(m, DOC_F, spark).select("feature", rnd("importance").alias("importance"))


@register("tree_report_documents")
def tree_report_documents(spark, sf):
    """M5 + M13–M16: gini tree (depth 5, leaf ≥ 20) trained on a stratified
    75 %; held-out report per class with the confusion counts."""
    d = learn.stratified_split(_doc_features(spark, sf), "quality", "doc_id", 0.25)
    d, labels = learn.index_label(learn.assemble(d, DOC_F), "quality")
    pred = learn.decision_tree(d.filter(~F.col("is_test"))).transform(d.filter(F.col("is_test")))
    pred = pred.select(F.col("label_idx").cast("int").alias("truth"), F.col("prediction").cast("int").alias("pred"))
    cm = learn.confusion_matrix(pred, "truth", "pred").groupBy(F.col("label").cast("string").alias("label")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("pred", "n"))), lambda x: x["n"].cast("string"))).alias("confusion"))
    rep = learn.classification_report(pred, "truth", "pred").join(cm, "label", "left")
    return rep.select("label", *[rnd(c).alias(c) for c in ("precision", "recall", "f1")], "support", "confusion")


@register("random_forest_documents")
def random_forest_documents(spark, sf):
    """M8 + M14: class-balanced random forest (400 trees) on a stratified
    split; held-out accuracy and macro F1."""
    d = _doc_features(spark, sf)
    d = learn.stratified_split(d, "quality", "doc_id", 0.25)
    d = learn.balanced_weights(d, "quality")
    d, _ = learn.index_label(learn.assemble(d, DOC_F), "quality")
    m = learn.random_forest(d.filter(~F.col("is_test")))
    p = m.transform(d.filter(F.col("is_test")))
    p = p.select(F.col("label_idx").cast("int").alias("truth"), F.col("prediction").cast("int").alias("pred")).cache()
    try:
        acc, f1 = learn.accuracy(p, "truth", "pred").first(), learn.f1_macro(p, "truth", "pred")
    finally:
        p.unpersist()
    return spark.createDataFrame([(acc["n"], round(acc["accuracy"], 6), round(f1, 6))], "n long, accuracy double, f1_macro double")


@register("logistic_documents")
def logistic_documents(spark, sf):
    """M9: L2, L1 and elastic-net logistic regression (C=1) held-out accuracy."""
    d = learn.stratified_split(_doc_features(spark, sf), "quality", "doc_id", 0.25)
    d, _ = learn.index_label(learn.assemble(d, DOC_F), "quality")
    train, test = d.filter(~F.col("is_test")).cache(), d.filter(F.col("is_test"))
    n = train.count()
    rows = []
    for pen in ("l2", "l1", "elasticnet"):
        m = learn.logistic(train, n, 1.0, pen)
        acc = learn.accuracy(m.transform(test), "label_idx", "prediction").first()["accuracy"]
        nz = int((abs(m.coefficientMatrix.toArray()) > 0).sum())
        rows.append((pen, float(round(acc, 6)), nz))
    train.unpersist()
    return spark.createDataFrame(rows, "penalty string, accuracy double, nonzero long")


@register("cross_val_documents")
def cross_val_documents(spark, sf):
    """M2 + M3: 5 stratified folds; decision-tree fold accuracies, their mean
    (fold −1) and σ with ddof 0 (fold −2); macro F1 of the balanced forest beside."""
    d = learn.stratified_folds(_doc_features(spark, sf), "quality", "doc_id", 5)
    d, _ = learn.index_label(learn.assemble(d, DOC_F), "quality")
    d = d.cache()
    mean, sd, scores = learn.cross_val_score(d, lambda tr: learn.decision_tree(tr))
    forest = lambda tr: learn.random_forest(learn.balanced_weights(tr, "label_idx"), n_trees=50)
    f_mean, f_sd, f_scores = learn.cross_val_score(d, forest, metric="f1")
    d.unpersist()
    rows = [*enumerate(zip(scores, f_scores)), (-1, (mean, f_mean)), (-2, (sd, f_sd))]
    return spark.createDataFrame([(i, float(round(a, 6)), float(round(f, 6))) for i, (a, f) in rows],
                                 "fold long, accuracy double, forest_f1_macro double")


@register("grid_search_documents")
def grid_search_documents(spark, sf):
    """M4: tree hyper-parameter grid (30 distinct MLlib settings) scored by
    5-fold stratified accuracy on the training split; best setting, its CV
    accuracy and held-out accuracy."""
    d = learn.stratified_split(_doc_features(spark, sf), "quality", "doc_id", 0.25)
    train = learn.stratified_folds(d.filter(~F.col("is_test")), "quality", "doc_id", 5)
    train, _ = learn.index_label(learn.assemble(train, DOC_F), "quality")
    train = train.coalesce(spark.sparkContext.defaultParallelism).cache()
    cv = learn.grid_search(train, parallelism=4)
    best = cv.bestModel
    test, _ = learn.index_label(learn.assemble(d.filter(F.col("is_test")), DOC_F), "quality")
    acc = learn.accuracy(best.transform(test), "label_idx", "prediction").first()["accuracy"]
    train.unpersist()
    return spark.createDataFrame([(best.getImpurity(), int(best.getMaxDepth()), int(best.getMinInstancesPerNode()),
                                   float(round(max(cv.avgMetrics), 6)), float(round(acc, 6)))],
                                 "impurity string, max_depth long, min_leaf long, cv_accuracy double, test_accuracy double")


@register("tree_rules_documents")
def tree_rules_documents(spark, sf):
    """M6: the if/else rules of the depth-5 tree with feature names."""
    d, labels = learn.index_label(learn.assemble(_doc_features(spark, sf), DOC_F), "quality")
    txt = learn.tree_rules(learn.decision_tree(d), DOC_F)
    return spark.createDataFrame([(i, line) for i, line in enumerate(txt.splitlines())], "line long, rule string")
