"""Classification, validation and evaluation.

Splits and folds are deterministic (hash of id and seed, ranked within each
class by bucketed prefix counts — no one-task window per class).  Linear and
quadratic discriminants come from one per-class moment aggregate; scoring is
a pure column expression.  Trees, forests and logistic regression are
MLlib estimators.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.exprs import clean_numeric
from statlake.functions.safe import same_keys
from statlake.operators.ranks import keyed_prefix, row_hash

WIDE = 16  # columns beyond which per-pair aggregates give way to numpy partials


def _k(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


# ---- M1, M2: stratified split and folds ---------------------------------------------

def _class_rank(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    """Rank of each row within its class (a null class is one too) by the MD5 of
    id and seed.  Rows that repeat an id follow each other by a hash of all
    their columns; only equal rows tie, so any partitioning gives the same rows."""
    d = df.withColumns({"_h": F.coalesce(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))), F.lit("")),
                        "_row": row_hash(df), "_one": F.lit(1)})
    r = keyed_prefix(d, [label], ["_h", "_row"], "_one", out="_r")
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    return same_keys(r, n, [label]).drop("_one", "_row", "_h")


def stratified_split(df: DataFrame, label: str, id_col: str, test_size: float = 0.25, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: the first round(test_size·n_c) rows of each class in
    hash order are test rows, so class shares match to within one row."""
    r = _class_rank(df, label, id_col, seed)
    cut = F.round(F.col("_nc") * F.lit(test_size))
    return r.withColumn("is_test", F.col("_r") < cut).drop("_r", "_nc")


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` = (rank within class in hash order) mod k."""
    r = _class_rank(df, label, id_col, seed)
    return r.withColumn("fold", (F.col("_r") % k).cast("int")).drop("_r", "_nc")


def stratified_split_folds(df: DataFrame, label: str, id_col: str, test_size: float = 0.25, k: int = 5, seed: int = 42) -> DataFrame:
    """Both columns from one rank, so that they agree for rows that repeat an id."""
    r = _class_rank(df, label, id_col, seed)
    return (r.withColumn("is_test", F.col("_r") < F.round(F.col("_nc") * F.lit(test_size)))
             .withColumn("fold", (F.col("_r") % k).cast("int")).drop("_r", "_nc"))


# ---- M13-M16: evaluation -------------------------------------------------------------

def confusion_matrix(df: DataFrame, label: str, pred: str, labels: Sequence | None = None) -> DataFrame:
    """Counts over the full label × prediction grid (zeros included)."""
    c = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    if labels is None:
        # distinct classes as one array (bounded by the class count), exploded twice
        arr = df.select(F.col(label).alias("_l")).union(df.select(F.col(pred).alias("_l"))).agg(
            F.array_sort(F.collect_set("_l")).alias("_ls"))
    else:
        arr = df.sparkSession.range(1).select(F.array(*[F.lit(x) for x in labels]).alias("_ls"))
    grid = arr.select(F.explode("_ls").alias("label"), "_ls").select("label", F.explode("_ls").alias("pred"))
    return grid.join(c, ["label", "pred"], "left").fillna(0, ["n"])


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision/recall/F1/support (0/0 → 0) plus macro and
    weighted averages, as rows ``(label, precision, recall, f1, support)``."""
    cm = confusion_matrix(df, label, pred)
    per = cm.groupBy("label").agg(
        F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum("n").alias("support"))
    predc = cm.groupBy(F.col("pred").alias("label")).agg(F.sum("n").alias("npred"))
    r = per.join(predc, "label")
    prec = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    r = r.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    r = r.withColumn("f1", f1).select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1",
                                      F.col("support").cast("long").alias("support"))
    tot = F.sum("support")
    macro = r.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                  F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.alias("support"))
    weighted = r.agg(F.lit("weighted avg").alias("label"),
                     (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                     (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                     (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"), tot.alias("support"))
    return r.unionByName(macro).unionByName(weighted)


def f1_macro(df: DataFrame, label: str, pred: str) -> float:
    return classification_report(df, label, pred).filter(F.col("label") == "macro avg").first()["f1"]


# ---- M10-M12: discriminant analysis ---------------------------------------------------

def class_moments(df: DataFrame, label: str, cols: Sequence[str]):
    """Per class n, mean and centred scatter (p x p) over rows whose columns
    are finite.  Returns ``{class: (n, mean, scatter)}`` — bounded by classes × p²."""
    cols = list(cols)
    df = clean_numeric(df.select(label, *cols), cols).filter(F.col(label).isNotNull())
    p = len(cols)
    if p > WIDE:
        return _wide_moments(df, label, cols)
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)]
    aggs += [F.covar_pop(a, b).alias(f"_c{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]
    out = {}
    for r in df.groupBy(label).agg(*aggs).collect():
        n = float(r["_n"])
        c = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                c[i, j] = c[j, i] = n * r[f"_c{i}_{j}"]
        out[r[label]] = (n, np.array([r[f"_m{i}"] for i in range(p)], dtype=float), c)
    return out


def _wide_moments(df: DataFrame, label: str, cols: list[str]):
    """The same for many columns: means by one aggregate, then per-partition
    scatters about them (numpy products), summed in two steps."""
    import pandas as pd
    p = len(cols)
    means = {r[label]: (float(r["_n"]), np.array([r[f"_m{i}"] for i in range(p)], dtype=float)) for r in
             df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)]).collect()}

    def partial(it):
        acc: dict = {}
        for pdf in it:
            for lab, part in pdf.groupby(label):
                x = part[cols].to_numpy(float) - means[lab][1]
                acc[lab] = acc.get(lab, 0) + x.T @ x
        if acc:  # a partition without rows sends nothing: an empty column has no type to convert to a list
            yield pd.DataFrame({"label": list(acc), "scatter": [a.ravel().tolist() for a in acc.values()]})

    def add(pdf):
        return pd.DataFrame({"label": [pdf["label"].iloc[0]], "scatter": [np.sum(np.stack(pdf["scatter"].to_numpy()), axis=0).tolist()]})
    kind = df.schema[label].dataType.simpleString()
    schema = f"label {kind}, scatter array<double>"
    parts = df.mapInPandas(partial, schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(32)))
    rows = parts.groupBy("label", "part").applyInPandas(add, schema).collect()  # at most 32 a class
    out = {}
    for lab, (n, m) in means.items():
        out[lab] = (n, m, sum(np.array(r["scatter"]).reshape(p, p) for r in rows if r["label"] == lab))
    return out


def _lin(cols, coef, const) -> Column:
    e = F.lit(float(const))
    for c, w in zip(cols, coef):
        e = e + F.col(c) * F.lit(float(w))
    return e


def _argmax(scores: dict, out: str, df: DataFrame) -> DataFrame:
    cand = [F.struct((-s).alias("neg"), F.lit(i).alias("i")) for i, s in enumerate(scores.values())]
    labels = list(scores.keys())
    best = F.array_min(F.array(*cand))["i"]
    m = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(i), F.lit(lab))])
    return df.withColumn(out, m[best])


def lda_fit(df: DataFrame, label: str, cols: Sequence[str], shrinkage: float | str | None = None):
    """Linear discriminant: pooled covariance (n − K), priors n_c/n.  With
    ``shrinkage='auto'`` a Ledoit–Wolf shrinkage of the pooled covariance
    toward its mean eigenvalue (shrinkage in [0, 1]) is used."""
    mom = class_moments(df, label, cols)
    classes = sorted(mom)
    n = sum(v[0] for v in mom.values())
    k = len(classes)
    scatter = sum(mom[c][2] for c in classes)
    cov = scatter / (n - k)
    lam = 0.0
    if shrinkage == "auto":
        cov, lam = _ledoit_wolf(df, label, cols, mom, n)
    elif isinstance(shrinkage, (int, float)):
        lam = float(shrinkage)
        mu_t = np.trace(cov) / len(cols)
        cov = (1 - lam) * cov + lam * mu_t * np.eye(len(cols))
    inv = np.linalg.pinv(cov)
    model = {}
    for c in classes:
        nc, mu, _ = mom[c]
        w = inv @ mu
        model[c] = (w, -0.5 * mu @ inv @ mu + math.log(nc / n))
    return {"classes": classes, "coef": model, "cov": cov, "shrinkage": lam}


def _ledoit_wolf(df, label, cols, mom, n):
    """Ledoit–Wolf shrinkage of the pooled within-class covariance; the
    fourth-moment term, the sum of |x−μ_c|⁴ over rows, is one more aggregate."""
    p = len(cols)
    mus = {c: mom[c][1] for c in mom}
    mu_map = F.create_map(*[x for c in mus for x in (F.lit(c), F.array(*[F.lit(float(v)) for v in mus[c]]))])
    d = df.withColumn("_mu", mu_map[F.col(label)])
    # Σ_ij (x−μ)_i² (x−μ)_j² of a row is the square of its squared distance to the class mean
    row = F.aggregate(F.zip_with(F.array(*[F.col(c).cast("double") for c in cols]), "_mu", lambda a, b: (a - b) * (a - b)),
                      F.lit(0.0), lambda a, b: a + b)
    x2 = (d.agg(F.sum(row * row)).first()[0] or 0.0) / n
    s = sum(mom[c][2] for c in mom) / n
    mu_t = np.trace(s) / p
    delta = ((s - mu_t * np.eye(p)) ** 2).sum() / p
    beta = (x2 / n - (s ** 2).sum() / n) / p
    beta = min(beta, delta)
    lam = 0.0 if delta == 0 else beta / delta
    return (1 - lam) * s + lam * mu_t * np.eye(p), lam


def lda_predict(df: DataFrame, model, cols: Sequence[str], out: str = "pred") -> DataFrame:
    if len(cols) * len(model["coef"]) > WIDE * WIDE:
        return _wide_predict(df, model, list(cols), out)
    scores = {c: _lin(cols, w, b) for c, (w, b) in model["coef"].items()}
    return _argmax(scores, out, df)


def _wide_predict(df: DataFrame, model, cols: list[str], out: str) -> DataFrame:
    """The same as one matrix product per Arrow batch."""
    import pyarrow as pa
    from pyspark.sql import types as T
    labels = list(model["coef"])
    w = np.array([model["coef"][c][0] for c in labels]).T
    b = np.array([model["coef"][c][1] for c in labels])
    kind = T._infer_type(labels[0])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols])
            best = (x @ w + b).argmax(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([labels[i] for i in best])], [*batch.schema.names, out])
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, kind)]))


def qda_fit(df: DataFrame, label: str, cols: Sequence[str]):
    """Quadratic discriminant: per-class covariance (n_c − 1), priors n_c/n."""
    mom = class_moments(df, label, cols)
    n = sum(v[0] for v in mom.values())
    model = {}
    for c in sorted(mom):
        nc, mu, sc = mom[c]
        cov = sc / (nc - 1)
        sign, logdet = np.linalg.slogdet(cov)
        model[c] = (mu, np.linalg.pinv(cov), -0.5 * logdet + math.log(nc / n))
    return {"classes": sorted(mom), "params": model}


def qda_predict(df: DataFrame, model, cols: Sequence[str], out: str = "pred") -> DataFrame:
    scores = {}
    for c, (mu, inv, const) in model["params"].items():
        diff = [F.col(col) - F.lit(float(m)) for col, m in zip(cols, mu)]
        quad = F.lit(0.0)
        for i in range(len(cols)):
            for j in range(len(cols)):
                if inv[i, j] != 0:
                    quad = quad + diff[i] * diff[j] * F.lit(float(inv[i, j]))
        scores[c] = F.lit(float(const)) - 0.5 * quad
    return _argmax(scores, out, df)


# ---- M3-M9: MLlib estimators ------------------------------------------------------------

def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def index_label(df: DataFrame, label: str, out: str = "label_idx"):
    from pyspark.ml.feature import StringIndexer
    m = StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc").fit(df)
    return m.transform(df), list(m.labels)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """n / (k · n_c) per row (class-balanced weights)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = c.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    c = c.crossJoin(F.broadcast(tot)).withColumn(out, F.col("_n") / (F.col("_k") * F.col("_nc")))
    return same_keys(df, c.select(label, out), [label])


def decision_tree(train: DataFrame, features: str = "features", label: str = "label_idx", max_depth: int = 5,
                  min_leaf: int = 20, impurity: str = "gini", seed: int = 42):
    from pyspark.ml.classification import DecisionTreeClassifier
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=max_depth,
                                  minInstancesPerNode=min_leaf, impurity=impurity, seed=seed).fit(train)


def random_forest(train: DataFrame, features: str = "features", label: str = "label_idx", n_trees: int = 400,
                  weight: str | None = "weight", seed: int = 42, max_depth: int = 5):
    from pyspark.ml.classification import RandomForestClassifier
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=n_trees, seed=seed, maxDepth=max_depth)
    if weight:
        rf = rf.setWeightCol(weight)
    return rf.fit(train)


def logistic(train: DataFrame, n_rows: int, c: float = 1.0, penalty: str = "l2", features: str = "features",
             label: str = "label_idx", max_iter: int = 100):
    """C-parameterised logistic regression: regParam = 1/(C·n);
    elasticNetParam 0 (L2), 1 (L1) or 0.5 (elastic net)."""
    from pyspark.ml.classification import LogisticRegression
    en = {"l2": 0.0, "l1": 1.0, "elasticnet": 0.5}[penalty]
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (c * n_rows), elasticNetParam=en,
                              standardization=False, maxIter=max_iter).fit(train)


def feature_importances(model, names: Sequence[str], spark) -> DataFrame:
    """M7: ``(feature, importance)`` sorted descending."""
    imp = model.featureImportances.toArray()
    rows = sorted(zip(names, map(float, imp)), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def tree_rules(model, names: Sequence[str]) -> str:
    """M6: if/else rules with feature names."""
    txt = model.toDebugString
    for i in sorted(range(len(names)), reverse=True):
        txt = txt.replace(f"feature {i} ", f"{names[i]} ")
    return txt


def cross_val_score(df: DataFrame, fit_fn, label: str = "label_idx", fold_col: str = "fold", k: int = 5,
                    metric: str = "accuracy"):
    """M3: fit on k−1 folds, score the held-out fold; mean and σ (ddof 0)."""
    scores = []
    for f in range(k):
        model = fit_fn(df.filter(F.col(fold_col) != f))
        pred = model.transform(df.filter(F.col(fold_col) == f))
        if metric == "accuracy":
            scores.append(accuracy(pred, label, "prediction").first()["accuracy"])
        else:
            scores.append(f1_macro(pred, label, "prediction"))
    return float(np.mean(scores)), float(np.std(scores)), scores


class GridSearch(NamedTuple):
    bestModel: object
    avgMetrics: list[float]  # in the order impurity, depth, leaf size


def cut_prediction(model, depth: int, features: str = "features") -> Column:
    """What ``model``, an MLlib tree, would predict if it ended at ``depth``."""
    from pyspark.ml.functions import vector_to_array
    x = vector_to_array(F.col(features))

    def below(node, left: int) -> Column:
        if not left or node.getClass().getSimpleName() == "LeafNode":
            return F.lit(float(node.prediction()))
        split = node.split()
        return F.when(x[split.featureIndex()] <= F.lit(float(split.threshold())), below(node.leftChild(), left - 1)).otherwise(
            below(node.rightChild(), left - 1))
    return below(model._call_java("rootNode"), depth)


def grid_search(df: DataFrame, features: str = "features", label: str = "label_idx", fold_col: str = "fold",
                parallelism: int = 4, grid: dict | None = None, folds: int = 5):
    """M4: decision-tree grid (impurity × depth × leaf size) scored by fold
    accuracy; the best setting (the first of equals) is refitted on all rows.  A
    split does not depend on the depth limit, so each fold, impurity and leaf
    size needs one tree, of the largest depth: cut at a lower depth it is the tree
    of that limit.  The reference grid is
    criterion {gini, entropy, log_loss} × max_depth {None, 2, 3, 4, 5} ×
    min_samples_split {2, 4, 6, 8} × min_samples_leaf {1, 2, 3}; log_loss is
    entropy, an unlimited depth maps to 30 (MLlib's maximum) and
    min_samples_split has no MLlib parameter, leaving 30 distinct settings."""
    from itertools import product
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    # The reference grid after mapping to MLlib parameters
    g = grid or {"impurity": ["gini", "entropy", "entropy"], "maxDepth": [30, 2, 3, 4, 5],
                 "minInstancesPerNode": [1, 2, 3]}
    impurities, depths, leaves = sorted(set(g["impurity"])), list(g["maxDepth"]), list(g["minInstancesPerNode"])
    fold, deepest = F.col(fold_col), max(depths)

    def score(job):
        f, impurity, leaf = job
        model = decision_tree(df.filter(fold != f), features, label, deepest, leaf, impurity)
        held = model.transform(df.filter(fold == f))
        right = [F.avg((F.col(label) == (F.col("prediction") if d == deepest else cut_prediction(model, d, features))).cast("double"))
                 for d in depths]
        return list(held.agg(*right).first())
    jobs = list(product(range(folds), impurities, leaves))
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        scores = dict(zip(jobs, pool.map(inheritable_thread_target(df.sparkSession)(score), jobs)))
    settings = list(product(impurities, depths, leaves))
    metrics = [float(np.mean([scores[f, i, m][depths.index(d)] for f in range(folds)])) for i, d, m in settings]
    impurity, depth, leaf = settings[int(np.argmax(metrics))]
    return GridSearch(decision_tree(df, features, label, depth, leaf, impurity), metrics)
