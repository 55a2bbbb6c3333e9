import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from statlake.operators import select as sel
from statlake.operators import stats


def test_ks_statistic_matches_mllib(spark):
    from pyspark.ml.stat import KolmogorovSmirnovTest
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(float(v),) for v in rng.gamma(2.0, 1.0, 800)], ["v"])
    mine = stats.ks_test_norm(df, "v").first()
    ref = KolmogorovSmirnovTest.test(df, "v", "norm", mine["mu"], mine["sigma"]).first()
    assert math.isclose(mine["d_stat"], ref["statistic"], rel_tol=1e-9)
    assert abs(mine["p_value"] - ref["pValue"]) < 0.05


def test_f_scores_select_like_mllib(spark):
    from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
    rng = np.random.default_rng(6)
    n = 600
    y = rng.integers(0, 3, n)
    cols = [f"f{i}" for i in range(8)]
    x = rng.normal(size=(n, 8)) + np.outer(y, [0.0, 0.9, 0.0, 0.4, 0.0, 1.5, 0.1, 0.0])
    pdf = pd.DataFrame(x, columns=cols).assign(label=y.astype(float))
    df = spark.createDataFrame(pdf)
    mine = sel.top_k(sel.f_scores(df, cols, "label"), "f_stat", 3)
    v = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    m = (UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="sel", selectionMode="numTopFeatures")
         .setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(3).fit(v))
    assert sorted(mine) == sorted(cols[i] for i in m.selectedFeatures)


def test_pca_ratio_two_features_closed_form(spark):
    from statlake.operators.cluster import pca_explained
    rng = np.random.default_rng(8)
    a = rng.normal(size=300)
    b = 0.6 * a + rng.normal(scale=0.5, size=300)
    df = spark.createDataFrame([(float(p), float(q)) for p, q in zip(a, b)], ["a", "b"])
    got = [r["ratio"] for r in pca_explained(df, ["a", "b"], 2).orderBy("component").collect()]
    ev = np.sort(np.linalg.eigvalsh(np.cov(np.vstack([a, b]))))[::-1]
    assert np.allclose(got, ev / ev.sum(), atol=1e-9)
