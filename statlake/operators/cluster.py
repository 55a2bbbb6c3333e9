"""Clustering and dimension reduction.

Nearest-centre assignment uses the (small, k x p) centre set as a literal
array inside one projection — no join and no per-row Python.  Iterative
methods (k-means restarts, batch SOM) run one Spark aggregate per step
over a cached input; only k x p sums reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.exprs import clean_numeric


def nearest_center(df: DataFrame, cols: Sequence[str], centers: Sequence[Sequence[float]],
                   out: str = "cluster", dist_out: str = "sqdist") -> DataFrame:
    """Index of the nearest centre (squared Euclidean; ties → lowest
    index) and that squared distance."""
    if len(cols) * len(centers) > 256:
        return _nearest_wide(df, list(cols), centers, out, dist_out)
    cand = []
    for i, c in enumerate(centers):
        d = F.lit(0.0)
        for col, v in zip(cols, c):
            d = d + (F.col(col) - F.lit(float(v))) * (F.col(col) - F.lit(float(v)))
        cand.append(F.struct(d.alias("d"), F.lit(i).alias("i")))
    best = F.array_min(F.array(*cand))
    return df.withColumn("_best", best).withColumn(out, F.col("_best.i").cast("long")).withColumn(
        dist_out, F.col("_best.d")).drop("_best")


def _nearest_wide(df: DataFrame, cols: list[str], centers, out: str, dist_out: str) -> DataFrame:
    """The same for many dimensions and centres: numpy on Arrow batches, as
    the expression would outgrow a generated method."""
    import pyarrow as pa
    from pyspark.sql import types as T
    cs = np.asarray(centers, float)

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in cols])
            best = np.zeros(len(x), np.int64)
            dist = np.full(len(x), np.inf)
            for i, c in enumerate(cs):
                d = ((x - c) ** 2).sum(1)
                less = d < dist
                best[less], dist[less] = i, d[less]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(best), pa.array(dist)], [*b.schema.names, out, dist_out])
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.LongType()), T.StructField(dist_out, T.DoubleType())]))


def inertia(df: DataFrame, cols: Sequence[str], centers) -> DataFrame:
    """K2: Σ squared distance to the nearest centre, with cluster sizes."""
    a = nearest_center(df, cols, centers)
    return a.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("sqdist").alias("sse"))


def centroids(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """A21 used as centres: per-label means."""
    return df.groupBy(label).agg(*[F.avg(c).alias(c) for c in cols])


BLOCK_ROWS = 4096


def _lloyd(df: DataFrame, cols: Sequence[str], starts: Sequence[np.ndarray], max_iter: int, tol: float):
    """(centres, cost) of Lloyd's iterations from each of ``starts``.

    All runs advance together: a step is one pass over the rows, held as blocks
    of doubles, in which a task adds up, for every run that still moves, the
    rows, sums and squared distances of each centre (a few numbers a centre
    reach the driver).  A run ends when no centre moves more than ``tol``; its
    cost is that of its last assignment; a centre without rows stays."""
    import pyarrow as pa
    p = len(cols)

    def pack(batches):
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in cols])
            parts = [x[i:i + BLOCK_ROWS].tobytes() for i in range(0, len(x), BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["x"])
    parallel = df.sparkSession.sparkContext.defaultParallelism
    blocks = df.select(*cols).mapInArrow(pack, "x binary").coalesce(2 * parallel).persist()
    runs = [[np.array(c, float), 0.0, False] for c in starts]
    try:
        for _ in range(max_iter):
            live = [r for r in runs if not r[2]]
            if not live:
                break
            centres = [r[0] for r in live]

            def add(batches):
                cost = np.zeros(len(centres))
                sums = [np.zeros((len(c), p + 1)) for c in centres]
                for b in batches:
                    for v in b.column(0):
                        x = np.frombuffer(v.as_buffer(), float).reshape(-1, p)
                        one = np.column_stack([x, np.ones(len(x))])
                        for i, c in enumerate(centres):
                            best = ((c * c).sum(1) - 2.0 * (x @ c.T)).argmin(1)
                            cost[i] += ((x - c[best]) ** 2).sum()
                            sums[i] += (best == np.arange(len(c))[:, None]).astype(float) @ one
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([cost, *[s.ravel() for s in sums]])])], ["v"])
            total = np.sum([r["v"] for r in blocks.mapInArrow(add, "v array<double>").collect()], axis=0)
            at = len(live)
            for i, r in enumerate(live):
                c = r[0]
                s = total[at:at + c.shape[0] * (p + 1)].reshape(-1, p + 1)
                at += s.size
                some = s[:, p] > 0
                new = c.copy()
                new[some] = s[some, :p] / s[some, p:]
                r[:] = [new, float(total[i]), bool((((new - c) ** 2).sum(1) <= tol * tol).all())]
        return [(c.tolist(), cost) for c, cost, _ in runs]
    finally:
        blocks.unpersist()


def _kmeans_many(df: DataFrame, cols: Sequence[str], ks: Sequence[int], n_init: int, max_iter: int, tol: float, seed: int):
    """{k: (centres, cost)} of the best of ``n_init`` runs for each k: MLlib's
    k-means|| gives the starts, all runs then share the passes of :func:`_lloyd`."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    df = clean_numeric(df.select(*cols), cols)
    data = VectorAssembler(inputCols=list(cols), outputCol="_features").transform(df).select("_features")
    data = data.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism).cache()
    try:
        jobs = [(k, seed + i) for k in ks for i in range(n_init)]
        starts = [np.array(KMeans(k=k, maxIter=0, tol=tol, seed=s, featuresCol="_features").fit(data).clusterCenters()) for k, s in jobs]
    finally:
        data.unpersist()
    out: dict = {}
    for (k, _), (centres, cost) in zip(jobs, _lloyd(df, cols, starts, max_iter, tol)):
        if k not in out or cost < out[k][1]:
            out[k] = (centres, cost)
    return out


def kmeans(df: DataFrame, cols: Sequence[str], k: int, n_init: int = 10, max_iter: int = 300,
           tol: float = 1e-4, seed: int = 42):
    """K1: k-means (k-means|| seeding) started ``n_init`` times with different
    seeds; the lowest cost wins.  Returns (centres as list, cost)."""
    return _kmeans_many(df, cols, [k], n_init, max_iter, tol, seed)[k]


def silhouette_sq(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """K3 (squared Euclidean): per-row silhouette from per-cluster sufficient
    statistics (size, mean, variances): the mean squared distance of x to a
    cluster is that to its mean plus the cluster's spread, so no pairs are
    formed.  Own-cluster mean excludes the point itself; singletons, points
    that coincide with all others and a lone cluster score 0.  ``(label, n, silhouette)``
    per cluster plus an ``__all__`` row."""
    import pyarrow as pa
    cols = list(cols)
    df = clean_numeric(df.select(label, *cols), cols)
    # k rows (bounded by the number of clusters): size, mean and mean squared distance to the mean
    stats = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)],
                                  *[F.var_pop(c).alias(f"_v{i}") for i, c in enumerate(cols)]).collect()
    place = {r[label]: i for i, r in enumerate(stats)}
    size = np.array([float(r["_n"]) for r in stats])
    mean = np.array([[r[f"_m{i}"] for i in range(len(cols))] for r in stats], float).reshape(len(stats), len(cols))
    spread = np.array([sum(r[f"_v{i}"] for i in range(len(cols))) for r in stats], float)

    def score(batches):
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in cols])
            own = np.array([place[v] for v in b.column(label).to_pylist()], np.int64)
            at = np.arange(len(x))
            # mean squared distance to a cluster = squared distance to its mean + its spread
            d = np.column_stack([((x - m) ** 2).sum(1) + v for m, v in zip(mean, spread)]) if len(x) else np.zeros((0, len(size)))
            n = size[own]
            a = d[at, own] * n / np.maximum(1, n - 1)
            d[at, own] = np.inf
            near = d.min(1) if len(x) else np.zeros(0)
            top = np.maximum(a, near)
            s = np.where((n > 1) & (top > 0) & np.isfinite(near), (near - a) / np.where(top > 0, top, 1), 0.0)
            yield pa.RecordBatch.from_arrays([b.column(label), pa.array(s)], [label, "silhouette"])
    kind = df.schema[label].dataType.simpleString()
    rows = df.mapInArrow(score, f"`{label}` {kind}, silhouette double")
    by = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette"))
    allr = rows.agg(F.lit("__all__").alias(label), F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette"))
    return by.withColumn(label, F.col(label).cast("string")).unionByName(allr)


def kmeans_sweep(df: DataFrame, cols: Sequence[str], ks=range(2, 8), seed: int = 42, n_init: int = 3):
    """K3 sweep: k-means for each k, all runs together, squared-Euclidean silhouette of each."""
    out = []
    for k, (centers, cost) in _kmeans_many(df, cols, list(ks), n_init, 300, 1e-4, seed).items():
        lab = nearest_center(df, cols, centers)
        sil = silhouette_sq(lab, cols, "cluster").filter(F.col("cluster") == "__all__").first()["silhouette"]
        out.append((k, cost, sil))
    return df.sparkSession.createDataFrame(out, "k long, inertia double, silhouette double")


def pca_explained(df: DataFrame, cols: Sequence[str], k: int = 2) -> DataFrame:
    """K4: explained-variance ratios of the top ``k`` components (MLlib PCA)."""
    from pyspark.ml.feature import PCA, VectorAssembler
    v = VectorAssembler(inputCols=list(cols), outputCol="_f").transform(df.select(*cols))
    m = PCA(k=k, inputCol="_f", outputCol="_pc").fit(v)
    ev = [float(x) for x in m.explainedVariance]
    return df.sparkSession.createDataFrame([(i + 1, e) for i, e in enumerate(ev)], "component long, ratio double")


def som_grid(m: int, n: int):
    return [(iy, ix) for iy in range(m) for ix in range(n)]


def som_fit(df: DataFrame, cols: Sequence[str], m: int, n: int, epochs: int = 20, seed: int = 0,
            sigma0: float | None = None):
    """K5 (batch SOM): per epoch assign every row to its best-matching unit
    (literal weight array), aggregate Σx and counts per unit in Spark, then
    smooth the m·n unit sums with a Gaussian neighbourhood whose width decays
    σ0·e^{−t/T}.  Returns (weights [m·n, p], quantisation error per epoch)."""
    cols = list(cols)
    data = clean_numeric(df.select(*cols), cols).cache()
    try:
        rng = np.random.default_rng(seed)
        # start weights: the rows with the smallest hash, whatever the partitioning
        sample = data.orderBy(F.xxhash64(*cols, F.lit(seed)), *cols).limit(max(m * n * 4, 64)).collect()
        pts = np.array([[r[c] for c in cols] for r in sample], dtype=float)
        w = pts[rng.choice(len(pts), size=m * n, replace=len(pts) < m * n)]
        grid = np.array(som_grid(m, n), dtype=float)
        sigma0 = sigma0 or max(m, n) / 2.0
        history = []
        for t in range(epochs):
            a = nearest_center(data, cols, w.tolist(), "bmu", "qe")
            rows = a.groupBy("bmu").agg(F.count(F.lit(1)).alias("c"), F.sum("qe").alias("qe"),
                                        *[F.sum(c).alias(c) for c in cols]).collect()
            counts = np.zeros(m * n)
            sums = np.zeros((m * n, len(cols)))
            qe = 0.0
            for r in rows:
                counts[r["bmu"]] = r["c"]
                sums[r["bmu"]] = [r[c] for c in cols]
                qe += r["qe"]
            history.append(qe / max(counts.sum(), 1))
            sigma = max(sigma0 * math.exp(-t / epochs), 0.5)
            d2 = ((grid[:, None, :] - grid[None, :, :]) ** 2).sum(-1)
            h = np.exp(-d2 / (2 * sigma * sigma))
            num = h @ sums
            den = h @ counts
            ok = den > 0
            w[ok] = num[ok] / den[ok, None]
        return w, history
    finally:
        data.unpersist()


def som_transform(df: DataFrame, cols: Sequence[str], weights, n: int) -> DataFrame:
    """K6: best-matching unit and its grid coordinates (iy, ix)."""
    a = nearest_center(df, cols, [list(map(float, x)) for x in weights], "bmu", "qe")
    return a.withColumn("iy", (F.col("bmu") / n).cast("long")).withColumn("ix", (F.col("bmu") % n).cast("long"))


def som_hit_map(assigned: DataFrame, top: int = 5) -> DataFrame:
    """K7: hits per unit, the ``top`` busiest units first (ties by position)."""
    return (assigned.groupBy("iy", "ix").agg(F.count(F.lit(1)).alias("hits"))
                    .orderBy(F.desc("hits"), "iy", "ix").limit(top))
