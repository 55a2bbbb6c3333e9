"""Sufficient statistics in one aggregate: counts, means and centred products.

``gram_agg`` is the shared primitive behind OLS, ADF, Granger, AR fits,
discriminant analysis and Gauss–Newton steps.  It is a single hash
aggregate with partial (map-side) aggregation, so a hot key costs no more
than any other: each task folds its rows into O(p²) numbers.  Products are
centred (Spark merges means and co-moments stably), so a column with a large
mean and a small spread keeps its digits.
The p x p solves that follow run per key inside ``mapInPandas`` over the
Gram rows (one row per key), never over data rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gram_agg(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
             extra: Sequence[Column] = ()) -> DataFrame:
    """One row per key over null-free ``cols``: ``n``, ``m__a`` = mean of a,
    ``c__a__b`` = population covariance of a and b (a ≤ b)."""
    cols = list(cols)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(c).alias(f"m__{c}") for c in cols]
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append((F.var_pop(a) if a == b else F.covar_pop(a, b)).alias(f"c__{a}__{b}"))
    aggs += list(extra)
    return df.groupBy(*keys).agg(*aggs)


def gram_from_row(row, cols: Sequence[str]):
    """(n, means[p], Σ(a−ā)(b−b̄) [p,p]) from a pandas row / dict of ``gram_agg``."""
    p = len(cols)
    n = float(row["n"])
    m = np.array([row[f"m__{c}"] for c in cols], dtype=float)
    c = np.zeros((p, p))
    for i, a in enumerate(cols):
        for j in range(i, p):
            c[i, j] = c[j, i] = n * row[f"c__{a}__{cols[j]}"]
    return n, m, c


def merge_rows(n: float, m: np.ndarray, c: np.ndarray, x: np.ndarray):
    """(n, means, centred products) after the rows of ``x`` join them."""
    if not len(x):
        return n, m, c
    mx = x.mean(0)
    cx = (x - mx).T @ (x - mx)
    total = n + len(x)
    d = mx - m
    return total, m + d * len(x) / total, c + cx + np.outer(d, d) * n * len(x) / total


def map_gram_rows(gram: DataFrame, fn: Callable[[pd.Series], list[dict]], schema: str) -> DataFrame:
    """Apply ``fn`` (one Gram row → result rows) inside ``mapInPandas``."""
    cols = [f.name for f in _schema_fields(gram.sparkSession, schema)]

    def run(it):
        for pdf in it:
            out = []
            for _, row in pdf.iterrows():
                out.extend(fn(row))
            yield pd.DataFrame(out, columns=cols)

    return gram.mapInPandas(run, schema)


def _schema_fields(spark, ddl: str):
    from pyspark.sql.types import _parse_datatype_string  # noqa: F401
    return spark.createDataFrame([], ddl).schema.fields


def ols_gram(n: float, mean: np.ndarray, c: np.ndarray, xi: Sequence[int], yi: int):
    """OLS with intercept from means and centred products, equilibrated
    (stable when columns differ in scale by many orders).

    Returns (beta [const, x...], ssr, inv of the full XᵀX, k)."""
    xi = list(xi)
    k = len(xi) + 1
    if not xi:
        ssr = float(c[yi, yi])
        return np.array([mean[yi]]), max(ssr, 1e-300), np.array([[1.0 / n]]), 1
    cxx = c[np.ix_(xi, xi)]
    cxy = c[xi, yi]
    cyy = c[yi, yi]
    dg = np.sqrt(np.maximum(np.diag(cxx), 1e-300))
    scaled = cxx / np.outer(dg, dg)
    try:
        inv_s = np.linalg.inv(scaled)
    except np.linalg.LinAlgError:
        inv_s = np.linalg.pinv(scaled)
    inv_c = inv_s / np.outer(dg, dg)
    slopes = inv_c @ cxy
    ssr = float(cyy - slopes @ cxy)
    xbar = mean[xi]
    beta = np.concatenate([[mean[yi] - slopes @ xbar], slopes])
    inv = np.empty((k, k))
    inv[1:, 1:] = inv_c
    inv[1:, 0] = inv[0, 1:] = -inv_c @ xbar
    inv[0, 0] = 1.0 / n + xbar @ inv_c @ xbar
    return beta, max(ssr, 1e-300), inv, k
