"""Regressions on lags from sums of lag products.

The cross-product matrix of a series' own lags is Toeplitz but for its edges:
moving both lags on by one place adds one product at the head of the series
and takes one off at its tail.  So the matrix of L lags of m columns follows
from m * m * (L + 1) sums over the rows and the L rows at either end.  The sums
are taken per chunk of the series in numpy (with halo rows from the chunk
before) and added up in Spark; the plan doesn't grow with the number of lags.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.safe import same_keys
from statlake.operators.moments import merge_rows
from statlake.operators.seams import chunked

# what a row of the regression holds, made from the rows of the series: rows lost
# at the head, the columns, and a centre near their means
SHAPES = {
    "as is": (0, lambda y: y, lambda mean, first, last, n: mean),
    "differences": (1, lambda y: np.diff(y, axis=0), lambda mean, first, last, n: (last - first) / max(n - 1, 1)),
    "level and difference": (1, lambda y: np.column_stack([y[:-1], np.diff(y, axis=0)]),
                             lambda mean, first, last, n: np.r_[mean, (last - first) / max(n - 1, 1)]),
}


def lag_sums(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], shape: str, lags: Callable[[int], int],
             chunk: int | None = None) -> DataFrame:
    """``(*keys, n, centre, sums)`` per series of null-free ``cols``: the rows,
    the centre taken off and what :class:`LagGram` reads.  ``lags`` gives the
    number of lags for n rows and doesn't fall with n.  A keyed series is one
    chunk unless ``chunk`` is given, as for windows."""
    keys, cols = list(keys), list(cols)
    lost, make, centre_of = SHAPES[shape]
    rows = df.select(*keys, order, *cols)
    facts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[
        F.array(F.avg(c), F.min_by(c, order), F.max_by(c, order)).cast("array<double>").alias(f"_f{i}") for i, c in enumerate(cols)])
    whole = bool(keys) and chunk is None
    if whole:
        d = rows.withColumns({"_t": F.col(order), "_own": F.lit(True), "_chunk": F.lit(0)})
    else:
        longest = facts.agg(F.max("_n")).first()[0] or 0
        d, _ = chunked(rows, keys, order, before=lags(int(longest)) + lost, chunk=chunk)
    d = same_keys(d, facts, keys) if keys else d.crossJoin(F.broadcast(facts))  # one row

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_t")
        head = pdf.iloc[0]
        n = int(head["_n"])
        mean, first, last = np.array([list(head[f"_f{i}"]) for i in range(len(cols))]).T
        centre = centre_of(mean, first, last, n)
        u = make(pdf[cols].to_numpy(float)) - centre
        own = pdf["_own"].to_numpy(bool)[lost:]
        at = (np.arange(len(u)) if whole else pdf["_t"].to_numpy()[lost:] - lost)
        count, k, m = n - lost, lags(n), len(centre)
        place, value = [], []
        used = np.flatnonzero(own & (at >= k))
        if len(used):
            p, q = used[0], used[-1] + 1
            prods = np.stack([u[p:q].T @ u[p - j:q - j] for j in range(k + 1)], axis=-1)
            value += [prods.ravel(), u[p:q].sum(0)]
            place += [np.arange(m * m * (k + 1) + m)]
        ends = m * m * (k + 1) + m
        for start, low in ((ends, 0), (ends + k * m, count - k)):
            here = np.flatnonzero(own & (at >= low) & (at < low + k) & (at >= 0))
            value.append(u[here].ravel())
            place.append((start + (at[here] - low)[:, None] * m + np.arange(m)).ravel())
        return pd.DataFrame({**{c: [head[c]] for c in keys}, "n": [n], "centre": [centre],
                             "place": [np.concatenate(place).astype(np.int64)], "value": [np.concatenate(value)]})

    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.select(*keys).schema.fields)
    parts = d.groupBy(*keys, "_chunk").applyInPandas(run, kinds + "n long, centre array<double>, place array<long>, value array<double>")
    each = parts.select(*keys, "n", "centre", F.explode_outer(F.arrays_zip("place", "value")).alias("e")).select(*keys, "n", "centre", "e.*")
    each = each.groupBy(*keys, "n", "centre", "place").agg(F.sum("value").alias("value"))
    # at most (m * m + 2 m) (lags + 1) + m entries a series
    return each.groupBy(*keys, "n", "centre").agg(F.sort_array(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "value")))).alias("sums"))


class LagGram:
    """Means and centred products of lagged columns, from a ``lag_sums`` row.

    Columns are pairs (column of the shape, lag).  The centre stays off:
    slopes and residual sums of a regression with a constant don't change."""

    def __init__(self, row, shape: str, lags: int):
        lost = SHAPES[shape][0]
        self.centre = np.array(list(row["centre"]), float)
        self.rows, self.lags = int(row["n"]) - lost, lags
        m, k = len(self.centre), lags
        flat = np.zeros(m * m * (k + 1) + m + 2 * k * m)
        for e in row["sums"]:
            flat[e["place"]] = e["value"]
        self.prods = flat[:m * m * (k + 1)].reshape(m, m, k + 1)
        self.sum0 = flat[m * m * (k + 1):m * m * (k + 1) + m]
        self.head, self.tail = flat[len(flat) - 2 * k * m:].reshape(2, k, m)

    def _early(self, columns, start: int) -> np.ndarray:
        """Rows ``start`` to ``lags`` - 1; lags from before the series are 0."""
        at = np.arange(start, self.lags)
        if not len(at):
            return np.zeros((0, len(columns)))
        return np.column_stack([np.where(at >= j, self.head[np.maximum(at - j, 0), c], 0.0) for c, j in columns])

    def gram(self, columns: Sequence[tuple[int, int]], start: int | None = None):
        """(n, means, centred products) of ``columns`` over the rows from
        ``start`` on (default: from the row that has all lags)."""
        k, n = self.lags, max(self.rows - self.lags, 0)
        m = len(self.centre)
        g, s = np.zeros((m, m, k + 1, k + 1)), np.zeros((m, k + 1))
        g[:, :, 0, :] = self.prods
        g[:, :, :, 0] = self.prods.transpose(1, 0, 2)
        s[:, 0] = self.sum0
        if k and n:
            back, off = self.head[::-1], self.tail[::-1]  # the rows before the first and up to the last, nearest first
            for i in range(k):
                g[:, :, i + 1, 1:] = (g[:, :, i, :-1] + back[i][:, None, None] * back.T[None] - off[i][:, None, None] * off.T[None])
                s[:, i + 1] = s[:, i] + back[i] - off[i]
        c, j = np.array(columns).T
        mean = s[c, j] / max(n, 1)
        prods = g[c[:, None], c[None, :], j[:, None], j[None, :]] - n * np.outer(mean, mean)
        return merge_rows(n, mean, prods, self._early(columns, k if start is None else start))


def nested_ssr(c: np.ndarray) -> np.ndarray | None:
    """Residual sums of regressing the last column on the first 0, 1, 2, ...
    of the others, from centred products by one Cholesky factor; None where
    the regressors are linearly dependent."""
    d = np.sqrt(np.maximum(np.diag(c), 1e-300))
    scaled = c / np.outer(d, d)
    try:
        low = np.linalg.cholesky(scaled[:-1, :-1])
    except np.linalg.LinAlgError:
        return None
    if np.diag(low).min(initial=1.0) < 1e-7:
        return None
    z = np.zeros(len(low))
    for i in range(len(low)):
        z[i] = (scaled[i, -1] - low[i, :i] @ z[:i]) / low[i, i]
    return np.maximum(c[-1, -1] * (1.0 - np.r_[0.0, np.cumsum(z * z)]), 1e-300)
