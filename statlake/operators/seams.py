"""Long series in chunks: windows with halo rows, lag products, banded solves.

A window over a series without a key is one task for the whole table, and so is
one over a key that holds most rows.  Here the rows of a series are numbered by
bucketed prefix counts and cut into chunks of ``CHUNK`` places:

* a window that looks ``before`` places back and ``after`` places ahead gets
  copies of just those rows of the neighbour chunks (the halo) and drops them
  afterwards, so its values are exact at the seams;
* what reaches further (the last value seen) is carried over one summary row a
  chunk;
* sums of lag products are taken per chunk in numpy, whatever the number of
  lags, and added up in Spark;
* a banded system is reduced chunk by chunk to the two values at each end,
  solved there, and filled in again per chunk.

Rows that tie in the order are placed by a hash of all their columns, so the
outcome does not depend on partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.functions.safe import same_keys
from statlake.operators.ranks import keyed_prefix, row_hash

CHUNK = 100_000


def _k(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def numbered(df: DataFrame, keys, order: str | Sequence[str], out: str = "_t") -> DataFrame:
    """Adds the 0-based place of each row in its series."""
    d = df.withColumns({"_one": F.lit(1).cast("long"), "_row": row_hash(df)})
    return keyed_prefix(d, _k(keys), [*_k(order), "_row"], "_one", out=out).drop("_one", "_row")


def chunked(df: DataFrame, keys, order: str | Sequence[str], before: int = 0, after: int = 0, chunk: int | None = None,
            places: bool = False):
    """(rows, window): rows with ``_t`` (place), ``_chunk`` and ``_own``, false
    for copies from the neighbour chunks; the window runs over one chunk.  With
    ``places`` the order is a column of ``numbered`` and the rows are not numbered again."""
    span = max(chunk or CHUNK, before, after)
    d = df.withColumn("_t", F.col(order)) if places else numbered(df, keys, order)
    home, at = F.floor(F.col("_t") / span), F.col("_t") % span
    chunks = [home]
    if before:
        chunks.append(F.when(at >= span - before, home + 1))
    if after:
        chunks.append(F.when((at < after) & (home > 0), home - 1))
    d = d.withColumn("_home", home).withColumn("_chunk", F.explode(F.array_compact(F.array(*chunks))))
    d = d.withColumn("_own", F.col("_chunk") == F.col("_home")).drop("_home")
    return d, Window.partitionBy(*_k(keys), "_chunk").orderBy("_t")


def own_rows(d: DataFrame, *also: str) -> DataFrame:
    """The rows of ``chunked`` without the copies and without its columns."""
    return d.filter("_own").drop("_own", "_chunk", "_t", *also)


def nearest_seen(d: DataFrame, keys, window, seen: str, chunk_col: str = "_chunk") -> DataFrame:
    """Adds ``_prev`` and ``_next``: the nearest non-null ``seen`` at or before
    and at or after each row of ``chunked`` (without halo)."""
    keys = _k(keys)
    ends = d.groupBy(*keys, chunk_col).agg(F.max_by(seen, F.when(F.col(seen).isNotNull(), F.col("_t"))).alias("_last"),
                                           F.min_by(seen, F.when(F.col(seen).isNotNull(), F.col("_t"))).alias("_first"))
    part = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))  # one row a chunk
    # what comes next is what was last seen from behind: a frame that ends with the partition is read anew for every row
    back = Window.partitionBy(*keys, chunk_col).orderBy(F.desc("_t"))
    before = (Window.unboundedPreceding, -1)
    ends = ends.select(*keys, chunk_col, F.last("_last", ignorenulls=True).over(part.orderBy(chunk_col).rowsBetween(*before)).alias("_carried"),
                       F.last("_first", ignorenulls=True).over(part.orderBy(F.desc(chunk_col)).rowsBetween(*before)).alias("_coming"))
    d = same_keys(d, ends, [*keys, chunk_col])
    return (d.withColumn("_prev", F.coalesce(F.last(seen, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)), "_carried"))
             .withColumn("_next", F.coalesce(F.last(seen, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0)), "_coming"))
             .drop("_carried", "_coming"))


def lag_products(df: DataFrame, keys, order: str, value: str, lags: int, chunk: int | None = None) -> DataFrame:
    """``(*keys, n, lag, product)``: the number of rows and, for lag 0 to
    ``lags``, the sum of c(t) * c(t - lag), c being ``value`` less its mean.  A
    chunk's sums are one numpy pass; the plan does not grow with ``lags``.
    ``value`` has no nulls.  As for windows, a keyed series is one chunk unless
    ``chunk`` is given."""
    keys = _k(keys)
    rows = df.select(*keys, order, value)
    facts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("_mean"))
    if keys and chunk is None:
        d = rows.withColumns({"_t": F.col(order), "_own": F.lit(True), "_chunk": F.lit(0)})
    else:
        d, _ = chunked(rows, keys, order, before=lags, chunk=chunk)
    d = same_keys(d, facts, keys)
    keys = [*keys, "n"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_t")
        y, own = pdf[value].to_numpy(float) - pdf["_mean"].iloc[0], pdf["_own"].to_numpy(bool)
        out = np.zeros(lags + 1)
        for k in range(min(lags, len(y) - 1) + 1):
            out[k] = (y[k:] * y[:len(y) - k])[own[k:]].sum()
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in keys}, "products": [out]})

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.select(*keys).schema.fields)
    sums = d.groupBy(*keys, "_chunk").applyInPandas(run, kinds + ", products array<double>")
    return (sums.select(*keys, F.posexplode("products").alias("lag", "product")).groupBy(*keys, "lag")
            .agg(F.sum("product").alias("product")).withColumn("lag", F.col("lag").cast("long")))


# ---- pentadiagonal systems -------------------------------------------------------------

def _bands(a: int, b: int, n: int, lamb: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows a - 2 to b - 1 of I + lamb * D'D, D the second difference of n
    values: its diagonal and its first and second off-diagonals (to the right)."""
    i = np.arange(a - 2, b)
    valid = lambda r: ((r >= 0) & (r <= n - 3)).astype(float)
    main = 1.0 + lamb * (valid(i) + 4 * valid(i - 1) + valid(i - 2))
    return main, lamb * (-2 * valid(i) - 2 * valid(i - 1)), lamb * valid(i)


def _banded_solve(main: np.ndarray, one: np.ndarray, two: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Symmetric positive pentadiagonal solve for the columns of ``rhs`` by L D L'."""
    n = len(main)
    d, p, q = [0.0] * n, [0.0] * n, [0.0] * n
    a0, a1, a2 = main.tolist(), one.tolist(), two.tolist()
    for i in range(n):
        x = a0[i]
        y = a1[i]
        if i:
            x -= p[i - 1] * p[i - 1] * d[i - 1]
            y -= q[i - 1] * p[i - 1] * d[i - 1]
        if i > 1:
            x -= q[i - 2] * q[i - 2] * d[i - 2]
        d[i], p[i], q[i] = x, y / x, a2[i] / x
    z = [list(c) for c in rhs.T.tolist()]
    for c in z:
        for i in range(1, n):
            c[i] -= p[i - 1] * c[i - 1] + (q[i - 2] * c[i - 2] if i > 1 else 0.0)
        for i in range(n - 1, -1, -1):
            c[i] = c[i] / d[i] - (p[i] * c[i + 1] if i + 1 < n else 0.0) - (q[i] * c[i + 2] if i + 2 < n else 0.0)
    return np.array(z).T


def _couplings(a: int, b: int, n: int, lamb: float):
    """(bands of the block, left and right): columns of the block's rows for
    the two values before a and the two from b on."""
    main, one, two = _bands(a, b, n, lamb)
    m = b - a
    left, right = np.zeros((m, 2)), np.zeros((m, 2))
    left[0] = two[0], one[1]
    left[1 if m > 1 else 0, 1] += two[1] if m > 1 else 0.0
    right[m - 1] = one[m + 1], two[m + 1]
    if m > 1:
        right[m - 2, 0] = two[m]
    if a == 0:
        left[:] = 0.0
    if b == n:
        right[:] = 0.0
    return main[2:], one[2:], two[2:], left, right


def smooth_penalised(df: DataFrame, keys, order: str | Sequence[str], value: str, lamb: float, out: str = "trend",
                     chunk: int | None = None) -> DataFrame:
    """Adds the ``out`` that minimises the sum of (value - out)^2 plus ``lamb``
    times that of squared second differences, per series of any length.

    Each chunk is solved for its own values and for unit values of its
    neighbours' ends; a system of four unknowns a chunk gives the ends; then
    each chunk is solved once more with its neighbours' ends known."""
    keys = _k(keys)
    span, given = max(4, chunk or CHUNK), df.columns
    d = numbered(df, keys, order)
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    d = same_keys(d, n, keys)
    # a last chunk of one row belongs to the one before
    d = d.withColumn("_chunk", F.least(F.floor(F.col("_t") / span), F.floor(F.greatest(F.col("_n") - 2, F.lit(0)) / span)).cast("long"))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in df.select(*keys).schema.fields)

    def block(pdf: pd.DataFrame):
        pdf = pdf.sort_values("_t")
        a, n = int(pdf["_t"].iloc[0]), int(pdf["_n"].iloc[0])
        return pdf, _couplings(a, a + len(pdf), n, lamb)

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, (main, one, two, left, right) = block(pdf)
        x = _banded_solve(main, one, two, np.column_stack([pdf[value].to_numpy(float), left, right]))
        ends = x[[0, min(1, len(x) - 1), max(0, len(x) - 2), len(x) - 1]]
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in keys}, "_chunk": [int(pdf["_chunk"].iloc[0])], "ends": [ends.ravel()]})

    def join_ends(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        e = np.array(pdf["ends"].tolist()).reshape(-1, 4, 5)
        ends = _solve_ends(e)
        before = np.vstack([np.zeros((1, 2)), ends[:-1, 2:]])
        behind = np.vstack([ends[1:, :2], np.zeros((1, 2))])
        return pd.DataFrame({**{c: pdf[c] for c in keys}, "_chunk": pdf["_chunk"], "_b0": before[:, 0], "_b1": before[:, 1],
                             "_a0": behind[:, 0], "_a1": behind[:, 1]})

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, (main, one, two, left, right) = block(pdf)
        rhs = pdf[value].to_numpy(float) - left @ pdf[["_b0", "_b1"]].iloc[0].to_numpy(float) - right @ pdf[["_a0", "_a1"]].iloc[0].to_numpy(float)
        return pdf[given].assign(**{out: _banded_solve(main, one, two, rhs[:, None])[:, 0]})

    ends = d.select(*keys, value, "_t", "_n", "_chunk").groupBy(*keys, "_chunk").applyInPandas(reduce, kinds + "_chunk long, ends array<double>")
    # one row a chunk
    ends = ends.groupBy(*keys).applyInPandas(join_ends, kinds + "_chunk long, _b0 double, _b1 double, _a0 double, _a1 double")
    from pyspark.sql import types as T
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
    return same_keys(d, ends, [*keys, "_chunk"]).groupBy(*keys, "_chunk").applyInPandas(fill, schema)


def _solve_ends(e: np.ndarray) -> np.ndarray:
    """(chunks, 4): first two and last two values of each chunk.  ``e[j]`` has
    their parts from the chunk's own values and, to be taken off, from unit
    values of the two before and the two behind it.  Chunks are eliminated
    forwards (ends as a constant and a share of the next chunk's first two)
    and filled in backwards."""
    m = len(e)
    const, share = np.zeros((m, 4)), np.zeros((m, 4, 2))
    for j in range(m):
        own, left, right = e[j][:, 0], e[j][:, 1:3], e[j][:, 3:5]
        if j:  # last two of the chunk before = c - s @ (this chunk's first two)
            c, s = const[j - 1][2:], share[j - 1][2:]
            lhs = np.eye(4)
            lhs[:, :2] -= left @ s
            own, right = np.linalg.solve(lhs, own - left @ c), np.linalg.solve(lhs, right)
        const[j], share[j] = own, right
    out = np.zeros((m, 4))
    for j in range(m - 1, -1, -1):
        out[j] = const[j] - (share[j] @ out[j + 1][:2] if j + 1 < m else 0.0)
    return out
