"""Linear recursions over series of any length.

Exponential smoothing, additive Holt-Winters and ARMA innovations are all
x(t+1) = M x(t) + g y(t) with a fixed matrix M: an affine map of the state.  A
chunk of m rows maps its first state x to M^m x + z, z being the outcome
from a zero state.  So the chunks are run at once from zero, the states at their
starts follow from one row a chunk, and the chunks are run again from there.

Multiplicative Holt-Winters divides by its states and is no affine map; it stays
per series (``forecast.holt_winters``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlake.functions.exprs import clean_numeric
from statlake.functions.safe import same_keys
from statlake.operators.seams import CHUNK, _k, numbered


def _run(y: np.ndarray, x: np.ndarray, m: np.ndarray, g: np.ndarray, keep: bool):
    """The state after the rows, and with ``keep`` the state before each."""
    seen = np.empty((len(y), len(x))) if keep else None
    push = np.outer(y, g)
    for t in range(len(y)):
        if keep:
            seen[t] = x
        x = m @ x + push[t]
    return x, seen


def affine_scan(df: DataFrame, keys, value: str, m: np.ndarray, g: Sequence[float], start: DataFrame | None = None,
                out: str = "state", chunk: int | None = None) -> DataFrame:
    """Adds ``out``, the state before each row, to rows with their place ``_t`` (see
    ``seams.numbered``).  ``start`` holds the first state of each series as
    ``(*keys, start)``, an array; zero without it."""
    keys, span = _k(keys), chunk or CHUNK
    m, g, given, started = np.asarray(m, dtype=float), np.asarray(g, dtype=float), df.columns, start is not None
    d = df.withColumn("_chunk", F.floor(F.col("_t") / span).cast("long"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*keys).schema.fields)

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("_t")[value].to_numpy(float)
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in keys}, "_chunk": [pdf["_chunk"].iloc[0]], "_m": [len(y)],
                             "_z": [_run(y, np.zeros(len(g)), m, g, False)[0]]})

    def carry(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        full, at = np.linalg.matrix_power(m, span), []
        x = np.array(pdf["start"].iloc[0], dtype=float) if started else np.zeros(len(g))
        for n, z in zip(pdf["_m"], pdf["_z"]):
            at.append(x)
            x = (full if n == span else np.linalg.matrix_power(m, int(n))) @ x + np.array(z)
        return pdf[[*keys, "_chunk"]].assign(_x=at)

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_t")
        seen = _run(pdf[value].to_numpy(float), np.array(pdf["_x"].iloc[0], dtype=float), m, g, True)[1]
        return pdf[given].assign(**{out: list(seen)})

    ends = d.select(*keys, value, "_t", "_chunk").groupBy(*keys, "_chunk").applyInPandas(reduce, kinds + "_chunk long, _m long, _z array<double>")
    if started:
        ends = same_keys(ends, start, keys) if keys else ends.crossJoin(F.broadcast(start))
    ends = ends.groupBy(*keys).applyInPandas(carry, kinds + "_chunk long, _x array<double>")  # one row a chunk
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])
    return same_keys(d, ends, [*keys, "_chunk"]).groupBy(*keys, "_chunk").applyInPandas(fill, schema)


def _prepared(df: DataFrame, keys, order, value: str) -> DataFrame:
    d = clean_numeric(df.withColumn(value, F.col(value).cast("double")), [value])
    return numbered(d, keys, order)


def smooth_additive(df: DataFrame, keys, order: str | Sequence[str], value: str, alpha: float, beta: float,
                    gamma: float = 0.0, season: int = 0, chunk: int | None = None) -> DataFrame:
    """F5 at fixed weights, additive: adds ``forecast`` (one step ahead, made before
    the row is seen) and ``error``.  Level and trend start from the means of the
    first two seasons (without season: from the first two rows; a single row has
    trend 0), the season from the first one.  Series shorter than two seasons
    and rows without a finite value give no rows; a null key is a series."""
    keys, given = _k(keys), df.columns
    d, s = _prepared(df, keys, order, value), season
    head = d.filter(F.col("_t") < max(2, 2 * s)).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_t", value))).alias("_h"))
    head = head.select(*keys, F.col(f"_h.{value}").alias("_h"))

    def mean(a):
        return F.aggregate(a, F.lit(0.0), lambda u, v: u + v) / s
    if s:
        head = head.filter(F.size("_h") == 2 * s).withColumns({"_a": mean(F.slice("_h", 1, s)), "_b": mean(F.slice("_h", s + 1, s))})
        first = F.concat(F.array(F.col("_a"), (F.col("_b") - F.col("_a")) / s), F.transform(F.slice("_h", 1, s), lambda v: v - F.col("_a")))
    else:
        first = F.array(F.get("_h", F.lit(0)), F.coalesce(F.get("_h", F.lit(1)) - F.get("_h", F.lit(0)), F.lit(0.0)))
    # state: level, trend, seasons from the row's own on
    look = np.zeros(2 + s)
    look[:min(3, 2 + s)] = 1.0
    step, push = np.zeros((2 + s, 2 + s)), np.zeros(2 + s)
    step[0, :2], step[1, 1], push[:2] = 1.0, 1.0, (alpha, alpha * beta)
    for j in range(s):
        step[2 + j, 2 + (j + 1) % s] = 1.0
    if s:
        push[-1] = gamma * (1 - alpha)
    d = affine_scan(d, keys, value, step - np.outer(push, look), push, head.select(*keys, first.alias("start")), "_state", chunk)
    seen = F.get("_state", F.lit(0)) + F.get("_state", F.lit(1)) + (F.get("_state", F.lit(2)) if s else 0.0)
    return d.withColumn("forecast", seen).withColumn("error", F.col(value) - F.col("forecast")).select(*given, "forecast", "error")


def arma_innovations(df: DataFrame, keys, order: str | Sequence[str], value: str, ar: Sequence[float], ma: Sequence[float],
                     chunk: int | None = None) -> DataFrame:
    """Innovations of F1 at fixed weights: adds ``resid``, e(t) = y(t) - sum ar_i y(t-i)
    - sum ma_j e(t-j), values and innovations before the first row being 0.
    Rows without a finite value give no rows; a null key is a series."""
    keys, given = _k(keys), df.columns
    d, p, q = _prepared(df, keys, order, value), len(ar), len(ma)
    if p + q == 0:
        return d.withColumn("resid", F.col(value)).select(*given, "resid")
    w = np.array([*ar, *ma], dtype=float)  # state: the last p values, then the last q innovations
    step, push = np.zeros((p + q, p + q)), np.zeros(p + q)
    for j in range(1, p):
        step[j, j - 1] = 1.0
    for j in range(1, q):
        step[p + j, p + j - 1] = 1.0
    if p:
        push[0] = 1.0
    if q:
        step[p], push[p] = -w, 1.0
    d = affine_scan(d, keys, value, step, push, None, "_state", chunk)
    told = F.aggregate(F.zip_with("_state", F.array(*[F.lit(float(v)) for v in w]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return d.withColumn("resid", F.col(value) - told).select(*given, "resid")
