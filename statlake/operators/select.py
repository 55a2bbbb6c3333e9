"""Feature selection: filter scores from one aggregate, wrapper searches
whose candidate models are fitted together.

Filter scores (variance, χ², ANOVA F, binned mutual information) are
computed for every feature in one or two keyed aggregates.  Wrapper
searches fit the logistic regressions of all candidates, folds and classes
of a step in the same passes (:mod:`statlake.operators.logit`).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.exprs import is_finite, minmax_scale
from statlake.functions.safe import div
from statlake.operators import logit
from statlake.operators.ranks import keyed_prefix, row_hash
from statlake.operators.seams import CHUNK, chunked, own_rows


def _long(df: DataFrame, cols: Sequence[str], id_col: str, label: str) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])
    return df.select(id_col, label, F.explode(arr).alias("e")).select(id_col, label, "e.feature", "e.v")


def variance_scores(df: DataFrame, cols: Sequence[str], threshold: float = 0.0) -> DataFrame:
    """Population variance per feature and ``keep`` = variance > threshold."""
    wide = df.agg(*[F.var_pop(c).alias(c) for c in cols])
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("variance")) for c in cols])
    return wide.select(F.explode(arr).alias("e")).select("e.*").withColumn("keep", F.col("variance") > threshold)


def chi2_scores(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """χ² of non-negative features ([0,1]-scaled first): observed =
    class sums, expected = feature total × class share."""
    s = minmax_scale(df, cols)
    cls = s.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"), *[F.sum(c).alias(c) for c in cols])
    tot = cls.agg(F.sum("_nc").alias("_n"), *[F.sum(c).alias(f"_t_{c}") for c in cols])
    j = cls.crossJoin(F.broadcast(tot))  # one-row frame
    terms = []
    for c in cols:
        e = F.col(f"_t_{c}") * F.col("_nc") / F.col("_n")
        terms.append(F.sum(F.when(e > 0, (F.col(c) - e) ** 2 / e).otherwise(0.0)).alias(c))
    wide = j.agg(*terms)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("chi2")) for c in cols])
    return wide.select(F.explode(arr).alias("e")).select("e.*")


def f_scores(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """S3: one-way ANOVA F of every feature across classes, from per-class
    counts, means and variances (centred: a large common mean costs no
    digits).  Null and non-finite values of a feature take no part."""
    ok = {c: F.when(is_finite(c), F.col(c).cast("double")) for c in cols}
    g = df.groupBy(label).agg(*[F.struct(F.lit(c).alias("feature"), F.count(ok[c]).alias("n"), F.avg(ok[c]).alias("m"),
                                         F.var_pop(ok[c]).alias("v")).alias(f"_{i}") for i, c in enumerate(cols)])
    g = g.select(F.explode(F.array(*[F.col(f"_{i}") for i in range(len(cols))])).alias("e")).select("e.*").filter("n > 0")
    # one row per class and feature
    g = g.join(g.groupBy("feature").agg(F.avg("m").alias("c")), "feature")
    off = F.col("m") - F.col("c")
    t = g.groupBy("feature").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("v")).alias("w"),
                                 F.sum(F.col("n") * off).alias("a"), F.sum(F.col("n") * off * off).alias("b"))
    ssb = F.col("b") - F.col("a") * F.col("a") / F.col("n")
    return t.select("feature", div(div(ssb, F.col("k") - 1), div(F.col("w"), F.col("n") - F.col("k"))).alias("f_stat"))


def mutual_info_binned(df: DataFrame, cols: Sequence[str], label: str, id_col: str, bins: int = 10) -> DataFrame:
    """S4 by bins (beside :func:`mutual_info_nearest`): mutual information between
    equal-frequency bins of each feature (rank order, ties by id) and the class, in nats."""
    lg = _long(df, cols, id_col, label)
    lg = lg.withColumns({"_one": F.lit(1), "_row": row_hash(lg)})
    r = keyed_prefix(lg, ["feature"], ["v", id_col, "_row"], "_one", out="_r")
    n = df.count()
    r = r.withColumn("bin", F.floor(F.col("_r") * bins / F.lit(n)).cast("int"))
    joint = r.groupBy("feature", "bin", label).agg(F.count(F.lit(1)).alias("nbc"))
    pb = joint.groupBy("feature", "bin").agg(F.sum("nbc").alias("nb"))
    pc = joint.groupBy("feature", label).agg(F.sum("nbc").alias("ncl"))
    j = joint.join(pb, ["feature", "bin"]).join(pc, ["feature", label])
    term = F.col("nbc") / n * F.log(F.col("nbc") * n / (F.col("nb") * F.col("ncl")))
    return j.groupBy("feature").agg(F.sum(term).alias("mi"))


def digamma_col(x: Column) -> Column:
    """ψ(x) for x >= 1: eight steps up by the recurrence, then the asymptotic series."""
    up = x + F.lit(8.0)
    tail = F.log(up) - 0.5 / up
    for i, c in enumerate((1 / 12, -1 / 120, 1 / 252, -1 / 240, 1 / 132)):
        tail = tail - F.lit(c) / F.pow(up, F.lit(2.0 * (i + 1)))
    for i in range(8):
        tail = tail - 1.0 / (x + F.lit(float(i)))
    return tail


def mutual_info_nearest(df: DataFrame, cols: Sequence[str], label: str, k: int = 3, chunk: int | None = None) -> DataFrame:
    """Mutual information (nats) of each feature with the class by nearest
    neighbours, ``(feature, n, mi)``.

    With d the distance of a row to the min(k, class size - 1)-th nearest
    other row of its class, N the rows, N_c those of its class and m the rows
    of any class nearer than d (itself counted; if d is 0, the rows at its
    value): ψ(N) + mean ψ(min(k, N_c - 1)) - mean ψ(N_c) - mean ψ(m), at least
    0.  Classes of one row take no part; neither do null and non-finite values
    and null classes.

    One dimension needs no pairs: the neighbours are among the k rows to
    either side in the order of the class (chunks with halo rows), and m is a
    difference of two prefix counts over values and interval ends sorted
    together.  No task holds a feature or a class."""
    feats = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])
    lg = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("c"), F.explode(feats).alias("e")).select("c", "e.feature", "e.v")
    lg = lg.filter(is_finite("v"))
    sizes = lg.groupBy("feature", "c").agg(F.count(F.lit(1)).alias("nc")).filter("nc > 1")
    lg = lg.join(sizes, ["feature", "c"])
    d, w = chunked(lg, ["feature", "c"], "v", before=k, after=k, chunk=chunk or CHUNK)
    near = [f(F.col("v"), i).over(w) for i in range(1, k + 1) for f in (F.lag, F.lead)]
    near = F.array_sort(F.array_compact(F.array(*[F.when(x.isNotNull(), F.struct(F.abs(x - F.col("v")).alias("d"), x.alias("at"))) for x in near])))
    d = d.withColumn("kk", F.least(F.lit(k), F.col("nc") - 1).cast("int")).withColumn("_near", near)
    d = own_rows(d.withColumn("nn", F.element_at("_near", F.col("kk"))), "_near")
    # equal (value, class, neighbour) rows have the same ends: counted once
    cell = d.groupBy("feature", "v", "nc", "kk", "nn").agg(F.count(F.lit(1)).alias("w"))
    v, gap, at = F.col("v"), F.col("nn.d"), F.col("nn.at")
    tied = gap == 0
    # the neighbour itself is an end, so rounding of v +- d can't count it in
    low = F.when(tied, F.struct(v.alias("x"), F.lit(0).alias("side"))).otherwise(
        F.struct(F.when(at < v, at).otherwise(v - gap).alias("x"), F.lit(2).alias("side")))
    high = F.when(tied, F.struct(v.alias("x"), F.lit(2).alias("side"))).otherwise(
        F.struct(F.when(at > v, at).otherwise(v + gap).alias("x"), F.lit(0).alias("side")))
    cell = cell.select("*", low.alias("low"), high.alias("high"))
    ends = cell.select("feature", F.explode(F.array("low", "high")).alias("e")).distinct().select("feature", "e.x", "e.side", F.lit(0).cast("long").alias("w"))
    values = lg.groupBy("feature", F.col("v").alias("x")).agg(F.count(F.lit(1)).alias("w")).select("feature", "x", F.lit(1).alias("side"), "w")
    # an end of side 0 comes before the values equal to it, one of side 2 after them
    before = keyed_prefix(values.unionByName(ends), ["feature"], ["x", "side"], "w", out="below").filter("side <> 1")
    before = before.select("feature", F.struct("x", "side").alias("end"), "below")
    cell = cell.join(before.select("feature", F.col("end").alias("low"), F.col("below").alias("n_low")), ["feature", "low"])
    cell = cell.join(before.select("feature", F.col("end").alias("high"), F.col("below").alias("n_high")), ["feature", "high"])
    psi = lambda c: digamma_col(F.col(c).cast("double"))
    m = cell.withColumn("m", F.col("n_high") - F.col("n_low"))
    t = m.groupBy("feature").agg(F.sum("w").alias("n"), F.sum(F.col("w") * (psi("kk") - psi("nc") - psi("m"))).alias("s"))
    return t.select("feature", "n", F.greatest(psi("n") + F.col("s") / F.col("n"), F.lit(0.0)).alias("mi"))


def top_k(scores: DataFrame, score: str, k: int) -> list[str]:
    """Names of the k best features (score desc, name) — k rows collected."""
    return [r["feature"] for r in scores.orderBy(F.desc(score), "feature").limit(k).collect()]


# ---- wrapper searches (logistic regressions, all candidates of a step together) -------------

def sequential_select(df: DataFrame, cols: Sequence[str], label: str, k: int, fold_col: str = "fold",
                      direction: str = "forward", c: float = 1.0) -> list[str]:
    """Greedy forward or backward selection to ``k`` features by the
    cross-validated accuracy of one-against-rest L2 logistic regressions."""
    with logit.Rows(df, cols, label, fold_col, c) as rows:
        return [cols[i] for i in logit.sequential(rows, k, direction)]


def rfe(df: DataFrame, cols: Sequence[str], label: str, k: int, step: int = 1, fold_col: str | None = None, c: float = 1.0) -> list[str]:
    """Recursive elimination — refit the L2 logistic regressions and drop
    the feature with the smallest Σ coef² each round.  Rows of fold −1 take no part."""
    with logit.Rows(df, cols, label, fold_col, c) as rows:
        return [cols[i] for i in logit.eliminate(rows, k, step)]


def model_select(df: DataFrame, cols: Sequence[str], label_idx: str, penalty: str = "l1", c: float = 1.0) -> list[str]:
    """Features with a non-zero coefficient under an L1 / elastic-net
    logistic regression."""
    from statlake.operators.learn import assemble, logistic
    n = df.count()
    m = logistic(assemble(df, cols), n, c, penalty, label=label_idx)
    nz = (np.abs(m.coefficientMatrix.toArray()) > 0).any(axis=0)
    return [c_ for c_, z in zip(cols, nz) if z]
