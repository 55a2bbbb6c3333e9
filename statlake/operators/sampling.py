"""Selection probabilities and weighted sampling over table rows.

The selection schemes of evolutionary search are re-aimed at rows of a
table: each row has a fitness, each scheme gives every row a probability
(closed forms, no simulation), and ``weighted_sample`` draws rows by
inverse CDF in one sort of draws and interval starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.functions.exprs import clean_numeric
from statlake.functions.safe import div, same_keys
from statlake.operators.ranks import cumulative_share, exact_quantiles, keyed_prefix


def _k(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def _with_stats(df, fitness, keys):
    keys = _k(keys)
    st = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_N"), F.sum(fitness).alias("_sum"),
                               F.min(fitness).alias("_min"), F.max(fitness).alias("_max"))
    return same_keys(df, st, keys)


def worst_rank(df: DataFrame, fitness: str, id_col: str, keys=(), out: str = "wrank") -> DataFrame:
    """0-based rank from the worst (lowest fitness; ties by id), distributed."""
    d = df.withColumn("_one", F.lit(1))
    return keyed_prefix(d, _k(keys), [fitness, id_col], "_one", out=out).drop("_one")


def proportional(df: DataFrame, fitness: str, keys=(), shift_min: bool = False) -> DataFrame:
    """f/Σf, or the GA form (f − min + 1e-12)/Σ(f − min + 1e-12)."""
    d = _with_stats(df, fitness, keys)
    if shift_min:
        num = F.col(fitness) - F.col("_min") + F.lit(1e-12)
        den = F.col("_sum") - F.col("_N") * F.col("_min") + F.col("_N") * F.lit(1e-12)
    else:
        num, den = F.col(fitness), F.col("_sum")
    return d.withColumn("p", F.when(den != 0, num / den)).drop("_N", "_sum", "_min", "_max")


def rank_linear(df: DataFrame, fitness: str, id_col: str, keys=(), s: float = 1.5) -> DataFrame:
    """R2: (2−s)/N + 2i(s−1)/(N(N−1)), i = 0 for the worst row; a lone row has 1."""
    d = _with_stats(worst_rank(df, fitness, id_col, keys), fitness, keys)
    n = F.col("_N").cast("double")
    p = F.when(n > 1, (2.0 - s) / n + 2.0 * F.col("wrank") * (s - 1.0) / (n * F.greatest(n - 1.0, F.lit(1.0)))).otherwise(F.lit(1.0))
    return d.withColumn("p", p).drop("_N", "_sum", "_min", "_max")


def tournament(df: DataFrame, fitness: str, id_col: str, k: int, keys=(), replacement: bool = True) -> DataFrame:
    """Probability that a row wins a size-k tournament, r = 1-based rank
    from the worst: (r^k − (r−1)^k)/N^k with replacement,
    C(r−1, k−1)/C(N, k) without."""
    d = _with_stats(worst_rank(df, fitness, id_col, keys), fitness, keys)
    r = F.col("wrank").cast("double") + 1.0
    n = F.col("_N").cast("double")
    if replacement:
        p = (F.pow(r, k) - F.pow(r - 1.0, k)) / F.pow(n, k)
    else:
        num: Column = F.lit(1.0)
        for i in range(1, k):
            num = num * (r - i) / i
        den: Column = F.lit(1.0)
        for i in range(k):
            den = den * (n - i) / (i + 1)
        p = F.when(den != 0, F.when(r >= k, num / den).otherwise(F.lit(0.0)))
    return d.withColumn("p", p).drop("_N", "_sum", "_min", "_max")


def threshold(df: DataFrame, fitness: str, q: float, keys=()) -> DataFrame:
    """Uniform over rows with fitness ≥ the q-quantile (linear
    interpolation, exact); the best row alone if none qualifies."""
    keys = _k(keys)
    qt = exact_quantiles(df, fitness, [q], keys).select(*keys, F.col("quantile").alias("_thr"))
    d = same_keys(df, qt, keys)
    d = _with_stats(d, fitness, keys)
    ok = F.col(fitness) >= F.col("_thr")
    m = d.groupBy(*keys).agg(F.sum(ok.cast("long")).alias("_m"))
    d = same_keys(d, m, keys)
    p = F.when(F.col("_m") > 0, F.when(ok, 1.0 / F.col("_m")).otherwise(0.0)).otherwise(
        F.when(F.col(fitness) == F.col("_max"), 1.0).otherwise(0.0))
    return d.withColumn("p", p).drop("_thr", "_m", "_N", "_sum", "_min", "_max")


def uniform(seed: int, *parts) -> Column:
    """A number in [0, 1) from the MD5 of the parts and a seed: the same for
    any partitioning (52 bits, exact in a double: every place of up to 2^52 can be drawn)."""
    text = F.concat_ws(":", *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def weighted_sample(df: DataFrame, weight: str, id_col: str, n_draws: int, seed: int = 7,
                    buckets: int | None = None) -> DataFrame:
    """``n_draws`` draws with replacement, P(row) ∝ weight, by inverse
    CDF: draw j has u_j from the MD5 of (j, seed) and takes the row whose
    interval [lo, hi) holds it.  ``(draw, id)``.

    Draws and interval starts are counted together by bucketed prefix sums: a
    draw with c starts at or before it takes the c-th.  Buckets follow a
    sample of both, so neither many draws nor many tiny weights at one place
    share a task (draws that hit one row are told apart by their number)."""
    spark = df.sparkSession
    iv = cumulative_share(clean_numeric(df.select(id_col, weight), [weight]).filter(F.col(weight) > 0), weight, [id_col])
    kind_of = df.schema[id_col].dataType
    none = F.lit(0).cast(kind_of)
    # of starts at one place (rows of no visible width) the last by id holds it
    starts = iv.select(F.col("cum_lo").alias("u"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("draw"), F.col(id_col).alias("id"),
                       F.lit(1).cast("long").alias("one"))
    draws = spark.range(n_draws).withColumnRenamed("id", "draw").select(
        uniform(seed, "draw").alias("u"), F.lit(1).alias("kind"), "draw", none.alias("id"), F.lit(0).cast("long").alias("one"))
    c = keyed_prefix(starts.unionByName(draws), [], ["u", "kind", "draw", "id"], "one", out="c", buckets=buckets)
    rows = c.filter("kind = 0").select("id", (F.col("c") + 1).alias("c"))  # its own place among the starts
    return c.filter("kind = 1").select("draw", "c").join(rows, "c").select("draw", "id")


def selection_probabilities(df: DataFrame, fitness: str, id_col: str, keys=(), s: float = 1.5, k: int = 3,
                            q: float = 0.5) -> DataFrame:
    """R1–R4 side by side: ``p_prop, p_prop_ga, p_rank, p_tour_w, p_tour_wo,
    p_thr`` from one rank, one set of totals and one quantile per key."""
    keys = _k(keys)
    d = _with_stats(worst_rank(df, fitness, id_col, keys), fitness, keys)
    thr = exact_quantiles(df, fitness, [q], keys).select(*keys, F.col("quantile").alias("_thr"))
    d = same_keys(d, thr, keys)
    f, n, r = F.col(fitness), F.col("_N").cast("double"), F.col("wrank").cast("double") + 1.0
    ok = f >= F.col("_thr")
    m = d.groupBy(*keys).agg(F.sum(ok.cast("long")).alias("_m"))
    d = same_keys(d, m, keys)
    num, den = F.lit(1.0), F.lit(1.0)
    for i in range(k):
        num = num * (r - i) / i if i else num
        den = den * (n - i) / (i + 1)
    ga = F.col("_sum") - F.col("_N") * F.col("_min") + F.col("_N") * F.lit(1e-12)
    out = {"p_prop": div(f, F.col("_sum")), "p_prop_ga": div(f - F.col("_min") + F.lit(1e-12), ga),
           "p_rank": F.when(n > 1, (2.0 - s) / n + 2.0 * F.col("wrank") * (s - 1.0) / (n * F.greatest(n - 1.0, F.lit(1.0)))).otherwise(F.lit(1.0)),
           "p_tour_w": (F.pow(r, k) - F.pow(r - 1.0, k)) / F.pow(n, k),
           "p_tour_wo": F.when(den != 0, F.when(r >= k, num / den).otherwise(F.lit(0.0))),
           "p_thr": F.when(F.col("_m") > 0, F.when(ok, 1.0 / F.col("_m")).otherwise(F.lit(0.0))).otherwise(
               F.when(f == F.col("_max"), F.lit(1.0)).otherwise(F.lit(0.0)))}
    return d.select(*[F.col(c) for c in df.columns], *[v.alias(c) for c, v in out.items()])


def selection_shares(draws: DataFrame, probs: DataFrame, id_col: str, n_draws: int) -> DataFrame:
    """Observed share of draws per row next to its probability."""
    c = draws.groupBy(F.col("id").alias(id_col)).agg(F.count(F.lit(1)).alias("hits"))
    return probs.join(c, id_col, "left").fillna(0, ["hits"]).withColumn("share", F.col("hits") / F.lit(float(n_draws)))


def tournament_draws(df: DataFrame, fitness: str, id_col: str, k: int, n_draws: int, seed: int = 7) -> DataFrame:
    """R3 draws: ``n_draws`` tournaments of size k with replacement; each
    pick is an MD5 of (draw, slot, seed) mapped onto a dense row position
    (bucketed prefix counts), joined on that unique position — no cross
    join — and the fittest pick wins (ties by id).  ``(draw, id)``."""
    spark = df.sparkSession
    base = df.select(id_col, fitness).withColumn("_one", F.lit(1))
    pos = keyed_prefix(base, [], [id_col], "_one", out="_pos").drop("_one")
    n = df.count()
    picks = (spark.range(n_draws).withColumnRenamed("id", "draw")
                  .withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
                  .withColumn("_pos", F.floor(uniform(seed, "draw", "_slot") * F.lit(float(n))).cast("long")))
    won = picks.join(pos, "_pos").groupBy("draw").agg(
        F.max_by(F.col(id_col), F.struct(F.col(fitness), F.col(id_col))).alias("id"))
    return won
