"""Distributed ordered prefix sums, ranks and exact quantiles.

A window ``partitionBy(key).orderBy(v)`` puts a whole key (or, without a
key, the whole table) into one task.  Here the sort space is cut into
range buckets whose boundaries come from a bounded sample, so

* bucket id is a pure function of the row (deterministic on recompute),
* a hot key is spread over many buckets,
* per-bucket totals (at most ``buckets + #keys`` rows) give the offsets.

``keyed_prefix`` is the primitive; ranks, quantiles, cumulative
probabilities and rank–frequency tables are built on it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.functions.safe import same_keys

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 512
SAMPLE_PER_BUCKET = 64


def _bucket_expr(cols: list[str], bounds: list[tuple]) -> Column:
    """Binary search over sorted boundary tuples as a ``when`` tree:
    bucket = number of boundaries <= row (lexicographic struct order)."""
    row = F.struct(*[F.col(c) for c in cols])

    def lit_struct(b):
        return F.struct(*[F.lit(v).alias(c) for v, c in zip(b, cols)])

    def build(lo: int, hi: int) -> Column:  # answer in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2  # bounds[mid-1] is the mid-th boundary
        return F.when(row < lit_struct(bounds[mid - 1]), build(lo, mid - 1)).otherwise(build(mid, hi))

    return build(0, len(bounds))


def _sort_key(t: tuple) -> tuple:
    """Python order matching Spark's ascending order with nulls first."""
    return tuple((v is not None, v) for v in t)


def _pick(pts: list[tuple], b: int) -> list[tuple]:
    """b−1 increasing boundaries at even ranks of the sorted sample; tuples
    holding a null are skipped (two buckets merge, results stay exact)."""
    pts = sorted(pts, key=_sort_key)
    bounds: list[tuple] = []
    for i in range(1, b):
        bd = pts[min((i * len(pts)) // b, len(pts) - 1)]
        if any(v is None for v in bd):
            continue
        if not bounds or _sort_key(bd) > _sort_key(bounds[-1]):
            bounds.append(bd)
    return bounds


def plan_bounds(cells: DataFrame, cols: list[str], buckets: int | None = None, seed: int = 17,
                with_estimate: bool = False, per_bucket: int | None = None):
    """Range-bucket boundaries over ``cols`` (lexicographic) from ONE job.

    The K rows with the smallest hash form a uniform, deterministic sample
    (each task keeps at most K rows); when the sample is full its K-th hash
    also estimates the number of distinct rows (KMV), which sets the bucket
    count unless ``buckets`` is given.  Returns [] for a single bucket
    (and the estimate when ``with_estimate``)."""
    k = MAX_BUCKETS * SAMPLE_PER_BUCKET
    h = F.xxhash64(*[F.col(c) for c in cols], F.lit(seed))
    rows = cells.select(*cols, h.alias("__kmv_hash")).orderBy("__kmv_hash").limit(k).collect()
    if len(rows) < k:
        n_est = len(rows)
    else:
        frac = (rows[-1]["__kmv_hash"] + 2 ** 63) / 2 ** 64
        n_est = (k - 1) / max(frac, 1e-18)
    b = buckets or max(1, min(MAX_BUCKETS, math.ceil(n_est / (per_bucket or ROWS_PER_BUCKET))))
    bounds = []
    if b > 1 and len(rows) >= b:
        bounds = _pick([tuple(r[c] for c in cols) for r in rows], b)
    return (bounds, n_est) if with_estimate else bounds


def plan_bounds_multi(rows: DataFrame, col_sets: Sequence[Sequence[str]], seed: int = 17):
    """Bucket plans for several sort orders from ONE bottom-K sample of the
    raw rows.  Quantiles over rows bound the cells per bucket too (a cell
    holds at least one row), and the row-count estimate is an upper bound
    on the cell count.  Returns [(bounds, n_est)] per column set."""
    allc = list(dict.fromkeys(c for cs in col_sets for c in cs))
    k = MAX_BUCKETS * SAMPLE_PER_BUCKET
    h = F.xxhash64(*[F.col(c) for c in allc], F.lit(seed))
    sample = rows.select(*allc, h.alias("__kmv_hash")).orderBy("__kmv_hash").limit(k).collect()
    if len(sample) < k:
        n_est = len(sample)
    else:
        n_est = (k - 1) / max((sample[-1]["__kmv_hash"] + 2 ** 63) / 2 ** 64, 1e-18)
    b = max(1, min(MAX_BUCKETS, math.ceil(n_est / ROWS_PER_BUCKET)))
    out = []
    for cs in col_sets:
        bounds = []
        if b > 1 and len(sample) >= b:
            bounds = _pick(list({tuple(r[c] for c in cs) for r in sample}), b)
        out.append((bounds, n_est))
    return out


def _range_buckets(cells: DataFrame, cols: list[str], n_buckets: int) -> DataFrame:
    """Bucket ids for inputs too large for a literal boundary tree: Spark's
    range partitioner (sampled bounds, binary search, any partition count)
    assigns them, and a reliable checkpoint in the shared checkpoint folder
    freezes them, so every later consumer and any recomputation after an
    executor loss sees the same buckets."""
    from statlake.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(cells.sparkSession)
    r = cells.repartitionByRange(n_buckets, *[F.col(c) for c in cols]).withColumn("_bkt", F.spark_partition_id())
    return r.checkpoint(eager=True)


def keyed_prefix(cells: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str,
                 out: str = "before", buckets: int | None = None, seed: int = 17,
                 plan: tuple[list, float] | None = None, position: str | None = None) -> DataFrame:
    """Add ``out`` = Σ ``weight`` over rows with the same ``keys`` and a
    strictly smaller ``order`` tuple, and ``position``, if named, the number of
    such rows.  ``(keys, order)`` must be unique and non-null in ``cells``
    (collapse duplicates with a groupBy first) or tie for equal rows only
    (``row_hash``): those then get consecutive sums and positions.

    ``buckets``: None = automatic (≤ MAX_BUCKETS boundary tree, range
    partitioner + checkpoint beyond), n = that many tree buckets, -1 = force
    the range-partitioner path."""
    keys, order = list(keys), list(order)
    cols = keys + order
    if plan is not None:
        bounds, n_est = plan
    else:
        bounds, n_est = ([], 0) if buckets == 1 else plan_bounds(cells, cols, buckets, seed, with_estimate=True)
    want = buckets or math.ceil(n_est / ROWS_PER_BUCKET)
    if buckets == -1 or want > MAX_BUCKETS:
        # beyond a literal boundary tree: range partitioner + checkpoint
        b = _range_buckets(cells, cols, max(2, want if want > 0 else 2))
        bounds = [None]
    else:
        b = cells.withColumn("_bkt", _bucket_expr(cols, bounds) if bounds else F.lit(0))
    part = ["_bkt"] + keys
    w_local = (Window.partitionBy(*part).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, -1))
    b = b.withColumn("_local", F.coalesce(F.sum(weight).over(w_local), F.lit(0)))
    if position:
        b = b.withColumn(position, F.row_number().over(Window.partitionBy(*part).orderBy(*order)).cast("long") - 1)
    if not bounds and not keys:
        # one bucket, no key: nothing precedes it, the local sum is the answer
        return b.withColumnRenamed("_local", out).drop("_bkt")
    totals = b.groupBy(*part).agg(F.sum(weight).alias("_tot"), F.count(F.lit(1)).alias("_rows"))
    w_off = (Window.partitionBy(*keys).orderBy("_bkt")
             .rowsBetween(Window.unboundedPreceding, -1)) if keys else \
        Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    # totals has at most (#buckets + #keys) rows, so this window is small
    offs = totals.withColumn("_off", F.coalesce(F.sum("_tot").over(w_off), F.lit(0))).withColumn(
        "_rows", F.coalesce(F.sum("_rows").over(w_off), F.lit(0))).drop("_tot")
    # null-safe on the keys: a null key is a group like any other
    offs = offs.select(*[F.col(c).alias(f"_o_{c}") for c in part], "_off", "_rows")
    cond = [b[c].eqNullSafe(offs[f"_o_{c}"]) for c in part]
    j = b.join(offs, cond).withColumn(out, F.col("_off") + F.col("_local"))
    if position:
        j = j.withColumn(position, F.col(position) + F.col("_rows"))
    return j.drop("_off", "_rows", "_local", "_bkt", *[f"_o_{c}" for c in part])


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns (maps aside), to place rows that tie otherwise;
    rows with equal hashes are equal, so their places can be swapped."""
    from pyspark.sql import types as T
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])


def value_cells(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, value, cnt)`` — duplicates collapsed by a partial aggregate."""
    return (df.filter(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt")))


def average_ranks(df: DataFrame, value: str, keys: Sequence[str] = (), out: str = "rank",
                  buckets: int | None = None, plan: tuple[list, float] | None = None) -> DataFrame:
    """Distinct ``(keys, value)`` with the average (mid) rank of the value:
    rows below + (ties + 1)/2.  Join back on ``(keys, value)`` for per-row ranks."""
    cells = value_cells(df, value, keys)
    pre = keyed_prefix(cells, keys, [value], "cnt", buckets=buckets, plan=plan)
    return pre.withColumn(out, F.col("before") + (F.col("cnt") + F.lit(1)) / F.lit(2.0)).drop("before")


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], keys: Sequence[str] = (),
                    buckets: int | None = None) -> DataFrame:
    """Linear-interpolated exact quantiles (same rule as numpy's default and
    SQL ``percentile_cont``) as rows ``(keys, q, quantile)``.

    Position h = (n−1)q; the answer interpolates the order statistics at
    floor(h) and ceil(h), found by an interval join on the prefix counts.
    Memory per task is bounded, unlike a collect-all percentile."""
    keys = list(keys)
    cells = value_cells(df, value, keys)
    pre = keyed_prefix(cells, keys, [value], "cnt", buckets=buckets)
    n = cells.groupBy(*keys).agg(F.sum("cnt").alias("_n"))
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    targets = (n.withColumn("q", F.explode(qarr))
                 .withColumn("_h", (F.col("_n") - 1) * F.col("q"))
                 .withColumn("_lo", F.floor("_h").cast("long"))
                 .withColumn("_hi", F.ceil("_h").cast("long"))
                 .withColumn("_frac", F.col("_h") - F.col("_lo")))
    pos = targets.select(*keys, "q", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("_lo").alias("pos")),
        F.struct(F.lit(1).alias("side"), F.col("_hi").alias("pos")))).alias("p"), "_frac")
    pos = pos.select(*keys, "q", "_frac", "p.side", "p.pos")
    pre_r = pre.select(*[F.col(k).alias(f"_pk_{k}") for k in keys], F.col(value).alias("_v"),
                       F.col("before").alias("_before"), F.col("cnt").alias("_cnt"))
    cond = [pos[k].eqNullSafe(pre_r[f"_pk_{k}"]) for k in keys] + [
        pre_r["_before"] <= pos["pos"], pos["pos"] < pre_r["_before"] + pre_r["_cnt"]]
    # without keys the target side has exactly 2·len(qs) rows: a size-proven
    # broadcast turns the interval join into a nested-loop probe per cell
    probe = pos if keys else F.broadcast(pos)
    hit = probe.join(pre_r, cond).select(*[pos[k] for k in keys], "q", "_frac", "side", "_v")
    return (hit.groupBy(*keys, "q").agg(
        F.max(F.when(F.col("side") == 0, F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("side") == 1, F.col("_v"))).alias("_vhi"),
        F.first("_frac").alias("_frac"))
        .select(*keys, "q", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias("quantile")))


def cumulative_share(df: DataFrame, weight: str, order: Sequence[str], keys: Sequence[str] = (),
                     buckets: int | None = None) -> DataFrame:
    """Per row: ``cum_lo``/``cum_hi`` = normalised prefix sums of ``weight``
    in ``order``, i.e. the inverse-CDF interval of each row.  Rows that tie in
    ``order`` follow each other by a hash of all their columns; intervals never
    overlap.  The last row of a key, told by its position and not by float
    sums, closes at exactly 1; a bound never passes 1."""
    keys = list(keys)
    rows = df.withColumn("_row", row_hash(df))
    pre = keyed_prefix(rows, keys, [*order, "_row"], weight, buckets=buckets, position="_at").drop("_row")
    tot = df.groupBy(*keys).agg(F.sum(weight).alias("_total"), F.count(F.lit(1)).alias("_n"))
    j = same_keys(pre, tot, keys)
    share = lambda x: F.when(F.col("_total") != 0, F.least(x / F.col("_total"), F.lit(1.0)))
    is_last = F.col("_at") == F.col("_n") - 1
    return (j.withColumn("cum_lo", share(F.col("before")))
             .withColumn("cum_hi", F.when(is_last, F.lit(1.0)).otherwise(share(F.col("before") + F.col(weight))))
             .drop("before", "_total", "_at", "_n"))
