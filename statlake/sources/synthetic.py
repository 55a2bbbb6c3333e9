"""Synthetic generators (``spark.range`` + seeded column expressions).

Used by tests and examples; every registered report reads the given
tables instead.  Noise comes from ``randn(seed)``/``rand(seed)`` so a
frame is reproducible for a fixed partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def series(spark: SparkSession, n: int, trend: float = 0.5, season: float = 8.0, period: int = 12,
           noise: float = 1.0, level: float = 100.0, seed: int = 0, key: str = "s",
           start: str = "2020-01-01") -> DataFrame:
    """IO5: level + trend·t + season·sin(2πt/period) + N(0, noise)."""
    d = spark.range(n).withColumnRenamed("id", "t")
    v = (F.lit(level) + F.lit(trend) * F.col("t") + F.lit(season) * F.sin(2 * math.pi * F.col("t") / period)
         + F.lit(noise) * F.randn(seed))
    return d.select(F.lit(key).alias("series_key"), "t", F.add_months(F.to_date(F.lit(start)), F.col("t").cast("int")).alias("ts"),
                    v.alias("value"))


def station(spark: SparkSession, months: int = 72, seed: int = 0, noise: float = 1.0) -> DataFrame:
    """IO6: monthly station data: clipped seasonal insolation, degradation
    d^m, tariff ramp with a step from month 42, production, revenue,
    maintenance with a March spike and net cash flow."""
    d = spark.range(months).withColumnRenamed("id", "m")
    ts = F.add_months(F.to_date(F.lit("2019-01-01")), F.col("m").cast("int"))
    ins = F.greatest(F.lit(0.2), F.least(F.lit(1.2), 0.7 + 0.4 * F.sin(2 * math.pi * (F.col("m") - 3) / 12)
                                         + F.lit(noise) * 0.03 * F.randn(seed)))
    deg = F.pow(F.lit(0.999), F.col("m"))
    tariff = 0.12 + 0.0005 * F.col("m") + F.when(F.col("m") >= 42, 0.01).otherwise(0.0)
    prod = 1000.0 * ins * deg
    rev = prod * tariff
    costs = 15.0 + 0.01 * prod + F.when(F.month(ts) == 3, 40.0).otherwise(0.0)
    return d.select(ts.alias("ts"), rev.alias("revenue"), costs.alias("costs"), (rev - costs).alias("net_cashflow"),
                    prod.alias("prod_kwh"), tariff.alias("tariff"), ins.alias("insolation_idx"), deg.alias("degradation_idx"))


def pv_rows(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """IO7: irradiance, ambient temperature, wind, cosθ → cell temperature
    and power (gamma(5) as a sum of 5 exponentials, beta(2,2) as the middle
    of three uniforms)."""
    from statlake.functions.exprs import cell_temperature, pv_power
    d = spark.range(n)
    gamma5 = sum((-F.log(F.rand(seed + i)) for i in range(5)), F.lit(0.0))
    u = [F.rand(seed + 10 + i) for i in range(3)]
    mid = F.greatest(F.least(u[0], u[1]), F.least(F.greatest(u[0], u[1]), u[2]))
    d = d.select("id", (gamma5 * 120.0).alias("G"), (15 + 8 * F.randn(seed + 20)).alias("Ta"),
                 (3 * F.rand(seed + 21)).alias("W"), mid.alias("cos_theta"))
    d = d.withColumn("T_cell", cell_temperature("Ta", "G", "W"))
    return d.withColumn("P", pv_power("G", "T_cell", "cos_theta"))


def blobs(spark: SparkSession, centers: Sequence[Sequence[float]], n_per: int, sd: float | Sequence[float] = 1.0,
          seed: int = 0) -> DataFrame:
    """IO8: Gaussian clouds around ``centers`` (label = centre index)."""
    sds = list(sd) if isinstance(sd, (list, tuple)) else [sd] * len(centers)
    c = spark.createDataFrame([(i, *map(float, cc), float(s)) for i, (cc, s) in enumerate(zip(centers, sds))],
                              ["label"] + [f"c{j}" for j in range(len(centers[0]))] + ["sd"])
    d = c.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n_per - 1))))
    cols = [(F.col(f"c{j}") + F.col("sd") * F.randn(seed + j)).alias(f"x{j}") for j in range(len(centers[0]))]
    return d.select("label", *cols)


def random_walk(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """IO9: cumulative sum of N(0,1) steps (one short series)."""
    d = spark.range(n).withColumnRenamed("id", "t").withColumn("step", F.randn(seed))
    return d.withColumn("value", F.sum("step").over(Window.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)))


def exp_curve(spark: SparkSession, n: int, a: float = 2.0, b: float = 0.8, c: float = 0.5, noise: float = 0.1,
              seed: int = 0) -> DataFrame:
    """IO9: y = a·e^{bt} + c + noise on t ∈ [0, 2]."""
    d = spark.range(n).withColumn("t", F.col("id") * 2.0 / max(n - 1, 1))
    return d.withColumn("y", F.lit(a) * F.exp(F.lit(b) * F.col("t")) + F.lit(c) + F.lit(noise) * F.randn(seed))
