"""Readers for the parquet tables and the frames derived from them.

All readers are lazy; projections and filters applied later reach the
parquet scan (column pruning and predicate pushdown by Catalyst).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def monthly_order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long series frame ``(series_key, ts date, value)``: monthly sum of
    ``o_totalprice`` per ``o_orderpriority``.  Partial aggregation makes the
    heavy part a map-side combine; the output has one row per key-month."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("series_key"),
                      F.trunc(F.col("o_orderdate").cast("date"), "month").alias("ts"))
             .agg(F.sum("o_totalprice").alias("value")))


def monthly_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(series_key, ts, revenue, discount)``: monthly Σ extendedprice and
    average discount by ship month, keyed by ``l_returnflag``."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_returnflag").alias("series_key"),
                       F.trunc(F.col("l_shipdate").cast("date"), "month").alias("ts"))
              .agg(F.sum("l_extendedprice").alias("revenue"),
                   F.avg("l_discount").alias("discount")))


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(series_key, ts date, n, value)``: daily event count and Σ value per type."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.col("event_type").alias("series_key"),
                       F.col("ts").cast("date").alias("ts"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")))


def embedding_points(spark: SparkSession, sf_dir: str, dims: int = 2) -> DataFrame:
    """``(id, grp, x0..x{dims-1})`` from the first embedding dimensions."""
    e = table(spark, sf_dir, "embeddings")
    cols = [F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(dims)]
    return e.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("grp"), *cols)
