"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.operators.windows import interpolate_linear, regularize_monthly
from statlake.sources.tables import monthly_order_totals

R = 6  # decimals kept for statistics in reports (same rounding in SQL)


def rnd(c, d: int = R) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), d)


def longs(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("long"))
    return df


def regular_monthly(df: DataFrame, keys, ts: str, value: str) -> DataFrame:
    """The series on its full month grid, gaps filled by linear interpolation:
    what every test and fit that takes lags by row position needs first."""
    return interpolate_linear(regularize_monthly(df, keys, ts, value), keys, ts, value)


def monthly_series(spark, sf) -> DataFrame:
    """Monthly order totals per priority, regular and without gaps."""
    return regular_monthly(monthly_order_totals(spark, sf), ["series_key"], "ts", "value")
