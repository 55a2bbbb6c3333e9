"""'~'-separated CSV sources and sinks with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.functions.exprs import require_columns


def read_series(spark: SparkSession, path: str, sep: str = "~", date_col: str = "date",
                value_col: str = "value") -> DataFrame:
    """IO1: ``date~value`` CSV with a header → ``(date date, value double)``
    sorted by date; raises if the columns are missing (header checked on
    the schema, no inference pass)."""
    raw = spark.read.option("sep", sep).option("header", True).csv(path)
    require_columns(raw, date_col, value_col)
    return (raw.select(F.to_date(F.col(date_col)).alias(date_col), F.col(value_col).cast("double").alias(value_col))
               .orderBy(date_col))


def read_csv_required(spark: SparkSession, path: str, schema: str, required: Sequence[str],
                      sep: str = ",") -> DataFrame:
    """IO2: CSV with an explicit DDL schema and required columns."""
    df = spark.read.option("sep", sep).option("header", True).schema(schema).csv(path)
    return require_columns(df, *required)


def to_kv(df: DataFrame) -> DataFrame:
    """IO3: unpivot a one-row (or keyed) result to ``(metric, value)`` rows
    (values cast to string, the file format of key/value reports)."""
    cols = df.columns
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value"))
                                          for c in cols])).alias("kv")).select("kv.*")


def write_table(df: DataFrame, path: str, sep: str = "~", mode: str = "overwrite") -> None:
    """IO3/IO4: write a result as '~'-separated CSV with a header."""
    df.write.mode(mode).option("sep", sep).option("header", True).csv(path)
