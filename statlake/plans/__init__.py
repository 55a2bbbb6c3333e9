"""Registered report queries over the parquet tables (``queries()``) and
their DuckDB-runnable SQL equivalents (``oracle_sql()``)."""

from statlake.plans.catalog import QUERIES, ORACLE  # noqa: F401
