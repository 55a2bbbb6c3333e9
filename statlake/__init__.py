"""statlake — statistical analytics as Spark DataFrame operators.

Every public operator takes DataFrames (plus column names and an optional
grouping ``key``) and returns a DataFrame.  Heavy work is expressed with
Spark aggregates, windows, joins and MLlib; only small dense solves
(p x p, bounded by the number of features or lags) leave the JVM, inside
``mapInPandas`` / ``applyInPandas`` tasks that Spark partitions.
"""

from statlake.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
