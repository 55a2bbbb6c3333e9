"""Intermediate tables in the folder that all executors share.

The folder is the one named by ``spark.checkpoint.dir``; only a session that
leaves it unset (tests, laptops) gets a private one.  A table written here
cuts the lineage: losing an executor never costs more than the running stage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
BATCH_ROWS = 1000  # rows in an Arrow batch: whole texts, some very long, go to Python workers


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate files, shared by the driver and all executors."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if conf:
        return conf.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if sc.applicationId not in _OWN:
        _OWN[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="statlake-llm-")
    return _OWN[sc.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}-{label}"


def table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 1 << 20) -> DataFrame:
    """``df``, a slim written table, with a broadcast hint if it has at most
    ``rows`` rows; beyond that Spark shuffles both sides of the join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lookup(rows: DataFrame, named: DataFrame, keys: list[str], salt: str, salts: int = 64) -> DataFrame:
    """``rows`` left-joined with ``named``, which has one row for each of
    ``keys``.  Rows of one key are dealt over ``salts`` cells by the hash of
    their column ``salt``; each (key, cell) that occurs fetches the named row
    once, so a key that holds most rows is spread over many tasks.  ``rows``
    is read twice and should be a written table."""
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64(salt), F.lit(salts)))
    cells = rows.select(*keys, "_cell").distinct().join(named, keys)
    return rows.join(cells, [*keys, "_cell"], "left").drop("_cell")


def renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns called c0, c1, ..., and the new name of each, so
    that columns of any name can be carried beside those that an operator adds."""
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*at.values()), at


def named_back(docs: DataFrame, at: dict[str, str]) -> DataFrame:
    """The columns that ``renamed`` called ``at``, under their own names."""
    return docs.select(*[F.col(a).alias(c) for c, a in at.items()])


def small_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches at ``BATCH_ROWS`` rows at most."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def sample(df: DataFrame, key: Column, k: int) -> DataFrame:
    """The ``k`` rows with the smallest hash ``key`` (a long), or all.  A cut
    by the row count comes first, so that a task sends on a few of ``k`` rows
    at most, however many tasks there are."""
    n = df.count()
    if n > 8 * k:
        df = df.filter(key <= -(2 ** 63) + int(2 ** 64 * min(1.0, (k + 10 * k ** 0.5 + 50) / n)))
    return df.withColumn("_sample_key", key).orderBy("_sample_key").limit(k).drop("_sample_key")
