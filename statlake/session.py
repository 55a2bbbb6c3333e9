"""Spark session defaults for statlake jobs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults that matter at scale: AQE re-plans joins at runtime (broadcast
# only when a materialised shuffle stage is under the threshold), splits
# skewed join partitions and coalesces small shuffle partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast decisions only on materialised (runtime) sizes: plan-time
    # estimates do not see row growth from explode and similar generators
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "statlake", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with statlake's defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taken from ``spark.checkpoint.dir``.

    On a cluster that folder must be shared storage named by the cluster
    configuration.  Only a local-mode session (tests, laptops) without the
    setting gets a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: iterative statlake operators "
            "need a shared checkpoint folder on a cluster")
    path = tempfile.mkdtemp(prefix="statlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``statlake`` importable in Python workers (``mapInPandas``,
    ``applyInPandas`` and Pandas UDFs import it there): zip the package and
    hand it to ``SparkContext.addPyFile``, which distributes it to every
    executor.  Done once per application."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="statlake-pkg-"), "statlake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(pkg):
            for nm in names:
                if nm.endswith(".py"):
                    full = os.path.join(base, nm)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
