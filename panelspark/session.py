"""Session helpers.

The cluster names a shared checkpoint folder in ``spark.checkpoint.dir``; we read
it from the session and only pick our own folder when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Remove checkpoint files once their DataFrame is garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "panelspark", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with AQE and skew-join handling switched on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when none is configured.

    On a cluster the folder must be shared storage named by ``spark.checkpoint.dir``.
    A machine-local fallback is allowed only for a local master (tests).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset; point it at shared storage on a cluster")
    folder = tempfile.mkdtemp(prefix="panelspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()
