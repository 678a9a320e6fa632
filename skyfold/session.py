"""Session construction and the shared work folder.

Every job in this package is planned by Catalyst and run by the executors; the
session only fixes what must hold for results to repeat: UTC session zone,
ANSI mode as shipped with Spark 4, adaptive execution on.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # One day of snapshots arrives as many small JSON files; pack several
    # files into one read task instead of one task per file.
    "spark.sql.files.openCostInBytes": str(1 << 20),
    # Checkpoint files (merge inputs materialised once) are removed when no
    # DataFrame refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "skyfold", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench; a cluster passes its own settings."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    A cluster sets ``spark.checkpoint.dir`` to a shared file system; that value
    is used as it is. Only where it is unset (local runs, tests) a folder is
    made here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="skyfold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder for tables and landings."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    run = f"work-{uuid.uuid4().hex[:12]}"
    return "/".join([base, run, *parts])
