"""Session helpers.  The caller owns the session; nothing here starts work."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are written for.  AQE sizes the reduce side, splits
# skewed join partitions and picks broadcast joins from measured sizes, so no
# operator forces a broadcast of data whose size it cannot bound.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "ledgerbrook", **options: str) -> SparkSession:
    """A session with the recommended settings; master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="ledgerbrook-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping whatever the cluster has set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for a table handed from one job to the next."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
