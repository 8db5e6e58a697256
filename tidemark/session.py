"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Settings the operators count on. Timestamps are read and shown in UTC and
# written in microseconds, which carry the statistics that let a later scan skip
# row groups (the default INT96 form carries none). The rest lets Spark split
# skewed joins and size shuffle partitions at run time. Nanosecond timestamps in
# files are read as numbers, which ingest turns into timestamps; times of day are
# read as such and stored as text.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that already runs."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


class NoSharedFolder(RuntimeError):
    """A cluster without a folder that the driver and all executors share."""


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster.

    Where none is set, a temporary folder serves a session that runs in one process;
    any other session is refused, since its executors would write where nobody reads.
    """
    context = spark.sparkContext
    root = (
        spark.conf.get(CHECKPOINT_SETTING, None)
        or context.getConf().get(CHECKPOINT_SETTING)
        or context.getCheckpointDir()
    )
    if root is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise NoSharedFolder(f"set {CHECKPOINT_SETTING} to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder of its own below the shared one."""
    return f"{checkpoint_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
