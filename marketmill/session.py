"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str, master: str | None = None, time_zone: str = "Asia/Taipei", shuffle_partitions: int | None = None) -> SparkSession:
    """A session for the jobs; resources are left to the deployment.

    shuffle_partitions is where AQE starts merging from: at least the largest
    shuffle divided by what one task should take. Too many cost little, too few spill.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.parquet.compression.codec", "snappy")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffle_partitions)
    return (builder.master(master) if master else builder).getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder under the checkpoint folder every executor can reach.

    A local session without one gets a temporary folder; a cluster session
    without one is an error, since its executors share no local disk.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="marketmill-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
