"""Session settings and shared folders."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app_name: str = "smslens", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with adaptive execution on; sizes are left to the cluster unless given."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one is set only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", "")
        if configured:
            sc.setCheckpointDir(configured)
        elif sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="smslens-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.checkpoint.dir", "") or sc.getCheckpointDir()
