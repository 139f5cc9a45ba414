"""Session settings for local runs; a cluster keeps its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str, cores: int | None = None, shared_folder: str | None = None) -> SparkSession:
    """A local session with as many shuffle partitions as cores. Operators rely on none of these settings."""
    cores = cores or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        # Do not record the Python line of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Skip the sort of a join whose build side turns out small in every partition.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    )
    if shared_folder:
        builder = builder.config("spark.checkpoint.dir", shared_folder)
    return builder.getOrCreate()
