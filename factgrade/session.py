"""Session settings that suit this package."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", app: str = "factgrade", memory: str = "16g", checkpoints: str | None = None
) -> SparkSession:
    """A session on one machine.  On a cluster, take these settings and leave the partitions to its size."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Text work is heavy per byte: small shuffles still use all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    if checkpoints:
        builder = builder.config("spark.checkpoint.dir", checkpoints)
    return builder.getOrCreate()
