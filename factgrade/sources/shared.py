"""The folder that driver and executors share, for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str = "work") -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only where the setting is absent on one machine, as in tests, a temporary folder takes its place; on a cluster
    that is an error, for each machine would write to its own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="factgrade-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table", folder: str | None = None) -> DataFrame:
    """Write a table once and go on from the copy: short lineage, stable ids, no repeated model calls."""
    path = f"{folder}/{name}" if folder else shared_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
