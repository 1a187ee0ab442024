"""A session with the settings that the operators are designed for."""

from __future__ import annotations

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Adaptive execution merges small partitions, splits skewed joins, and turns a join
# into a broadcast only after the real size of a side is known.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def panel_session(app: str, *, shuffle_partitions: int | None = None, shared_dir: str | None = None, **more: str) -> SparkSession:
    """`shuffle_partitions`: about three per core for a cluster, one per core for a single machine.

    `shared_dir` names the shared folder for staged tables where spark.checkpoint.dir is not set.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if shared_dir and not SparkConf().contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", shared_dir)
    return builder.getOrCreate()
