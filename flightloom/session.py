"""Session settings and the folder shared by driver and executors."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession


def settings(shuffle_bytes: int | None = None) -> dict[str, str]:
    """SQL settings the jobs are designed for.

    Shuffles start with many partitions, of which AQE merges those that turn out small.
    ``shuffle_bytes`` is the expected size of the largest shuffle, for more than some
    200 GB: the initial number then follows from it (128 MB each, so that one sorts in
    memory).
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
        # Rows for a few folders are written side by side instead of sorted first.
        "spark.sql.maxConcurrentOutputFileWriters": "16",
    }
    if shuffle_bytes is not None:
        n = max(1, math.ceil(shuffle_bytes / (128 << 20)))
        conf["spark.sql.shuffle.partitions"] = str(n)
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(n)
    return conf


def build_session(
    app: str,
    master: str | None = None,
    shuffle_bytes: int | None = None,
    hive: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    conf = settings(shuffle_bytes)
    if "spark.sql.shuffle.partitions" in (extra or {}):
        conf.pop("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    for key, value in {**conf, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path that every executor can reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``. Where that is
    unset it lies below the warehouse, which executors must reach as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file, in any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def delete_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
