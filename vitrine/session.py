"""Session settings the jobs are written for."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(
    app: str = "vitrine",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with adaptive execution on.

    On a cluster leave `shuffle_partitions` unset and size
    spark.sql.adaptive.coalescePartitions.initialPartitionNum for the largest shuffle (about
    200 MB a partition); AQE merges what turns out small and splits what turns out skewed.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.driver.memory", os.environ.get("VITRINE_DRIVER_MEMORY", "8g"))
            # many generated classes in one JVM; the default code cache fills in a long session
            .config("spark.driver.extraJavaOptions", "-XX:ReservedCodeCacheSize=512m")
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """In it, shuffle files go when their query has ended, and not when the driver's next collection finds them unused."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_folder(spark: SparkSession, default: str | None = None) -> str:
    """Folder every executor reaches: the cluster's spark.checkpoint.dir, else `default`."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or default
    if not folder:
        raise ValueError("spark.checkpoint.dir is unset and no folder was given")
    return folder.rstrip("/")
