"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of this package relies on; sizes (partitions, memory) stay with the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Landed pages are small: at the default of 4 MiB per opened file a task would read 32 of them and write a tiny table
    # file; at this value some hundreds.
    "spark.sql.files.openCostInBytes": str(256 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("skyops")
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str | int]) -> Iterator[None]:
    """Session settings for what starts inside; afterwards the former ones hold again."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def small_files(spark: SparkSession):
    """For listing and streaming many small files. Spark would list each file or folder in a task of its own, up to 10,000 of
    them at a time; a few per core do the same. It would also keep what it has listed, up to 250 MB of the driver, for readers of
    the same frame, which hold the list themselves."""
    listing = 4 * max(8, spark.sparkContext.defaultParallelism)
    return settings(spark, {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": listing,
        "spark.sql.files.openCostInBytes": DEFAULTS["spark.sql.files.openCostInBytes"],
        "spark.sql.hive.filesourcePartitionFileCacheSize": 0,
    })


def workspace(spark: SparkSession, label: str) -> str:
    """Path of a new folder under the session's ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode and only when that setting is absent: on a cluster the executors
    would not see it, so there the missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="skyops-")
    return f"{base.rstrip('/')}/skyops/{label}-{uuid.uuid4().hex}"
