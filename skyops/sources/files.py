"""The file system calls that Spark offers no DataFrame function for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _folder(spark, path)
    return system.exists(folder)


def local(spark: SparkSession, path: str) -> str | None:
    """The plain path where ``path`` is in the file system of the machine (or one mounted there); None for any other store."""
    system, folder = _folder(spark, path)
    return system.makeQualified(folder).toUri().getPath() if system.getUri().getScheme() == "file" else None


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, in order; none if there is no such folder."""
    system, folder = _folder(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    system, file = _folder(spark, path)
    system.create(file, True).close()


def delete(spark: SparkSession, path: str) -> None:
    system, folder = _folder(spark, path)
    system.delete(folder, True)
