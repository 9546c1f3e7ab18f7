"""Tables as parquet folders.

Three kinds: *appended* ones grow by a stream or a log; *replaced* ones are recomputed whole, into a new version folder
that readers pick up only once it is complete; *partitioned* ones are recomputed for some partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from skyops.session import small_files
from skyops.sources import files
from skyops.sources.files import exists
from skyops.sources.landing import source_options

KEPT_VERSIONS = 2
# Fixed value: what Spark names the folder of a null.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _versions(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """All version folders in order, and the complete ones among them."""
    names = [n for n in files.names(spark, path) if n.startswith("v")]
    return names, [n for n in names if exists(spark, f"{path}/{n}/_SUCCESS")]


def replace_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), options: Mapping[str, str | int] | None = None
) -> DataFrame:
    """Recompute a table: write the next version, then drop versions that no reader can still want.

    The job's success marker is the switch, so a failed write changes nothing, and ``df`` may read the version it is
    about to replace.
    """
    spark = df.sparkSession
    known, complete = _versions(spark, path)
    latest = int(known[-1][1:]) if known else 0
    target = f"{path}/v{latest + 1:012d}"
    writer = df.write.mode("overwrite").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    for name in [n for n in known if n not in complete[-(KEPT_VERSIONS - 1):]]:
        files.delete(spark, f"{path}/{name}")
    return spark.read.schema(df.schema).parquet(target)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch read: the newest complete version of a replaced table, or the whole folder of another one."""
    _, complete = _versions(spark, path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{path}/{complete[-1]}" if complete else path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not have been written yet."""
    return read_table(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def partition_values(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The value of a partition column (as text) once for every file of a table. It comes from the names of the files, none of
    which is opened; of a table that a stream writes, only files count that the stream has committed."""
    folder = F.regexp_extract("path", rf"/\Q{column}\E=([^/]+)/", 1)
    value = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    known = F.when((folder != "") & (folder != NO_VALUE), value)
    return spark.read.format("binaryFile").load(path).select(known.alias(column))


def is_ready(spark: SparkSession, path: str) -> bool:
    return bool(_versions(spark, path)[1])


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str | int] | None = None
) -> DataFrame:
    """Stream read of an appended table: each row once."""
    return spark.readStream.schema(schema).options(**source_options(options)).parquet(path)


def append_stream(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append everything that is available now, exactly once, and stop."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return run_stream(writer, path)


def run_stream(writer: DataStreamWriter, path: str | None = None) -> StreamingQuery:
    """Everything that is available now, then stop. The settings hold until then: a file source reads those of the caller's
    session, not of the stream's copy."""
    with small_files(writer._spark):
        query = writer.trigger(availableNow=True).start(path)
        query.awaitTermination()
    return query


# A quarantined row carries its whole page. Pages repeat row after row, so a large dictionary stores each once; the writer
# is told to check its buffers often, as its default of every 100 rows would hold 100 pages per column.
PAGE_TEXT_OPTIONS = {
    "parquet.dictionary.page.size": 16 * 1024 * 1024,
    "parquet.page.size.row.check.min": 4,
    "parquet.block.size.row.check.min": 4,
}


def replace_dates(df: DataFrame, path: str, column: str, dates: Sequence[str]) -> None:
    """Bring the ``dates`` (names of their folders) of a table partitioned by ``column`` up to date: ``df`` has all of their rows.

    A date without rows goes. Other dates are left alone; versions of an earlier layout go too.
    """
    spark = df.sparkSession
    kept = {r[0] for r in df.select(F.coalesce(F.col(column).cast("string"), F.lit(NO_VALUE))).distinct().collect()}
    replace_partitions(df.hint("rebalance", column), path, [column])
    gone = [f"{column}={day}" for day in dates if day not in kept] + _versions(spark, path)[0]
    for name in set(gone) & set(files.names(spark, path)):
        files.delete(spark, f"{path}/{name}")


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace just the partitions that occur in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
