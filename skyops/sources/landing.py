"""Landed pages: Hive-style folders of JSON files, read one row per file."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyops.functions.text import path_safe
from skyops.session import settings, small_files
from skyops.sources import files

# The file source silently skips files that are much older than the newest one it has seen. Late files must not be lost, with
# or without an archive, so the age is far out of reach, and the driver remembers the path of every file that it has read.
# Where read pages are archived, the landing folder holds new pages only and listing it stays cheap. A job whose list of
# paths must stay short may pass ``maxFileAge`` in ``options`` and then loses later files.
# A micro-batch takes a bounded number of files, so that a backlog is worked off in pieces.
SOURCE_OPTIONS = {"maxFileAge": "36500d", "maxFilesPerTrigger": 20_000}


def source_options(options: Mapping[str, str | int] | None, archive: str | None = None) -> dict[str, str | int]:
    """Options of a file source: the defaults, with ``archive`` (a folder) those that move read files there, then the caller's."""
    moved = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    return {**SOURCE_OPTIONS, **moved, **(options or {})}


# Landing folders and their partition columns.
FLIGHT_PARTITIONS = ("direction", "airport", "date", "window_start", "run_id")
REFERENCE_PARTITIONS = ("date", "run_id")
FLIGHT_FOLDER = "flight_status"
REFERENCE_FOLDER = "reference_data"


def bronze_schema(partitions: Sequence[str]) -> T.StructType:
    """Columns of a bronze table."""
    return T.StructType([
        *[T.StructField(c, T.StringType()) for c in ("raw_json", *partitions)],
        T.StructField("_source_file_path", T.StringType()),
        T.StructField("_source_file_name", T.StringType()),
        T.StructField("_source_file_size", T.LongType()),
        T.StructField("_source_file_modification_time", T.TimestampType()),
        T.StructField("_ingested_at", T.TimestampType()),
    ])


def _schema(partitions: Sequence[str]) -> T.StructType:
    # Declared, never inferred: an empty folder would have no partition columns, and ``date`` would turn into a DATE.
    return T.StructType([T.StructField(c, T.StringType()) for c in ("value", *partitions)])


def _bronze(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    return df.select(
        F.col("value").alias("raw_json"),
        *partitions,
        *[
            F.col(f"_metadata.{name}").alias(f"_source_{name}")
            for name in ("file_path", "file_name", "file_size", "file_modification_time")
        ],
        F.current_timestamp().alias("_ingested_at"),
    )


def landing_batch(spark: SparkSession, path: str, partitions: Sequence[str]) -> DataFrame:
    """Every file below ``path`` as one row: its whole text, its folder values and its file facts."""
    with small_files(spark):
        pages = spark.read.format("text").option("wholetext", True).schema(_schema(partitions)).load(path)
    return _bronze(pages, partitions)


def landing_stream(
    spark: SparkSession, path: str, partitions: Sequence[str], options: Mapping[str, str | int] | None = None,
    archive: str | None = None,
) -> DataFrame:
    """The same rows as a stream that sees each new file once. ``options`` go to the file source, for instance
    ``maxFilesPerTrigger``; ``archive`` is a folder outside ``path`` to which read files move."""
    reader = spark.readStream.format("text").option("wholetext", True).schema(_schema(partitions))
    return _bronze(reader.options(**source_options(options, archive)).load(path), partitions)


def flight_folder(root: str) -> str:
    return f"{root}/{FLIGHT_FOLDER}"


def reference_folder(root: str, entity: str) -> str:
    return f"{root}/{REFERENCE_FOLDER}/{entity}"


def landed_pages(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """Folder values and ``page`` of every file below ``path``; files are listed, not read."""
    with small_files(spark):
        files_below = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")

    def value(folder: str):
        found = F.regexp_extract("path", rf"/{folder}=([^/]*)", 1)
        decoded = F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))
        return F.nullif(decoded, F.lit("__HIVE_DEFAULT_PARTITION__"))

    # A page is a folder ``page=<n>`` or a file ``page=<n>.json``.
    page = F.regexp_extract("path", r"page=([^/]*?)(\.json)?(/[^/]*)?$", 1)
    return files_below.select(*[value(c).alias(c) for c in folders], page.alias("page"))


def manifest_path(root: str, dataset: str) -> str:
    """Where the list of landed pages is: beside the landing folders, out of a stream's sight."""
    return f"{root}/_landed/{dataset}"


def landed_manifest(spark: SparkSession, root: str, dataset: str, folders: Sequence[str]) -> DataFrame:
    """Folder values and ``page`` of all pages that have ever landed, archived ones included."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*folders, "page")])
    path = manifest_path(root, dataset)
    return spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)


def _unlisted(pages: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``pages`` whose ``keys`` are not ``listed``; nulls are equal."""
    known = listed.select(*[F.col(c).alias(f"_listed_{c}") for c in keys])
    return pages.join(known, [F.col(c).eqNullSafe(F.col(f"_listed_{c}")) for c in keys], "left_anti")


def _list_pages(pages: DataFrame, root: str, dataset: str) -> None:
    pages.write.mode("append").partitionBy("date").parquet(manifest_path(root, dataset))


# What Spark escapes in the names of partition folders, and what it names the folder of a null or empty text.
_ESCAPED = {c: f"%{c:02X}" for c in (*range(1, 32), *b"\"#%'*/:=?\\{[]^", 127)}
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"
# Pages go to the writing tasks in batches of about so many bytes.
_WRITE_BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": 4 * 1024 * 1024, "spark.sql.execution.arrow.maxRecordsPerBatch": 1000}


def _write_pages(pages: DataFrame, keys: Sequence[str], path: str) -> None:
    """One file ``page=<n>.json`` per page where ``path`` is mounted, else what Spark's writer makes: a folder ``page=<n>`` with a
    file. Spark's writer makes a folder, starts a program for the file's mode and moves the file in the driver, page by page.

    A file gets its name once it is whole, and a page always has the same name, so a repeated task adds nothing.
    """
    spark = pages.sparkSession
    root = files.local(spark, path)
    if root is None:
        pages.write.mode("append").option("maxRecordsPerFile", 1).partitionBy(*keys).text(path)
        return

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            for *values, body in zip(*[column.to_pylist() for column in batch.columns]):
                names = [f"{key}={(value or _NO_NAME).translate(_ESCAPED)}" for key, value in zip(keys, values)]
                folder = os.path.join(root, *names[:-1])
                if folder != made:
                    os.makedirs(folder, exist_ok=True)
                    made = folder
                temporary = f"{folder}/.{uuid.uuid4().hex}"
                with open(temporary, "wb") as file:
                    file.write((body or "").encode() + b"\n")
                os.replace(temporary, f"{folder}/{names[-1]}.json")
        yield pa.RecordBatch.from_pydict({"done": pa.array([], pa.bool_())})

    with settings(spark, _WRITE_BATCH):
        pages.select(*keys, "body").mapInArrow(write, "done boolean").write.format("noop").mode("overwrite").save()


def write_landing(pages: DataFrame, root: str, dataset: str, archive: str | None = None) -> None:
    """Write pages (folder columns, ``page``, ``body``) in the landing layout, one file per page.

    A page is a file ``page=<n>.json``, or a folder ``page=<n>`` in stores where only Spark can write, as it names files itself;
    the readers above accept both. A page that has landed is left alone, wherever its file is by now: landing it again adds no second file, which a stream would
    read as new. What has landed is looked up in the manifest, and only for the dates of ``pages``; the landing folder is not
    listed. Of rows that repeat a page the least body lands.

    The manifest follows the files. A writer that dies in between leaves a mark, and the next call (like the first one over a
    folder without a manifest) lists the landing folder, and the ``archive`` folder where one is named, to complete it. One
    writer at a time for a dataset.
    """
    spark = pages.sparkSession
    folders = FLIGHT_PARTITIONS if dataset == FLIGHT_FOLDER else REFERENCE_PARTITIONS
    keys = [*folders, "page"]
    safe = {c: path_safe(F.col(c)) for c in ("window_start", "run_id") if c in folders}
    asked = pages.select(*[F.col(c).cast("string").alias(c) for c in (*keys, "body")]).withColumns(safe)
    open_mark, landing_folder = f"{root}/_landed/_open/{dataset}", f"{root}/{dataset}"
    if files.exists(spark, open_mark) or files.exists(spark, landing_folder) and not files.exists(spark, manifest_path(root, dataset)):
        for path in (landing_folder, *([f"{archive}/{dataset}"] if archive else [])):
            if files.exists(spark, path):
                found = landed_pages(spark, path, folders).distinct()
                _list_pages(_unlisted(found, landed_manifest(spark, root, dataset, folders), keys), root, dataset)

    days = [r[0] for r in asked.select("date").distinct().collect()]
    listed = landed_manifest(spark, root, dataset, folders).where(F.col("date").isin(days) | F.col("date").isNull())
    new = _unlisted(asked, listed, keys).groupBy(*keys).agg(F.min("body").alias("body"))
    files.mark(spark, open_mark)
    _write_pages(new, keys, landing_folder)
    # The files are there now, so this is what was asked for and is not in the list yet.
    _list_pages(_unlisted(asked.select(*keys), listed, keys).distinct(), root, dataset)
    files.delete(spark, open_mark)
