"""Landing to bronze: new files become rows, once, then the job stops."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from skyops.layout import Layout
from skyops.sources import landing, tables


def _ingest(
    spark: SparkSession, layout: Layout, path: str, name: str, folders: Sequence[str], partition_by: Sequence[str],
    options: Mapping[str, str | int] | None, archive: bool,
) -> StreamingQuery | None:
    """None where nothing has ever landed: there is no folder to watch yet."""
    if not tables.exists(spark, path):
        return None
    pages = landing.landing_stream(spark, path, folders, options, layout.archive if archive else None)
    return tables.append_stream(pages, layout.bronze(name), layout.checkpoint(f"bronze_{name}"), partition_by)


def ingest_flights(
    spark: SparkSession, layout: Layout, options: Mapping[str, str | int] | None = None, archive: bool = False
) -> StreamingQuery | None:
    path = landing.flight_folder(layout.landing)
    return _ingest(spark, layout, path, "flight_status", landing.FLIGHT_PARTITIONS, (), options, archive)


def ingest_reference(
    spark: SparkSession, layout: Layout, entity: str, options: Mapping[str, str | int] | None = None, archive: bool = False
) -> StreamingQuery | None:
    """Bronze is partitioned by run, so that reading the latest run opens that run's files only."""
    path = landing.reference_folder(layout.landing, entity)
    return _ingest(spark, layout, path, entity, landing.REFERENCE_PARTITIONS, ["run_id"], options, archive)
