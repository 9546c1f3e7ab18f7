"""Checks on what has landed: are requests complete, is the request grid covered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.functions import envelope
from skyops.functions.times import window_floor

# Page sizes, and the hours each run reaches back (negative: ahead) per direction.
FLIGHT_PAGE_SIZE = 50
REFERENCE_PAGE_SIZE = 100
DEPARTURE_OFFSET_HOURS = (24, 20, 16, 12, 8, 4, 0, -4)
ARRIVAL_OFFSET_HOURS = (12, 8, 4, 0, -4, -8, -12, -16)

FLIGHT_REQUEST = ("run_id", "airport", "direction", "window_start")
REFERENCE_REQUEST = ("run_id",)


def page_number(path: Column) -> Column:
    """From ``page=<n>.json`` as well as from a folder ``page=<n>``."""
    return F.regexp_extract(path, r"page=(\d+)", 1)


def landing_completeness(
    pages: DataFrame, resource: str, request: Sequence[str] = FLIGHT_REQUEST, page_size: int = FLIGHT_PAGE_SIZE
) -> DataFrame:
    """Per request: pages landed, pages its announced record total calls for, and whether all are there.

    A request without a known total cannot be called complete. A page that landed twice counts once.
    """
    counted = pages.select(
        *request,
        page_number(F.col("_source_file_path")).alias("page"),
        envelope.total_count(F.col("raw_json"), resource).alias("total"),
    )
    # One row per page first: the grouping keys then spread over pages, and copies vanish on the map side.
    once = counted.groupBy(*request, "page").agg(F.max("total").alias("total"))
    grouped = once.groupBy(*request).agg(F.count(F.lit(1)).alias("pages_landed"), F.max("total").alias("total_count"))
    expected = F.greatest(F.lit(1), F.ceil(F.col("total_count") / page_size)).cast("long")
    return grouped.select(
        *request,
        "pages_landed",
        "total_count",
        F.when(F.col("total_count").isNotNull(), expected).alias("pages_expected"),
    ).withColumn("is_complete", F.coalesce(F.col("pages_landed") >= F.col("pages_expected"), F.lit(False)))


def latest_complete_run(pages: DataFrame, resource: str, page_size: int = REFERENCE_PAGE_SIZE) -> DataFrame | None:
    """Pages of the greatest complete run: an optional guard against a partial run that would delete dimension rows.

    None if no run is complete; otherwise a filter on the run, so only its files are read.
    """
    complete = landing_completeness(pages, resource, REFERENCE_REQUEST, page_size).where("is_complete")
    run_id = complete.agg(F.max("run_id")).first()[0]
    return None if run_id is None else pages.where(F.col("run_id") == run_id)


def request_grid(runs: DataFrame) -> DataFrame:
    """Cells (airport, direction, window start) that runs should have asked for; ``runs`` has ``airport`` and ``run_at``
    (UTC wall clock). Each row fans out to the sixteen fixed offsets; overlapping runs ask for a cell more than once."""
    offsets = F.array(*[
        F.struct(F.lit(direction).alias("direction"), F.lit(hours).alias("offset_hours"))
        for direction, all_hours in (("departures", DEPARTURE_OFFSET_HOURS), ("arrivals", ARRIVAL_OFFSET_HOURS))
        for hours in all_hours
    ])
    # Runs inside one window ask for the same cells, so they collapse before the fan-out.
    per_window = runs.select("airport", window_floor(F.col("run_at")).alias("window")).distinct()
    cells = per_window.select("airport", "window", F.inline(offsets))
    window_start = F.timestamp_add("HOUR", -F.col("offset_hours"), F.col("window"))
    return cells.select("airport", "direction", window_start.alias("window_start")).distinct()


def coverage_audit(runs: DataFrame, landed: DataFrame) -> DataFrame:
    """Grid cells without a landed page; ``landed`` has ``airport, direction, window_start``."""
    cell = ["airport", "direction", "window_start"]
    return request_grid(runs).join(landed.select(*cell).distinct(), cell, "left_anti")
