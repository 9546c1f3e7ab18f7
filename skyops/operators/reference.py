"""Reference pages to dimension snapshots; one code path for all entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyops.functions import envelope, text
from skyops.operators import cdc, quality
from skyops.specs import CODE, NUMBER, EntitySpec

LINEAGE = ["source_file_path", "source_file_modification_ts", "run_id"]
_CLEAN = {CODE: text.clean_code, NUMBER: lambda column: column}


def latest_run(pages: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Pages of the greatest run id (as text, which ISO ids sort correctly).

    A scalar subquery rather than a join with the maximum: on a table partitioned by run the scan then opens the files
    of that run only. ``runs`` holds the run ids where there is a cheaper list of them than ``pages``, such as
    ``tables.partition_values``.
    """
    return pages.where(F.col("run_id") == (pages if runs is None else runs).select(F.max("run_id")).scalar())


def clean(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Cleaned columns beside the ``*_raw`` ones."""
    return df.withColumns({
        c: _CLEAN.get(kind, text.clean_text)(F.col(f"{c}_raw")) for c, (_, kind) in spec.columns.items()
    })


def stage_reference(pages: DataFrame, spec: EntitySpec) -> DataFrame:
    """One row per record: raw and cleaned columns, the page text and lineage."""
    rows = envelope.explode_records(pages, spec.record_path, spec.record, "record")
    flat = rows.select(
        *[F.col(f"record.{path}").alias(f"{c}_raw") for c, (path, _) in spec.columns.items()],
        "raw_json",
        F.col("_source_file_path").alias("source_file_path"),
        F.col("_source_file_modification_time").alias("source_file_modification_ts"),
        "run_id",
    )
    return clean(flat, spec)


def quarantined_reference(staged: DataFrame, spec: EntitySpec) -> DataFrame:
    """Invalid records with their first failing rule."""
    bad = quality.quarantine(staged, spec.rules, "first", "validation_error")
    return bad.select(
        *spec.raw_columns, "validation_error", "raw_json", *LINEAGE, F.current_timestamp().alias("quarantined_ts")
    )


def valid_snapshot(staged: DataFrame, spec: EntitySpec) -> DataFrame:
    """Valid records, one per business key: the newest source file wins."""
    valid = quality.expect_or_drop(staged, spec.rules).select(*spec.columns, *LINEAGE)
    return cdc.dedup_latest(valid, spec.keys, ["source_file_modification_ts", "source_file_path"])


def snapshot_valid(bronze: DataFrame, spec: EntitySpec) -> DataFrame:
    """Latest run of the bronze pages to a clean snapshot."""
    return valid_snapshot(stage_reference(latest_run(bronze), spec), spec)
