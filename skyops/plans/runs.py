"""Whole runs over a warehouse: reference data first, then flights and marts."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyops.layout import Layout
from skyops.operators import cdc, quality, reference
from skyops.plans import audits, marts
from skyops.sources import files, landing, tables
from skyops.specs import ENTITIES, EntitySpec
from skyops.streaming import bronze, silver


def apply_snapshot(spark: SparkSession, layout: Layout, spec: EntitySpec, guard: bool = False) -> dict[str, DataFrame]:
    """Latest bronze run of one entity to its quarantine, valid snapshot and current table.

    With ``guard`` the latest complete run is taken instead, so a partial run cannot delete dimension rows. Where no run is
    complete, or nothing has landed, all tables stay as they are: a warning says so, and the result has the tables that exist.
    """
    schema = landing.bronze_schema(landing.REFERENCE_PARTITIONS)
    pages = tables.read_or_empty(spark, layout.bronze(spec.name), schema)
    if guard:
        run = audits.latest_complete_run(pages, spec.resource)
    else:
        path = layout.bronze(spec.name)
        run = reference.latest_run(pages, tables.partition_values(spark, path, "run_id") if tables.exists(spark, path) else None)
    if run is None or not guard and pages.isEmpty():
        warnings.warn(f"{spec.name}: no {'complete ' if guard else ''}run, tables left as they are", stacklevel=2)
        names = {k: layout.silver(f"{spec.name}_{k}") for k in ("quarantine", "snapshot_valid", "current")}
        return {k.partition("_")[0]: tables.read_table(spark, p) for k, p in names.items() if tables.is_ready(spark, p)}
    staged = reference.stage_reference(run, spec)
    quarantined = tables.replace_table(
        reference.quarantined_reference(staged, spec), layout.silver(f"{spec.name}_quarantine"),
        options=tables.PAGE_TEXT_OPTIONS,
    )
    tables.replace_table(quality.rule_metrics(staged, spec.rules), layout.silver(f"{spec.name}_rule_metrics"))
    snapshot = tables.replace_table(
        reference.valid_snapshot(staged, spec), layout.silver(f"{spec.name}_snapshot_valid")
    )
    target = layout.silver(f"{spec.name}_current")
    before = tables.read_table(spark, target) if tables.is_ready(spark, target) else snapshot.limit(0)
    current = tables.replace_table(cdc.scd1_apply(before, snapshot, spec.keys), target)
    return {"quarantine": quarantined, "snapshot": snapshot, "current": current}


def run_reference(
    spark: SparkSession, layout: Layout, entities: list[str] | None = None, guard: bool = False,
    options: Mapping[str, str | int] | None = None, archive: bool = False,
) -> dict[str, dict[str, DataFrame]]:
    """New pages of some entities (default: all) through to their current tables. ``options`` go to the file source that
    reads the landing folder; with ``archive`` read pages move to the layout's archive folder."""
    out = {}
    for name in entities or ENTITIES:
        bronze.ingest_reference(spark, layout, name, options, archive)
        out[name] = apply_snapshot(spark, layout, ENTITIES[name], guard)
    return out


def run_operational(
    spark: SparkSession, layout: Layout, options: Mapping[str, str | int] | None = None, archive: bool = False,
) -> dict[str, DataFrame]:
    """New flight pages through to the three marts, which are laid out by date: see ``refresh_marts``. Without any flight so far,
    the marts are empty.

    ``options`` go to both stages (landing to bronze, bronze to silver) and bound their micro-batches, for instance
    ``maxFilesPerTrigger``; the defaults are in ``landing.SOURCE_OPTIONS``. ``archive`` as in ``run_reference``.
    """
    if not tables.is_ready(spark, layout.silver("airports_current")):
        raise RuntimeError("no current airports: the distance mart needs them, run the reference data first")
    bronze.ingest_flights(spark, layout, options, archive)
    silver.update_flights(spark, layout, options)
    return refresh_marts(spark, layout)


def _dates_to_refresh(spark: SparkSession, layout: Layout, base: DataFrame, airports: DataFrame, pending: DataFrame) -> list[str]:
    used = layout.gold("mart_airports")
    if not tables.is_ready(spark, used):
        return silver.touched_dates(base, silver.DATE)
    reached = marts.reached_dates(base, tables.read_table(spark, used), airports)
    return silver.touched_dates(pending.select(silver.DATE).unionByName(reached.select(F.col(silver.DATE).cast("string"))), silver.DATE)


def refresh_marts(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """Bring the three marts and their rule metrics up to date, for some dates only: those that batches have touched since the last
    refresh, and those with flights from or to an airport that has changed since. The first refresh takes all dates.

    A run that dies is made good by the next one: the notes of touched dates go, and the airports used are stored, only when
    the marts have been written.
    """
    airports = tables.read_table(spark, layout.silver("airports_current")).select("airport_code", "latitude", "longitude")
    schema, path = silver.kpi_base_schema(spark), layout.gold("kpi_base")
    base, notes = tables.read_or_empty(spark, path, schema), layout.gold("touched_dates")
    noted = tables.read_or_empty(spark, notes, T.StructType.fromDDL(f"{silver.DATE} string, query_id string, batch_id string"))
    folders = [f"query_id={r.query_id}/batch_id={r.batch_id}" for r in noted.select("query_id", "batch_id").distinct().collect()]
    pending = noted.where(F.concat(F.lit("query_id="), "query_id", F.lit("/batch_id="), "batch_id").isin(folders))
    dates = _dates_to_refresh(spark, layout, base, airports, pending)
    some = silver.read_dates(spark, path, schema, silver.DATE, dates) if dates else base.limit(0)

    built = {name: marts.unchecked_mart(name, some, airports) for name in marts.MART_RULES}
    made = {name: quality.expect_or_drop(mart, marts.MART_RULES[name]) for name, mart in built.items()}
    by_date = {layout.gold(name): mart for name, mart in made.items()}
    by_date[layout.gold("rule_metrics")] = marts.mart_rule_metrics(built, [silver.DATE])
    for target, rows in by_date.items():
        if dates or not tables.exists(spark, target):
            tables.replace_dates(rows, target, silver.DATE, dates)
    tables.replace_table(airports, layout.gold("mart_airports"))
    for folder in folders:
        files.delete(spark, f"{notes}/{folder}")
    return {name: spark.read.schema(mart.schema).parquet(layout.gold(name)).select(*mart.columns) for name, mart in made.items()}


def run_all(
    spark: SparkSession, layout: Layout, guard: bool = False, options: Mapping[str, str | int] | None = None,
    archive: bool = False,
) -> dict[str, DataFrame]:
    run_reference(spark, layout, guard=guard, options=options, archive=archive)
    return run_operational(spark, layout, options, archive)
