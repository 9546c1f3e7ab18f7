"""Streaming jobs and whole runs, in a new folder each time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyops import fixtures
from skyops.catalog import sqlparts as s
from skyops.catalog.audits import _LANDED, land_flights
from skyops.catalog.changes import _EVENT, _event_versions
from skyops.catalog.reference import _FIRST, _LAST, _rounded, _snapshot_sql
from skyops.catalog.registry import register
from skyops.layout import Layout
from skyops.operators import cdc, flights, quality
from skyops.plans import reports, runs
from skyops.session import workspace
from skyops.sources import landing, tables
from skyops.specs import ENTITIES
from skyops.streaming import bronze, silver


def _run_flights(spark, sf_dir, options: dict | None = None, archive: bool = False, compact: bool = False) -> Layout:
    """Some versions land, then their new files are processed; then the others."""
    layout = Layout(workspace(spark, "flights"))
    for versions in ([0], [1, 2]):
        land_flights(spark, sf_dir, layout.landing, versions)
        bronze.ingest_flights(spark, layout, options, archive)
        silver.update_flights(spark, layout, options)
        if compact:
            silver.compact_log(spark, layout.silver("flight_status_cdc_source"), flights.FEED_SCHEMA)
    return layout


def _numbered(spark, layout: Layout):
    """The stored history. File times stand for the sequence, so versions are numbered."""
    history = tables.read_table(spark, layout.silver("flight_status_history"), flights.HISTORY_SCHEMA)
    number = F.row_number().over(Window.partitionBy(flights.KEY).orderBy(cdc.START))
    return history.select(
        flights.KEY, "flight_date", "flight_status_code", "departure_delay_minutes", number.alias("version_no"),
        F.col(cdc.END).isNull().alias("is_open"),
    )


@register(_LANDED)
def stream_bronze(spark, sf_dir):
    """Two rounds of landing and ingest: the second sees only the new files."""
    layout = Layout(workspace(spark, "bronze"))
    for versions in ([0], [1, 2]):
        land_flights(spark, sf_dir, layout.landing, versions)
        bronze.ingest_flights(spark, layout)
    pages = tables.read_table(spark, layout.bronze("flight_status"), silver.BRONZE)
    folders = list(landing.FLIGHT_PARTITIONS)
    per_page = flights.project_flights(pages).groupBy("_source_file_path", *folders).agg(F.count(F.lit(1)).alias("n"))
    return per_page.groupBy(*folders).agg(F.count(F.lit(1)).alias("pages"), F.sum("n").alias("flights"))


@register(f"{_LANDED.replace('GROUP BY', 'WHERE version = 1 GROUP BY')}")
def stream_reland(spark, sf_dir):
    """Land, ingest, land the same pages again, ingest: every page is one bronze row."""
    layout = Layout(workspace(spark, "reland"))
    for _ in range(2):
        land_flights(spark, sf_dir, layout.landing, [1])
        bronze.ingest_flights(spark, layout)
    pages = tables.read_table(spark, layout.bronze("flight_status"), silver.BRONZE)
    folders = list(landing.FLIGHT_PARTITIONS)
    flat = flights.project_flights(pages).groupBy(*folders).agg(F.count(F.lit(1)).alias("flights"))
    return pages.groupBy(*folders).agg(F.count(F.lit(1)).alias("pages")).join(flat, folders)


@register(f"{_LANDED.replace('GROUP BY', 'WHERE version = 1 GROUP BY')}")
def stream_reland_archived(spark, sf_dir):
    """The same three times over with read pages archived: they are known although they have left the landing folder."""
    layout = Layout(workspace(spark, "reland-archived"))
    for _ in range(3):
        land_flights(spark, sf_dir, layout.landing, [1])
        bronze.ingest_flights(spark, layout, archive=True)
    pages = tables.read_table(spark, layout.bronze("flight_status"), silver.BRONZE)
    folders = list(landing.FLIGHT_PARTITIONS)
    flat = flights.project_flights(pages).groupBy(*folders).agg(F.count(F.lit(1)).alias("flights"))
    return pages.groupBy(*folders).agg(F.count(F.lit(1)).alias("pages")).join(flat, folders)


_NUMBERED = f"""
SELECT flight_instance_hash_key, CAST(flight_date AS VARCHAR) AS flight_date, flight_status_code, departure_delay_minutes,
 CAST(row_number() OVER (PARTITION BY flight_instance_hash_key ORDER BY __START_AT) AS INT) AS version_no,
 __END_AT IS NULL AS is_open FROM ({s.HISTORY}) h
"""


@register(_NUMBERED)
def stream_scd2(spark, sf_dir):
    """Landing to history in two incremental runs."""
    return _numbered(spark, _run_flights(spark, sf_dir))


@register(_NUMBERED)
def stream_batches_compacted(spark, sf_dir):
    """The same in small micro-batches, with read pages archived and the change log compacted after each run."""
    layout = _run_flights(spark, sf_dir, {"maxFilesPerTrigger": _files_per_batch(spark, sf_dir)}, archive=True, compact=True)
    return _numbered(spark, layout)


def _files_per_batch(spark, sf_dir) -> int:
    """About a third of the files that the first run lands: one page of 50 of each airport at least."""
    flights_in_a_run = fixtures.source(spark, sf_dir, "orders").count() // 3
    return max(9, flights_in_a_run // 150 + 1)


@register(f"""
SELECT flight_instance_hash_key, update_id, CAST(__START_AT AS VARCHAR) AS __START_AT, CAST(__END_AT AS VARCHAR) AS __END_AT
FROM ({s.HISTORY}) h
""")
def stream_out_of_order(spark, sf_dir):
    """The last updates of all flights arrive first, then the first ones, then those between."""
    updates = fixtures.spark_table(spark, sf_dir, "flight_updates").drop(*fixtures.PLAIN_FIELDS)
    dated = updates.withColumn("flight_date", F.to_date("scheduled_departure_utc_ts"))
    valid = quality.expect_or_drop(dated.withColumn(flights.KEY, flights.flight_key()), flights.RULES)
    root = workspace(spark, "late")
    for version in (2, 0, 1):
        valid.where(F.col("version") == version).write.mode("append").parquet(f"{root}/in")
        changes = tables.stream_table(spark, f"{root}/in", valid.schema)
        silver.scd2_stream(changes, f"{root}/log", f"{root}/history", f"{root}/checkpoint", [flights.KEY], flights.SEQUENCE)
    return spark.read.parquet(f"{root}/history").select(flights.KEY, "update_id", cdc.START, cdc.END)


@register(_event_versions("user_id"))
def stream_scd2_bucketed(spark, sf_dir):
    """Keys without a date: three batches of events, out of order, into a history that is kept in buckets of the key."""
    events = fixtures.source(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    root = workspace(spark, "bucketed")
    for third in (2, 0, 1):
        events.where(F.col("event_id") % 3 == third).write.mode("append").parquet(f"{root}/in")
        changes = tables.stream_table(spark, f"{root}/in", events.schema)
        silver.scd2_stream(changes, f"{root}/log", f"{root}/history", f"{root}/checkpoint", ["user_id"], "ts", partition=None, buckets=16)
    return spark.read.parquet(f"{root}/history").select(*_EVENT)


@register(f"""
WITH u AS ({s.UPDATES}), f AS (
 SELECT 'valid_operating_airline_id' AS rule, count(*) FILTER (WHERE no_airline) AS failed FROM u UNION ALL
 SELECT 'valid_operating_flight_number', count(*) FILTER (WHERE no_number) FROM u UNION ALL
 SELECT 'valid_arrival_airport_code', count(*) FILTER (WHERE no_arrival) FROM u UNION ALL
 SELECT 'valid_departure_airport_code', 0 UNION ALL SELECT 'valid_scheduled_departure_utc_ts', 0 UNION ALL
 SELECT 'valid_flight_date', 0)
SELECT rule, CAST((SELECT count(*) FROM u) - failed AS BIGINT) AS passed, CAST(failed AS BIGINT) AS failed FROM f
""")
def stream_rule_metrics(spark, sf_dir):
    """What the batches of two runs counted, summed up."""
    counted = spark.read.parquet(_run_flights(spark, sf_dir).silver("flight_status_rule_metrics"))
    return counted.groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


@register(f"""
SELECT {s.REASON} AS quarantine_reason, count(*) AS rows FROM ({s.UPDATES}) u
WHERE no_airline OR no_number OR no_arrival GROUP BY 1
""")
def stream_quarantine(spark, sf_dir):
    layout = _run_flights(spark, sf_dir)
    return reports.quarantine_volume(spark.read.parquet(layout.silver("flight_status_quarantine")))


def _land_reference(spark, sf_dir, root: str, entity: str, run_id: str) -> None:
    pages = fixtures.reference_pages(spark, sf_dir, entity).where(F.col("run_id") == run_id)
    # The copies' folder is part of the page name, so that pages stay apart and keep their order.
    page = F.regexp_replace("source_file_path", r"(copy=(\d+)/)?page=(\d+)\.json", "$2-$3")
    landing.write_landing(pages.withColumn("page", page), root, f"{landing.REFERENCE_FOLDER}/{entity}")


def _run_reference(spark, sf_dir, layout: Layout, entities) -> None:
    for run_id in (_FIRST, _LAST):
        for entity in entities:
            _land_reference(spark, sf_dir, layout.landing, entity, run_id)
        runs.run_reference(spark, layout, entities)


def _register_run(entity: str) -> None:
    spec = ENTITIES[entity]

    @register(f"SELECT {_rounded(spec.columns, spec)}, run_id FROM ({_snapshot_sql(spec, _LAST)}) x", f"run_reference_{entity}")
    def run(spark, sf_dir):
        layout = Layout(workspace(spark, "reference"))
        _run_reference(spark, sf_dir, layout, [entity])
        return tables.read_table(spark, layout.silver(f"{entity}_current")).select(*spec.columns, "run_id")


for _entity in ENTITIES:
    _register_run(_entity)

@register(f"SELECT {_rounded(ENTITIES['countries'].columns, ENTITIES['countries'])}, run_id FROM ({_snapshot_sql(ENTITIES['countries'], _FIRST)}) x")
def run_reference_guarded(spark, sf_dir):
    """A complete run, one of which only a page has landed, one without a known total: the first stays current."""
    layout, spec = Layout(workspace(spark, "guarded")), ENTITIES["countries"]
    every = fixtures.reference_pages(spark, sf_dir, "countries").withColumn("page", F.regexp_extract("source_file_path", r"(\d+)", 1))
    part = every.where((F.col("run_id") == _LAST) & (F.col("page") == "0"))
    blind = every.where(F.col("run_id") == _LAST).withColumns({
        "run_id": F.lit("2024-03-01T10-05-00Z"), "body": F.regexp_replace("body", r'"TotalCount":\d+', '"TotalCount":"many"'),
    })
    for pages in (every.where(F.col("run_id") == _FIRST), part, blind):
        landing.write_landing(pages, layout.landing, f"{landing.REFERENCE_FOLDER}/countries")
        runs.run_reference(spark, layout, ["countries"], guard=True)
    return tables.read_table(spark, layout.silver("countries_current")).select(*spec.columns, "run_id")


# Flights of the fixture as the marts see them after the last version.
_CURRENT = f"""
SELECT *, scheduled_departure_utc_ts AS scheduled_departure_local_ts,
 departure_delay_minutes IS NOT NULL AS has_actual_departure, arrival_delay_minutes IS NOT NULL AS has_actual_arrival,
 NOT is_cancelled AND NOT (is_diverted OR is_rerouted) AS planned, is_diverted OR is_rerouted AS disrupted,
 departure_delay_minutes IS NOT NULL OR arrival_delay_minutes IS NOT NULL OR is_cancelled AS relevant
FROM (SELECT *, coalesce(flight_status_code = 'CD', FALSE) AS is_cancelled, coalesce(flight_status_code = 'DV', FALSE) AS is_diverted,
 coalesce(flight_status_code = 'RT', FALSE) AS is_rerouted FROM ({s.HISTORY}) h WHERE __END_AT IS NULL) c
"""
_RUN_AIRPORTS = f"SELECT airport_code, latitude, longitude FROM ({_snapshot_sql(ENTITIES['airports'], _LAST)}) x"


def _run_marts(spark, sf_dir) -> Layout:
    layout = Layout(workspace(spark, "run"))
    _run_reference(spark, sf_dir, layout, ["airports"])
    for versions in ([0, 1], [2]):
        land_flights(spark, sf_dir, layout.landing, versions)
        runs.run_operational(spark, layout)
    return layout


def _register_mart(mart: str, sql: str, rates: bool) -> None:
    @register(s.rounded(sql, rates), f"run_{mart}")
    def run(spark, sf_dir):
        return tables.read_table(spark, _run_marts(spark, sf_dir).gold(mart))


_register_mart("departure_airport_hourly", s.hourly(_CURRENT), False)
_register_mart("route_daily_performance", s.route(_CURRENT), True)
_register_mart("airport_distance_category_daily_performance", s.distance(_CURRENT, _RUN_AIRPORTS), True)


def _counted(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS rows FROM ({sql}) t"


@register("\nUNION ALL\n".join([
    *[_counted(f"{e}_current", _snapshot_sql(spec, _LAST)) for e, spec in ENTITIES.items()],
    _counted("departure_airport_hourly", s.hourly(_CURRENT)), _counted("route_daily_performance", s.route(_CURRENT)),
    _counted("airport_distance_category_daily_performance", s.distance(_CURRENT, _RUN_AIRPORTS)),
]))
def run_bootstrap(spark, sf_dir):
    """One call over everything that has landed: five dimensions, then flights and the three marts."""
    layout = Layout(workspace(spark, "bootstrap"))
    for entity in ENTITIES:
        for run_id in (_FIRST, _LAST):
            _land_reference(spark, sf_dir, layout.landing, entity, run_id)
    land_flights(spark, sf_dir, layout.landing)
    built = runs.run_all(spark, layout)
    made = {f"{e}_current": tables.read_table(spark, layout.silver(f"{e}_current")) for e in ENTITIES} | built
    counts = [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, t in made.items()]
    return reduce(DataFrame.unionByName, counts)
