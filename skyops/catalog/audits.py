"""Ingestion logs, landing completeness, request coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyops import fixtures
from skyops.catalog.registry import register
from skyops.functions import times
from skyops.operators import flights
from skyops.plans import audits, reports
from skyops.session import workspace
from skyops.sources import landing, logs, tables
from skyops.specs import ENTITIES

_LOG = fixtures.ansi_sql("ingest_log")


@register(f"""
SELECT run_id, status, http_status, count(*) AS rows FROM ({_LOG}) l GROUP BY ALL
""")
def log_health(spark, sf_dir):
    return reports.log_health(fixtures.spark_table(spark, sf_dir, "ingest_log"))


@register(f"""
SELECT run_id, count(*) AS rows, count(*) FILTER (WHERE status = 'retry') AS retries,
 count(*) FILTER (WHERE status LIKE 'failed%') AS failures FROM ({_LOG}) l GROUP BY ALL
""")
def log_retries(spark, sf_dir):
    return reports.log_retries(fixtures.spark_table(spark, sf_dir, "ingest_log"))


@register("""
SELECT strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%Y-%m-%dT%H:%M') AS timestamp_utc, event_type AS status,
 CAST(user_id AS INT) AS records_total, '{"limit":' || CAST(event_id % 100 AS VARCHAR) || '}' AS params_json,
 CAST(NULL AS VARCHAR) AS airport
FROM events
""")
def log_append(spark, sf_dir):
    """Two appends into one log table, then a read of all of it."""
    path = f"{workspace(spark, 'log')}/flight_status"
    events = fixtures.source(spark, sf_dir, "events")
    records = events.select(
        times.window_label(F.col("ts")).alias("timestamp_utc"),
        F.col("event_type").alias("status"),
        F.col("user_id").alias("records_total"),
        F.struct((F.col("event_id") % 100).alias("limit")).alias("params"),
        "event_id",
    )
    for part in (0, 1):
        logs.append_log(records.where(F.col("event_id") % 2 == part), "flight_status", path)
    written = tables.read_table(spark, path, logs.log_schema("flight_status"))
    return written.select("log_date", "timestamp_utc", "status", "records_total", "params_json", "airport")


_PAGES = """
SELECT version, airport, page, count(*) AS rows FROM (
 SELECT CAST(o_orderkey % 3 AS INT) AS version, 'N' || lpad(CAST(((o_orderkey - o_orderkey % 3) / 3)::BIGINT % 25 AS VARCHAR), 2, '0') AS airport,
  (o_orderkey // 3) // 1250 AS page FROM orders) o GROUP BY version, airport, page
"""
_RUN = "'2024-01-12T' || lpad(CAST(version * 4 AS VARCHAR), 2, '0')"


@register(f"""
SELECT {_RUN} || ':00:00Z' AS run_id, airport, 'departures' AS direction, {_RUN} || ':00' AS window_start,
 count(*) FILTER (WHERE landed) AS pages_landed, CAST(sum(rows) AS INT) AS total_count,
 CAST(greatest(1, ceil(sum(rows) / 50.0)) AS BIGINT) AS pages_expected, bool_and(landed) AS is_complete
FROM (SELECT *, NOT (page = 2 AND airport IN ('N03', 'N11')) AS landed FROM ({_PAGES}) p) q
GROUP BY version, airport
""")
def landing_completeness(spark, sf_dir):
    """All pages of the fixture but the third one of two airports."""
    pages = fixtures.flight_bronze(spark, sf_dir)
    lost = F.col("airport").isin("N03", "N11") & (audits.page_number(F.col("_source_file_path")) == "2")
    return audits.landing_completeness(pages.where(~lost), flights.RESOURCE)


@register(f"""
SELECT run_id, CAST(count(DISTINCT source_file_path) FILTER (WHERE NOT lost) AS BIGINT) AS pages_landed, CAST(count(*) AS INT) AS total_count,
 CAST(greatest(1, ceil(count(*) / 100.0)) AS BIGINT) AS pages_expected,
 count(DISTINCT source_file_path) FILTER (WHERE NOT lost) >= greatest(1, ceil(count(*) / 100.0)) AS is_complete
FROM (SELECT *, run_id LIKE '2024-02%' AND source_file_path <> 'page=0.json' AS lost FROM ({fixtures.ansi_sql("countries_snapshots")}) c) x
GROUP BY run_id
""")
def landing_completeness_reference(spark, sf_dir):
    """Countries; of the second run only the first page has landed."""
    pages = fixtures.reference_bronze(spark, sf_dir, "countries")
    lost = F.col("run_id").startswith("2024-02") & (F.col("_source_file_path") != "page=0.json")
    spec = ENTITIES["countries"]
    return audits.landing_completeness(
        pages.where(~lost), spec.resource, audits.REFERENCE_REQUEST, audits.REFERENCE_PAGE_SIZE
    )


@register(f"""
WITH cells AS ({fixtures.ansi_sql("landed_cells")}),
offsets AS (SELECT 'departures' AS direction, unnest([24, 20, 16, 12, 8, 4, 0, -4]) AS hours
 UNION ALL SELECT 'arrivals', unnest([12, 8, 4, 0, -4, -8, -12, -16])),
grid AS (SELECT DISTINCT c.airport, o.direction, c.window_start - to_hours(o.hours) AS window_start FROM cells c, offsets o)
SELECT airport, direction, CAST(window_start AS VARCHAR) AS window_start FROM grid
EXCEPT SELECT airport, 'departures', CAST(window_start AS VARCHAR) FROM cells
""")
def coverage_audit(spark, sf_dir):
    """A run in every landed window of an airport asks for its neighbours as well; only departures have landed."""
    cells = fixtures.spark_table(spark, sf_dir, "landed_cells")
    runs = cells.select("airport", F.timestamp_add("MINUTE", F.lit(95), F.col("window_start")).alias("run_at"))
    landed = cells.select("airport", F.lit("departures").alias("direction"), "window_start")
    return audits.coverage_audit(runs, landed)


_LANDED = f"""
SELECT 'departures' AS direction, airport, '2024-01-12' AS date, {_RUN} || '-00' AS window_start, {_RUN} || '-00-00Z' AS run_id,
 count(*) AS pages, CAST(sum(rows) AS BIGINT) AS flights FROM ({_PAGES}) p GROUP BY version, airport
"""


def land_flights(spark, sf_dir, root: str, versions=(0, 1, 2)) -> None:
    """Land the fixture pages of some versions, one run after the other; the file times then follow the versions."""
    pages = fixtures.flight_pages(spark, sf_dir)
    for version in versions:
        landing.write_landing(pages.where(F.col("version") == version), root, landing.FLIGHT_FOLDER)


@register(_LANDED)
def landing_round_trip(spark, sf_dir):
    """Write pages, write one run again, read all of them."""
    root = workspace(spark, "landing")
    land_flights(spark, sf_dir, root)
    land_flights(spark, sf_dir, root, [1])
    pages = landing.landing_batch(spark, f"{root}/{landing.FLIGHT_FOLDER}", landing.FLIGHT_PARTITIONS)
    folders = list(landing.FLIGHT_PARTITIONS)
    staged = flights.project_flights(pages).groupBy("_source_file_path", *folders).agg(F.count(F.lit(1)).alias("n"))
    return staged.groupBy(*folders).agg(F.count(F.lit(1)).alias("pages"), F.sum("n").alias("flights"))
