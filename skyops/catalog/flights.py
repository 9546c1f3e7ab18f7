"""Flight pages to staged flights, quality and change feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyops import fixtures
from skyops.catalog import sqlparts as s
from skyops.catalog.registry import register
from skyops.functions import text, times
from skyops.operators import flights, quality
from skyops.plans import reports


def _updates(spark, sf_dir):
    """Updates with the derived columns that rules and keys read."""
    updates = fixtures.spark_table(spark, sf_dir, "flight_updates")
    dated = updates.withColumn("flight_date", F.to_date("scheduled_departure_utc_ts"))
    return dated.withColumn(flights.KEY, flights.flight_key())


def _staged(spark, sf_dir):
    return flights.stage_flights(fixtures.flight_bronze(spark, sf_dir))


@register(f"SELECT update_id, flight_instance_hash_key FROM ({s.UPDATES}) u")
def flight_keys(spark, sf_dir):
    return _updates(spark, sf_dir).select("update_id", flights.KEY)


def _times_sql(end: str, due: str) -> str:
    happened = f"{due} + INTERVAL 1 MINUTE * {end}_delay_minutes"
    return f"""CAST({due} AS VARCHAR) AS scheduled_{end}_local_ts, CAST({due} AS VARCHAR) AS scheduled_{end}_utc_ts,
 CAST({happened} + INTERVAL 60 MINUTE AS VARCHAR) AS actual_{end}_local_ts, CAST({happened} AS VARCHAR) AS actual_{end}_utc_ts"""


_HOUR = "lpad(CAST(version * 4 AS VARCHAR), 2, '0')"
_STAGED_SQL = f"""
SELECT update_id, flight_instance_hash_key, CAST(flight_date AS VARCHAR) AS flight_date, operating_airline_id,
 operating_flight_number, departure_airport_code, arrival_airport_code, {", ".join(fixtures.PLAIN_FIELDS)},
 {_times_sql("departure", "scheduled_departure_utc_ts")},
 {_times_sql("arrival", "(scheduled_departure_utc_ts + INTERVAL 120 MINUTE)")},
 flight_status_code, departure_delay_minutes, arrival_delay_minutes, flight_status_code IS NULL AS has_missing_status,
 coalesce(flight_status_code = 'LD', FALSE) AS is_landed, coalesce(flight_status_code = 'CD', FALSE) AS is_cancelled,
 coalesce(flight_status_code = 'DV', FALSE) AS is_diverted, coalesce(flight_status_code = 'RT', FALSE) AS is_rerouted,
 'departures' AS requested_direction, departure_airport_code AS requested_airport, '2024-01-12' AS requested_date,
 '2024-01-12T' || {_HOUR} || ':00' AS requested_window_start,
 CAST(TIMESTAMP '2024-01-12 00:00:00' + INTERVAL 4 HOUR * version AS VARCHAR) AS sequence_ts
FROM ({s.UPDATES}) u
"""


@register(f"SELECT * EXCLUDE (update_id) FROM ({_STAGED_SQL}) x")
def envelope_parse(spark, sf_dir):
    """Fixture rows to JSON pages of 50 and back, every staged column."""
    return _staged(spark, sf_dir).select(*flights.STAGED)


@register(f"""
WITH u AS (SELECT *, (version + CAST(substr(departure_airport_code, 2) AS INT)) % 5 AS broken, (update_id // 3) // 1250 AS page
 FROM ({s.UPDATES}) x)
SELECT departure_airport_code AS requested_airport, '2024-01-12T' || {_HOUR} || ':00' AS requested_window_start, broken,
 CASE WHEN broken > 2 THEN count(*) ELSE count(DISTINCT page) END AS records,
 CASE WHEN broken > 2 THEN count(operating_flight_number) ELSE 0 END AS numbers
FROM u GROUP BY departure_airport_code, version, broken
""")
def malformed_pages(spark, sf_dir):
    """Of five kinds of pages one is cut off, one has an empty list and one a text where records should be. Each of
    these counts as one empty record."""
    pages = fixtures.flight_bronze(spark, sf_dir)
    hour, airport = F.substring("window_start", 12, 2).cast("int"), F.substring("airport", 2, 2).cast("int")
    broken = (F.floor(hour / 4) + airport) % 5
    resource = '{"FlightStatusResource":{"Flights":{"Flight":%s}}}'
    body = (
        F.when(broken == 0, F.expr("substring(raw_json, 1, length(raw_json) DIV 2)"))
        .when(broken == 1, F.lit(resource % "[]")).when(broken == 2, F.lit(resource % '"none"')).otherwise(F.col("raw_json"))
    )
    staged = flights.stage_flights(pages.withColumn("raw_json", body))
    hour, airport = F.substring("requested_window_start", 12, 2).cast("int"), F.substring("requested_airport", 2, 2).cast("int")
    return staged.groupBy(
        "requested_airport", "requested_window_start", ((F.floor(hour / 4) + airport) % 5).cast("int").alias("broken")
    ).agg(
        F.count(F.lit(1)).alias("records"), F.count("operating_flight_number").alias("numbers")
    )


@register(f"""
SELECT requested_airport, requested_window_start, count(*) AS flights,
 count(*) FILTER (WHERE is_cancelled) AS cancelled, CAST(sum(departure_delay_minutes) AS BIGINT) AS delay
FROM ({_STAGED_SQL}) x GROUP BY ALL
""")
def request_context(spark, sf_dir):
    return _staged(spark, sf_dir).groupBy("requested_airport", "requested_window_start").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if("is_cancelled").alias("cancelled"),
        F.sum("departure_delay_minutes").alias("delay"),
    )


@register(f"""
SELECT operating_airline_id, operating_flight_number, departure_airport_code, arrival_airport_code,
 CAST(sequence_ts AS VARCHAR) AS sequence_ts, {s.REASON} AS quarantine_reason
FROM ({s.UPDATES}) u WHERE no_airline OR no_number OR no_arrival
""")
def quarantine_reasons(spark, sf_dir):
    bad = quality.quarantine(_updates(spark, sf_dir), flights.RULES, "all", "quarantine_reason")
    return bad.select(
        "operating_airline_id", "operating_flight_number", "departure_airport_code", "arrival_airport_code",
        "sequence_ts", "quarantine_reason",
    )


@register(f"""
SELECT {s.REASON} AS quarantine_reason, count(*) AS rows FROM ({s.UPDATES}) u
WHERE no_airline OR no_number OR no_arrival GROUP BY 1
""")
def quarantine_summary(spark, sf_dir):
    """From the JSON pages on."""
    return reports.quarantine_volume(flights.quarantined_flights(_staged(spark, sf_dir)))


@register(f"""
SELECT * EXCLUDE (update_id), replace(requested_window_start, ':00', ':00:00Z') AS run_id,
 concat_ws('/', replace(requested_window_start, ':00', ':00:00Z'), requested_airport, 'page=' || CAST((update_id // 3) // 1250 AS VARCHAR) || '.json')
  AS _source_file_path, sequence_ts AS _source_file_modification_time
FROM ({_STAGED_SQL}) x WHERE update_id IN (SELECT update_id FROM ({s.VALID}) v)
""")
def valid_feed(spark, sf_dir):
    return flights.cdc_feed(_staged(spark, sf_dir))


@register(f"""
WITH u AS ({s.UPDATES}), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE no_airline OR no_number OR no_arrival) AS d FROM u),
f AS (
 SELECT 'valid_operating_airline_id' AS rule, count(*) FILTER (WHERE no_airline) AS failed FROM u UNION ALL
 SELECT 'valid_operating_flight_number', count(*) FILTER (WHERE no_number) FROM u UNION ALL
 SELECT 'valid_arrival_airport_code', count(*) FILTER (WHERE no_arrival) FROM u UNION ALL
 SELECT 'valid_departure_airport_code', 0 UNION ALL SELECT 'valid_scheduled_departure_utc_ts', 0 UNION ALL
 SELECT 'valid_flight_date', 0)
SELECT rule, n - failed AS passed, CAST(failed AS BIGINT) AS failed, d AS rows_dropped FROM f, n
""")
def rule_metrics(spark, sf_dir):
    return quality.rule_metrics(_updates(spark, sf_dir), flights.RULES)


# --- times: every event's instant, written in several ways, good and bad

_SHAPES = """
SELECT event_id, CAST(event_id % 6 AS INT) AS shape, date_trunc('minute', ts) AS minute, ts FROM {events}
"""


def _raw_times(spark, sf_dir):
    events = fixtures.source(spark, sf_dir, "events")
    label, shape = times.window_label(F.col("ts")), F.col("event_id") % 6
    raw = (
        F.when(shape == 0, label)
        .when(shape == 1, F.concat(label, F.lit("Z")))
        .when(shape == 2, F.concat(label, F.lit("+02")))
        .when(shape == 3, F.concat(label, F.lit(":30")))
        .when(shape == 4, F.lit("2024-02-30T10:00"))
    )
    return events.select("event_id", raw.alias("raw"))


@register(f"""
SELECT event_id, CAST(CASE WHEN shape = 0 THEN minute END AS VARCHAR) AS local_ts,
 CAST(CASE WHEN shape = 1 THEN minute WHEN shape = 2 THEN minute - INTERVAL 2 HOUR END AS VARCHAR) AS utc_ts,
 CAST(CAST(coalesce(CASE WHEN shape = 0 THEN minute END, CASE WHEN shape = 1 THEN minute WHEN shape = 2 THEN minute - INTERVAL 2 HOUR END)
  AS DATE) AS VARCHAR) AS flight_date
FROM ({_SHAPES.format(events="events")}) e
""")
def time_parse(spark, sf_dir):
    local, utc = times.local_time(F.col("raw")), times.utc_time(F.col("raw"))
    return _raw_times(spark, sf_dir).select(
        "event_id", local.alias("local_ts"), utc.alias("utc_ts"), times.flight_date(local, utc).alias("flight_date")
    )


@register("""
SELECT event_id, CAST(trunc(date_diff('microsecond', TIMESTAMP '2024-01-15 12:00:30', ts) / 60000000.0) AS INT) AS minutes FROM events
""")
def delay_minutes(spark, sf_dir):
    due = F.expr("TIMESTAMP_NTZ '2024-01-15 12:00:30'")
    events = fixtures.source(spark, sf_dir, "events")
    return events.select("event_id", times.delay_minutes(due, F.col("ts")).alias("minutes"))


@register("""
SELECT strftime(w, '%Y-%m-%dT%H:%M') AS window_start, strftime(w - INTERVAL 12 HOUR, '%Y-%m-%dT%H:%M') AS half_day_before,
 strftime(w + INTERVAL 4 HOUR, '%Y-%m-%dT%H:%M') AS next_window, count(*) AS events
FROM (SELECT time_bucket(INTERVAL 4 HOUR, ts, TIMESTAMP '2024-01-01 00:00:00') AS w FROM events) e GROUP BY ALL
""")
def window_floor(spark, sf_dir):
    ts = F.col("ts")
    return fixtures.source(spark, sf_dir, "events").groupBy(
        *[
            times.window_label(times.window_floor(ts, hours)).alias(name)
            for name, hours in (("window_start", 0), ("half_day_before", 12), ("next_window", -4))
        ]
    ).agg(F.count(F.lit(1)).alias("events"))


@register("""
SELECT DISTINCT replace(o_orderpriority || ':' || o_orderstatus, ':', '-') AS safe,
 replace(strftime(o_orderdate, '%Y-%m-%dT%H:%M'), ':', '-') AS window_folder FROM orders
""")
def path_safe_ids(spark, sf_dir):
    orders = fixtures.source(spark, sf_dir, "orders")
    return orders.select(
        text.path_safe(F.concat_ws(":", "o_orderpriority", "o_orderstatus")).alias("safe"),
        text.path_safe(times.window_label(F.col("o_orderdate"))).alias("window_folder"),
    ).distinct()
