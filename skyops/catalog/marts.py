"""Marts, flight measures, distance and lookups, reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from skyops import fixtures
from skyops.catalog import sqlparts as s
from skyops.catalog.registry import register
from skyops.functions import kpi
from skyops.operators import lookup
from skyops.plans import marts, reports


def _airports(spark, sf_dir):
    return fixtures.spark_table(spark, sf_dir, "airports_dim")


def _hourly(spark, sf_dir):
    return marts.mart_hourly(fixtures.flights_wide(spark, sf_dir))


def _route(spark, sf_dir):
    return marts.mart_route_daily(fixtures.flights_wide(spark, sf_dir))


def _distance(spark, sf_dir):
    return marts.mart_distance_daily(fixtures.flights_wide(spark, sf_dir), _airports(spark, sf_dir))


register(s.rounded(s.HOURLY, rates=False), "mart_hourly")(_hourly)
register(s.rounded(s.ROUTE, rates=True), "mart_route_daily")(_route)
register(s.rounded(s.DISTANCE, rates=True), "mart_distance_daily")(_distance)

_FROM_BASE = {
    "departure_airport_hourly": (s.HOURLY, False),
    "route_daily_performance": (s.ROUTE, True),
    "airport_distance_category_daily_performance": (s.DISTANCE, True),
}


def _register_from_base(mart: str, sql: str, rates: bool) -> None:
    @register(s.rounded(sql, rates), f"base_{mart}")
    def from_base(spark, sf_dir):
        base = marts.kpi_base(fixtures.flights_wide(spark, sf_dir))
        return marts.mart_from_base(mart, base, _airports(spark, sf_dir))


for _mart, (_sql, _rates) in _FROM_BASE.items():
    _register_from_base(_mart, _sql, _rates)

# The marts before their rules, and when a row fails each rule.
_OTP_FAILS = {f"valid_{end}_otp_range": f"NOT {end}_otp_15_pct BETWEEN 0 AND 1" for end in ("departure", "arrival")}
_COUNT_FAILS = {f"non_negative_{c}": f"{c} < 0" for c in (
    "total_flights", "cancelled_flights", "route_disrupted_flights", "operated_flights", "operated_as_planned_flights"
)}
_FAILS = {
    "departure_airport_hourly": (s.hourly(s.FLAGGED, checked=False), {
        "valid_flight_date": "flight_date IS NULL",
        "valid_airport": "coalesce(trim(departure_airport_code), '') = ''",
        "valid_hour": "NOT coalesce(departure_hour BETWEEN 0 AND 23, FALSE)",
        "non_negative_flights": "total_flights < 0",
        **_OTP_FAILS,
    }),
    "route_daily_performance": (s.route(s.FLAGGED, checked=False), {
        **{f"valid_{c}": f"{c} IS NULL" for c in marts.ROUTE_KEYS}, **_COUNT_FAILS, **_OTP_FAILS,
    }),
    "airport_distance_category_daily_performance": (s.distance(s.FLAGGED, s.AIRPORTS, checked=False), {
        "valid_distance_category": "distance_category IS NULL", **_COUNT_FAILS, **_OTP_FAILS,
    }),
}


def _fails_sql(mart: str, sql: str, fails: dict[str, str]) -> str:
    dropped = " OR ".join(f"({f})" for f in fails.values())
    listed = ", ".join(f"count(*) FILTER (WHERE {f}) AS {rule}" for rule, f in fails.items())
    counted = f"SELECT count(*) AS n, count(*) FILTER (WHERE {dropped}) AS rows_dropped, {listed} FROM ({sql}) m"
    return f"""
SELECT '{mart}' AS mart, rule, n - failed AS passed, failed, rows_dropped
FROM (UNPIVOT ({counted}) ON {", ".join(fails)} INTO NAME rule VALUE failed) u"""


@register("\nUNION ALL\n".join(_fails_sql(mart, *checked) for mart, checked in _FAILS.items()))
def mart_rule_metrics(spark, sf_dir):
    base = marts.kpi_base(fixtures.flights_wide(spark, sf_dir))
    airports = _airports(spark, sf_dir)
    return marts.mart_rule_metrics({name: marts.unchecked_mart(name, base, airports) for name in marts.MART_RULES})


_ROW = ["operating_airline_id", "departure_airport_code", "arrival_airport_code", "flight_date", "scheduled_departure_local_ts"]
_ROW_SQL = """operating_airline_id, departure_airport_code, arrival_airport_code, CAST(flight_date AS VARCHAR) AS flight_date,
 CAST(scheduled_departure_local_ts AS VARCHAR) AS scheduled_departure_local_ts"""


@register(f"""
SELECT {_ROW_SQL}, is_cancelled AS _is_cancelled, disrupted AS _is_route_disrupted, NOT is_cancelled AS _is_operated,
 planned AS _is_operated_as_planned FROM ({s.FLAGGED}) f
""")
def flight_flags(spark, sf_dir):
    flags = [kpi.CANCELLED, kpi.DISRUPTED, kpi.OPERATED, kpi.PLANNED]
    return kpi.flight_flags(fixtures.flights_wide(spark, sf_dir)).select(*_ROW, *flags)


@register(f"SELECT {_ROW_SQL}, flight_status_code FROM ({s.FLAGGED}) f WHERE relevant")
def relevant_flights(spark, sf_dir):
    return marts.relevant_flights(fixtures.flights_wide(spark, sf_dir)).select(*_ROW, "flight_status_code")


@register(f"""
SELECT operating_airline_id, {s._BANDS}, count(*) AS flights FROM ({s.FLAGGED}) f GROUP BY operating_airline_id
""")
def delay_buckets(spark, sf_dir):
    bands = kpi.delay_buckets()
    return kpi.flight_flags(fixtures.flights_wide(spark, sf_dir)).groupBy("operating_airline_id").agg(
        *[F.count_if(inside).alias(name) for name, inside in bands.items()], F.count(F.lit(1)).alias("flights")
    )


@register(f"""
SELECT operating_airline_id, round(coalesce(avg(departure_delay_minutes) FILTER (WHERE planned), 0.0), 6) AS avg_delay,
 round(CASE WHEN count(*) FILTER (WHERE planned) > 0 THEN count(*) FILTER (WHERE planned AND departure_delay_minutes <= 15)
  / count(*) FILTER (WHERE planned) ELSE 0.0 END, 6) AS departure_otp,
 round(CASE WHEN count(*) FILTER (WHERE planned) > 0 THEN count(*) FILTER (WHERE planned AND departure_delay_minutes <= 30)
  / count(*) FILTER (WHERE planned) ELSE 0.0 END, 6) AS departure_otp_30
FROM ({s.FLAGGED}) f GROUP BY operating_airline_id
""")
def otp_rates(spark, sf_dir):
    flights, planned = kpi.flight_flags(fixtures.flights_wide(spark, sf_dir)), F.count_if(kpi.PLANNED)
    return flights.groupBy("operating_airline_id").agg(
        kpi.avg_or_zero(F.col("departure_delay_minutes"), F.col(kpi.PLANNED)).alias("avg_delay"),
        kpi.safe_ratio(F.count_if(kpi.on_time("departure")), planned).alias("departure_otp"),
        kpi.safe_ratio(F.count_if(kpi.on_time("departure", 30)), planned).alias("departure_otp_30"),
    )


def _routes(spark, sf_dir):
    """Routes with their flights and distance: grouped first, located after."""
    routes = fixtures.flights_wide(spark, sf_dir).groupBy("departure_airport_code", "arrival_airport_code").agg(
        F.count(F.lit(1)).alias("flights")
    )
    return marts.distances(lookup.with_coordinates(routes, _airports(spark, sf_dir)))


_ROUTES = f"""
SELECT departure_airport_code, arrival_airport_code, flights, CASE WHEN {s.KNOWN} THEN km END AS km FROM ({s.located(
 f"SELECT departure_airport_code, arrival_airport_code, count(*) AS flights FROM ({s.FLAGGED}) g GROUP BY ALL", s.AIRPORTS)}) r
"""


@register(f"SELECT departure_airport_code, arrival_airport_code, round(km, 6) AS distance_km FROM ({_ROUTES}) r")
def distance_km(spark, sf_dir):
    return _routes(spark, sf_dir).select("departure_airport_code", "arrival_airport_code", "distance_km")


@register(f"""
SELECT {s.CATEGORY} AS distance_category, count(*) AS routes, CAST(sum(flights) AS BIGINT) AS flights FROM ({_ROUTES}) r GROUP BY ALL
""")
def distance_category(spark, sf_dir):
    return _routes(spark, sf_dir).groupBy("distance_category").agg(
        F.count(F.lit(1)).alias("routes"), F.sum("flights").alias("flights")
    )


_COORDINATES = ["dep_latitude", "dep_longitude", "arr_latitude", "arr_longitude"]
_LOOKUP = f"SELECT {_ROW_SQL}, {', '.join(_COORDINATES)} FROM ({s.located(s.FLAGGED, s.AIRPORTS)}) l"


@register(_LOOKUP)
def airport_lookup(spark, sf_dir):
    flights = fixtures.flights_wide(spark, sf_dir).select(*_ROW)
    return lookup.with_coordinates(flights, _airports(spark, sf_dir)).select(*_ROW, *_COORDINATES)


@register(_LOOKUP)
def airport_lookup_unbounded(spark, sf_dir):
    """The lookup as it runs when the dimension is too large to broadcast, with the busier airports as hot keys."""
    flights = fixtures.flights_wide(spark, sf_dir).select(*_ROW)
    return lookup.with_coordinates(flights, _airports(spark, sf_dir), limit=0, hot_rows=2000).select(*_ROW, *_COORDINATES)


@register(f"SELECT {_ROW_SQL}, {', '.join(c for c in _COORDINATES if c.startswith('dep'))} FROM ({s.located(s.FLAGGED, s.AIRPORTS)}) l")
def lookup_mixed_types(spark, sf_dir):
    """Airport numbers, INT in flights and BIGINT in the dimension, the busier ones hot."""
    number = F.substring("departure_airport_code", 2, 2).cast("int")
    flights = fixtures.flights_wide(spark, sf_dir).select(*_ROW, number.alias("number"))
    airports = _airports(spark, sf_dir).withColumn("number", F.substring("airport_code", 2, 2).cast("long"))
    names = {"latitude": "dep_latitude", "longitude": "dep_longitude"}
    found = lookup.left_lookup(flights, airports, "number", "number", names, small=False, hot_rows=240)
    return found.select(*_ROW, *names.values())


# --- reports; marts are the ones checked above


def _over_hourly(report, sql: str, name: str | None = None) -> None:
    register(sql, name or report.__name__)(lambda spark, sf_dir: report(_hourly(spark, sf_dir)))


def _over_route(report, sql: str) -> None:
    register(sql, report.__name__)(lambda spark, sf_dir: report(_route(spark, sf_dir)))


_DELAY_ALL = "round(sum(avg_departure_delay_minutes * total_flights) / sum(total_flights), 6)"
_DELAY = """round(CASE WHEN sum(operated_as_planned_flights) > 0 THEN sum(avg_departure_delay_minutes * operated_as_planned_flights)
 / sum(operated_as_planned_flights) ELSE 0.0 END, 6)"""
_OTP = """round(CASE WHEN sum(operated_as_planned_flights) > 0 THEN sum(on_time_departures)
 / sum(operated_as_planned_flights) ELSE 0.0 END, 6)"""


def _exact(rounded: str) -> str:
    """The value before rounding, by which reports rank."""
    return rounded.removeprefix("round(").removesuffix(", 6)")


def _big(name: str, alias: str | None = None) -> str:
    return f"CAST(sum({name}) AS BIGINT) AS {alias or name}"


_over_hourly(reports.busiest_airports, f"""
SELECT departure_airport_code, {_big("total_flights", "flights")} FROM ({s.HOURLY}) h GROUP BY 1 ORDER BY flights DESC, 1
""")
_over_hourly(reports.airport_mean_delay, f"""
SELECT departure_airport_code, {_DELAY_ALL} AS avg_delay FROM ({s.HOURLY}) h GROUP BY 1 ORDER BY avg_delay DESC, 1
""")
_over_hourly(reports.airport_cancel_rate, f"""
SELECT departure_airport_code, round(sum(cancelled_flights) / sum(total_flights), 6) AS cancellation_rate
FROM ({s.HOURLY}) h GROUP BY 1 ORDER BY 2 DESC, 1
""")
_over_hourly(reports.airport_otp, f"""
SELECT departure_airport_code, round(sum(on_time_departures) / sum(total_flights), 6) AS otp FROM ({s.HOURLY}) h
GROUP BY 1 ORDER BY 2 DESC, 1
""")
_over_hourly(reports.peak_delay_hours, f"""
SELECT departure_hour, {_DELAY_ALL} AS avg_delay FROM ({s.HOURLY}) h GROUP BY 1 ORDER BY 2 DESC, 1
""")
_SUMMARY = f"""
SELECT {_big("total_flights")}, {_DELAY} AS avg_departure_delay_minutes, {_OTP} AS departure_otp_15_pct,
 {_big("cancelled_flights")}, round(sum(cancelled_flights) / sum(total_flights), 6) AS cancellation_rate,
 {_big("route_disrupted_flights", "disrupted_flights")} FROM ({s.HOURLY}) h
"""
_over_hourly(reports.kpi_summary, _SUMMARY)


@register(f"""{_SUMMARY} WHERE flight_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-06'
 AND departure_airport_code IN ('N01', 'N07', 'N20')""")
def kpi_summary_filtered(spark, sf_dir):
    chosen = reports.apply_filters(
        _hourly(spark, sf_dir), date(2024, 1, 3), date(2024, 1, 6), ["N01", "N07", "N20"]
    )
    return reports.kpi_summary(chosen)


_over_hourly(reports.hourly_delay, f"""
SELECT departure_hour, {_DELAY} AS avg_departure_delay_minutes FROM ({s.HOURLY}) h GROUP BY 1
""")
_over_hourly(reports.hourly_otp, f"""
SELECT departure_hour, {_OTP} AS departure_otp_15_pct FROM ({s.HOURLY}) h GROUP BY 1
""")
_over_hourly(reports.delay_distribution, "\nUNION ALL\n".join(
    f"""SELECT departure_hour, '{category}' AS category, {_big(column, "flights")},
 round(sum({column}) / sum(total_flights), 6) AS share FROM ({s.HOURLY}) h GROUP BY 1"""
    for category, column in (
        ("early", "early_departures"), ("0-15", "on_time_0_15_departures"), ("15-60", "delay_15_60_departures"),
        ("60-120", "delay_60_120_departures"), ("120+", "delay_120_plus_departures"),
        ("disrupted", "route_disrupted_flights"), ("cancelled", "cancelled_flights"),
    )
))


@register(f"""
SELECT distance_category, {_big("total_flights")}, {_DELAY} AS avg_departure_delay_minutes, {_OTP} AS departure_otp_15_pct
FROM ({s.DISTANCE}) d GROUP BY 1
""")
def distance_compare(spark, sf_dir):
    return reports.distance_compare(_distance(spark, sf_dir))


_over_route(reports.top_routes_delay, f"""
SELECT route, {_DELAY} AS avg_departure_delay_minutes FROM ({s.ROUTE}) r GROUP BY 1 ORDER BY {_exact(_DELAY)} DESC, 1 LIMIT 10
""")
_over_route(reports.top_routes_otp, f"""
SELECT route, {_OTP} AS departure_otp_15_pct FROM ({s.ROUTE}) r GROUP BY 1 ORDER BY {_exact(_OTP)} DESC, 1 LIMIT 10
""")
_over_route(reports.top_routes_volume, f"""
SELECT route, {_big("total_flights")} FROM ({s.ROUTE}) r GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
_over_route(reports.top_routes_cancellation, f"""
SELECT route, round(sum(cancelled_flights) / sum(total_flights), 6) AS cancellation_rate FROM ({s.ROUTE}) r
GROUP BY 1 ORDER BY sum(cancelled_flights) / sum(total_flights) DESC, 1 LIMIT 10
""")
_over_route(reports.route_detail, f"""
SELECT route, {", ".join(_big(c) for c in (
    "total_flights", "cancelled_flights", "route_disrupted_flights", "operated_flights", "operated_as_planned_flights",
    "on_time_departures", "on_time_arrivals"))},
 {_DELAY} AS avg_departure_delay_minutes, {_DELAY.replace("departure", "arrival")} AS avg_arrival_delay_minutes,
 {_OTP} AS departure_otp_15_pct, {_OTP.replace("departures", "arrivals")} AS arrival_otp_15_pct,
 round(sum(cancelled_flights) / sum(total_flights), 6) AS cancellation_rate,
 round(CASE WHEN sum(operated_flights) > 0 THEN sum(route_disrupted_flights) / sum(operated_flights) ELSE 0.0 END, 6)
  AS route_disruption_rate
FROM ({s.ROUTE}) r GROUP BY 1
""")


@register(f"""
SELECT DISTINCT departure_airport_code, airport_name, concat_ws(' - ', departure_airport_code, airport_name) AS airport_label
FROM ({s.HOURLY}) h LEFT JOIN ({s.AIRPORTS}) a ON departure_airport_code = airport_code
""")
def airport_selector(spark, sf_dir):
    return reports.airport_selector(_hourly(spark, sf_dir), _airports(spark, sf_dir))
