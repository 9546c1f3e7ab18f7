"""Reports over the marts, quarantine tables and logs. All read grouped tables; none touches flights."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.functions.kpi import BANDS, safe_ratio
from skyops.operators.lookup import airport_labels
from skyops.operators.skew import BROADCAST_BYTES

# Category names of the delay distribution, with the hourly mart's column for each.
DELAY_CATEGORIES = dict(zip(("early", "0-15", "15-60", "60-120", "120+"), BANDS)) | {
    "disrupted": "route_disrupted_flights",
    "cancelled": "cancelled_flights",
}


def apply_filters(
    df: DataFrame, start: date | None = None, end: date | None = None, airports: Sequence[str] | None = None
) -> DataFrame:
    """The shared filters of every view: date range (both ends included) and departure airports."""
    if start is not None:
        df = df.where(F.col("flight_date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("flight_date") <= F.lit(end))
    if airports is not None:
        df = df.where(F.col("departure_airport_code").isin(*airports))
    return df


def _total(name: str) -> Column:
    return F.sum(name)


def _weighted(value: str, weight: str) -> Column:
    return F.sum(F.col(value) * F.col(weight))


def _planned_mean(end: str = "departure") -> Column:
    """Mean delay over flights operated as planned, from per-group means."""
    return safe_ratio(
        _weighted(f"avg_{end}_delay_minutes", "operated_as_planned_flights"), _total("operated_as_planned_flights")
    )


def _planned_otp(end: str = "departures") -> Column:
    return safe_ratio(_total(f"on_time_{end}"), _total("operated_as_planned_flights"))


def _ranked(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    return df.groupBy(key).agg(value.alias(name)).orderBy(F.desc(name), key)


# --- standing questions over the hourly mart; their denominator is all flights, not those as planned


def busiest_airports(hourly: DataFrame) -> DataFrame:
    return _ranked(hourly, "departure_airport_code", _total("total_flights"), "flights")


def _mean_delay_over_all() -> Column:
    return safe_ratio(_weighted("avg_departure_delay_minutes", "total_flights"), _total("total_flights"))


def airport_mean_delay(hourly: DataFrame) -> DataFrame:
    return _ranked(hourly, "departure_airport_code", _mean_delay_over_all(), "avg_delay")


def airport_cancel_rate(hourly: DataFrame) -> DataFrame:
    rate = safe_ratio(_total("cancelled_flights"), _total("total_flights"))
    return _ranked(hourly, "departure_airport_code", rate, "cancellation_rate")


def airport_otp(hourly: DataFrame) -> DataFrame:
    rate = safe_ratio(_total("on_time_departures"), _total("total_flights"))
    return _ranked(hourly, "departure_airport_code", rate, "otp")


def peak_delay_hours(hourly: DataFrame) -> DataFrame:
    return _ranked(hourly, "departure_hour", _mean_delay_over_all(), "avg_delay")


# --- quality


def quarantine_volume(quarantined: DataFrame, reason: str = "quarantine_reason") -> DataFrame:
    return quarantined.groupBy(reason).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), reason)


# --- dashboard views


def kpi_summary(hourly: DataFrame) -> DataFrame:
    return hourly.agg(
        _total("total_flights").alias("total_flights"),
        _planned_mean().alias("avg_departure_delay_minutes"),
        _planned_otp().alias("departure_otp_15_pct"),
        _total("cancelled_flights").alias("cancelled_flights"),
        safe_ratio(_total("cancelled_flights"), _total("total_flights")).alias("cancellation_rate"),
        _total("route_disrupted_flights").alias("disrupted_flights"),
    )


def hourly_delay(hourly: DataFrame) -> DataFrame:
    mean = _planned_mean().alias("avg_departure_delay_minutes")
    return hourly.groupBy("departure_hour").agg(mean).orderBy("departure_hour")


def delay_distribution(hourly: DataFrame) -> DataFrame:
    """Flights per hour and delay category, and the category's share of the hour's flights."""
    per_hour = hourly.groupBy("departure_hour").agg(
        F.sum("total_flights").alias("hour_flights"), *[F.sum(c).alias(c) for c in DELAY_CATEGORIES.values()]
    )
    cells = [F.struct(F.lit(name).alias("category"), F.col(c).alias("flights")) for name, c in DELAY_CATEGORIES.items()]
    return per_hour.select("departure_hour", "hour_flights", F.inline(F.array(*cells))).select(
        "departure_hour", "category", "flights", safe_ratio(F.col("flights"), F.col("hour_flights")).alias("share")
    )


def hourly_otp(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("departure_hour").agg(_planned_otp().alias("departure_otp_15_pct")).orderBy("departure_hour")


def distance_compare(distance: DataFrame) -> DataFrame:
    return distance.groupBy("distance_category").agg(
        _total("total_flights").alias("total_flights"),
        _planned_mean().alias("avg_departure_delay_minutes"),
        _planned_otp().alias("departure_otp_15_pct"),
    )


def _top_routes(routes: DataFrame, value: Column, name: str, k: int) -> DataFrame:
    """The ``k`` greatest; ties go to the route first in the alphabet."""
    return routes.groupBy("route").agg(value.alias(name)).orderBy(F.desc(name), "route").limit(k)


def top_routes_delay(routes: DataFrame, k: int = 10) -> DataFrame:
    return _top_routes(routes, _planned_mean(), "avg_departure_delay_minutes", k)


def top_routes_otp(routes: DataFrame, k: int = 10) -> DataFrame:
    return _top_routes(routes, _planned_otp(), "departure_otp_15_pct", k)


def top_routes_cancellation(routes: DataFrame, k: int = 10) -> DataFrame:
    return _top_routes(routes, safe_ratio(_total("cancelled_flights"), _total("total_flights")), "cancellation_rate", k)


def top_routes_volume(routes: DataFrame, k: int = 10) -> DataFrame:
    return _top_routes(routes, _total("total_flights"), "total_flights", k)


def route_detail(routes: DataFrame) -> DataFrame:
    counts = (
        "total_flights", "cancelled_flights", "route_disrupted_flights", "operated_flights",
        "operated_as_planned_flights", "on_time_departures", "on_time_arrivals",
    )
    return routes.groupBy("route").agg(
        *[F.sum(c).alias(c) for c in counts],
        _planned_mean("departure").alias("avg_departure_delay_minutes"),
        _planned_mean("arrival").alias("avg_arrival_delay_minutes"),
        _planned_otp("departures").alias("departure_otp_15_pct"),
        _planned_otp("arrivals").alias("arrival_otp_15_pct"),
        safe_ratio(_total("cancelled_flights"), _total("total_flights")).alias("cancellation_rate"),
        safe_ratio(_total("route_disrupted_flights"), _total("operated_flights")).alias("route_disruption_rate"),
    )


def airport_selector(hourly: DataFrame, airports: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    return airport_labels(hourly, airports, limit)


# --- ingestion log


def log_health(log: DataFrame) -> DataFrame:
    """Log rows by run, status and HTTP status."""
    return log.groupBy("run_id", "status", "http_status").agg(F.count(F.lit(1)).alias("rows"))


def log_retries(log: DataFrame) -> DataFrame:
    """Requests, retries and failures of every run. Every ``failed`` kind of status counts as a failure."""
    return log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("status") == "retry").alias("retries"),
        F.count_if(F.col("status").startswith("failed")).alias("failures"),
    )
