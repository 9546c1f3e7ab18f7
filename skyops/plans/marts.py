"""The three performance marts.

Each mart is ``finish(sums)``: sums per mart key, then means and ratios; its rules then drop rows. The sums come either
straight from flights or from ``kpi_base``, the same sums at the finest grain, which one scan of the flights makes and
all three marts share.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.functions import geo, kpi
from skyops.functions.text import route_label
from skyops.operators.cdc import snapshot_diff
from skyops.operators.lookup import with_coordinates
from skyops.operators.quality import Rule, expect_or_drop, present, rule_metrics
from skyops.operators.skew import BROADCAST_BYTES

HOURLY_KEYS = ("flight_date", "departure_airport_code", "departure_hour")
ROUTE_KEYS = ("flight_date", "departure_airport_code", "arrival_airport_code")
DISTANCE_KEYS = ("flight_date", "departure_airport_code", "distance_category")
BASE_KEYS = ("flight_date", "departure_airport_code", "arrival_airport_code", "departure_hour", "is_relevant")

_MEASURES = [
    "total_flights", "cancelled_flights", "route_disrupted_flights", "avg_departure_delay_minutes",
    "avg_arrival_delay_minutes", "on_time_departures", "on_time_arrivals",
]
_DERIVED = ["operated_flights", "operated_as_planned_flights", "departure_otp_15_pct", "arrival_otp_15_pct"]
_RATES = ["cancellation_rate", "route_disruption_rate"]

_OTP_RULES = [Rule(f"valid_{end}_otp_range", f"{end}_otp_15_pct BETWEEN 0 AND 1") for end in ("departure", "arrival")]
_COUNT_RULES = [
    Rule(f"non_negative_{name}", f"{name} >= 0")
    for name in (
        "total_flights", "cancelled_flights", "route_disrupted_flights", "operated_flights",
        "operated_as_planned_flights",
    )
]
HOURLY_RULES = [
    present("flight_date", text=False),
    Rule("valid_airport", present("departure_airport_code").check),
    Rule("valid_hour", "departure_hour BETWEEN 0 AND 23"),
    Rule("non_negative_flights", "total_flights >= 0"),
    *_OTP_RULES,
]
ROUTE_RULES = [
    *[present(c, text=False) for c in ROUTE_KEYS],
    *_COUNT_RULES,
    *_OTP_RULES,
]
DISTANCE_RULES = [present("distance_category", text=False), *_COUNT_RULES, *_OTP_RULES]


def relevant_flights(flights: DataFrame, not_null: Sequence[str] = ()) -> DataFrame:
    """Flights that left, arrived or were cancelled, with all of ``not_null`` known."""
    return flights.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in not_null], _is_relevant()))


def _is_relevant() -> Column:
    known = "actual_departure_utc_ts IS NOT NULL OR actual_arrival_utc_ts IS NOT NULL"
    return F.expr(f"{known} OR coalesce(is_cancelled, FALSE)")


def departure_hour(flights: DataFrame) -> DataFrame:
    return flights.withColumn("departure_hour", F.hour("scheduled_departure_local_ts"))


def _sums(flights: DataFrame, keys: Sequence[str], bands: bool = False) -> DataFrame:
    return kpi.flight_flags(flights).groupBy(*keys).agg(*kpi.additive_aggs(bands))


def _rolled_up(base: DataFrame, keys: Sequence[str], bands: bool = False) -> DataFrame:
    return base.groupBy(*keys).agg(*kpi.rollup_aggs(bands))


def kpi_base(current: DataFrame) -> DataFrame:
    """All sums by date, departure, arrival and hour: as many rows as there are such cells, however many flights.

    Flights that are not relevant are summed apart, so every date that has flights has rows, and replacing the rows of a
    date also clears it of flights that were relevant before.
    """
    return _sums(departure_hour(current.withColumn("is_relevant", _is_relevant())), BASE_KEYS, bands=True)


def _finish_hourly(sums: DataFrame) -> DataFrame:
    mart = kpi.derive_otp(kpi.derive_counts(kpi.derive_means(sums)))
    return mart.select(*HOURLY_KEYS, *_MEASURES, *kpi.BANDS, *_DERIVED)


def _finish_route(sums: DataFrame) -> DataFrame:
    mart = kpi.derive_rates(kpi.derive_otp(kpi.derive_counts(kpi.derive_means(sums))))
    route = route_label(F.col("departure_airport_code"), F.col("arrival_airport_code")).alias("route")
    return mart.select(*ROUTE_KEYS, *_MEASURES, route, *_DERIVED, *_RATES)


def _finish_distance(route_sums: DataFrame, airports: DataFrame, limit: int) -> DataFrame:
    """Distance depends on the route alone, so coordinates are looked up per route and day, not per flight."""
    located = with_coordinates(route_sums.where(F.col("departure_airport_code").isNotNull()), airports, limit)
    sums = _rolled_up(distances(located).where(F.col("distance_category").isNotNull()), DISTANCE_KEYS)
    mart = kpi.derive_rates(kpi.derive_otp(kpi.derive_counts(kpi.derive_means(sums))))
    return mart.select(*DISTANCE_KEYS, *_MEASURES, *_DERIVED, *_RATES)


def distances(located: DataFrame) -> DataFrame:
    """``distance_km`` and ``distance_category`` from the coordinates of both ends."""
    km = geo.distance_km(*[F.col(c) for c in ("dep_latitude", "dep_longitude", "arr_latitude", "arr_longitude")])
    return located.withColumn("distance_km", km).withColumn(
        "distance_category", geo.distance_category(F.col("distance_km"))
    )


def mart_hourly(current: DataFrame) -> DataFrame:
    sums = _sums(departure_hour(relevant_flights(current)), HOURLY_KEYS, bands=True)
    return expect_or_drop(_finish_hourly(sums), HOURLY_RULES)


def mart_route_daily(current: DataFrame) -> DataFrame:
    return expect_or_drop(_finish_route(_sums(relevant_flights(current, ROUTE_KEYS), ROUTE_KEYS)), ROUTE_RULES)


def mart_distance_daily(current: DataFrame, airports: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    sums = _sums(relevant_flights(current), ROUTE_KEYS)
    return expect_or_drop(_finish_distance(sums, airports, limit), DISTANCE_RULES)


# Table names of the marts, with their rules.
MART_RULES = {
    "departure_airport_hourly": HOURLY_RULES,
    "route_daily_performance": ROUTE_RULES,
    "airport_distance_category_daily_performance": DISTANCE_RULES,
}


def reached_dates(base: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Dates (``flight_date``) with flights from or to an airport that is new, gone or elsewhere in ``after``."""
    position = ["airport_code", "latitude", "longitude"]
    changed = snapshot_diff(before.select(*position), after.select(*position), ["airport_code"]).where("change <> 'unchanged'")
    ends = F.explode(F.array("departure_airport_code", "arrival_airport_code")).alias("airport_code")
    return base.select("flight_date", ends).distinct().join(changed, "airport_code", "left_semi").select("flight_date").distinct()


def unchecked_mart(name: str, base: DataFrame, airports: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A mart from stored ``kpi_base`` rows, before its rules; only the distance mart looks at the airports."""
    base = base.where("is_relevant")
    if name == "departure_airport_hourly":
        return _finish_hourly(_rolled_up(base, HOURLY_KEYS, bands=True))
    if name == "route_daily_performance":
        known = base.where(" AND ".join(f"{c} IS NOT NULL" for c in ROUTE_KEYS))
        return _finish_route(_rolled_up(known, ROUTE_KEYS))
    return _finish_distance(_rolled_up(base, ROUTE_KEYS), airports, limit)


def mart_from_base(name: str, base: DataFrame, airports: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A mart from stored sums; equal to the function above of that mart on the flights."""
    return expect_or_drop(unchecked_mart(name, base, airports, limit), MART_RULES[name])


def mart_rule_metrics(unchecked: dict[str, DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Passed, failed and dropped rows of every rule of every mart, for each value of ``by``."""
    counted = [
        rule_metrics(mart, MART_RULES[name], by).withColumn("mart", F.lit(name)) for name, mart in unchecked.items()
    ]
    return reduce(DataFrame.unionByName, counted).select(*by, "mart", "rule", "passed", "failed", "rows_dropped")
