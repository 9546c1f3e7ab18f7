"""Flight flags and the measures built on them.

Measures come in two steps. ``additive`` ones (counts and sums) are plain partial aggregates: they are combined on the
map side, and a table of them can be summed again to any coarser grain. ``derived`` ones (means, ratios) are computed
from the sums at the very end. A hot airport or route therefore never sends its flights to one task, only one partial
row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The punctuality limit and the delay bands (minutes).
ON_TIME_MINUTES = 15
DELAY_BANDS = {
    "early_departures": (None, -1),
    "on_time_0_15_departures": (0, 15),
    "delay_15_60_departures": (16, 60),
    "delay_60_120_departures": (61, 120),
    "delay_120_plus_departures": (121, None),
}

COUNTS = ("total_flights", "cancelled_flights", "route_disrupted_flights", "on_time_departures", "on_time_arrivals")
DELAY_SUMS = ("departure_delay_sum", "departure_delay_n", "arrival_delay_sum", "arrival_delay_n")
BANDS = tuple(DELAY_BANDS)

# Flight columns that hold the flags below; the measures read them by name.
CANCELLED, DISRUPTED, OPERATED, PLANNED = (
    "_is_cancelled", "_is_route_disrupted", "_is_operated", "_is_operated_as_planned"
)


def flight_flags(df: DataFrame) -> DataFrame:
    """NULL-safe flags of a flight: cancelled, diverted or rerouted, operated, operated without either."""
    cancelled = "coalesce(is_cancelled, FALSE)"
    disrupted = "(coalesce(is_diverted, FALSE) OR coalesce(is_rerouted, FALSE))"
    return df.withColumns({
        CANCELLED: F.expr(cancelled),
        DISRUPTED: F.expr(disrupted),
        OPERATED: F.expr(f"NOT {cancelled}"),
        PLANNED: F.expr(f"NOT {cancelled} AND NOT {disrupted}"),
    })


def on_time(end: str, limit: int = ON_TIME_MINUTES) -> Column:
    """As planned and not later than ``limit`` at this end; an early flight is on time, one of unknown delay is not."""
    return F.expr(f"{PLANNED} AND coalesce({end}_delay_minutes <= {limit}, FALSE)")


def delay_buckets() -> dict[str, Column]:
    """One condition per departure delay band, over whole minutes; an unknown delay is in no band."""
    bands = {}
    for name, (low, high) in DELAY_BANDS.items():
        limits = [f"departure_delay_minutes {op} {v}" for op, v in ((">=", low), ("<=", high)) if v is not None]
        bands[name] = F.expr(f"{PLANNED} AND coalesce({' AND '.join(limits)}, FALSE)")
    return bands


def avg_or_zero(value: Column, condition: Column) -> Column:
    return F.coalesce(F.avg(F.when(condition, value)), F.lit(0.0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def additive_aggs(bands: bool = True) -> list[Column]:
    """Counts and sums over flight rows with their flags."""
    aggs = [
        F.expr("count(*) AS total_flights"),
        F.expr(f"count_if({CANCELLED}) AS cancelled_flights"),
        F.expr(f"count_if({DISRUPTED}) AS route_disrupted_flights"),
        F.count_if(on_time("departure")).alias("on_time_departures"),
        F.count_if(on_time("arrival")).alias("on_time_arrivals"),
    ]
    for end in ("departure", "arrival"):
        planned = f"CASE WHEN {PLANNED} THEN {end}_delay_minutes END"
        aggs += [
            F.expr(f"coalesce(sum({planned}), 0) AS {end}_delay_sum"), F.expr(f"count({planned}) AS {end}_delay_n")
        ]
    if bands:
        aggs += [F.count_if(condition).alias(name) for name, condition in delay_buckets().items()]
    return aggs


def rollup_aggs(bands: bool = True) -> list[Column]:
    """The same counts and sums over rows that already hold them at a finer grain."""
    return [F.expr(f"sum({name}) AS {name}") for name in COUNTS + DELAY_SUMS + (BANDS if bands else ())]


def derive_counts(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "operated_flights": F.expr("total_flights - cancelled_flights"),
        "operated_as_planned_flights": F.expr("total_flights - cancelled_flights - route_disrupted_flights"),
    })


def derive_means(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f"avg_{end}_delay_minutes": safe_ratio(F.col(f"{end}_delay_sum"), F.col(f"{end}_delay_n"))
        for end in ("departure", "arrival")
    })


def derive_otp(df: DataFrame) -> DataFrame:
    planned = F.col("operated_as_planned_flights")
    return df.withColumns({
        "departure_otp_15_pct": safe_ratio(F.col("on_time_departures"), planned),
        "arrival_otp_15_pct": safe_ratio(F.col("on_time_arrivals"), planned),
    })


def derive_rates(df: DataFrame) -> DataFrame:
    """Cancellations are measured against all flights, disruptions against the operated ones."""
    return df.withColumns({
        "cancellation_rate": safe_ratio(F.col("cancelled_flights"), F.col("total_flights")),
        "route_disruption_rate": safe_ratio(F.col("route_disrupted_flights"), F.col("operated_flights")),
    })
