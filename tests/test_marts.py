import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyops import fixtures
from skyops.operators import lookup
from skyops.plans import audits, marts, reports

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def flights(spark):
    return fixtures.flights_wide(spark, SF)


@pytest.fixture(scope="module")
def airports(spark):
    return fixtures.spark_table(spark, SF, "airports_dim")


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_totals_are_the_relevant_flights(flights, airports):
    relevant = marts.relevant_flights(flights)
    total = lambda m: m.agg(F.sum("total_flights")).first()[0]
    assert total(marts.mart_route_daily(flights)) <= relevant.count()
    in_hourly = marts.mart_hourly(flights).select(*marts.HOURLY_KEYS)
    kept = marts.departure_hour(relevant).join(in_hourly, list(marts.HOURLY_KEYS), "left_semi")
    assert total(marts.mart_hourly(flights)) == kept.count()


def test_buckets_sum_to_planned_flights_with_known_delay(flights):
    hourly = marts.mart_hourly(flights)
    buckets = sum((F.col(c) for c in list(reports.DELAY_CATEGORIES.values())[:5]), F.lit(0))
    planned = marts.relevant_flights(flights).where(
        "NOT (is_cancelled OR is_diverted OR is_rerouted) AND departure_delay_minutes IS NOT NULL"
    )
    assert hourly.agg(F.sum(buckets)).first()[0] == planned.count()


def test_marts_from_stored_sums_equal_direct_ones(flights, airports):
    base = marts.kpi_base(flights)
    built = {name: marts.mart_from_base(name, base, airports) for name in marts.MART_RULES}
    assert same(marts.mart_hourly(flights), built["departure_airport_hourly"])
    assert same(marts.mart_route_daily(flights), built["route_daily_performance"])
    assert same(
        marts.mart_distance_daily(flights, airports), built["airport_distance_category_daily_performance"]
    )


def test_null_hour_is_dropped_from_the_hourly_mart_only(spark):
    columns = ("flight_date date, departure_airport_code string, arrival_airport_code string, scheduled_departure_local_ts"
               " timestamp_ntz, departure_delay_minutes int, arrival_delay_minutes int, actual_departure_utc_ts timestamp_ntz,"
               " actual_arrival_utc_ts timestamp_ntz, is_cancelled boolean, is_diverted boolean, is_rerouted boolean")
    day, at = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 5)
    df = spark.createDataFrame([
        (day, "FRA", "MUC", None, 3, None, at, None, None, None, None),
        (day, "FRA", "MUC", at, 3, None, at, None, True, True, None),
        (day, " ", "MUC", at, 3, None, at, None, None, None, None),
        (day, None, "MUC", at, 3, None, at, None, None, None, None),
        (day, "FRA", "MUC", at, None, None, None, None, False, None, None),
    ], columns)
    # A cancelled and diverted flight leaves -1 as planned: its OTP is 0, the hourly mart keeps it, the route mart sums on.
    hourly = marts.mart_hourly(df).collect()
    assert [(r.departure_airport_code, r.departure_hour, r.operated_as_planned_flights) for r in hourly] == [("FRA", 5, -1)]
    route = {r.departure_airport_code: r for r in marts.mart_route_daily(df).collect()}
    assert route["FRA"].total_flights == 2 and route["FRA"].operated_as_planned_flights == 0
    assert set(route) == {"FRA", " "} and route["FRA"].route == "FRA ->MUC"


def test_lookup_without_broadcast_gives_the_same_rows(flights, airports):
    rows = flights.select("departure_airport_code", "arrival_airport_code", "flight_date").unionAll(
        flights.limit(50).select(F.lit(None).cast("string"), "arrival_airport_code", "flight_date")
    )
    expected = lookup.with_coordinates(rows, airports)
    assert "BroadcastHashJoin" in expected._jdf.queryExecution().executedPlan().toString()
    assert same(expected, lookup.with_coordinates(rows, airports, limit=0))
    assert same(expected, lookup.with_coordinates(rows, airports, limit=0, hot_rows=100))


def test_lookup_compares_numbers_in_their_common_type(spark):
    facts = spark.range(1000).select(F.lit(5).alias("k"), "id")
    dimension = spark.createDataFrame([(5, "five"), (6, "six")], "k long, name string")
    for small, hot_rows in ((True, 10), (False, 10**6), (False, 10)):
        got = lookup.left_lookup(facts, dimension, "k", "k", {"name": "name"}, small, hot_rows)
        assert got.where("name = 'five'").count() == 1000
    with pytest.raises(TypeError, match="compared"):
        lookup.left_lookup(facts, dimension, "k", "name", {"name": "n"}, False)


def test_reports_are_in_order(flights, airports):
    """By value, greatest first, then by name."""
    hourly, routes = marts.mart_hourly(flights), marts.mart_route_daily(flights)
    for report, source, key, k in (
        (reports.busiest_airports, hourly, "departure_airport_code", None), (reports.airport_mean_delay, hourly, "departure_airport_code", None),
        (reports.airport_cancel_rate, hourly, "departure_airport_code", None), (reports.airport_otp, hourly, "departure_airport_code", None),
        (reports.peak_delay_hours, hourly, "departure_hour", None), (reports.top_routes_delay, routes, "route", 10),
        (reports.top_routes_otp, routes, "route", 10), (reports.top_routes_volume, routes, "route", 10),
        (reports.top_routes_cancellation, routes, "route", 10),
    ):
        rows = [tuple(r) for r in report(source).collect()]
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0])) and len(rows) == (k or len(rows)) > 0
        if k:
            every = [tuple(r) for r in report(source, 10**6).collect()]
            assert rows == sorted(every, key=lambda r: (-r[1], r[0]))[:k]


def test_filters(flights):
    hourly = marts.mart_hourly(flights)
    day = dt.date(2024, 1, 3)
    got = reports.apply_filters(hourly, day, day, ["N01"]).select("flight_date", "departure_airport_code").distinct().collect()
    assert [tuple(r) for r in got] == [(day, "N01")]
    assert same(reports.apply_filters(hourly), hourly)


def test_completeness(spark):
    page = lambda n, total: (
        f'{{"X":{{"Meta":{{"TotalCount":{total}}}}}}}' if total is not None else "{}", f"/run/page={n}.json", "r"
    )
    def state(*pages):
        df = spark.createDataFrame([(*p,) for p in pages], "raw_json string, _source_file_path string, run_id string")
        return [tuple(r)[1:] for r in audits.landing_completeness(df, "X", ["run_id"], 50).collect()]

    assert state(page(0, 120), page(1, 120)) == [(2, 120, 3, False)]
    assert state(page(0, 120), page(1, 120), page(2, 120), page(2, 120)) == [(3, 120, 3, True)]
    assert state(page(0, 0)) == [(1, 0, 1, True)]
    # A total that is no whole number is unknown, and nothing breaks.
    for odd in ('"abc"', '""', "12.5", "-3", "1e300", "null", "[1]", "true"):
        assert state(page(0, odd)) == [(1, None, None, False)]
    for whole in ("12.0", '"12.0"', '" 12 "'):
        assert state(page(0, whole)) == [(1, 12, 1, True)]
    assert state(page(0, None)) == [(1, None, None, False)]


def test_request_grid(spark):
    runs = spark.createDataFrame([("FRA", dt.datetime(2024, 1, 2, 9, 15))], "airport string, run_at timestamp_ntz")
    grid = {(r.direction, r.window_start) for r in audits.request_grid(runs).collect()}
    assert len(grid) == 16
    starts = sorted(w for d, w in grid if d == "departures")
    assert (starts[0], starts[-1]) == (dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 2, 12))
    starts = sorted(w for d, w in grid if d == "arrivals")
    assert (starts[0], starts[-1]) == (dt.datetime(2024, 1, 1, 20), dt.datetime(2024, 1, 3, 0))


def test_results_do_not_depend_on_the_session_zone(spark, zone, flights):
    expected = sorted(map(tuple, marts.mart_hourly(flights).collect()))
    zone("America/New_York")
    assert sorted(map(tuple, marts.mart_hourly(fixtures.flights_wide(spark, SF)).collect())) == expected
