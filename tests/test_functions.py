import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from skyops.functions import envelope, geo, kpi, text, times
from skyops.operators import flights, reference
from skyops.specs import AIRPORTS, CITIES, ENTITIES


def rows(df):
    return [tuple(r) for r in df.collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("zone_name", ["UTC", "America/New_York", "Asia/Beirut"])
def test_time_parse_does_not_depend_on_the_session_zone(spark, zone, zone_name):
    zone(zone_name)
    cases = [
        ("2024-03-10T02:30", dt.datetime(2024, 3, 10, 2, 30), None),  # in New York's gap
        ("2024-03-31T00:30", dt.datetime(2024, 3, 31, 0, 30), None),  # in Beirut's gap
        ("2024-03-10T02:30Z", None, dt.datetime(2024, 3, 10, 2, 30)),
        ("2024-03-10T02:30+02", None, dt.datetime(2024, 3, 10, 0, 30)),
        ("2024-03-10T02:30+02:00", None, None),
        ("2024-03-10T02:30:00", None, None),
        ("2024-02-30T10:00", None, None),
        ("junk", None, None),
        ("", None, None),
        (None, None, None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, raw string")
    got = df.orderBy("i").select(
        times.local_time(F.col("raw")).cast("string").alias("l"), times.utc_time(F.col("raw")).cast("string").alias("u")
    ).collect()
    assert [(r.l, r.u) for r in got] == [(c[1] and str(c[1]), c[2] and str(c[2])) for c in cases]


@pytest.mark.parametrize("zone_name", ["UTC", "Asia/Beirut"])
def test_window_floor(spark, zone, zone_name):
    zone(zone_name)
    at = F.expr("TIMESTAMP_NTZ '2024-03-31 00:15:59.5'")
    label = [one(spark, times.window_label(times.window_floor(at, h))) for h in (0, 12, -4)]
    assert label == ["2024-03-31T00:00", "2024-03-30T12:00", "2024-03-31T04:00"]
    before_epoch = F.expr("TIMESTAMP_NTZ '1969-12-31 23:59:59'")
    assert one(spark, times.window_label(times.window_floor(before_epoch))) == "1969-12-31T20:00"


def test_delay_crosses_no_daylight_saving(spark, zone):
    zone("America/New_York")
    due, late = (F.expr(f"TIMESTAMP_NTZ '2024-03-{t}'") for t in ("10 01:00:00", "12 03:30:00"))
    assert one(spark, times.delay_minutes(due, late)) == 2 * 1440 + 150
    assert one(spark, times.delay_minutes(late, due)) == -(2 * 1440 + 150)


def test_delay_is_cut_toward_zero(spark):
    due = F.expr("TIMESTAMP_NTZ '2024-01-01 10:00:00'")
    got = [
        one(spark, times.delay_minutes(due, F.expr(f"TIMESTAMP_NTZ '2024-01-01 {t}'")))
        for t in ("09:58:30", "10:01:30", "09:59:01", "10:00:00")
    ]
    assert got == [-1, 1, 0, 0]
    assert one(spark, times.delay_minutes(due, F.lit(None).cast("timestamp_ntz"))) is None


def test_key_counts_a_missing_part_as_empty(spark):
    import hashlib

    key = text.instance_key(F.lit("XY"), F.lit(None).cast("string"), F.lit("FRA"), F.lit(dt.date(2024, 1, 2)))
    assert one(spark, key) == hashlib.sha256(b"XY||||FRA||2024-01-02").hexdigest()


def test_route_label(spark):
    assert one(spark, text.route_label(F.lit("FRA"), F.lit("MUC"))) == "FRA ->MUC"


def test_distance(spark):
    def km(*c):
        return one(spark, geo.distance_km(*[F.lit(v).cast("double") for v in c]))

    assert km(50.0, 8.0, 50.0, 8.0) == 0.0
    assert math.isclose(km(0.0, 0.0, 0.0, 180.0), math.pi * 6371.0)
    assert math.isclose(km(90.0, 0.0, -90.0, 0.0), math.pi * 6371.0)
    assert not math.isnan(km(37.1, 10.0, -37.1, -170.0))
    assert km(None, 0.0, 1.0, 1.0) is None
    bands = [one(spark, geo.distance_category(F.lit(v).cast("double"))) for v in (0, 1499.9, 1500, 3499.9, 3500, None)]
    assert bands == ["short_haul", "short_haul", "medium_haul", "medium_haul", "long_haul", None]


def test_delay_bands_partition_the_known_delays(spark):
    delays = [None, -300, -1, 0, 15, 16, 60, 61, 120, 121, 900]
    df = spark.createDataFrame([(d, False, False, None) for d in delays],
                               "departure_delay_minutes int, is_cancelled boolean, is_diverted boolean, is_rerouted boolean")
    bands = kpi.delay_buckets()
    got = kpi.flight_flags(df).select("departure_delay_minutes", *[c.cast("int").alias(n) for n, c in bands.items()]).collect()
    for r in got:
        assert sum(r[n] for n in bands) == (0 if r.departure_delay_minutes is None else 1)
    names = [next((n for n in bands if r[n]), None) for r in got]
    assert names == [
        None, "early_departures", "early_departures", "on_time_0_15_departures", "on_time_0_15_departures",
        "delay_15_60_departures", "delay_15_60_departures", "delay_60_120_departures", "delay_60_120_departures",
        "delay_120_plus_departures", "delay_120_plus_departures",
    ]


# --- envelopes

AIRPORT = '{"AirportCode":" fra ","Names":{"Name":{"@LanguageCode":"en","$":" Frankfurt"}},"CityCode":"fra","CountryCode":"de",' \
          '"Position":{"Coordinate":{"Latitude":50.1,"Longitude":8.5}}}'
OTHER = '{"AirportCode":"MUC","Names":{"Name":{"$":"Munich"}},"CityCode":"MUC","CountryCode":"DE"}'


def airport_page(body):
    return f'{{"AirportResource":{{"Airports":{{"Airport":{body}}},"Meta":{{"TotalCount":7}}}}}}'


def staged_airports(spark, *pages):
    df = spark.createDataFrame(
        [(p, "r1", f"f{i}", dt.datetime(2024, 1, 1)) for i, p in enumerate(pages)],
        "raw_json string, run_id string, _source_file_path string, _source_file_modification_time timestamp",
    )
    return reference.stage_reference(df, AIRPORTS)


@pytest.mark.parametrize("page, codes", [
    (airport_page(f"[{AIRPORT},{OTHER}]"), ["FRA", "MUC"]),
    (airport_page(AIRPORT), ["FRA"]),
    (airport_page("[]"), [None]),
    (airport_page("null"), [None]),
    ('{"Other":1}', [None]),
    (airport_page(AIRPORT)[:60], [None]),
    ("plain text", [None]),
    ("", [None]),
    (None, [None]),
])
def test_page_shapes(spark, page, codes):
    assert [r.airport_code for r in staged_airports(spark, page).collect()] == codes


def test_a_wrong_field_costs_only_itself(spark):
    odd_name = AIRPORT.replace('{"@LanguageCode":"en","$":" Frankfurt"}', '[{"$":"A"},{"$":"B"}]')
    odd_place = AIRPORT.replace("50.1", '"north"')
    number = OTHER.replace('"CityCode":"MUC"', '"CityCode":12')
    got = staged_airports(spark, airport_page(f"[{odd_name},{odd_place},{number}]")).collect()
    assert [(r.airport_code, r.airport_name, r.latitude, r.city_code) for r in got] == [
        ("FRA", None, 50.1, "FRA"), ("FRA", "Frankfurt", None, "FRA"), ("MUC", "Munich", None, "12"),
    ]


def test_record_total(spark):
    assert one(spark, envelope.total_count(F.lit(airport_page("[]")), "AirportResource")) == 7
    assert one(spark, envelope.total_count(F.lit("{}"), "AirportResource")) is None


def test_list_page_is_parsed_once(spark):
    """The object reading is the lazily evaluated arm of coalesce, and no later projection parses again."""
    plan = staged_airports(spark, airport_page("[]"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField") == 2 and "explode(coalesce(from_json" in plan


def test_declared_feed_schema(spark):
    pages = spark.createDataFrame([], "raw_json string, direction string, airport string, date string, window_start string,"
                                      " run_id string, _source_file_path string, _source_file_modification_time timestamp")
    staged = flights.stage_flights(pages)
    assert len(flights.STAGED) == 39 and staged.columns == flights.STAGED + flights.METADATA
    feed = flights.cdc_feed(staged)
    assert [(f.name, f.dataType) for f in feed.schema] == [(f.name, f.dataType) for f in flights.FEED_SCHEMA]


def test_quarantine_columns():
    assert CITIES.raw_columns == ["city_code_raw", "country_code_raw", "city_name_raw"]
    assert len(AIRPORTS.raw_columns) == 9
    assert set(ENTITIES) == {"airports", "airlines", "aircraft", "cities", "countries"}
