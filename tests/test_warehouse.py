"""Sources, sinks, streams and whole runs on temporary folders."""

import datetime as dt
import json
import os
import random
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyops.layout import Layout
from skyops.operators import cdc, flights, quality
from skyops.plans import marts, runs
from skyops.session import workspace
from skyops.sources import landing, logs, tables
from skyops.streaming import bronze, silver


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# --- tables


def test_replace_table_keeps_two_versions_and_ignores_a_failed_one(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.is_ready(spark, path)
    for n in (1, 2, 3):
        tables.replace_table(spark.range(n), path)
    assert tables.read_table(spark, path).count() == 3
    assert sorted(os.listdir(path)) == ["v000000000002", "v000000000003"]
    os.makedirs(f"{path}/v000000000004")
    assert tables.read_table(spark, path).count() == 3
    replaced = tables.replace_table(tables.read_table(spark, path).limit(0), path)
    assert replaced.count() == tables.read_table(spark, path).count() == 0
    assert sorted(os.listdir(path)) == ["v000000000003", "v000000000005"]


def test_replace_partitions_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.replace_partitions(spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(v, k)"), path, ["k"])
    tables.replace_partitions(spark.sql("SELECT 9 AS v, 'b' AS k"), path, ["k"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (9, "b")]


def test_workspace_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = workspace(spark, "x"), workspace(spark, "x")
    assert first != second and (base is None or first.startswith(base))


def test_log_rows(spark):
    records = spark.createDataFrame(
        [("2024-01-02T03:04:05Z", "", 5, "x"), ("", None, None, "y"), ("2024-01-02T03:04:05Z", "2020-01-01", 7, "z")],
        "timestamp_utc string, log_date string, records_total bigint, other string",
    )
    got = logs.log_rows(records, "reference_data")
    assert got.schema == logs.log_schema("reference_data")
    assert [r.log_date for r in got.collect()] == ["2024-01-02", None, "2020-01-01"]


def test_landing_twice_leaves_one_copy(spark, tmp_path):
    pages = spark.createDataFrame(
        [("departures", "FRA", "2024-01-01", "2024-01-01T04:00", "2024-01-01T04:05:06Z", str(n), '{"a":\n1}') for n in (0, 1)],
        [*landing.FLIGHT_PARTITIONS, "page", "body"],
    )
    for _ in range(2):
        landing.write_landing(pages, str(tmp_path), landing.FLIGHT_FOLDER)
    got = landing.landing_batch(spark, f"{tmp_path}/{landing.FLIGHT_FOLDER}", landing.FLIGHT_PARTITIONS).collect()
    assert len(got) == 2
    assert {(r.window_start, r.run_id, r.date) for r in got} == {("2024-01-01T04-00", "2024-01-01T04-05-06Z", "2024-01-01")}
    assert all(json.loads(r.raw_json) == {"a": 1} and r._source_file_size > 0 for r in got)
    # A page that stands as a plain file is known as well.
    plain = Path(f"{tmp_path}/x/flight_status/direction=d/airport=A/date=2024-01-01/window_start=w/run_id=r")
    plain.mkdir(parents=True)
    (plain / "page=7.json").write_text("{}")
    again = spark.createDataFrame([("d", "A", "2024-01-01", "w", "r", p, "{}") for p in "78"], [*landing.FLIGHT_PARTITIONS, "page", "body"])
    landing.write_landing(again, f"{tmp_path}/x", landing.FLIGHT_FOLDER)
    assert sorted(r.page for r in landing.landed_pages(spark, f"{tmp_path}/x/flight_status", landing.FLIGHT_PARTITIONS).collect()) == ["7", "8"]


# --- history as a stream of batches


def changes(spark, rows):
    return spark.createDataFrame(rows, "k string, flight_date date, seq timestamp_ntz, src string, v int")


def test_any_split_order_and_replay_gives_the_batch_history(spark, tmp_path):
    rnd = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (f"k{i % 23}", dt.date(2024, 1, 1 + i % 23 % 4), start + dt.timedelta(minutes=rnd.randrange(60)), rnd.choice("ab"), i)
        for i in range(200)
    ]
    expected = cdc.scd2_history(changes(spark, rows), ["k"], "seq", ["src"])
    for trial in range(2):
        rnd.shuffle(rows)
        log, history = f"{tmp_path}/log{trial}", f"{tmp_path}/history{trial}"
        parts = [rows[:30], rows[30:150], rows[150:]]
        for batch_id in (0, 1, 1, 2, 0):  # batches 1 and 0 are replayed
            silver.scd2_apply(changes(spark, parts[batch_id]), batch_id, log, history, ["k"], "seq", ["src"])
        assert same(expected, spark.read.parquet(history))


def test_history_of_any_stream(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(f"k{i % 5}", dt.date(2024, 1, 1 + i % 5), start + dt.timedelta(minutes=i), "a", i) for i in range(40)]
    source = f"{tmp_path}/in"
    for part in (rows[20:], rows[:20]):  # late ones second
        changes(spark, part).write.mode("append").parquet(source)
        stream = tables.stream_table(spark, source, changes(spark, rows).schema)
        silver.scd2_stream(stream, f"{tmp_path}/log", f"{tmp_path}/h", f"{tmp_path}/c", ["k"], "seq")
    assert same(cdc.scd2_history(changes(spark, rows), ["k"], "seq"), spark.read.parquet(f"{tmp_path}/h"))


# --- whole runs over real files in the landing layout


def flight(number, status="LD", departure="FRA", due="2024-01-01T10:00", delay=5, airline="XY", arrival="MUC"):
    def at(minutes):
        return (dt.datetime.fromisoformat(due) + dt.timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%MZ")

    departed = {"ActualTimeUTC": {"DateTime": at(delay)}} if delay is not None else {}
    return {
        "OperatingCarrier": {"AirlineID": airline, "FlightNumber": number},
        "FlightStatus": {"Code": status},
        "Departure": {"AirportCode": departure, "ScheduledTimeLocal": {"DateTime": due}, "ScheduledTimeUTC": {"DateTime": at(0)}, **departed},
        "Arrival": {"AirportCode": arrival, "ScheduledTimeUTC": {"DateTime": at(60)}},
    }


def land(layout, run, page, body, mtime, airport="FRA"):
    folder = Path(layout.landing) / "flight_status" / "direction=departures" / f"airport={airport}" / "date=2024-01-01" \
        / "window_start=2024-01-01T08-00" / f"run_id={run}"
    folder.mkdir(parents=True, exist_ok=True)
    file = folder / f"page={page}.json"
    if not isinstance(body, str):
        body = json.dumps({"FlightStatusResource": {"Flights": {"Flight": body}, "Meta": {"TotalCount": 1}}})
    file.write_text(body)
    os.utime(file, (mtime, mtime))


def land_airports(layout, run, airports, total=None):
    folder = Path(layout.landing) / "reference_data" / "airports" / "date=2024-01-01" / f"run_id={run}"
    folder.mkdir(parents=True, exist_ok=True)
    records = [
        {"AirportCode": code, "Names": {"Name": {"$": code}}, "CityCode": code, "CountryCode": "DE",
         "Position": {"Coordinate": {"Latitude": lat, "Longitude": 10.0}}} for code, lat in airports
    ]
    meta = {"TotalCount": total or len(records)}
    (folder / "page=0.json").write_text(json.dumps({"AirportResource": {"Airports": {"Airport": records}, "Meta": meta}}))


def table(spark, layout, name):
    schema = flights.HISTORY_SCHEMA if name.endswith(("history", "current")) else None
    return tables.read_table(spark, layout.silver(name), schema)


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path))


def test_operational_run_needs_airports(spark, layout):
    with pytest.raises(RuntimeError, match="airports"):
        runs.run_operational(spark, layout)


def test_flights_from_files_to_marts(spark, layout):
    land_airports(layout, "2024-01-01T00-00-00Z", [("FRA", 50.0), ("MUC", 48.0), ("LHR", 75.0)])
    runs.run_reference(spark, layout, ["airports"])

    land(layout, "r1", 0, [flight("1", "CD", delay=None), flight("2"), flight("3", airline="  "), flight("4", arrival="")], 1000)
    land(layout, "r1", 1, flight("5", arrival="LHR"), 1000)
    land(layout, "r1", 2, '{"FlightStatusResource": {"Flights"', 1000)
    land(layout, "r1", 3, [], 1000)
    first = runs.run_operational(spark, layout)
    assert sorted(r.distance_category for r in first["airport_distance_category_daily_performance"].collect()) == [
        "medium_haul", "short_haul"
    ]
    reasons = sorted(r.quarantine_reason for r in spark.read.parquet(layout.silver("flight_status_quarantine")).collect())
    nothing = ", ".join(r.reason for r in flights.RULES)
    assert reasons == sorted(["missing_operating_airline_id", "missing_arrival_airport_code", nothing, nothing])
    assert first["departure_airport_hourly"].first().total_flights == 3

    # The cancelled flight is on again and has not left: no relevant flight of that route remains but flight 2.
    land(layout, "r2", 0, [flight("1", "EX", delay=None)], 2000)
    # An update from before the first run comes late.
    land(layout, "r2", 1, [flight("2", "EX", delay=None)], 500)
    second = runs.run_operational(spark, layout)
    hourly = second["departure_airport_hourly"].first()
    assert (hourly.total_flights, hourly.cancelled_flights, hourly.departure_hour) == (2, 0, 10)

    history = table(spark, layout, "flight_status_history").orderBy("operating_flight_number", cdc.START)
    got = [(r.operating_flight_number, r.flight_status_code, r[cdc.END] is None) for r in history.collect()]
    assert got == [("1", "CD", False), ("1", "EX", True), ("2", "EX", False), ("2", "LD", True), ("5", "LD", True)]
    current = table(spark, layout, "flight_status_current")
    assert same(current, cdc.current_of(table(spark, layout, "flight_status_history")))

    # Nothing new: nothing changes.
    third = runs.run_operational(spark, layout)
    assert all(same(second[name], third[name]) for name in second)
    metrics = tables.read_table(spark, layout.gold("rule_metrics"))
    assert metrics.count() == 6 + 10 + 8 and metrics.where("failed > 0").count() == 0
    of_airports = tables.read_table(spark, layout.silver("airports_rule_metrics")).collect()
    assert [(r.passed, r.failed) for r in of_airports] == [(3, 0)] * 4
    dropped = spark.read.parquet(layout.silver("flight_status_rule_metrics")).agg(F.max("rows_dropped")).first()[0]
    assert dropped == 4


def test_a_date_without_relevant_flights_leaves_the_marts(spark, layout):
    land_airports(layout, "2024-01-01T00-00-00Z", [("FRA", 50.0), ("MUC", 48.0)])
    runs.run_reference(spark, layout, ["airports"])
    land(layout, "r1", 0, [flight("1", "CD", delay=None)], 1000)
    assert runs.run_operational(spark, layout)["departure_airport_hourly"].count() == 1
    land(layout, "r2", 0, [flight("1", "EX", delay=None)], 2000)
    assert all(m.count() == 0 for m in runs.run_operational(spark, layout).values())


def test_files_much_older_than_the_newest_are_not_skipped(spark, layout):
    for run, mtime in (("r1", 100_000_000), ("r2", 1000)):  # three years back
        land(layout, run, 0, flight("1"), mtime)
        bronze.ingest_flights(spark, layout)
        silver.update_flights(spark, layout)
    assert table(spark, layout, "flight_status_history").count() == 2


def test_first_run_with_nothing_or_only_invalid_pages(spark, layout):
    land_airports(layout, "2024-01-01T00-00-00Z", [("FRA", 50.0), ("MUC", 48.0)])
    runs.run_reference(spark, layout, ["airports"])
    for _ in range(2):  # nothing has landed, then nothing is new
        assert {n: m.count() for n, m in runs.run_operational(spark, layout).items()} == dict.fromkeys(marts.MART_RULES, 0)
    land(layout, "r1", 0, "junk", 1000)
    assert all(m.count() == 0 for m in runs.run_operational(spark, layout).values())
    land(layout, "r2", 0, flight("1"), 2000)
    first = runs.run_operational(spark, layout)
    assert first["departure_airport_hourly"].count() == 1
    again = runs.run_operational(spark, layout)
    assert all(same(first[name], again[name]) for name in first)


def test_guard_without_a_complete_run_leaves_everything(spark, layout):
    land_airports(layout, "2024-01-01T00-00-00Z", [("FRA", 50.0), ("MUC", 48.0)], total=500)
    with pytest.warns(UserWarning, match="no complete run"):
        assert runs.run_reference(spark, layout, ["airports"], guard=True) == {"airports": {}}
    plain = runs.run_reference(spark, layout, ["airports"])["airports"]["current"]
    assert plain.count() == 2
    with pytest.warns(UserWarning, match="left as they are"):
        kept = runs.run_reference(spark, layout, ["airports"], guard=True)["airports"]
    assert sorted(kept) == ["current", "quarantine", "snapshot"] and kept["current"].count() == 2


def test_small_batches_archive_and_compaction(spark, layout):
    land_airports(layout, "2024-01-01T00-00-00Z", [("FRA", 50.0), ("MUC", 48.0)])
    runs.run_reference(spark, layout, ["airports"], archive=True)
    for run in range(3):
        for page in range(4):
            land(layout, f"r{run}", page, flight(str(page), "EX" if run < 2 else "LD"), 1000 + run)
        runs.run_operational(spark, layout, {"maxFilesPerTrigger": 1}, archive=True)
    history = table(spark, layout, "flight_status_history")
    assert history.count() == 12 and cdc.current_of(history).count() == 4
    log = layout.silver("flight_status_cdc_source")
    day = "flight_date=2024-01-01"
    assert len([d for d in os.listdir(f"{log}/{day}") if d.startswith("query_id")]) >= 1
    before = silver.read_dates(spark, log, flights.FEED_SCHEMA, silver.DATE, ["2024-01-01"]).collect()
    silver.compact_log(spark, log, flights.FEED_SCHEMA)
    after = silver.read_dates(spark, log, flights.FEED_SCHEMA, silver.DATE, ["2024-01-01"]).collect()
    assert sorted(map(str, before)) == sorted(map(str, after)) and len(os.listdir(f"{log}/{day}")) == 1
    silver.compact_log(spark, log, flights.FEED_SCHEMA)  # nothing to do
    land(layout, "r9", 0, flight("0", "LD", delay=9), 5000)
    runs.run_operational(spark, layout, archive=True)
    assert table(spark, layout, "flight_status_history").count() == 13
    assert os.path.isdir(layout.archive)


def test_pages_only_invalid(spark, layout):
    land(layout, "r1", 0, "junk", 1000)
    bronze.ingest_flights(spark, layout)
    silver.update_flights(spark, layout)
    assert spark.read.parquet(layout.silver("flight_status_quarantine")).count() == 1
    assert not tables.exists(spark, layout.silver("flight_status_history"))


def test_partial_run_deletes_unless_guarded(spark, layout, tmp_path):
    land_airports(layout, "2024-01-01T00-00-00Z", [("FRA", 50.0), ("MUC", 48.0)])
    runs.run_reference(spark, layout, ["airports"])
    land_airports(layout, "2024-02-01T00-00-00Z", [("FRA", 51.0)], total=150)
    codes = lambda: sorted(
        (r.airport_code, r.latitude) for r in tables.read_table(spark, layout.silver("airports_current")).collect()
    )
    runs.run_reference(spark, layout, ["airports"], guard=True)
    assert codes() == [("FRA", 50.0), ("MUC", 48.0)]
    runs.run_reference(spark, layout, ["airports"])
    assert codes() == [("FRA", 51.0)]


def test_latest_run_reads_only_its_partition(spark, layout):
    for run in ("2024-01-01T00-00-00Z", "2024-02-01T00-00-00Z"):
        land_airports(layout, run, [("FRA", 50.0)])
    bronze.ingest_reference(spark, layout, "airports")
    from skyops.operators import reference

    pages = tables.read_table(spark, layout.bronze("airports"), landing.bronze_schema(landing.REFERENCE_PARTITIONS))
    plan = reference.latest_run(pages)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "scalar-subquery" in plan.lower().replace("subquery subquery", "scalar-subquery")

    names = tables.partition_values(spark, layout.bronze("airports"), "run_id")
    latest = reference.latest_run(pages, names)
    assert [r.run_id for r in latest.select("run_id").distinct().collect()] == ["2024-02-01T00-00-00Z"]
    assert latest.count() == reference.latest_run(pages).count() == 1
    # Files that the stream has not committed don't count, and none is opened: this one is no table file.
    stray = Path(layout.bronze("airports")) / "run_id=2025-01-01T00-00-00Z" / "part-0.parquet"
    stray.parent.mkdir()
    stray.write_text("not parquet")
    assert sorted({r.run_id for r in tables.partition_values(spark, layout.bronze("airports"), "run_id").collect()}) == [
        "2024-01-01T00-00-00Z", "2024-02-01T00-00-00Z"
    ]


def test_partition_values_open_no_file(spark, tmp_path):
    values = ["007", "10", "a+b", "é b", "x:y%41/z", None]
    spark.createDataFrame([(1, v) for v in values], "n int, run_id string").write.partitionBy("run_id").parquet(str(tmp_path / "t"))
    for file in (tmp_path / "t").rglob("*.parquet"):
        file.write_text("not parquet")
    got = [r.run_id for r in tables.partition_values(spark, str(tmp_path / "t"), "run_id").collect()]
    assert sorted(got, key=str) == sorted(values, key=str)


def test_kpi_base_covers_every_date(spark):
    from skyops import fixtures

    df = fixtures.flights_wide(spark, "/root/testdata/sf0.001")
    base = marts.kpi_base(df.withColumns({"actual_departure_utc_ts": F.lit(None).cast("timestamp_ntz"),
                                          "actual_arrival_utc_ts": F.lit(None).cast("timestamp_ntz"),
                                          "is_cancelled": F.lit(False)}))
    assert base.where("is_relevant").count() == 0
    assert base.select("flight_date").distinct().count() == df.select("flight_date").distinct().count()


# --- landing with an archive, buckets, marts by date, counts on the way


def landing_pages(spark, numbers, date="2024-01-01"):
    rows = [("departures", "FRA", date, "2024-01-01T04-00", "r", str(n), json.dumps({"n": n})) for n in numbers]
    return spark.createDataFrame(rows, [*landing.FLIGHT_PARTITIONS, "page", "body"])


def bronze_rows(spark, layout):
    return tables.read_table(spark, layout.bronze("flight_status"), silver.BRONZE).select("raw_json").collect()


def test_landing_again_after_the_archive_took_the_files(spark, layout):
    for _ in range(3):
        landing.write_landing(landing_pages(spark, range(4)), layout.landing, landing.FLIGHT_FOLDER)
        bronze.ingest_flights(spark, layout, archive=True)
    assert len(bronze_rows(spark, layout)) == 4
    # New pages, one of them twice, on a known and on a new date.
    landing.write_landing(landing_pages(spark, [3, 4, 4]).unionByName(landing_pages(spark, [3], "2024-01-02")), layout.landing, landing.FLIGHT_FOLDER)
    bronze.ingest_flights(spark, layout, archive=True)
    assert len(bronze_rows(spark, layout)) == 6
    listed = landing.landed_manifest(spark, layout.landing, landing.FLIGHT_FOLDER, landing.FLIGHT_PARTITIONS)
    assert sorted((r.date, r.page) for r in listed.collect()) == [("2024-01-01", str(n)) for n in range(5)] + [("2024-01-02", "3")]


def test_a_writer_that_died_is_made_good(spark, layout):
    landing.write_landing(landing_pages(spark, range(3)), layout.landing, landing.FLIGHT_FOLDER)
    bronze.ingest_flights(spark, layout, archive=True)
    # The files of a second call are there, its list is not; what was read has been archived meanwhile.
    folder = Path(layout.landing) / "_landed"
    landing.write_landing(landing_pages(spark, [7]), layout.landing, landing.FLIGHT_FOLDER)
    shutil.rmtree(folder)
    (folder / "_open").mkdir(parents=True)
    (folder / "_open" / landing.FLIGHT_FOLDER).touch()
    bronze.ingest_flights(spark, layout, archive=True)
    landing.write_landing(landing_pages(spark, [0, 7, 8]), layout.landing, landing.FLIGHT_FOLDER, f"{layout.archive}{layout.landing}")
    bronze.ingest_flights(spark, layout, archive=True)
    assert len(bronze_rows(spark, layout)) == 5 and not (folder / "_open" / landing.FLIGHT_FOLDER).exists()


def test_late_files_in_archive_mode_are_not_skipped(spark, layout):
    for run, mtime in (("r1", 100_000_000), ("r2", 100_000_000 - 60 * 86_400), ("r3", 1000)):
        land(layout, run, 0, flight("1"), mtime)
        bronze.ingest_flights(spark, layout, archive=True)
    assert len(bronze_rows(spark, layout)) == 3


def test_bucketed_history_rewrites_touched_buckets_only(spark, tmp_path):
    rnd, start = random.Random(8), dt.datetime(2024, 1, 1)
    rows = [(rnd.choice([None, *map(str, range(30))]), None, start + dt.timedelta(minutes=i), "a", i) for i in range(300)]
    log, history = f"{tmp_path}/log", f"{tmp_path}/history"
    apply = lambda part, n: silver.scd2_apply(changes(spark, part), n, log, history, ["k"], "seq", partition=None, buckets=8)
    apply(rows[100:], 0)
    files_of = lambda: {p: p.stat().st_mtime_ns for p in Path(history).rglob("*.parquet")}
    before = files_of()
    touched = apply([r for r in rows[:100] if r[0] == "5"] or [("5", None, start, "a", 0)], 1)
    assert len(touched) == 1
    assert {p.parent.name for p in before.keys() - files_of().keys()} == {f"bucket_of_8={touched[0]}"}
    apply(rows[:100], 1)
    assert same(cdc.scd2_history(changes(spark, rows), ["k"], "seq"), spark.read.parquet(history).drop("bucket_of_8"))
    with pytest.raises(ValueError, match="other buckets"):
        silver.scd2_apply(changes(spark, rows), 2, log, history, ["k"], "seq", partition=None, buckets=16)


def test_marts_follow_touched_dates_and_moved_airports(spark, layout, tmp_path):
    from skyops.plans import reports

    land_airports(layout, "2024-01-01T00-00-00Z", [("FRA", 50.0), ("MUC", 48.0), ("LHR", 51.0)])
    runs.run_reference(spark, layout, ["airports"])
    due = [f"2024-01-0{d}T10:00" for d in (1, 2, 3)]
    land(layout, "r1", 0, [flight("1", due=due[0]), flight("2", due=due[1]), flight("3", due=due[2], arrival="LHR")], 1000)
    runs.run_operational(spark, layout)

    def files_of(name):
        return {str(p.parent.name) + p.name for p in Path(layout.gold(name)).rglob("*.parquet")}

    def full():
        """The same marts from nothing but the stored sums."""
        base = tables.read_table(spark, layout.gold("kpi_base"), silver.kpi_base_schema(spark))
        airports = tables.read_table(spark, layout.silver("airports_current"))
        return {name: marts.mart_from_base(name, base, airports) for name in marts.MART_RULES}

    hourly, distance = "departure_airport_hourly", "airport_distance_category_daily_performance"
    before = files_of(hourly)
    land(layout, "r2", 0, [flight("2", "EX", due=due[1], delay=None), flight("9", due=due[2])], 2000)
    second = runs.run_operational(spark, layout)
    # The second day has no relevant flight any more, the first one is untouched.
    assert {f[:22] for f in before & files_of(hourly)} == {"flight_date=2024-01-01"}
    assert not any(f.startswith("flight_date=2024-01-02") for f in files_of(hourly))
    assert all(same(second[name], mart) for name, mart in full().items())

    before = files_of(distance)
    land_airports(layout, "2024-02-01T00-00-00Z", [("FRA", 50.0), ("MUC", 48.0), ("LHR", 85.0)])
    runs.run_reference(spark, layout, ["airports"])
    third = runs.run_operational(spark, layout)
    assert {f[:22] for f in before - files_of(distance)} == {"flight_date=2024-01-03"}
    assert all(same(third[name], mart) for name, mart in full().items()) and third[distance].count() == 3
    metrics = tables.read_table(spark, layout.gold("rule_metrics"))
    assert sorted(str(r.flight_date) for r in metrics.select("flight_date").distinct().collect()) == ["2024-01-01", "2024-01-03"]
    assert os.listdir(layout.gold("touched_dates")) and not list(Path(layout.gold("touched_dates")).rglob("*.parquet"))

    view = reports.apply_filters(tables.read_table(spark, layout.gold(hourly)), dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(flight_date" in plan and view.count() == 1


def test_rules_are_counted_while_rows_pass(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (" ", 2), (None, None), ("b", None)], "code string, n int")
    rules = [quality.present("code"), quality.present("n", text=False)]
    passing, seen = quality.observed(df, rules)
    quality.quarantine(passing, rules, "all", "why").write.parquet(f"{tmp_path}/bad")
    assert seen.get == {"rows": 4, "dropped": 3, "valid_code": 2, "valid_n": 2}
    assert same(quality.observed_metrics(spark, seen, rules), quality.rule_metrics(df, rules))
