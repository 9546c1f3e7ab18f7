"""Flight status pages to staged flights: flatten, parse times, derive keys, delays, flags and request context.

Row-wise only (no shuffle); the same functions serve batch and stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyops.functions import envelope, text, times
from skyops.operators.cdc import END, START
from skyops.operators.quality import Rule, expect_or_drop, present, quarantine

# Where the records sit in a page, and the flat name of every record field read.
RESOURCE = "FlightStatusResource"
RECORD_PATH = "FlightStatusResource.Flights.Flight"
FIELDS = {
    "operating_airline_id": "OperatingCarrier.AirlineID",
    "operating_flight_number": "OperatingCarrier.FlightNumber",
    "marketing_airline_id": "MarketingCarrier.AirlineID",
    "marketing_flight_number": "MarketingCarrier.FlightNumber",
    "departure_airport_code": "Departure.AirportCode",
    "arrival_airport_code": "Arrival.AirportCode",
    "scheduled_departure_local_raw": "Departure.ScheduledTimeLocal.DateTime",
    "scheduled_departure_utc_raw": "Departure.ScheduledTimeUTC.DateTime",
    "actual_departure_local_raw": "Departure.ActualTimeLocal.DateTime",
    "actual_departure_utc_raw": "Departure.ActualTimeUTC.DateTime",
    "scheduled_arrival_local_raw": "Arrival.ScheduledTimeLocal.DateTime",
    "scheduled_arrival_utc_raw": "Arrival.ScheduledTimeUTC.DateTime",
    "actual_arrival_local_raw": "Arrival.ActualTimeLocal.DateTime",
    "actual_arrival_utc_raw": "Arrival.ActualTimeUTC.DateTime",
    "departure_time_status_code": "Departure.TimeStatus.Code",
    "departure_time_status_definition": "Departure.TimeStatus.Definition",
    "departure_terminal_name": "Departure.Terminal.Name",
    "departure_gate": "Departure.Terminal.Gate",
    "arrival_time_status_code": "Arrival.TimeStatus.Code",
    "arrival_time_status_definition": "Arrival.TimeStatus.Definition",
    "aircraft_code": "Equipment.AircraftCode",
    "aircraft_registration": "Equipment.AircraftRegistration",
    "flight_status_code": "FlightStatus.Code",
    "flight_status_definition": "FlightStatus.Definition",
    "service_type": "ServiceType",
}
FLIGHT = envelope.struct_of({path: T.StringType() for path in FIELDS.values()})

# Status codes that set a flag.
STATUS_FLAGS = {"is_landed": "LD", "is_cancelled": "CD", "is_diverted": "DV", "is_rerouted": "RT"}

LINEAGE = ["run_id", "_source_file_path", "_source_file_modification_time"]
METADATA = ["raw_json", "direction", "airport", "date", "window_start", *LINEAGE]
REQUEST = {
    "requested_direction": "direction",
    "requested_airport": "airport",
    "requested_date": "date",
    "requested_window_start": "window_start",
}
KEY = "flight_instance_hash_key"
SEQUENCE = "sequence_ts"
# Of two updates of a flight with one sequence, the greater source file wins, then the greater run.
TIE = ["_source_file_path", "run_id"]

# Raw times become columns of the same name ending in _ts.
TIMES = {name: name.removesuffix("_raw") + "_ts" for name in FIELDS if name.endswith("_raw")}
STAGED = [
    KEY,
    "flight_date",
    *[TIMES.get(name, name) for name in FIELDS],
    "departure_delay_minutes",
    "arrival_delay_minutes",
    "has_missing_status",
    *STATUS_FLAGS,
    *REQUEST,
    SEQUENCE,
]
FEED = STAGED + LINEAGE

_KINDS = {
    "flight_date": T.DateType(),
    "departure_delay_minutes": T.IntegerType(),
    "arrival_delay_minutes": T.IntegerType(),
    "has_missing_status": T.BooleanType(),
    **dict.fromkeys(STATUS_FLAGS, T.BooleanType()),
    **dict.fromkeys(TIMES.values(), T.TimestampNTZType()),
    SEQUENCE: T.TimestampType(),
    "_source_file_modification_time": T.TimestampType(),
}
FEED_SCHEMA = T.StructType([T.StructField(c, _KINDS.get(c, T.StringType())) for c in FEED])
HISTORY_SCHEMA = T.StructType([*FEED_SCHEMA.fields, *[T.StructField(c, _KINDS[SEQUENCE]) for c in (START, END)]])

# A flight needs all of these; the order is that of the reasons in a quarantined row.
RULES: list[Rule] = [
    present("operating_airline_id"),
    present("operating_flight_number"),
    present("departure_airport_code"),
    present("arrival_airport_code"),
    present("scheduled_departure_utc_ts", text=False),
    present("flight_date", text=False),
]


def project_flights(pages: DataFrame) -> DataFrame:
    """One row per flight record of each page, flattened; page columns stay."""
    flights = envelope.explode_records(pages, RECORD_PATH, FLIGHT, "flight")
    return flights.select(*METADATA, *[F.col(f"flight.{path}").alias(name) for name, path in FIELDS.items()])


def parse_times(df: DataFrame) -> DataFrame:
    """The eight raw times as wall clocks: local ones as printed, UTC ones in UTC."""
    return df.withColumns({
        stamp: (times.utc_time if "_utc_" in stamp else times.local_time)(F.col(raw)) for raw, stamp in TIMES.items()
    })


def enrich_flights(df: DataFrame) -> DataFrame:
    """Flight date, delays, status flags, request context, sequence and key."""
    status = F.col("flight_status_code")
    dated = df.withColumns({
        "flight_date": times.flight_date(F.col("scheduled_departure_local_ts"), F.col("scheduled_departure_utc_ts")),
        **{
            f"{end}_delay_minutes": times.delay_minutes(F.col(f"scheduled_{end}_utc_ts"), F.col(f"actual_{end}_utc_ts"))
            for end in ("departure", "arrival")
        },
        "has_missing_status": status.isNull(),
        **{flag: F.coalesce(status == code, F.lit(False)) for flag, code in STATUS_FLAGS.items()},
        **{name: F.col(source) for name, source in REQUEST.items()},
        SEQUENCE: F.col("_source_file_modification_time"),
    })
    return dated.withColumn(KEY, flight_key())


def flight_key():
    """The arrival is not part of the key: a diverted flight stays the same flight."""
    parts = ("operating_airline_id", "operating_flight_number", "departure_airport_code", "flight_date")
    return text.instance_key(*[F.col(p) for p in parts])


def stage_flights(pages: DataFrame) -> DataFrame:
    """Bronze pages to staged flights: 39 columns plus the eight of the page."""
    return enrich_flights(parse_times(project_flights(pages))).select(*STAGED, *METADATA)


def cdc_feed(staged: DataFrame) -> DataFrame:
    """Valid flights only, with lineage but without the page text."""
    return expect_or_drop(staged, RULES).select(*FEED)


def quarantined_flights(staged: DataFrame) -> DataFrame:
    """Invalid flights with every reason and the whole page they came from."""
    bad = quarantine(staged, RULES, "all", "quarantine_reason")
    return bad.select(*METADATA, "quarantine_reason", F.current_timestamp().alias("quarantined_at"))
