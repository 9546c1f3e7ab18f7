"""Shared parts of the checking SQL, written for the checking engine and independent of the Spark code."""

from skyops.fixtures import ansi_sql

FLAGGED = f"""
SELECT *, NOT is_cancelled AND NOT (is_diverted OR is_rerouted) AS planned, is_diverted OR is_rerouted AS disrupted,
 has_actual_departure OR has_actual_arrival OR is_cancelled AS relevant
FROM ({ansi_sql("flights_wide")}) w
"""

_COUNTS = """
 count(*) AS total_flights, count(*) FILTER (WHERE is_cancelled) AS cancelled_flights,
 count(*) FILTER (WHERE disrupted) AS route_disrupted_flights,
 coalesce(avg(departure_delay_minutes) FILTER (WHERE planned), 0.0) AS avg_departure_delay_minutes,
 coalesce(avg(arrival_delay_minutes) FILTER (WHERE planned), 0.0) AS avg_arrival_delay_minutes,
 count(*) FILTER (WHERE planned AND departure_delay_minutes <= 15) AS on_time_departures,
 count(*) FILTER (WHERE planned AND arrival_delay_minutes <= 15) AS on_time_arrivals
"""
_BANDS = """
 count(*) FILTER (WHERE planned AND departure_delay_minutes < 0) AS early_departures,
 count(*) FILTER (WHERE planned AND departure_delay_minutes BETWEEN 0 AND 15) AS on_time_0_15_departures,
 count(*) FILTER (WHERE planned AND departure_delay_minutes > 15 AND departure_delay_minutes <= 60) AS delay_15_60_departures,
 count(*) FILTER (WHERE planned AND departure_delay_minutes > 60 AND departure_delay_minutes <= 120) AS delay_60_120_departures,
 count(*) FILTER (WHERE planned AND departure_delay_minutes > 120) AS delay_120_plus_departures
"""
_OPERATED = """*, total_flights - cancelled_flights AS operated_flights,
 total_flights - cancelled_flights - route_disrupted_flights AS operated_as_planned_flights"""
_OTP = """*, CASE WHEN operated_as_planned_flights > 0 THEN on_time_departures / operated_as_planned_flights ELSE 0.0 END AS departure_otp_15_pct,
 CASE WHEN operated_as_planned_flights > 0 THEN on_time_arrivals / operated_as_planned_flights ELSE 0.0 END AS arrival_otp_15_pct"""
_RATES = """*, CASE WHEN total_flights > 0 THEN cancelled_flights / total_flights ELSE 0.0 END AS cancellation_rate,
 CASE WHEN operated_flights > 0 THEN route_disrupted_flights / operated_flights ELSE 0.0 END AS route_disruption_rate"""
_SANE = "departure_otp_15_pct BETWEEN 0 AND 1 AND arrival_otp_15_pct BETWEEN 0 AND 1"
_NOT_NEGATIVE = """total_flights >= 0 AND cancelled_flights >= 0 AND route_disrupted_flights >= 0
 AND operated_flights >= 0 AND operated_as_planned_flights >= 0"""

KM = """2 * 6371.0 * asin(sqrt(least(1.0, power(sin((radians(a.latitude) - radians(d.latitude)) / 2), 2)
 + cos(radians(d.latitude)) * cos(radians(a.latitude)) * power(sin((radians(a.longitude) - radians(d.longitude)) / 2), 2))))"""
CATEGORY = "CASE WHEN km < 1500 THEN 'short_haul' WHEN km < 3500 THEN 'medium_haul' WHEN km >= 3500 THEN 'long_haul' END"


def hourly(flagged: str, checked: bool = True) -> str:
    rules = "flight_date IS NOT NULL AND trim(departure_airport_code) <> '' AND departure_hour BETWEEN 0 AND 23"
    return f"""
SELECT {_OTP} FROM (SELECT {_OPERATED} FROM (
 SELECT flight_date, departure_airport_code, CAST(hour(scheduled_departure_local_ts) AS INT) AS departure_hour, {_COUNTS}, {_BANDS}
 FROM ({flagged}) f WHERE relevant GROUP BY ALL) g
 WHERE {rules if checked else "TRUE"}) h
"""


def route(flagged: str, checked: bool = True) -> str:
    return f"""
SELECT * FROM (SELECT {_RATES} FROM (SELECT {_OTP} FROM (SELECT {_OPERATED} FROM (
 SELECT flight_date, departure_airport_code, arrival_airport_code,
  departure_airport_code || ' ->' || arrival_airport_code AS route, {_COUNTS}
 FROM ({flagged}) f WHERE relevant AND flight_date IS NOT NULL AND departure_airport_code IS NOT NULL
  AND arrival_airport_code IS NOT NULL GROUP BY ALL) g) h) i) j WHERE {f"{_SANE} AND {_NOT_NEGATIVE}" if checked else "TRUE"}
"""


def located(flagged: str, airports: str) -> str:
    return f"""
SELECT f.*, d.latitude AS dep_latitude, d.longitude AS dep_longitude, a.latitude AS arr_latitude, a.longitude AS arr_longitude,
 {KM} AS km
FROM ({flagged}) f LEFT JOIN ({airports}) d ON f.departure_airport_code = d.airport_code
 LEFT JOIN ({airports}) a ON f.arrival_airport_code = a.airport_code
"""


# Marts and reports need flights with both coordinates; least() ignores NULL, so the NULL test is spelled out.
_KNOWN = "dep_latitude IS NOT NULL AND dep_longitude IS NOT NULL AND arr_latitude IS NOT NULL AND arr_longitude IS NOT NULL"


def distance(flagged: str, airports: str, checked: bool = True) -> str:
    return f"""
SELECT * FROM (SELECT {_RATES} FROM (SELECT {_OTP} FROM (SELECT {_OPERATED} FROM (
 SELECT flight_date, departure_airport_code, {CATEGORY} AS distance_category, {_COUNTS}
 FROM ({located(flagged, airports)}) f WHERE relevant AND {_KNOWN} AND departure_airport_code IS NOT NULL GROUP BY ALL) g) h) i) j
WHERE {f"{_SANE} AND {_NOT_NEGATIVE}" if checked else "TRUE"}
"""


KNOWN = _KNOWN
AIRPORTS = ansi_sql("airports_dim")
HOURLY = hourly(FLAGGED)
ROUTE = route(FLAGGED)
DISTANCE = distance(FLAGGED, AIRPORTS)

_DAY = "CAST(flight_date AS VARCHAR) AS flight_date"
_MEANS = "round(avg_departure_delay_minutes, 6) AS avg_departure_delay_minutes, round(avg_arrival_delay_minutes, 6) AS avg_arrival_delay_minutes"
_OTPS = "round(departure_otp_15_pct, 6) AS departure_otp_15_pct, round(arrival_otp_15_pct, 6) AS arrival_otp_15_pct"
_RATED = "round(cancellation_rate, 6) AS cancellation_rate, round(route_disruption_rate, 6) AS route_disruption_rate"


def rounded(mart: str, rates: bool) -> str:
    """A mart with the value formats of ``comparable``."""
    return f"SELECT * REPLACE ({_DAY}, {_MEANS}, {_OTPS}{', ' + _RATED if rates else ''}) FROM ({mart}) m"


# --- flight updates

UPDATES = f"""
SELECT *, CAST(scheduled_departure_utc_ts AS DATE) AS flight_date,
 sha256(concat_ws('||', coalesce(operating_airline_id, ''), coalesce(operating_flight_number, ''),
  coalesce(departure_airport_code, ''), CAST(CAST(scheduled_departure_utc_ts AS DATE) AS VARCHAR))) AS flight_instance_hash_key,
 operating_airline_id IS NULL OR trim(operating_airline_id) = '' AS no_airline,
 operating_flight_number IS NULL OR trim(operating_flight_number) = '' AS no_number,
 arrival_airport_code IS NULL OR trim(arrival_airport_code) = '' AS no_arrival
FROM ({ansi_sql("flight_updates")}) u
"""
VALID = f"SELECT * FROM ({UPDATES}) u WHERE NOT no_airline AND NOT no_number AND NOT no_arrival"
REASON = """concat_ws(', ', CASE WHEN no_airline THEN 'missing_operating_airline_id' END,
 CASE WHEN no_number THEN 'missing_operating_flight_number' END, CASE WHEN no_arrival THEN 'missing_arrival_airport_code' END)"""
HISTORY = f"""
SELECT *, sequence_ts AS __START_AT, lead(sequence_ts) OVER (PARTITION BY flight_instance_hash_key ORDER BY sequence_ts) AS __END_AT
FROM ({VALID}) v
"""
