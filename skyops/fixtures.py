"""Flight-like tables derived from the supplied test tables.

Each derivation is one SQL text that both engines run, but for the words in ``_SPARK`` and ``_ANSI``. ``spark_table`` runs it
here, ``ansi_sql`` gives it to the checking engine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.functions.times import window_label
from skyops.operators import flights
from skyops.specs import ENTITIES

FLIGHTS_WIDE = """
SELECT concat('A', CAST(l_suppkey % 12 AS STRING)) AS operating_airline_id,
 concat('N', lpad(CAST(c_nationkey AS STRING), 2, '0')) AS departure_airport_code,
 concat('N', lpad(CAST(s_nationkey AS STRING), 2, '0')) AS arrival_airport_code,
 DATE '2024-01-01' + CAST(l_orderkey % 10 AS INT) AS flight_date,
 {ts} '2024-01-01 00:00:00' + INTERVAL '1' MINUTE * CAST((l_orderkey % 10) * 1440 + (l_partkey * 5 + l_linenumber * 61) % 1440 AS INT) AS scheduled_departure_local_ts,
 s AS flight_status_code,
 CASE WHEN k IN (0, 3) THEN NULL ELSE CAST((l_partkey * 7 + l_suppkey * 13 + l_linenumber * 29) % 200 AS INT) - 40 END AS departure_delay_minutes,
 CASE WHEN k IN (0, 3, 4) THEN NULL ELSE CAST((l_partkey * 11 + l_suppkey * 3 + l_linenumber * 17) % 220 AS INT) - 50 END AS arrival_delay_minutes,
 k <> 0 AND k <> 3 AS has_actual_departure, k NOT IN (0, 3, 4) AS has_actual_arrival,
 coalesce(s = 'CD', FALSE) AS is_cancelled, coalesce(s = 'DV', FALSE) AS is_diverted, coalesce(s = 'RT', FALSE) AS is_rerouted
FROM (SELECT *, (l_orderkey * 3 + l_linenumber) % 20 AS k,
  CASE (l_orderkey * 3 + l_linenumber) % 20 WHEN 0 THEN 'CD' WHEN 1 THEN 'DV' WHEN 2 THEN 'RT' WHEN 3 THEN NULL WHEN 4 THEN 'DP' ELSE 'LD' END AS s
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey JOIN {supplier} ON l_suppkey = s_suppkey) j
"""

AIRPORTS_DIM = """
SELECT concat('N', lpad(CAST(n_nationkey AS STRING), 2, '0')) AS airport_code, n_name AS airport_name,
 CAST(n_nationkey * 5 - 60 AS DOUBLE) AS latitude, CAST(n_nationkey * 7 - 80 AS DOUBLE) AS longitude
FROM {nation} WHERE n_nationkey <> 24
"""

# Record fields that no rule or key reads; they pass through unchanged.
PLAIN_FIELDS = (
    "marketing_airline_id", "marketing_flight_number", "departure_time_status_code", "departure_time_status_definition",
    "departure_terminal_name", "departure_gate", "arrival_time_status_code", "arrival_time_status_definition", "aircraft_code",
    "aircraft_registration", "flight_status_definition", "service_type",
)

FLIGHT_UPDATES = """
SELECT o_orderkey AS update_id, v AS version,
 CASE WHEN g % 41 = 0 THEN NULL WHEN g % 43 = 0 THEN '   ' ELSE concat('A', CAST(g % 12 AS STRING)) END AS operating_airline_id,
 CASE WHEN g % 47 = 0 THEN NULL ELSE CAST(g AS STRING) END AS operating_flight_number,
 concat('N', lpad(CAST(g % 25 AS STRING), 2, '0')) AS departure_airport_code,
 CASE WHEN g % 53 = 0 THEN '' ELSE concat('N', lpad(CAST((g * 7 + 3) % 25 AS STRING), 2, '0')) END AS arrival_airport_code,
 {ts} '2024-01-01 00:00:00' + INTERVAL '1' MINUTE * CAST((g % 10) * 1440 + (g * 37) % 1440 AS INT) AS scheduled_departure_utc_ts,
 CASE WHEN v = 0 OR (v = 2 AND g % 20 = 0) THEN NULL ELSE CAST((g * 7 + v * 29) % 200 AS INT) - 40 END AS departure_delay_minutes,
 CASE WHEN v < 2 OR g % 20 IN (0, 4) THEN NULL ELSE CAST((g * 11) % 220 AS INT) - 50 END AS arrival_delay_minutes,
 CASE WHEN v = 0 THEN CASE WHEN g % 5 = 0 THEN NULL ELSE 'EX' END WHEN v = 1 THEN 'DP'
  ELSE CASE g % 20 WHEN 0 THEN 'CD' WHEN 1 THEN 'DV' WHEN 2 THEN 'RT' WHEN 4 THEN 'DP' ELSE 'LD' END END AS flight_status_code,
 {ts} '2024-01-12 00:00:00' + INTERVAL '1' MINUTE * CAST(v * 240 + g % 240 AS INT) AS sequence_ts,
 CASE WHEN g % 8 = 0 THEN NULL ELSE concat('M', CAST(g % 9 AS STRING)) END AS marketing_airline_id,
 CAST(g % 1000 AS STRING) AS marketing_flight_number,
 concat('T', CAST(v AS STRING)) AS departure_time_status_code,
 CASE v WHEN 0 THEN 'No status' WHEN 1 THEN 'On time' ELSE 'Delayed' END AS departure_time_status_definition,
 CASE WHEN v > 0 THEN CAST(g % 3 + 1 AS STRING) END AS departure_terminal_name,
 CASE WHEN g % 6 <> 0 THEN concat('G', CAST(g % 60 AS STRING)) END AS departure_gate,
 concat('U', CAST(g % 4 AS STRING)) AS arrival_time_status_code, concat('arrival ', CAST(g % 4 AS STRING)) AS arrival_time_status_definition,
 CAST(g % 90 + 300 AS STRING) AS aircraft_code, concat('D-', CAST(g % 500 AS STRING)) AS aircraft_registration,
 CASE WHEN g % 5 <> 0 THEN concat('status ', CAST(v AS STRING)) END AS flight_status_definition,
 CASE WHEN g % 2 = 0 THEN 'Passenger' ELSE 'Cargo' END AS service_type
FROM (SELECT o_orderkey, CAST(o_orderkey % 3 AS INT) AS v, CAST((o_orderkey - o_orderkey % 3) / 3 AS BIGINT) AS g FROM {orders}) b
"""

# Two full runs of each dimension; run 2 adds, drops and changes keys; with blanks, and duplicates in the first. A page
# holds at most 100 records, however large the table.
DIM_SNAPSHOTS = """
SELECT r.run_id, CASE WHEN c_custkey % 97 = 0 THEN '' ELSE concat(' c', CAST(c_custkey AS STRING), ' ') END AS airline_id_raw,
 concat('ic', CAST(c_custkey AS STRING)) AS airline_id_icao_raw,
 CASE WHEN c_custkey % 89 = 0 THEN NULL WHEN r.n = 2 AND c_custkey % 7 = 0 THEN concat(c_name, ' renamed') ELSE c_name END AS airline_name_raw,
 concat('copy=', CAST(d.copy AS STRING), '/page=', CAST(CAST((c_custkey - c_custkey % 100) / 100 AS BIGINT) AS STRING), '.json') AS source_file_path
FROM {customer} {runs} {copies}
WHERE (r.n = 1 AND c_custkey % 10 <> 0 OR r.n = 2 AND c_custkey % 10 <> 1) AND (d.copy = 0 OR c_custkey % 11 = 0)
"""

AIRCRAFT_SNAPSHOTS = """
SELECT r.run_id, CASE WHEN p_partkey % 97 = 0 THEN '  ' ELSE concat('p', CAST(p_partkey AS STRING)) END AS aircraft_code_raw,
 CASE WHEN p_partkey % 83 = 0 THEN NULL ELSE concat(' ', p_name) END AS aircraft_name_raw, lower(p_brand) AS airline_equip_code_raw,
 concat('page=', CAST(CAST((p_partkey - p_partkey % 100) / 100 AS BIGINT) AS STRING), '.json') AS source_file_path
FROM {part} {runs} WHERE p_partkey % 10 <> r.n
"""

CITY_SNAPSHOTS = """
SELECT r.run_id, CASE WHEN s_suppkey % 31 = 0 THEN NULL ELSE concat('s', CAST(s_suppkey AS STRING)) END AS city_code_raw,
 CASE WHEN s_suppkey % 37 = 0 THEN '' ELSE concat('n', CAST(s_nationkey AS STRING)) END AS country_code_raw,
 CASE WHEN s_suppkey % 41 = 0 THEN ' ' ELSE concat(s_name, ' ') END AS city_name_raw,
 '+01:00' AS utc_offset_raw, concat('Zone/', CAST(s_nationkey AS STRING)) AS time_zone_id_raw,
 concat('page=', CAST(CAST((s_suppkey - s_suppkey % 100) / 100 AS BIGINT) AS STRING), '.json') AS source_file_path
FROM {supplier} {runs} WHERE s_suppkey % 10 <> r.n
"""

COUNTRY_SNAPSHOTS = """
SELECT r.run_id, concat(' k', CAST(c_custkey AS STRING)) AS country_code_raw,
 CASE WHEN c_custkey % 9 = 4 THEN '' ELSE concat(c_name, CASE WHEN r.n = 2 AND c_custkey % 4 = 0 THEN ' renamed' ELSE '' END) END AS country_name_raw,
 concat('page=', CAST(CAST((c_custkey - c_custkey % 100) / 100 AS BIGINT) AS STRING), '.json') AS source_file_path
FROM {customer} {runs} WHERE c_custkey % 10 <> r.n
"""

# The first 25 airports carry the codes that flights use. Airport 5 is alone on its page, which then holds a single object.
AIRPORT_SNAPSHOTS = """
SELECT r.run_id, CASE WHEN s_suppkey < 25 THEN concat('n', lpad(CAST(s_suppkey AS STRING), 2, '0'), ' ') ELSE concat('x', CAST(s_suppkey AS STRING)) END AS airport_code_raw,
 CASE WHEN s_suppkey % 19 = 4 THEN NULL ELSE concat(' ', s_name) END AS airport_name_raw,
 CASE WHEN s_suppkey % 23 = 7 THEN '' ELSE concat('c', CAST(s_suppkey AS STRING)) END AS city_code_raw,
 CASE WHEN s_suppkey % 29 = 9 THEN NULL ELSE concat('r', CAST(s_nationkey AS STRING)) END AS country_code_raw,
 CAST((s_suppkey % 25) * 5 - 60 AS DOUBLE) AS latitude_raw, CAST((s_suppkey % 25) * 7 - 80 AS DOUBLE) AS longitude_raw,
 'Airport' AS location_type_raw, '+01:00' AS utc_offset_raw, concat('Zone/', CAST(s_nationkey AS STRING)) AS time_zone_id_raw,
 concat('page=', CAST(CASE WHEN s_suppkey = 5 THEN 1 ELSE 2 + CAST((s_suppkey - s_suppkey % 100) / 100 AS BIGINT) END AS STRING), '.json') AS source_file_path
FROM {supplier} {runs} WHERE s_suppkey % 10 <> r.n
"""

INGEST_LOG = """
SELECT concat('run-', CAST(CAST(ts AS DATE) AS STRING)) AS run_id, CAST(CAST(ts AS DATE) AS STRING) AS log_date,
 CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'retry' WHEN 'signup' THEN 'no_data' ELSE 'success' END AS status,
 CASE event_type WHEN 'error' THEN 500 WHEN 'view' THEN 429 WHEN 'signup' THEN 404 ELSE 200 END AS http_status,
 CAST(user_id % 5 + 1 AS INT) AS attempt, CAST(event_id % 120 AS INT) AS records_total
FROM {events}
"""

LANDED_CELLS = """
SELECT departure_airport_code AS airport, window_start, count(*) AS updates FROM (
 SELECT departure_airport_code, {ts} '2024-01-01 00:00:00' + INTERVAL '1' MINUTE * CAST(m - m % 240 AS INT) AS window_start FROM (
  SELECT concat('N', lpad(CAST(g % 25 AS STRING), 2, '0')) AS departure_airport_code, (g % 10) * 1440 + (g * 37) % 1440 AS m
  FROM (SELECT CAST((o_orderkey - o_orderkey % 3) / 3 AS BIGINT) AS g FROM {orders}) a) b) c
GROUP BY departure_airport_code, window_start
"""

SQL = {
    "flights_wide": FLIGHTS_WIDE,
    "airports_dim": AIRPORTS_DIM,
    "flight_updates": FLIGHT_UPDATES,
    "airlines_snapshots": DIM_SNAPSHOTS,
    "aircraft_snapshots": AIRCRAFT_SNAPSHOTS,
    "cities_snapshots": CITY_SNAPSHOTS,
    "countries_snapshots": COUNTRY_SNAPSHOTS,
    "airports_snapshots": AIRPORT_SNAPSHOTS,
    "ingest_log": INGEST_LOG,
    "landed_cells": LANDED_CELLS,
}
# Declared schemas of the supplied tables (fixed values), so that no job has to infer them.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
    " o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


# What the engines word differently: zone-free timestamps, and rows times a fixed list.
_SPARK = {
    "ts": "TIMESTAMP_NTZ",
    "runs": "LATERAL VIEW inline(array(struct(1, '2024-01-01T10-05-00Z'), struct(2, '2024-02-01T10-05-00Z'))) r AS n, run_id",
    "copies": "LATERAL VIEW explode(array(0, 1)) d AS copy",
}
_ANSI = {
    "ts": "TIMESTAMP",
    "runs": "CROSS JOIN (SELECT 1 AS n, '2024-01-01T10-05-00Z' AS run_id UNION ALL SELECT 2, '2024-02-01T10-05-00Z') r",
    "copies": "CROSS JOIN (SELECT 0 AS copy UNION ALL SELECT 1) d",
}


def _worded(text: str, words: Mapping[str, str]) -> str:
    for word, replacement in words.items():
        text = text.replace("{" + word + "}", replacement)
    return text


def spark_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = _worded(SQL[name], _SPARK)
    used = {t: source(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def ansi_sql(name: str) -> str:
    text = _worded(SQL[name], _ANSI)
    for table in TABLES:
        text = text.replace("{" + table + "}", table)
    return text


def flights_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the marts want it: a known actual time stands where the fixture says that there is one."""
    df = spark_table(spark, sf_dir, "flights_wide")
    stamp = F.col("scheduled_departure_local_ts")
    return df.withColumns({
        f"actual_{end}_utc_ts": F.when(F.col(f"has_actual_{end}"), stamp) for end in ("departure", "arrival")
    })


# --- JSON pages


def _nested(leaves: Mapping[str, Column]) -> Column:
    """A struct column from dotted paths."""
    tree: dict = {}
    for path, leaf in leaves.items():
        *parents, last = path.split(".")
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
        node[last] = leaf

    def build(node: dict) -> Column:
        return F.struct(*[(build(v) if isinstance(v, dict) else v).alias(k) for k, v in node.items()])

    return build(tree)


def _pages(rows: DataFrame, page_keys: list[str], record: Column, order: str, record_path: str, total: Column) -> DataFrame:
    """Rows of one page (a bounded number) as its JSON ``body``; a page of one row holds an object, not a list."""
    grouped = rows.select(*page_keys, F.struct(F.col(order).alias("o"), record.alias("r")).alias("row")).groupBy(*page_keys)
    page = grouped.agg(F.transform(F.sort_array(F.collect_list("row")), lambda row: row["r"]).alias("records"))
    meta = f"{record_path.split('.')[0]}.Meta.TotalCount"
    listed = F.to_json(_nested({record_path: F.col("records"), meta: total}))
    single = F.to_json(_nested({record_path: F.col("records")[0], meta: total}))
    return page.withColumn("body", F.when(F.size("records") == 1, single).otherwise(listed)).drop("records")


def flight_record() -> Column:
    """A landed flight record from a row of ``flight_updates``; scheduled local times equal the UTC ones, actual local ones
    are an hour ahead, an arrival is due two hours after departure, and an actual time is the scheduled one plus the delay."""
    departure = F.col("scheduled_departure_utc_ts")
    arrival = F.timestamp_add("MINUTE", F.lit(120), departure)

    def text(stamp: Column, zone: str) -> Column:
        return F.concat(window_label(stamp), F.lit(zone))

    leaves = {
        "OperatingCarrier.AirlineID": F.col("operating_airline_id"),
        "OperatingCarrier.FlightNumber": F.col("operating_flight_number"),
        "FlightStatus.Code": F.col("flight_status_code"),
        "Departure.AirportCode": F.col("departure_airport_code"),
        "Arrival.AirportCode": F.col("arrival_airport_code"),
        **{flights.FIELDS[name]: F.col(name) for name in PLAIN_FIELDS},
    }
    for end, due in (("Departure", departure), ("Arrival", arrival)):
        delay = F.col(f"{end.lower()}_delay_minutes")
        happened = F.timestamp_add("MINUTE", delay, due)
        leaves[f"{end}.ScheduledTimeLocal.DateTime"] = text(due, "")
        leaves[f"{end}.ScheduledTimeUTC.DateTime"] = text(due, "Z")
        leaves[f"{end}.ActualTimeUTC.DateTime"] = text(happened, "Z")
        leaves[f"{end}.ActualTimeLocal.DateTime"] = text(F.timestamp_add("MINUTE", F.lit(60), happened), "")
    return _nested(leaves)


def flight_pages(spark: SparkSession, sf_dir: str, page_size: int = 50) -> DataFrame:
    """``flight_updates`` as landed pages: a run per version, a request per run and departure airport."""
    updates = spark_table(spark, sf_dir, "flight_updates")
    group = F.floor(F.col("update_id") / 3)
    requests = updates.withColumns({
        "airport": F.col("departure_airport_code"),
        # Within a request the flights are numbered without gaps, so a page holds page_size of them.
        "page": F.floor(group / (25 * page_size)).cast("string"),
    })
    totals = requests.groupBy("version", "airport").agg(F.count(F.lit(1)).alias("total"))
    keys = ["version", "airport", "page", "total"]
    # Three versions of 25 airports: at most 75 totals at any scale.
    pages = _pages(
        requests.join(F.broadcast(totals), ["version", "airport"]), keys, flight_record(), "update_id", flights.RECORD_PATH, F.col("total")
    )
    hour = F.lpad((F.col("version") * 4).cast("string"), 2, "0")
    return pages.select(
        "version",
        F.lit("departures").alias("direction"),
        "airport",
        F.lit("2024-01-12").alias("date"),
        F.concat(F.lit("2024-01-12T"), hour, F.lit(":00")).alias("window_start"),
        F.concat(F.lit("2024-01-12T"), hour, F.lit(":00:00Z")).alias("run_id"),
        "page",
        "body",
    )


def flight_bronze(spark: SparkSession, sf_dir: str, page_size: int = 50) -> DataFrame:
    """The same pages as bronze rows, without files."""
    pages = flight_pages(spark, sf_dir, page_size)
    folder = F.concat_ws("/", "run_id", "airport", F.concat(F.lit("page="), "page", F.lit(".json")))
    return pages.select(
        F.col("body").alias("raw_json"),
        "direction", "airport", "date", "window_start", "run_id",
        folder.alias("_source_file_path"),
        F.timestamp_add("HOUR", F.col("version") * 4, F.lit("2024-01-12 00:00:00Z").cast("timestamp")).alias(
            "_source_file_modification_time"
        ),
    )


def reference_pages(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The snapshots of an entity as landed pages, with one record total per run."""
    spec = ENTITIES[entity]
    rows = spark_table(spark, sf_dir, f"{entity}_snapshots")
    record = _nested({path: F.col(f"{c}_raw") for c, (path, _) in spec.columns.items()})
    # Two runs, so two totals at any scale.
    totals = rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("total"))
    pages = _pages(
        rows.join(F.broadcast(totals), "run_id"), ["run_id", "source_file_path", "total"], record, f"{spec.keys[0]}_raw",
        spec.record_path, F.col("total"),
    )
    return pages.select(F.substring("run_id", 1, 10).alias("date"), "run_id", "source_file_path", "body")


def reference_bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    pages = reference_pages(spark, sf_dir, entity)
    return pages.select(
        F.col("body").alias("raw_json"), "date", "run_id", F.col("source_file_path").alias("_source_file_path"),
        F.to_timestamp("date").alias("_source_file_modification_time"),
    )
