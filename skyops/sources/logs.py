"""Ingestion logs: append-only tables partitioned by ``log_date``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Log columns, in table order, and the ones that are whole numbers.
_SHARED_HEAD = ["log_date", "run_id", "timestamp_utc", "status", "http_status", "attempt", "url", "response_text", "exception"]
_SHARED_TAIL = ["page", "offset", "file_path", "records_total", "params_json"]
_NUMBERS = {"http_status", "attempt", "page", "offset", "records_total"}
LOG_COLUMNS = {
    "flight_status": [*_SHARED_HEAD, "airport", "flight_date", "window_start", "direction", *_SHARED_TAIL],
    "reference_data": [*_SHARED_HEAD, "reference_type", "reference_date", *_SHARED_TAIL],
}


def log_schema(kind: str) -> T.StructType:
    return T.StructType([
        T.StructField(c, T.IntegerType() if c in _NUMBERS else T.StringType()) for c in LOG_COLUMNS[kind]
    ])


def log_rows(records: DataFrame, kind: str) -> DataFrame:
    """Records in the fixed log schema: a missing field is NULL, other fields are dropped, ``params`` becomes JSON text,
    and the log date is the given one or else the day of ``timestamp_utc``."""
    def field(name: str, default):
        return F.col(name) if name in records.columns else default

    nothing = F.lit(None).cast("string")
    day = F.nullif(F.substring(field("timestamp_utc", nothing), 1, 10), F.lit(""))
    derived = {
        "log_date": F.coalesce(F.nullif(field("log_date", nothing), F.lit("")), day),
        "params_json": F.to_json("params") if "params" in records.columns else nothing,
    }
    return records.select(*[
        derived.get(f.name, field(f.name, nothing)).cast(f.dataType).alias(f.name) for f in log_schema(kind)
    ])


def append_log(records: DataFrame, kind: str, path: str) -> None:
    log_rows(records, kind).write.mode("append").partitionBy("log_date").parquet(path)
