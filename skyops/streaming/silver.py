"""Bronze flights to quarantine, change log, version history, current flights and mart sums.

The change log is the truth: inside each flight date every micro-batch owns one folder, so a replayed batch replaces its
own rows, and the updates of a date are found without listing those of other dates. Everything behind the log is a pure
function of it, recomputed for the flight dates that the batch touches. A flight's key contains its date, so all versions
of a flight live in one date, late and out-of-order updates need no special case, and the cost of a batch follows the few
dates it touches rather than the length of the history. No step reads a table it writes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyops.layout import Layout
from skyops.operators import cdc, flights, quality
from skyops.plans import marts
from skyops.sources import files, landing, tables

DATE = "flight_date"
# Keys that contain no date are dealt out by their hash: a batch rewrites the buckets of its keys only.
BUCKETS = 256
_BUCKET = "bucket_of_"

BRONZE = landing.bronze_schema(landing.FLIGHT_PARTITIONS)


def touched_dates(rows: DataFrame, column: str) -> list[str]:
    """Distinct dates of ``column`` as their folders name them: one entry per calendar day, whatever the rows."""
    name = F.coalesce(F.col(column).cast("string"), F.lit(tables.NO_VALUE))
    return [r[0] for r in rows.select(name).distinct().collect()]


def read_dates(spark: SparkSession, path: str, schema: T.StructType, column: str, dates: list[str]) -> DataFrame:
    """Rows of a table partitioned by a date column, for the given dates. Only their folders are listed."""
    folders = [f"{path}/{column}={day}" for day in dates]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)


def _query_id(spark: SparkSession) -> str:
    """A query that starts over from a new checkpoint counts batches from 0 again; its id keeps it from replacing the
    folders of its predecessor."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"


def _batch_folder(spark: SparkSession, path: str, batch_id: int) -> str:
    return f"{path}/query_id={_query_id(spark)}/batch_id={batch_id}"


def scd2_apply(
    changes: DataFrame, batch_id: int, log: str, history: str, keys: Sequence[str], sequence: str,
    tie: Sequence[str] = (), track: Sequence[str] | None = None, partition: str | None = DATE, buckets: int = BUCKETS,
) -> list[str]:
    """Add a batch to the change log and bring the history partitions it touches up to date.

    ``partition`` is a date column that the key determines. Without one, log and history are dealt out over ``buckets`` buckets of
    the keys' hash, in an additional column whose name states the number; a table once written keeps its number. Returns
    the touched partitions.
    """
    spark = changes.sparkSession
    if partition is None:
        partition = f"{_BUCKET}{buckets}"
        other = [n for n in files.names(spark, log) if n.startswith(_BUCKET) and not n.startswith(f"{partition}=")]
        if other:
            raise ValueError(f"{log} is kept in other buckets: {other[0].partition('=')[0]}")
        changes = changes.withColumn(partition, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    touched = touched_dates(changes, partition)
    if not touched:
        return touched
    # Rebalanced by date: few files per date, and a date that holds most rows is split over tasks.
    owned = changes.hint("rebalance", partition).withColumns(
        {"query_id": F.lit(_query_id(spark)), "batch_id": F.lit(batch_id)}
    )
    tables.replace_partitions(owned, log, [partition, "query_id", "batch_id"])
    logged = read_dates(spark, log, changes.schema, partition, touched)
    versions = cdc.scd2_history(logged, keys, sequence, tie, track, cluster_by=[partition])
    tables.replace_partitions(versions.hint("rebalance", partition), history, [partition])
    return touched


def compact_log(spark: SparkSession, log: str, schema: T.StructType, dates: list[str] | None = None, partition: str = DATE) -> None:
    """Rewrite the log of some dates (default: all) as one folder per date instead of one per batch.

    The new folder is complete before the old ones go. If the job dies in between, rows stand in the log twice, which changes
    no history, and the next compaction removes them. Not to be run beside a batch that writes to the same dates.
    """
    folders = [f"{partition}={day}" for day in dates] if dates is not None else files.names(spark, log)
    for folder in folders:
        if not folder.startswith(f"{partition}="):
            continue
        old = [n for n in files.names(spark, f"{log}/{folder}") if n.startswith("query_id=")]
        if len(old) < 2 and all(len(files.names(spark, f"{log}/{folder}/{n}")) < 2 for n in old):
            continue
        batch = f"query_id=compacted-{uuid.uuid4().hex}/batch_id=0"
        inside = T.StructType([f for f in schema if f.name != partition])
        rows = spark.read.schema(inside).option("basePath", f"{log}/{folder}").parquet(*[f"{log}/{folder}/{n}" for n in old])
        rows.select(*inside.names).distinct().hint("rebalance").write.parquet(f"{log}/{folder}/{batch}")
        for name in old:
            files.delete(spark, f"{log}/{folder}/{name}")


def process_pages(layout: Layout) -> Callable[[DataFrame, int], None]:
    """The batch function: one parse of the pages feeds both the quarantine and the history."""

    def process(pages: DataFrame, batch_id: int) -> None:
        spark = pages.sparkSession
        staged = flights.stage_flights(pages)
        # Only invalid rows keep their page: otherwise a page of 50 flights would be stored 50 times over.
        slim = staged.withColumn("raw_json", F.when(~quality.all_pass(flights.RULES), F.col("raw_json")))
        slim = slim.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # The rules are counted on all rows on their way to the quarantine.
            passing, seen = quality.observed(slim, flights.RULES)
            folder = _batch_folder(spark, layout.silver("flight_status_quarantine"), batch_id)
            flights.quarantined_flights(passing).write.mode("overwrite").options(**tables.PAGE_TEXT_OPTIONS).parquet(folder)
            metrics = quality.observed_metrics(spark, seen, flights.RULES)
            metrics.write.mode("overwrite").parquet(_batch_folder(spark, layout.silver("flight_status_rule_metrics"), batch_id))
            touched = scd2_apply(
                flights.cdc_feed(slim), batch_id, layout.silver("flight_status_cdc_source"),
                layout.silver("flight_status_history"), [flights.KEY], flights.SEQUENCE, flights.TIE,
            )
        finally:
            slim.unpersist()
        if touched:
            refresh_current(spark, layout, touched)
            days = spark.createDataFrame([(day,) for day in touched], f"{DATE} string").coalesce(1)
            days.write.mode("overwrite").parquet(_batch_folder(spark, layout.gold("touched_dates"), batch_id))

    return process


def kpi_base_schema(spark: SparkSession) -> T.StructType:
    return marts.kpi_base(spark.createDataFrame([], flights.HISTORY_SCHEMA)).schema


def refresh_current(spark: SparkSession, layout: Layout, dates: list[str]) -> None:
    """Current flights and their mart sums for some dates."""
    schema = flights.HISTORY_SCHEMA
    history = read_dates(spark, layout.silver("flight_status_history"), schema, DATE, dates)
    tables.replace_partitions(cdc.current_of(history), layout.silver("flight_status_current"), [DATE])
    current = read_dates(spark, layout.silver("flight_status_current"), schema, DATE, dates)
    tables.replace_partitions(marts.kpi_base(current).hint("rebalance", DATE), layout.gold("kpi_base"), [DATE])


def update_flights(spark: SparkSession, layout: Layout, options: Mapping[str, str | int] | None = None):
    """Process the bronze pages that are new since the last call; None where no page has reached bronze yet."""
    if not tables.exists(spark, layout.bronze("flight_status")):
        return None
    pages = tables.stream_table(spark, layout.bronze("flight_status"), BRONZE, options)
    writer = pages.writeStream.foreachBatch(process_pages(layout)).option("checkpointLocation", layout.checkpoint("silver_flight_status"))
    return tables.run_stream(writer)


def scd2_stream(
    changes: DataFrame, log: str, history: str, checkpoint: str, keys: Sequence[str], sequence: str,
    tie: Sequence[str] = (), track: Sequence[str] | None = None, partition: str | None = DATE, buckets: int = BUCKETS,
):
    """Keep a version history up to date with any stream of changes; ``partition`` and ``buckets`` as in ``scd2_apply``."""
    def process(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            scd2_apply(batch, batch_id, log, history, keys, sequence, tie, track, partition, buckets)
        finally:
            batch.unpersist()

    return tables.run_stream(changes.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint))
