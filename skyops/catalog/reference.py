"""Reference dimensions, from JSON pages to current tables, for each entity."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyops import fixtures
from skyops.catalog.registry import register
from skyops.operators import cdc, reference
from skyops.plans import reports
from skyops.session import workspace
from skyops.sources import tables
from skyops.specs import CODE, ENTITIES, NUMBER, EntitySpec

_FIRST, _LAST = "2024-01-01T10-05-00Z", "2024-02-01T10-05-00Z"


def _bronze(spark, sf_dir, spec: EntitySpec):
    return fixtures.reference_bronze(spark, sf_dir, spec.name)


def _staged(spark, sf_dir, spec: EntitySpec):
    return reference.stage_reference(reference.latest_run(_bronze(spark, sf_dir, spec)), spec)


def _first_state(spark, sf_dir, spec: EntitySpec):
    return reference.snapshot_valid(_bronze(spark, sf_dir, spec).where(F.col("run_id") == _FIRST), spec)


# --- checking SQL


def _cleaned_sql(spec: EntitySpec) -> str:
    clean = {CODE: "upper(trim({}))", NUMBER: "{}"}
    columns = ", ".join(f"{clean.get(kind, 'trim({})').format(c + '_raw')} AS {c}" for c, (_, kind) in spec.columns.items())
    return f"SELECT *, {columns} FROM ({fixtures.ansi_sql(spec.name + '_snapshots')}) x"


def _missing(column: str) -> str:
    return f"({column} IS NULL OR {column} = '')"


def _quarantine_sql(spec: EntitySpec) -> str:
    cases = " ".join(f"WHEN {_missing(c)} THEN '{c} missing or invalid'" for c in spec.required)
    raw = ", ".join(spec.raw_columns)
    return f"""
SELECT {raw}, source_file_path, run_id, CASE {cases} END AS validation_error FROM ({_cleaned_sql(spec)}) c
WHERE run_id = '{_LAST}' AND ({" OR ".join(_missing(c) for c in spec.required)})"""


def _snapshot_sql(spec: EntitySpec, run: str) -> str:
    keys, rest = ", ".join(spec.keys), [c for c in spec.columns if c not in spec.keys]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["source_file_path", *rest])
    return f"""
SELECT {", ".join(spec.columns)}, source_file_path, run_id FROM (
 SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS n FROM ({_cleaned_sql(spec)}) c
 WHERE run_id = '{run}' AND NOT ({" OR ".join(_missing(c) for c in spec.required)})) d WHERE n = 1"""


def _rounded(columns, spec: EntitySpec) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if spec.columns[c][1] == NUMBER else c for c in columns)


# --- queries


def _register_entity(spec: EntitySpec) -> None:
    lineage = ["source_file_path", "run_id"]
    columns = [*spec.columns, *lineage]
    listed = f"{_rounded(spec.columns, spec)}, {', '.join(lineage)}"
    raw = ", ".join(
        f"round({c}, 6) AS {c}" if spec.columns[c.removesuffix('_raw')][1] == NUMBER else c for c in spec.raw_columns
    )

    @register(f"SELECT {raw}, source_file_path, run_id, validation_error FROM ({_quarantine_sql(spec)}) q",
              f"ref_quarantine_{spec.name}")
    def quarantine(spark, sf_dir):
        bad = reference.quarantined_reference(_staged(spark, sf_dir, spec), spec)
        return bad.select(*spec.raw_columns, *lineage, "validation_error")

    @register(f"SELECT {listed} FROM ({_snapshot_sql(spec, _LAST)}) x", f"ref_snapshot_{spec.name}")
    def snapshot(spark, sf_dir):
        return reference.snapshot_valid(_bronze(spark, sf_dir, spec), spec).select(*columns)

    @register(f"SELECT {listed} FROM ({_snapshot_sql(spec, _LAST)}) x", f"ref_current_{spec.name}")
    def current(spark, sf_dir):
        latest = reference.snapshot_valid(_bronze(spark, sf_dir, spec), spec)
        return cdc.scd1_apply(_first_state(spark, sf_dir, spec), latest, spec.keys).select(*columns)

    @register(f"SELECT validation_error, count(*) AS rows FROM ({_quarantine_sql(spec)}) q GROUP BY 1",
              f"ref_quarantine_volume_{spec.name}")
    def volume(spark, sf_dir):
        bad = reference.quarantined_reference(_staged(spark, sf_dir, spec), spec)
        return reports.quarantine_volume(bad, "validation_error")


for _spec in ENTITIES.values():
    _register_entity(_spec)

_AIRLINES = ENTITIES["airlines"]
_KEYS = "airline_id"


@register(f"""
SELECT coalesce(a.airline_id, b.airline_id) AS airline_id,
 CASE WHEN a.airline_id IS NULL THEN 'insert' WHEN b.airline_id IS NULL THEN 'delete'
  WHEN a.airline_name IS NOT DISTINCT FROM b.airline_name AND a.airline_id_icao IS NOT DISTINCT FROM b.airline_id_icao
  THEN 'unchanged' ELSE 'update' END AS change, a.airline_name AS name_before, b.airline_name AS name_after
FROM ({_snapshot_sql(_AIRLINES, _FIRST)}) a FULL JOIN ({_snapshot_sql(_AIRLINES, _LAST)}) b ON a.airline_id = b.airline_id
""")
def snapshot_diff(spark, sf_dir):
    """Business columns only; lineage differs in every run."""
    business = list(_AIRLINES.columns)
    latest = reference.snapshot_valid(_bronze(spark, sf_dir, _AIRLINES), _AIRLINES).select(*business)
    diff = cdc.snapshot_diff(_first_state(spark, sf_dir, _AIRLINES).select(*business), latest, _AIRLINES.keys)
    return diff.select(
        _KEYS, "change", F.col("before.airline_name").alias("name_before"), F.col("after.airline_name").alias("name_after")
    )


@register(f"""
SELECT * FROM (SELECT coalesce(a.airline_id, b.airline_id) AS airline_id,
 CASE WHEN a.airline_id IS NULL THEN 'insert' WHEN b.airline_id IS NULL THEN 'delete' ELSE 'update' END AS change,
 a.airline_name AS name_before, b.airline_name AS name_after, a.airline_id_icao AS icao_before, b.airline_id_icao AS icao_after
FROM ({_snapshot_sql(_AIRLINES, _FIRST)}) a FULL JOIN ({_snapshot_sql(_AIRLINES, _LAST)}) b ON a.airline_id = b.airline_id) x
WHERE change <> 'update' OR name_before IS DISTINCT FROM name_after OR icao_before IS DISTINCT FROM icao_after
""")
def snapshot_changes(spark, sf_dir):
    """Narrow rows are compared first; whole rows are joined for changed keys only."""
    business = list(_AIRLINES.columns)
    latest = reference.snapshot_valid(_bronze(spark, sf_dir, _AIRLINES), _AIRLINES).select(*business)
    changes = cdc.snapshot_changes(_first_state(spark, sf_dir, _AIRLINES).select(*business), latest, _AIRLINES.keys)
    sides = [F.col(f"{s}.airline_{c}").alias(f"{n}_{s}") for c, n in (("name", "name"), ("id_icao", "icao")) for s in ("before", "after")]
    return changes.select(_KEYS, "change", *sides)


@register(f"""
SELECT airline_id, airline_name, airline_id_icao, source_file_path, run_id FROM ({_snapshot_sql(_AIRLINES, _LAST)}) x
""")
def scd1_snapshot(spark, sf_dir):
    """Two runs applied in turn to an empty dimension."""
    state = _first_state(spark, sf_dir, _AIRLINES).limit(0)
    for run in (_FIRST, _LAST):
        pages = _bronze(spark, sf_dir, _AIRLINES).where(F.col("run_id") == run)
        state = cdc.scd1_apply(state, reference.snapshot_valid(pages, _AIRLINES), _AIRLINES.keys)
    return state.select("airline_id", "airline_name", "airline_id_icao", "source_file_path", "run_id")


@register(f"""
SELECT run_id, source_file_path, count(*) AS records FROM ({fixtures.ansi_sql("airlines_snapshots")}) x
WHERE run_id = '{_LAST}' GROUP BY ALL
""")
def latest_run(spark, sf_dir):
    staged = _staged(spark, sf_dir, _AIRLINES)
    return staged.groupBy("run_id", "source_file_path").agg(F.count(F.lit(1)).alias("records"))


@register(f"""
SELECT run_id, source_file_path, count(*) AS records FROM ({fixtures.ansi_sql("airlines_snapshots")}) x
WHERE run_id = '{_LAST}' GROUP BY ALL
""")
def latest_run_by_name(spark, sf_dir):
    """Pages stored by run: the latest one is known from the names of the files."""
    path = workspace(spark, "pages-by-run")
    pages = _bronze(spark, sf_dir, _AIRLINES)
    pages.write.partitionBy("run_id").parquet(path)
    stored = spark.read.schema(pages.schema).parquet(path)
    run = reference.latest_run(stored, tables.partition_values(spark, path, "run_id"))
    staged = reference.stage_reference(run, _AIRLINES)
    return staged.groupBy("run_id", "source_file_path").agg(F.count(F.lit(1)).alias("records"))
