"""How pages are written and how their files are listed."""

import os
from pathlib import Path

from skyops.session import settings, small_files
from skyops.sources import files, landing, tables

KEYS = [*landing.FLIGHT_PARTITIONS, "page"]
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def odd_pages(spark):
    """Names with every character that a folder can't have as it is, empty ones and nulls; bodies with breaks, empty and null."""
    odd = ["a b", "ä+ö", "x/y", "100%", "a=b", "{[^]}", "q?*#'\"\\:", "tab\there", ""]
    rows = [("departures", name, "2024-01-01", "w", "r", str(n), f'{{"n":\n{n}}}') for n, name in enumerate(odd)]
    rows += [("d", "FRA", None, "w", "r", page, body) for page, body in (("1/2", ""), ("é 1", None), (None, "ü"))]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (*KEYS, "body")))


def below(folder):
    return sorted(str(p.relative_to(folder)) for p in Path(folder).rglob("*") if p.is_file() and not p.name.startswith((".", "_")))


def read(spark, folder):
    got = landing.landing_batch(spark, folder, landing.FLIGHT_PARTITIONS).select("raw_json", *landing.FLIGHT_PARTITIONS, "_source_file_size")
    return sorted(map(str, got.collect()))


def test_pages_are_plain_files_named_as_spark_names_folders(spark, tmp_path, monkeypatch):
    plain, folders = f"{tmp_path}/plain", f"{tmp_path}/folders"
    landing.write_landing(odd_pages(spark), plain, landing.FLIGHT_FOLDER)
    monkeypatch.setattr(files, "local", lambda *_: None)
    landing.write_landing(odd_pages(spark), folders, landing.FLIGHT_FOLDER)
    pages = [below(f"{top}/flight_status") for top in (plain, folders)]
    assert len(pages[0]) == 12 and sorted(os.path.dirname(p) + ".json" for p in pages[1]) == pages[0]
    assert read(spark, f"{plain}/flight_status") == read(spark, f"{folders}/flight_status")
    assert not [p for p in Path(plain, "flight_status").rglob(".*") if p.is_file()]


def test_a_repeated_write_adds_no_file(spark, tmp_path):
    for _ in range(2):
        landing._write_pages(odd_pages(spark), KEYS, str(tmp_path))
    assert len(below(tmp_path)) == 12


def test_files_are_listed_in_a_bounded_number_of_tasks(spark, tmp_path):
    for n in range(3):
        spark.range(2).write.parquet(f"{tmp_path}/in/k={n}")
    seen = []
    stream = tables.stream_table(spark, f"{tmp_path}/in", spark.range(0).schema)
    note = lambda batch, n: seen.append((spark.conf.get(LISTING), batch.count()))
    with settings(spark, {LISTING: 10_000}):
        tables.run_stream(stream.writeStream.foreachBatch(note).option("checkpointLocation", f"{tmp_path}/checkpoint"))
        assert spark.conf.get(LISTING) == "10000"
    assert seen == [(str(4 * max(8, spark.sparkContext.defaultParallelism)), 6)]


def test_settings_hold_inside_only(spark):
    before = spark.conf.get(LISTING)
    try:
        with small_files(spark):
            assert spark.conf.get(LISTING) != before
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(LISTING) == before


def test_what_was_listed_is_not_kept_in_the_driver(spark, tmp_path):
    landing.write_landing(odd_pages(spark), str(tmp_path), landing.FLIGHT_FOLDER)
    size = "spark.sql.hive.filesourcePartitionFileCacheSize"
    with small_files(spark):
        assert spark.conf.get(size) == "0"
    assert int(spark.conf.get(size)) > 0
    assert len(read(spark, f"{tmp_path}/flight_status")) == 12
