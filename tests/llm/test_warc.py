import hashlib
import random

import pytest
from pyspark.sql import functions as F

from skyops.llm import warc
from skyops.session import workspace

SCHEMA = "page_id long, url string, html string, payload string"


def record(kind, body):
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"


def pages():
    rng = random.Random(2)
    inner = record("response", "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nbad")
    out = [(1, "http://a/", None), (2, None, ""), (3, "http://b/x\r\nWARC-Type: revisit", "é" * 49), (4, "http://b/", "é" * 50),
           (5, "u", "é" * 50), (6, "u", "é" * 49), (7, "u", inner), (8, "u", "x" * 50 + inner * 3 + "WARC/1.1\r\n"),
           (9, "u", "WARC/1.1\r\nContent-Length: 10\r\n\r\n" + "y" * 200), (10, "u", "é" * 50), (None, "u", "é" * 50), (11, "u", inner * 2),
           (12, "u", "WARC/1.1\r\n" * 40), (13, "u", "z" * 90_000 + inner), (14, "u", "z" * 90_000 + inner)]
    for i in range(20, 160):
        html = "".join(rng.choice(["ü<p>", "\r\n\r\n", "WARC/1.1\r\n", "Content-Length: 7\r\n", inner, "word "]) for _ in range(rng.randrange(60)))
        out.append((i, f"http://h{i}", html))
    return out


def planned(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    for i, _, html in rows:
        data = (html or "").encode()
        response = len(data) < 100 or data not in first or first[data] == i
        yield i, "response" if response else "revisit", None if response else first[data], len(data), hashlib.sha256(data).hexdigest(), data if response else None


@pytest.mark.parametrize("block", ["128m", "1k", "333"])
def test_round_trip(spark, block):
    rows = pages()
    path = workspace(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(*r, "") for r in rows], SCHEMA).repartition(3), path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        read = warc.read_archives(spark, path).withColumn("again", F.sha2("payload", 256)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.stated_digest, None if r.payload is None else bytes(r.payload)) for r in read]
    assert sorted(got, key=str) == sorted(planned(rows), key=str)
    assert all(r.again in (None, r.stated_digest) for r in read)
    assert {r.url for r in read if r.page_id == 3} == {"http://b/x%0D%0AWARC-Type: revisit"} and {r.url for r in read if r.page_id == 2} == {None}


def test_files_follow_the_format(spark):
    """A plain reader that goes by lengths finds the same records."""
    rows = pages()
    path = workspace(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(*r, "") for r in rows], SCHEMA).coalesce(2), path)
    found = 0
    for file in spark.read.format("binaryFile").load(path).collect():
        data, at = bytes(file.content), 0
        while at < len(data):
            head, _, _ = data[at:].partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            length = int(head.rpartition(b"Content-Length: ")[2])
            at += len(head) + 4 + length
            assert data[at : at + 4] == b"\r\n\r\n"
            at, found = at + 4, found + 1
    assert found == len(rows)


def test_damage_ends_the_chain(spark):
    path = workspace(spark, "warc-test")
    body = "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\n"
    good, wrong = record("response", body + "abc"), record("response", body + "abc").replace("Content-Length: 4", "Content-Length: 9", 1)
    spark.createDataFrame([(good + good + wrong + good,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    assert [bytes(r.payload)[:3] for r in warc.read_archives(spark, path).collect()][:2] == [b"abc"] * 2
    assert warc.read_archives(spark, path).count() == 3


def test_long_headers(spark):
    """A url of 100 KB and one of 1 MB in the middle of a file."""
    urls = {1: "http://a/", 2: "data:" + "x" * 100_000, 3: "http://c/", 4: "data:" + "y" * 1_000_000, 5: "http://e/"}
    path = workspace(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(i, u, f"page {i}", "") for i, u in urls.items()], SCHEMA).coalesce(1), path)
    got = {r.page_id: (r.url, bytes(r.payload).decode()) for r in warc.read_archives(spark, path).collect()}
    assert got == {i: (u, f"page {i}") for i, u in urls.items()}


def test_repeats_and_no_rows(spark):
    rows = [(1, "u", "r" * 200, "")] * 2 + [(2, "u", "r" * 200, "")]
    path = workspace(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path)
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_archives(spark, path).collect())
    assert got == [(1, "response", None), (1, "response", None), (2, "revisit", 1)]
    path = workspace(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).collect() == []


def test_what_a_damaged_record_leaves_belongs_to_nobody(spark):
    """The segments behind a damaged record are not gathered by the record ahead of it."""
    path = workspace(spark, "warc-test")
    body = "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    good = record("response", body)
    broken = good.replace("Content-Length", "Content-Xength")
    spark.createDataFrame([(good * 3 + broken + good * 500,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    owned = warc.record_index(warc.segments(spark, path).drop("value"))
    assert owned.groupBy("owner").count().agg(F.max("count")).first()[0] == 1
    assert [bytes(r.payload) for r in warc.read_archives(spark, path).collect()] == [b"abc"] * 3


def test_long_http_header(spark):
    path = workspace(spark, "warc-test")
    body = "HTTP/1.1 200 OK\r\nX-Länge: " + "é" * 6000 + "\r\nContent-Length: 3\r\n\r\nabc"
    text = record("response", body).replace(f"Content-Length: {len(body)}", f"Content-Length: {len(body.encode())}", 1)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    assert [(bytes(r.payload), r.payload_bytes) for r in warc.read_archives(spark, path).collect()] == [(b"abc", 3)]
