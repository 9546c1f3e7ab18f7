"""WARC archives: a writer that stores equal payloads once, and a reader that follows record boundaries from the file start."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyops.llm.common import sized, stored

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads below this size are always stored.
REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 50_000

_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d{1,18})[ \t]*\r?$")


def planned_records(pages: DataFrame, min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``pages`` (``page_id``, ``url``, ``html``) with the ``payload``, its size and digest, the record type and ``refers_to``.

    Only digests that occur more than once are looked up, so the join's small side has one row per group of copies; a large
    group is the rows of one join key, which adaptive execution splits.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(F.encode(payload, "UTF-8"), 256).alias("payload_digest"),
    )
    groups = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")
    )
    groups = stored(groups.where("n > 1").select(F.col("payload_digest").alias("_digest"), "first_id"), "warc-copies")
    joined = rows.join(sized(groups), F.col("payload_digest") == F.col("_digest"), "left").drop("_digest")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit("\r\n")), F.lit(""))


def write_archives(pages: DataFrame, path: str, min_bytes: int = REVISIT_BYTES) -> None:
    """One record per row of ``pages`` into WARC 1.1 files below ``path``, which any file system of Spark may hold.

    A null html is an empty payload; a null url has no target; line ends in a url are percent-encoded. Of equal payloads of
    at least ``min_bytes`` bytes the least ``page_id`` is stored (all rows that repeat that id are); the others, rows with a
    null id among them, become revisits. Smaller payloads are always stored. No pages give no records.
    """
    rows = planned_records(pages, min_bytes)
    identity = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        _field("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"),
    )
    block = F.concat(http, F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit("")))
    revisit = F.col("record_type") == "revisit"
    record = F.concat(
        F.lit(MAGIC), _field("WARC-Type", F.col("record_type")), _field("WARC-Record-ID", identity(F.col("page_id"))),
        _field("WARC-Date", F.lit(DATE)), _field("WARC-Target-URI", target),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _field("WARC-Refers-To", F.when(revisit, identity(F.col("refers_to")))),
        _field("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block,
    )
    rows.select(record.alias("value")).write.option("lineSep", RECORD_END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _head(data: pa.Buffer) -> tuple[bytes, bytes, bytes]:
    """What precedes the first blank line of a segment, the blank line (empty if there is none) and some of the rest. Reads
    further only as long as it has not been found."""
    size = 1 << 16
    while not (head := data.slice(0, min(data.size, size)).to_pybytes().partition(b"\r\n\r\n"))[1] and size < data.size:
        size *= 8
    return head


def segments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magic strings, with its place: ``file, block, seq, start, length, next, head_length, content_length, value``.

    Spark splits the files into blocks, and the magic string serves as line separator, so tasks begin anywhere in a file.
    ``start`` and ``next`` count bytes from the block's first segment. A segment that begins with a header block is a
    candidate; ``next`` is where the segment after its record would begin. Other segments have nulls there.
    """
    mark = len(MAGIC)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seq, start = None, 0, 0
        for batch in batches:
            columns: dict[str, list] = {n: [] for n in ("seq", "start", "length", "next", "head_length", "content_length")}
            for file, block, value in zip(*[batch.column(i).to_pylist() for i in range(2)], batch.column(2)):
                if at != (file, block):
                    at, seq, start = (file, block), 0, 0
                data = value.as_buffer()
                length = data.size
                head = _head(data)
                found = _LENGTH.search(head[0]) if head[1] else None
                content = int(found[1]) if found else None
                for name, x in (
                    ("seq", seq), ("start", start), ("length", length), ("head_length", len(head[0]) if found else None),
                    ("content_length", content),
                    ("next", start + len(head[0]) + 4 + content + len(RECORD_END) + mark if found else None),
                ):
                    columns[name].append(x)
                seq, start = seq + 1, start + length + mark
            made = [pa.array(x, pa.int64()) for x in columns.values()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made, batch.column(2)], ["file", "block", *columns, "value"])

    text = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )
    schema = "file string, block long, seq long, start long, length long, next long, head_length long, content_length long, value binary"
    return text.mapInArrow(run, schema)


def _exits(rows: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a block, where its chain of records leaves the block."""
    rows = rows.sort_values("start")
    at = dict(zip(rows["start"], range(len(rows))))
    starts, nexts = rows["start"].tolist(), rows["next"].tolist()
    out: list[float | None] = [None] * len(rows)
    last = starts[-1]
    for i in range(len(rows) - 1, -1, -1):
        if nexts[i] == nexts[i]:  # else not a candidate: no chain goes through it
            inside = at.get(nexts[i])
            out[i] = nexts[i] if nexts[i] > last else out[inside] if inside is not None else None
    base = rows["base"].iloc[0]
    exits = pd.DataFrame({"file": rows["file"], "entry": rows["start"] + base, "exit": out}).dropna(subset=["exit"])
    return exits.assign(exit=exits["exit"].astype("int64") + base)


def _walk(rows: pd.DataFrame) -> pd.DataFrame:
    """Marks the block's records, from the one at which the true chain enters; the segments between are their payload."""
    rows = rows.sort_values("start")
    want, owner, owners, ends = rows["entry"].iloc[0], None, [], []
    for start, after in zip(rows["start"] + rows["base"], rows["next"] + rows["base"]):
        if start == want and after == after:
            owner, want = start, after
        elif start >= want:  # behind a damaged record: nobody's
            owner = None
        owners.append(owner)
        ends.append(want if owner is not None else None)
    return pd.DataFrame({
        "file": rows["file"], "block": rows["block"], "seq": rows["seq"], "at": rows["start"] + rows["base"],
        "owner": pd.array(owners, dtype="Int64"), "end": pd.array(ends, dtype="Int64"),
    })


def record_index(segments_index: DataFrame) -> DataFrame:
    """``file, block, seq, at, owner``: each segment's byte position in the file and that of the true record it belongs to.

    Blocks emit, for each candidate, the successor at which its chain leaves the block. Pointer jumping over blocks then
    doubles its step every round, from the file start, and keeps the entries that it meets; inside a block the chain from
    the entry is walked. A magic string inside a payload may look like a record, but no chain from the file start leads to
    it. Behind a damaged record nothing is reachable. Tasks hold the index of one block; file-level windows have one row
    per block.
    """
    mark = len(MAGIC)
    ordered = Window.partitionBy("file").orderBy("block")
    blocks = segments_index.groupBy("file", "block").agg(F.sum(F.col("length") + mark).alias("bytes"))
    bases = stored(blocks.withColumn("base", F.sum("bytes").over(ordered) - F.col("bytes")), "warc-blocks")
    based = segments_index.join(bases.drop("bytes"), ["file", "block"])
    jumps = based.groupBy("file", "block").applyInPandas(_exits, "file string, entry long, exit long")
    jumps = stored(jumps, "warc-jumps")
    # The first segment of a file is what precedes its first magic string, so the chain begins at the second.
    reached = segments_index.where("block = 0 AND seq = 0").select("file", (F.col("length") + mark).alias("entry"))
    reached, steps = stored(reached, "warc-reached"), jumps
    n = None
    while n != (n := reached.count()):
        onward = reached.join(steps, ["file", "entry"]).select("file", F.col("exit").alias("entry"))
        reached = stored(reached.union(onward).distinct(), "warc-reached")
        ahead = steps.select("file", F.col("entry").alias("exit"), F.col("exit").alias("further"))
        steps = stored(steps.join(ahead, ["file", "exit"]).select("file", "entry", F.col("further").alias("exit")), "warc-jumps")
    # An entry belongs to the last block that begins at or before it and is not empty.
    entries = reached.join(bases.where("bytes > 0"), "file").where("entry >= base AND entry < base + bytes")
    # A chain enters a block once; what a file holds behind its last record may look like a second entry.
    entries = entries.groupBy("file", "block").agg(F.min("entry").alias("entry"))
    entered = based.join(entries, ["file", "block"], "left")
    walked = entered.groupBy("file", "block").applyInPandas(_walk, "file string, block long, seq long, at long, owner long, end long")
    walked = stored(walked, "warc-owners")
    # Segments ahead of a block's first record go on with the last record of earlier blocks, as far as that states its length.
    last = walked.where("owner IS NOT NULL").groupBy("file", "block").agg(F.max(F.struct("owner", "end")).alias("last"))
    last = walked.select("file", "block").distinct().join(last, ["file", "block"], "left")
    before = last.withColumn("carried", F.last("last", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
    joined = walked.join(before.select("file", "block", "carried"), ["file", "block"])
    going_on = F.when(F.col("at") < F.col("carried.end"), F.col("carried.owner"))
    return joined.select("file", "block", "seq", "at", F.coalesce("owner", going_on).alias("owner")).where("owner IS NOT NULL")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The true records of the archives below ``path``:
    ``page_id, url, record_type, refers_to, stated_digest, payload_bytes, payload`` (null for a revisit).

    ``payload_bytes`` is what the record states, which for a revisit is the size of the payload it refers to. Payloads that
    hold the magic string are put together again from their segments; only those are shuffled.
    """
    index = stored(segments(spark, path).drop("value"), "warc-index")
    owned = stored(record_index(index), "warc-records")
    parts = owned.groupBy("file", "owner").agg(F.count(F.lit(1)).alias("n"))
    whole = owned.join(parts.where("n = 1"), ["file", "owner"], "left_semi")
    keys = ["file", "block", "seq"]
    content = ["head_length", "content_length", "value"]
    records = segments(spark, path).join(sized(whole.select(*keys)), keys).select(*content)
    cut = owned.join(parts.where("n > 1"), ["file", "owner"], "left_semi")
    if not cut.isEmpty():
        pieces = segments(spark, path).join(sized(cut), keys)
        joined = pieces.groupBy("file", "owner").agg(
            F.min_by("head_length", "at").alias("head_length"), F.min_by("content_length", "at").alias("content_length"),
            F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"),
        )
        value = F.array_join(F.transform("parts", lambda p: p["value"].cast("string")), MAGIC).cast("binary")
        records = records.unionByName(joined.select("head_length", "content_length", value.alias("value")))
    return _parsed(records)


def _parsed(records: DataFrame) -> DataFrame:
    head = F.substring("value", F.lit(1), F.col("head_length").cast("int")).cast("string")
    block = F.substring("value", (F.col("head_length") + 5).cast("int"), F.col("content_length").cast("int"))
    # Bytes ahead of the HTTP header's end, plus one; 0 if it has none.
    text = F.col("block").cast("string")
    ahead = F.octet_length(F.call_function("substring_index", text, F.lit(RECORD_END), F.lit(1))) + 1
    http_end = F.when(F.contains(text, F.lit(RECORD_END)), ahead).otherwise(0)
    field = lambda name: F.nullif(F.regexp_extract("head", rf"(?im)^{name}: *([^\r\n]*)", 1), F.lit(""))
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    payload = F.substring(F.col("block"), F.col("http_end") + 4, F.octet_length("block"))
    size = F.regexp_extract(F.substring(F.col("block"), F.lit(1), F.col("http_end")).cast("string"), r"(?i)content-length: *(\d+)", 1)
    response = F.col("record_type") == "response"
    return (
        records.select(head.alias("head"), block.alias("block")).withColumn("http_end", http_end)
        .select(
            number(field("WARC-Record-ID")).alias("page_id"), field("WARC-Target-URI").alias("url"),
            F.lower(field("WARC-Type")).alias("record_type"), number(field("WARC-Refers-To")).alias("refers_to"),
            F.regexp_extract(field("WARC-Payload-Digest"), r"^sha256:([0-9a-f]{64})$", 1).alias("stated_digest"),
            size.try_cast("long").alias("payload_bytes"), payload.alias("payload"),
        )
        .withColumn("payload", F.when(response, F.col("payload")))
    )
