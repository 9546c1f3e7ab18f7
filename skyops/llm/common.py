"""Helpers that several operators share: stored tables, words, sized joins."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.operators.skew import is_small
from skyops.session import workspace
from skyops.sources.files import delete

# The white space that separates words, and the letters that lower-casing touches.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Largest measured size, in bytes, of a side that an operator here broadcasts; beyond it the join is shuffled.
BROADCAST_BYTES = 24 * 1024 * 1024
# A Python step handles at most about this many bytes of text at a time (a single longer text on its own).
SLICE_BYTES = 8 * 1024 * 1024


# Removes a query's shuffle files as it ends; else they stay until the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# For each open ``scratch`` the tables written inside it.
_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``stored`` writes inside is deleted at the end, except for what is to be kept, and shuffle files go with the query that
    wrote them. A frame that reads it must not outlive the block, and none should be run twice inside."""
    _scratch.append([])
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
        for path in _scratch.pop():
            delete(spark, path)


def stored(df: DataFrame, label: str, group_bytes: int | None = None, keep: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage and survives lost executors. ``group_bytes`` bounds the
    row groups, which writers and readers hold whole; ``keep``: also after the ``scratch`` around it."""
    path = workspace(df.sparkSession, label)
    if _scratch and not keep:
        _scratch[-1].append(path)
    (df.write.option("parquet.block.size", group_bytes) if group_bytes else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its measured size (flat columns) allows it, else as it is."""
    return F.broadcast(df) if is_small(df, limit) else df


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for a null or blank one."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(F.length(body) == 0, F.array().cast("array<string>")).otherwise(F.split(body, SPACE_RUN))


def text_hash(text: Column) -> Column:
    """Tells texts apart that share an id; null and empty differ."""
    return F.xxhash64(F.lit(1), text)


def _slices(batch: pa.RecordBatch, sizes: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    upto, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < batch.num_rows:
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of text, so memory doesn't depend on the batch size."""
    yield from _slices(batch, np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)), limit)


def list_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` values of a list column."""
    yield from _slices(batch, np.asarray(pc.fill_null(pc.list_value_length(batch.column(column)), 0)), limit)


def split_words(texts: pa.Array, lower: bool) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in one array, and for each text where its words begin (one more entry at the end)."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    offsets, words = np.asarray(lists.offsets), lists.values
    offsets = offsets - offsets[0]
    words = lists.flatten()
    real = np.asarray(pc.not_equal(words, ""))
    kept = np.concatenate(([0], np.cumsum(real)))
    return words.filter(pa.array(real)), kept[offsets]


def hash_texts(texts: pa.Array, seed: int) -> np.ndarray:
    """Unsigned XXH64 of the UTF-8 bytes of each text."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1].tolist()
    data = (texts.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(data[a:b], seed) for a, b in zip(offsets, offsets[1:])), np.uint64, len(texts))
