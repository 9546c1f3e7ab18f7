"""Finding keys that hold so many rows that one task must not own them, and measuring tables before a broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyops.session import workspace

# A key with more rows than this is hot: more than one task should own. The table of hot keys has at most one entry for every
# HOT_ROWS rows of the input.
HOT_ROWS = 1_000_000

# Largest measured size, in bytes, of a table that may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
# Copies of a hot key that is looked up by a shuffle: its rows are dealt out over so many tasks.
_SALTS = 64


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys (NULL included) of more than ``hot_rows`` rows, as a stored table of ``keys`` and ``rows``; None if there are
    none.

    An exact count over the key columns alone: a key's rows collapse in the map tasks, so no task sees a hot key's rows.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > hot_rows)
    path = workspace(df.sparkSession, "hot-keys")
    counted.write.parquet(path)
    stored = df.sparkSession.read.schema(counted.schema).parquet(path)
    return None if stored.isEmpty() else stored


def mark_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame, flag: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with the boolean ``flag``: is its key one of ``hot``?

    The table of hot keys is broadcast if it is small. Otherwise both sides are shuffled by key and salt, with a copy of each
    hot key per salt, so that the rows of a hot key stay spread.
    """
    renamed = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias(flag))
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    names = [f"_hot_{k}" for k in keys]
    if is_small(renamed, limit):
        joined = df.join(F.broadcast(renamed), same, "left").drop(*names)
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_hot_salt")
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)).cast("int")
        dealt = df.withColumn("_salt", salt)
        joined = dealt.join(renamed.select("*", salts), [*same, F.col("_salt") == F.col("_hot_salt")], "left")
        joined = joined.drop(*names, "_salt", "_hot_salt")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``, counted by one aggregate over it: real text lengths plus 16 bytes per value."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    width = F.lit(16 * len(df.columns)).cast("long")
    for length in text:
        width = width + length
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """May ``df`` (flat columns only) be broadcast?"""
    flat = (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    return all(isinstance(f.dataType, flat) for f in df.schema) and measured_bytes(df) <= limit
