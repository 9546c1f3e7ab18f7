"""Left lookups of dimension columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyops.operators.skew import BROADCAST_BYTES, HOT_ROWS, hot_keys, is_small, mark_hot


def _common_type(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> T.DataType:
    """The type in which both keys are compared. Numbers are widened as Spark does; a text key meets only a text key."""
    kinds = facts.schema[fact_key].dataType, dimension.schema[dimension_key].dataType
    if kinds[0] == kinds[1]:
        return kinds[0]
    if not all(isinstance(k, T.NumericType) for k in kinds):
        raise TypeError(f"keys {fact_key} {kinds[0].simpleString()} and {dimension_key} {kinds[1].simpleString()} cannot be compared")
    nothing = [F.lit(None).cast(k) for k in kinds]
    return facts.sparkSession.range(0).select(F.coalesce(*nothing).alias("k")).schema["k"].dataType


def left_lookup(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, columns: dict[str, str], small: bool,
    hot_rows: int = HOT_ROWS, hot: DataFrame | None | str = "find",
) -> DataFrame:
    """``facts`` plus the dimension ``columns`` (source name to new name); unmatched rows keep NULLs.

    ``dimension`` has one row per key. It is broadcast when ``small``, which callers measure (``skew.is_small``). Otherwise
    the rows are joined by a shuffle, except those of hot fact keys (NULL included): these keys' dimension rows are joined
    apart, so that no task receives a hot key's facts. ``hot`` is the stored table of hot keys, in one column named like
    ``fact_key``, where a caller has it. Keys of different number types are compared in their common type.
    """
    kind = _common_type(facts, dimension, fact_key, dimension_key)
    key = f"_{dimension_key}_lookup"
    side = dimension.select(F.col(dimension_key).cast(kind).alias(key), *[F.col(c).alias(n) for c, n in columns.items()])

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, left[fact_key].cast(kind) == right[key], "left").drop(key)

    if small:
        return joined(facts, F.broadcast(side))
    if isinstance(hot, str):
        hot = hot_keys(facts, [fact_key], hot_rows)
    if hot is None:
        return joined(facts, side)
    # Each of the hot keys with its dimension row: a table as small as that of the hot keys.
    named = hot.select(F.col(fact_key).cast(kind).alias("_hot_key")).distinct()
    hot_side = side.join(named, F.col(key) == F.col("_hot_key"), "left_semi")
    marked = mark_hot(facts, [fact_key], hot, "_is_hot")
    cold = joined(marked.where("NOT _is_hot").drop("_is_hot"), side)
    apart = marked.where("_is_hot").drop("_is_hot")
    return cold.unionByName(joined(apart, F.broadcast(hot_side) if is_small(hot_side) else hot_side))


def with_coordinates(
    flights: DataFrame, airports: DataFrame, limit: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Coordinates of both ends. Codes are matched as stored: a lower-case flight code finds no airport.

    Where airports are too many to broadcast, one count over the flights finds the hot codes of both ends.
    """
    small = is_small(airports.select("airport_code", "latitude", "longitude"), limit)
    ends = {"departure": "dep", "arrival": "arr"}
    hot = None
    if not small:
        codes = F.explode(F.array(*[F.struct(F.lit(e).alias("end"), F.col(f"{e}_airport_code").alias("code")) for e in ends]))
        hot = hot_keys(flights.select(codes.alias("c")).select("c.*"), ["end", "code"], hot_rows)
    out = flights
    for end, prefix in ends.items():
        names = {"latitude": f"{prefix}_latitude", "longitude": f"{prefix}_longitude"}
        key = f"{end}_airport_code"
        own = hot.where(F.col("end") == end).select(F.col("code").alias(key)) if hot is not None else None
        out = left_lookup(out, airports, key, "airport_code", names, small, hot_rows, own)
    return out


def airport_labels(codes: DataFrame, airports: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Distinct departure airports with their names; an airport without a name is labelled by its code."""
    distinct = codes.select("departure_airport_code").distinct()
    name = {"airport_name": "airport_name"}
    small = is_small(airports.select("airport_code", "airport_name"), limit)
    # Distinct codes have no hot key.
    named = left_lookup(distinct, airports, "departure_airport_code", "airport_code", name, small, hot=None)
    label = F.concat_ws(" - ", "departure_airport_code", "airport_name")
    return named.withColumn("airport_label", label)
