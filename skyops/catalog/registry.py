"""Registered queries, each beside the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded and times as text, so that two engines give equal values; the SQL does the same."""
    def one(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            return F.round(column, DIGITS).alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[one(f) for f in df.schema])


def register(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name."""
    def add(query: Query) -> Query:
        key = name or query.__name__
        assert key not in QUERIES, key
        QUERIES[key] = lambda spark, sf_dir: comparable(query(spark, sf_dir))
        if sql is not None:
            ORACLE[key] = sql.strip()
        return query

    return add
