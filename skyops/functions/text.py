"""Cleaning, keys and labels on string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators that stored keys and labels depend on.
KEY_SEPARATOR = "||"
ROUTE_SEPARATOR = " ->"


def clean_text(column: Column) -> Column:
    return F.trim(column)


def clean_code(column: Column) -> Column:
    return F.upper(F.trim(column))


def path_safe(column: Column) -> Column:
    """Colons are not portable in folder names; run ids and window starts carry dashes instead."""
    return F.translate(column, ":", "-")


def route_label(departure: Column, arrival: Column) -> Column:
    return F.concat_ws(ROUTE_SEPARATOR, departure, arrival)


def instance_key(*parts: Column) -> Column:
    """SHA-256 (hex) over the parts as text; a NULL part counts as empty text so the number of parts stays fixed."""
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
