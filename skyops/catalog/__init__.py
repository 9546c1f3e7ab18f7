"""All registered queries with their checking SQL."""

from skyops.catalog import audits, changes, flights, marts, reference, streams  # noqa: F401
from skyops.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
