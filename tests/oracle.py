"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _rows(arrow) -> tuple[list[str], list[str], Counter]:
    names = sorted(arrow.column_names)
    arrow = arrow.select(names)
    kinds = [str(arrow.schema.field(n).type).replace("large_", "") for n in names]
    return names, kinds, Counter(zip(*[arrow.column(n).to_pylist() for n in names])) if names else Counter()


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree on column names, types and the bag of rows."""
    got_names, got_kinds, got = _rows(query(spark, sf_dir).toArrow())
    want_names, want_kinds, want = _rows(con.sql(sql).to_arrow_table())
    if got_names != want_names:
        return f"columns {got_names} vs {want_names}"
    if got_kinds != want_kinds:
        return f"types {[(n, a, b) for n, a, b in zip(got_names, got_kinds, want_kinds) if a != b]}"
    if got != want:
        return f"rows {got.total()} vs {want.total()}: extra {list((got - want).items())[:3]} missing {list((want - got).items())[:3]}"
    return None if got.total() else "no rows"
