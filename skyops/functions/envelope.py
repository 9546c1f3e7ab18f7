"""Payload envelopes: a page holds its records either as a list or, when there is only one, as a single object."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def struct_of(paths: Mapping[str, T.DataType]) -> T.StructType:
    """The nested struct that holds the given dotted paths."""
    tree: dict = {}
    for path, kind in paths.items():
        *parents, leaf = path.split(".")
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = kind

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(name, build(kind) if isinstance(kind, dict) else kind) for name, kind in node.items()
        ])

    return build(tree)


def _wrapped(record_path: str, kind: T.DataType) -> T.StructType:
    return struct_of({record_path: kind})


def records(raw: Column, record_path: str, record: T.StructType) -> Column:
    """The page's records as an array.

    The single-object reading sits behind ``coalesce``, so it runs only for pages whose list reading gave nothing:
    a list page is parsed once. A page that is neither (malformed, empty, path absent) yields one NULL record, an empty
    list stays empty.
    """
    as_list = F.from_json(raw, _wrapped(record_path, T.ArrayType(record)))
    as_object = F.from_json(raw, _wrapped(record_path, record))
    for step in record_path.split("."):
        as_list, as_object = as_list.getField(step), as_object.getField(step)
    return F.coalesce(as_list, F.array(as_object))


def explode_records(df: DataFrame, record_path: str, record: T.StructType, into: str, raw: str = "raw_json") -> DataFrame:
    """One row per record under column ``into``; a page without records still gives one row, with a NULL record."""
    return df.select("*", F.explode_outer(records(F.col(raw), record_path, record)).alias(into))


def total_count(raw: Column, resource: str) -> Column:
    """The record total a page announces for its whole request; NULL if it announces none or no whole number."""
    number = F.get_json_object(raw, f"$.{resource}.Meta.TotalCount").try_cast("double")
    return F.when((number >= 0) & (number == F.floor(number)), number).try_cast("int")
