"""Named quality rules: drop, count, quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A row passes when ``check`` (a SQL predicate) is TRUE; NULL fails, as in WHERE."""

    name: str
    check: str
    reason: str = ""


def present(column: str, text: bool = True, reason: str | None = None) -> Rule:
    """The column is known and, for text, not blank."""
    check = f"{column} IS NOT NULL" + (f" AND TRIM({column}) <> ''" if text else "")
    return Rule(f"valid_{column}", check, reason if reason is not None else f"missing_{column}")


def passes(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.check), F.lit(False))


def all_pass(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [passes(r) for r in rules])


def expect_or_drop(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every rule. The predicates are applied bare, so that a scan below can use them."""
    return df.where(" AND ".join(f"({r.check})" for r in rules))


def _counts(rules: Sequence[Rule]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~all_pass(rules)).alias("dropped"),
        *[F.count_if(passes(r)).alias(r.name) for r in rules],
    ]


def rule_metrics(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """One row per rule (and value of ``by``): passed and failed rows, and the rows dropped by all rules together. One pass over
    ``df``."""
    names = [F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("passed")) for r in rules]
    return (
        df.groupBy(*by).agg(*_counts(rules))
        .select(*by, "rows", "dropped", F.inline(F.array(*names)))
        .select(*by, "rule", "passed", (F.col("rows") - F.col("passed")).alias("failed"), F.col("dropped").alias("rows_dropped"))
    )


def observed(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """``df`` and what ``observed_metrics`` will read: the rules are counted while the rows of ``df`` pass to some output."""
    seen = Observation()
    return df.observe(seen, *_counts(rules)), seen


def observed_metrics(spark: SparkSession, seen: Observation, rules: Sequence[Rule]) -> DataFrame:
    """The rows of ``rule_metrics`` once that output has been written. No job reads the data again."""
    counted = seen.get
    rows = [(r.name, counted[r.name], counted["rows"] - counted[r.name], counted["dropped"]) for r in rules]
    return spark.createDataFrame(rows, "rule string, passed long, failed long, rows_dropped long")


def reasons(rules: Sequence[Rule], mode: str) -> Column:
    """Why a row fails: ``all`` reasons joined in rule order, or only the ``first``."""
    failed = [F.when(~passes(r), F.lit(r.reason)) for r in rules]
    return F.concat_ws(", ", *failed) if mode == "all" else F.coalesce(*failed)


def quarantine(df: DataFrame, rules: Sequence[Rule], mode: str, reason_column: str) -> DataFrame:
    """Exactly the rows that ``expect_or_drop`` leaves out, with the reason."""
    return df.where(~all_pass(rules)).withColumn(reason_column, reasons(rules, mode))
