import pytest

from skyops.operators.quality import (
    Rule, expect_or_drop, present, quarantine, rule_metrics,
)

RULES = [present("a"), present("b", text=False), Rule("small", "b BETWEEN 0 AND 9", "b out of range")]
DATA = [("x", 1), ("", 1), ("  ", None), (None, 50), ("y", None), ("z", 10)]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(DATA, "a string, b int")


def test_null_fails(df):
    assert [tuple(r) for r in expect_or_drop(df, RULES).collect()] == [("x", 1)]


def test_quarantine_is_the_complement(df):
    kept = expect_or_drop(df, RULES)
    bad = quarantine(df, RULES, "all", "why")
    assert bad.drop("why").unionAll(kept).exceptAll(df).count() == 0
    assert bad.count() + kept.count() == len(DATA)


def test_reasons(df):
    every = {(r.a, r.b): r.why for r in quarantine(df, RULES, "all", "why").collect()}
    first = {(r.a, r.b): r.why for r in quarantine(df, RULES, "first", "why").collect()}
    assert every[("  ", None)] == "missing_a, missing_b, b out of range"
    assert first[("  ", None)] == "missing_a"
    assert first[("z", 10)] == every[("z", 10)] == "b out of range"


def test_metrics(df):
    got = {r.rule: (r.passed, r.failed, r.rows_dropped) for r in rule_metrics(df, RULES).collect()}
    assert got == {"valid_a": (3, 3, 5), "valid_b": (4, 2, 5), "small": (2, 4, 5)}
