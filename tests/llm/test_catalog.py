"""Registered queries: against their SQL where they have one, else for whole results."""

import oracle
import pytest

import __spark_entry__ as entry
from skyops.llm import catalog

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = list(catalog.QUERIES)
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert {*names, "pipeline"} <= set(entry.queries()) and set(catalog.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", catalog.ORACLE)
def test_query_matches_sql(spark, name):
    assert oracle.difference(spark, oracle.connect(SF), catalog.QUERIES[name], catalog.ORACLE[name], SF) is None


@pytest.mark.parametrize(("name", "key", "table"), [
    ("op1_mixing", "doc_id", "documents"), ("op3_simhash", "doc_id", "documents"), ("op4_katz", "doc_id", "documents"),
    ("op6_token_counts", "doc_id", "documents"), ("op8_quality", "doc_id", "documents"), ("op9_url_rules", "page_id", "pages"),
    ("op11_fingerprints", "doc_id", "documents"),
])
def test_one_row_for_every_row(spark, name, key, table):
    got = [r[0] for r in catalog.QUERIES[name](spark, SF).select(key).collect()]
    assert sorted(got) == sorted(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())
