"""The queries with SQL against DuckDB, on the smallest tables."""

import pytest

from lakecensus.llm.oracles import ORACLES
from lakecensus.llm.queries import QUERIES
from lakecensus.plans.check import compare


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    got = compare(spark, "/root/testdata/sf0.001", [name])[name]
    assert got.get("match"), got


def test_entry_registers_queries_and_pipeline():
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
