"""Every registered query against its DuckDB oracle on the smallest test tables, plus
invariants of one run (SURVEY section 5)."""

import pytest
from pyspark.sql import functions as F

from lakecensus.plans import queries as QM
from lakecensus.plans.check import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF, names=sorted(QM.QUERIES), verbose=True)


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries

    assert set(QM.QUERIES) <= set(queries()) and set(QM.QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QM.QUERIES))
def test_query_matches_oracle(results, name):
    res = results[name]
    assert "error" not in res, res.get("error")
    assert res["match"], res


def test_invariants(spark):
    inv = QM.inventory(spark, SF)
    out = inv.cap.light()
    # one outcome per (request, page), and exactly one of ok / logged / silent
    assert out.count() == out.select("request_id", "page_no").distinct().count()
    assert {r[0] for r in out.select("outcome").distinct().collect()} <= {"ok", "logged", "silent"}
    # planned = ok + logged + silent + missing (page-0 outcome of each planned request)
    planned = inv.planned
    first = out.where("page_no = 0").select("request_id", "outcome")
    joined = planned.join(first, "request_id", "left").groupBy(F.coalesce("outcome", F.lit("missing"))).count()
    assert sum(r[1] for r in joined.collect()) == planned.count()
    # U1 = sum of the branches; surrogate ids unique
    branches = inv.datasource_branches()
    assert inv.datasources.count() == sum(b.count() for b in branches.values())
    for df, key in [(inv.history, "refresh_id"), (inv.power_queries, "query_id"), (inv.errors, "error_id"),
                    (inv.datasources, "datasource_id"), (inv.users, "id")]:
        assert df.count() == df.select(key).distinct().count(), key


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() >= 0 and "refresh_id" in df.columns
