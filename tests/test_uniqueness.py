"""Counts of ids by hashes, exact where hashes repeat."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakecensus.operators import uniqueness as U
from lakecensus.session import Staging


@pytest.fixture(scope="module")
def staging(spark):
    made = Staging(spark)
    yield made
    made.clean()


def check(spark, staging, ids, kind="string"):
    rows = spark.createDataFrame([(x,) for x in ids], f"id {kind}")
    counts = Counter(x for x in ids if x is not None)
    assert tuple(U.id_counts(rows, "id", staging).first()) == (len(ids), len(counts))
    assert dict(U.repeated_ids(rows, "id", staging).collect()) == {x: n for x, n in counts.items() if n > 1}


@pytest.mark.parametrize("ids", [
    [], [None], [None, None, None], ["a"], ["a", "a"], ["a", None, "a", None, "b"], ["", "", " "], ["a"] * 50 + ["b", "c"]])
def test_defined_cases(spark, staging, ids):
    check(spark, staging, ids)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 20)), max_size=40))
def test_generated_ids(spark, staging, ids):
    check(spark, staging, ids, "long")


def test_a_planted_copy_is_found_and_large_sets_are_joined_by_a_shuffle(spark, staging, monkeypatch):
    ids = spark.range(50_000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"))
    assert tuple(U.id_counts(ids, "id", staging).first()) == (50_000, 50_000)
    planted = ids.unionByName(ids.orderBy("id").limit(1))
    want = ids.agg(F.min("id")).first()[0]
    for bound in (U.BROADCAST_HASHES, 0):
        monkeypatch.setattr(U, "BROADCAST_HASHES", bound)
        assert tuple(U.id_counts(planted, "id", staging).first()) == (50_001, 50_000)
        assert [tuple(r) for r in U.repeated_ids(planted, "id", staging).collect()] == [(want, 2)]


def test_different_ids_of_one_hash_stay_apart(spark, staging, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(U.F, "xxhash64", lambda c: real(F.substring(F.col(c), 1, 1)))
    check(spark, staging, ["aa", "ab", "ab", "b", "ca", "cb", None])


def test_ids_themselves_are_not_shuffled(spark, staging):
    rows = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"))
    path = f"{staging.folder}/plan-input"
    rows.write.parquet(path)
    plan = U.id_counts(spark.read.parquet(path), "id", staging)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "sha2" not in plan  # unique: nothing left to compare
