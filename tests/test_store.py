"""K1-K4: tables published together, whatever happens to the writer; the ledger of counters."""

import os
import signal
import subprocess
import sys
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from lakecensus.sources.store import CommitConflict, Store


@pytest.fixture()
def store(spark):
    return Store(spark, tempfile.mkdtemp(prefix="lakecensus-store-"))


def numbers(spark, n, name="id"):
    return spark.range(n).withColumnRenamed("id", name)


def test_versions_are_whole_and_stay_readable(spark, store):
    assert store.versions() == [] and store.record()["tables"] == {} and store.ledger().count() == 0
    store.publish({"a": numbers(spark, 3), "errors": numbers(spark, 1)}, "r1")
    store.publish({"a": numbers(spark, 5, "x"), "errors": numbers(spark, 0)}, "r2")
    assert store.versions() == [1, 2]
    assert store.read("a").columns == ["x"] and store.read("a").count() == 5  # schema replaced
    assert store.read("a", 1).columns == ["id"] and store.read("a", 1).count() == 3
    assert store.read("errors").count() == 1  # empty: the table before is kept
    store.publish({"a": numbers(spark, 5), "errors": numbers(spark, 0)}, "r3", on_empty="overwrite")
    assert store.read("errors").count() == 0 and store.read("errors").columns == ["id"]
    with pytest.raises(LookupError):
        store.read("b")
    with pytest.raises(LookupError):
        store.read("a", 9)
    with pytest.raises(ValueError):
        store.publish({"a": numbers(spark, 1)}, on_empty="drop")


def test_each_table_is_written_once_errors_last(spark, store):
    seen = []
    write = store._write

    def spy(name, *rest):
        out = write(name, *rest)
        seen.append(name)
        return out

    store._write = spy
    tables = {n: numbers(spark, 2) for n in ("a", "b", "c", "d", "e", "errors")}
    store.publish(tables)
    assert sorted(seen) == sorted(tables) and seen[-1] == "errors"
    assert all(len(store._listed(n)) == 1 for n in tables)


def test_a_failed_run_leaves_the_last_one(spark, store):
    store.publish({"a": numbers(spark, 3), "b": numbers(spark, 4)}, "r1")
    broken = numbers(spark, 9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.publish({"a": numbers(spark, 7), "b": broken}, "r2")
    again = Store(spark, store.root)
    assert again.versions() == [1] and again.read("a").count() == 3 and again.read("b").count() == 4
    again.publish({"a": numbers(spark, 7), "b": numbers(spark, 8)}, "r3")
    assert again.read("a").count() == 7 and again.record()["run_id"] == "r3"


def test_of_two_writers_one_loses(spark, store):
    store.publish({"a": numbers(spark, 3)}, "r1")
    other = Store(spark, store.root)
    commit = store._commit

    def late(version, text):
        other.publish({"a": numbers(spark, 10)}, "faster")
        commit(version, text)

    store._commit = late
    with pytest.raises(CommitConflict):
        store.publish({"a": numbers(spark, 4)}, "slower")
    assert other.record()["run_id"] == "faster" and other.read("a").count() == 10 and other.versions() == [1, 2]


WRITER = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
from lakecensus.sources.store import Store
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
slow = spark.range(2, numPartitions=1).select(F.expr("java_method('java.lang.Thread', 'sleep', 60000L)").cast("string").alias("id"))
Store(spark, {root!r}).publish({{"a": spark.range(50), "b": slow}}, "killed")
"""


def test_a_killed_writer_leaves_the_last_run(spark, store):
    store.publish({"a": numbers(spark, 3), "b": numbers(spark, 4)}, "r1")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    writer = subprocess.Popen([sys.executable, "-c", WRITER.format(repo=repo, root=store.root)],
                              stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, start_new_session=True)
    try:
        for _ in range(120):  # until it has written its first table and is at the second
            if len(store._listed("a")) == 2 and store._listed("a", store._listed("a")[-1]).count("_SUCCESS"):
                break
            assert writer.poll() is None
            time.sleep(0.5)
        else:
            pytest.fail("the writer wrote nothing")
    finally:
        os.killpg(writer.pid, signal.SIGKILL)
        writer.wait()
    assert store.versions() == [1] and store.read("a").count() == 3 and store.read("b").count() == 4
    store.publish({"a": numbers(spark, 6), "b": numbers(spark, 7)}, "r2")
    assert store.read("a").count() == 6
    assert len(store.vacuum(keep=1)) >= 3  # both folders of the first run and the killed one's
    assert store.versions() == [2] and store.read("b").count() == 7 and len(store._listed("a")) == 1


def test_counters_are_observed_and_kept_by_run(spark, store):
    counters = {"a": {"even": F.count_if(F.col("id") % 2 == 0)}}
    store.publish({"a": numbers(spark, 5), "b": numbers(spark, 0)}, "r1", counters=counters, metrics={"cover": {"tried": 7}})
    store.publish({"a": numbers(spark, 2), "b": numbers(spark, 1)}, "r2", counters=counters)
    got = {tuple(r) for r in store.ledger().collect()}
    assert got == {(1, "r1", "a", "rows", 5), (1, "r1", "a", "even", 3), (1, "r1", "b", "rows", 0), (1, "r1", "cover", "tried", 7),
                   (2, "r2", "a", "rows", 2), (2, "r2", "a", "even", 1), (2, "r2", "b", "rows", 1)}


def test_ledger_agrees_with_the_tables(spark):
    from lakecensus.operators import powerquery as Q
    from lakecensus.operators import reporting as E
    from lakecensus.plans import queries as QM
    from lakecensus.plans.pipeline import K

    sf = "/root/testdata/sf0.001"
    inv, ledger = QM.inventory(spark, sf), QM.published(spark, sf).ledger()
    value = {(r["table_name"], r["metric"]): r["value"] for r in ledger.collect()}
    for name, df in inv.tables().items():
        assert value[name, "rows"] == df.count(), name
        for metric, agg in E.counters().get(name, {}).items():
            assert value[name, metric] == df.agg(agg).first()[0], (name, metric)
    for name, row in (("datasource_coverage", E.ds_coverage(inv.planned, inv.cap.light(K.OP_MODEL_DATASOURCES), inv.models).first()),
                      ("power_query_coverage", Q.pq_coverage(inv.cap, inv.ordered_models).first())):
        assert {m: v for (t, m), v in value.items() if t == name} == {k: int(v) for k, v in row.asDict().items()}
