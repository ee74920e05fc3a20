"""Queries capture the endpoints that they read, once, and join no more of the workspace list than has answers."""

import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.operators.normalize import in_scope
from lakecensus.operators.reporting import errors_enriched
from lakecensus.plans import queries as QM
from lakecensus.plans.pipeline import Inventory
from lakecensus.sources.schemas import LANDING
from lakecensus.sources.shredded import STORED, GrowingCapture
from lakecensus.operators.paging import Capture
from test_plans import plan_of


@pytest.fixture()
def world(spark, tmp_path):
    """Small tables of their own, under a path that no other test has read."""
    at = str(tmp_path / uuid.uuid4().hex)
    day = "timestamp_ntz'2001-09-20 00:00:00'"
    tables = {
        "customer": "SELECT id c_custkey, concat('C', id) c_name, 1 c_nationkey, 0D c_acctbal, 'M' c_mktsegment FROM range(160)",
        "orders": f"SELECT id o_orderkey, id o_custkey, 'O' o_orderstatus, 0D o_totalprice, {day} o_orderdate, '1-URGENT' o_orderpriority FROM range(300)",
        "part": "SELECT id p_partkey, concat('P', id) p_name, 'B' p_brand, 'T' p_type, cast(id AS int) p_size, 0D p_retailprice FROM range(60)",
        "supplier": "SELECT id s_suppkey, concat('S', id) s_name, 1 s_nationkey, 0D s_acctbal FROM range(30)",
        "pages": "SELECT id page_id, concat('u', id) url, '<p>' html FROM range(20)",
        "documents": "SELECT id doc_id, 'let x = 1' text, 'en' lang, concat('src', id % 9) source, 9L n_chars FROM range(300)",
        "labels": "SELECT id doc_id, cast(id % 2 AS int) quality, cast(id % 3 = 0 AS int) toxic FROM range(40)",
        "lineitem": f"""SELECT id l_orderkey, id % 60 l_partkey, id % 30 l_suppkey, cast(id % 4 AS int) l_linenumber, 1D l_quantity, 1D l_extendedprice,
                        0D l_discount, 0D l_tax, 'A' l_returnflag, 'O' l_linestatus, {day} l_shipdate FROM range(400)""",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(os.path.join(at, f"{name}.parquet"))
    return at


def test_a_query_captures_what_it_reads(spark, world):
    assert QM.QUERIES["norm_workspaces"](spark, world).count() == 160
    has = QM.fixture(spark, world)._has["inventory"]
    assert has == {K.OP_LIST_WORKSPACES}
    assert QM.QUERIES["first_truthy"](spark, world).count() > 0
    assert has == {K.OP_LIST_WORKSPACES, K.OP_ROLE_ASSIGNMENTS}
    assert QM.QUERIES["array_csv"](spark, world).count() > 0
    assert has == {K.OP_LIST_WORKSPACES, K.OP_ROLE_ASSIGNMENTS, K.OP_LIST_DATASETS, K.OP_REFRESH_SCHEDULE}
    assert QM.QUERIES["item_history"](spark, world).count() > 0
    assert QM.fixture(spark, world)._has["runs"] == {K.OP_LIST_WORKSPACES, K.OP_LIST_ITEMS}


def test_grown_by_and_by_it_is_the_whole_capture(spark, world, tmp_path):
    fx = QM.fixture(spark, world)
    grown = GrowingCapture(spark, str(tmp_path / "grown"), "2001-10-01", lambda *ops: Capture(fx.stored("inventory", *ops), "2001-10-01"))
    for op in (K.OP_REFRESH_HISTORY, K.OP_DAX_TABLES, K.OP_LIST_WORKSPACES):
        grown.warm((op,))
    raw = Capture(fx.stored("inventory"), "2001-10-01")
    columns = raw.light().columns
    assert sorted(map(repr, grown.light().select(columns).collect())) == sorted(map(repr, raw.light().collect()))
    assert set(grown._parts) == set(STORED)
    for op in (K.OP_ROLE_ASSIGNMENTS, K.OP_LIST_REPORTS, K.OP_LIST_DATAFLOWS):
        asked = grown.asked(op)  # a stored list, not the elements again
        assert "HashAggregate" not in plan_of(asked.select("*"))
        found = raw.elements(op).select("workspace_id").distinct()
        assert sorted(map(tuple, asked.collect())) == sorted(map(tuple, raw.asked(op).collect())) and found.exceptAll(asked).isEmpty()
    a, b = Inventory(raw).tables(), Inventory(grown).tables()
    for name in a:
        rows = sorted(map(repr, a[name].collect()))
        assert rows == sorted(map(repr, b[name].collect())), name
    assert fx.stored("inventory").count() == fx.stored("inventory").distinct().count()  # no operation twice


def test_empty_pages_of_null_and_repeated_workspaces(spark, world):
    el = spark.createDataFrame([("ws-1", 0, 0, "{}"), ("ws-1", 1, 0, "{}"), (None, 0, 0, "{}")], "workspace_id string, page_no long, pos long, elem string")
    every = spark.createDataFrame([("ws-1",), ("ws-2",), ("ws-2",), (None,)], "workspace_id string")
    pages = QM.fixture(spark, world)._listing("Op", el, F.lit("u"), every)
    got = sorted((r["workspace_id"] or "", r["page_no"], r["body"]) for r in pages.collect())
    empty = '{"value":[],"nextLink":null}'
    assert got == [("", 0, '{"value":[{}],"nextLink":null}'), ("ws-1", 0, '{"value":[{}],"nextLink":"u?page=1"}'),
                   ("ws-1", 1, '{"value":[{}],"nextLink":""}'), ("ws-2", 0, empty), ("ws-2", 0, empty)]
    # empty pages are added after the last pages are looked up, so that the workspace list is in no such join
    assert re.search(r"AdaptiveSparkPlan \(\d+\)\n\+- Union", plan_of(pages.select("*")))


def test_pages_of_a_listing_move_once(spark, world):
    """The whole listing of workspaces has one key: looking its last page up must not gather it."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = QM.fixture(spark, world).workspaces()
        assert pages.count() == 2 and "SortMergeJoin" not in plan_of(pages)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_listings_join_their_own_cuts_and_the_workspaces_that_have_elements(spark, landing):
    def page(op, ws, no, body, status=200):
        return {"operation": op, "request_id": f"{op}|{ws}", "workspace_id": ws, "page_no": no, "status": status, "body": body}

    one, more, none = '{"value":[{"id":"a"}]}', '{"value":[{"id":"a"}],"nextLink":"n"}', '{"value":[]}'
    users, reports = K.OP_ROLE_ASSIGNMENTS, K.OP_LIST_REPORTS
    cap = Capture(landing([
        page(users, "refused", 0, "no", 403), page(users, "empty", 0, none), page(users, "broken", 0, more),
        page(users, "broken", 1, "no", 500), page(users, "broken", 2, one), page(users, "fails last", 0, more),
        page(users, "fails last", 1, "no", 500), page(reports, "empty", 0, none), page(reports, "full", 0, more),
        page(reports, "full", 1, one), page(reports, "null", 0, '{"value":[null]}')]), "2001-10-01").warm((users, reports))
    # only the chain with an answer behind its cut is cut, and no other listing's bodies are joined with it
    assert [(r["request_id"], r["cut"]) for r in cap._cut_cache[users].collect()] == [(f"{users}|broken", 0)]
    assert cap._cut_cache[reports] is None and "Join" not in plan_of(cap.bodies(reports))
    assert sorted((r["workspace_id"], r["page_no"]) for r in cap.elements(users).collect()) == [("broken", 0), ("fails last", 0)]
    assert sorted(r["workspace_id"] for r in cap.asked(reports).collect()) == ["full", "null"]
    assert sorted(r["workspace_id"] for r in cap.asked(users).collect()) == ["broken", "fails last"]
    assert cap.elements(reports).count() == 3


def test_scope_and_names_join_what_has_answers(spark):
    ws = spark.createDataFrame([("ws-1", "one", 0, 0), ("ws-1", "later", 0, 1), ("ws-2", "two", 0, 2), (None, "none", 0, 3)],
                               "workspace_id string, workspace_name string, _page int, _pos int")
    el = spark.createDataFrame([("ws-1", 1), ("ws-1", 2), ("ws-9", 3), (None, 4)], "workspace_id string, n int")
    kept = in_scope(el, ws, el.select("workspace_id").distinct())
    assert sorted(r["n"] for r in kept.collect()) == sorted(r["n"] for r in in_scope(el, ws).collect()) == [1, 2]
    errors = spark.createDataFrame([("ws-1", ""), ("ws-9", ""), ("", "")], "workspace_id string, workspace_name string")
    named = errors_enriched(errors, ws)
    assert sorted(map(tuple, named.collect())) == [("", ""), ("ws-1", "later"), ("ws-9", "")]
    assert "LeftSemi" in plan_of(named)  # names of workspaces without errors are not joined


def test_no_operations_give_an_empty_landing(spark, world):
    fx = QM.fixture(spark, world)
    nothing = fx.stored("inventory", K.OP_LIST_LAKEHOUSES)
    assert nothing.columns == LANDING.fieldNames() and nothing.count() == 0
