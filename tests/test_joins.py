"""What is broadcast is bounded by counted rows: files of many rows may be small."""

import pytest
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.operators.joins import is_few
from lakecensus.operators.normalize import in_scope
from lakecensus.operators.paging import Capture
from lakecensus.operators.refresh import refresh_history, refresh_schedules
from lakecensus.operators.reporting import errors_enriched

MANY = 60_000  # more than 10 MB of rows, in files of less


def broadcast_rows(df):
    """Rows of each broadcast that a query made."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(plan.plan())
        else:
            if kind == "BroadcastExchangeExec":
                found.append(plan.metrics().apply("numOutputRows").value())
            children = plan.children()
            todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Workspaces with a model and an error each, as staged tables: long lists in small files."""
    at = str(tmp_path_factory.mktemp("stored"))
    ws, no = F.concat(F.lit("ws-"), F.col("id")), F.col("id").cast("int")
    rows = {
        "workspaces": [ws.alias("workspace_id"), F.lit("name").alias("workspace_name"), F.lit(0).alias("_page"), no.alias("_pos")],
        "models": [ws.alias("workspace_id"), F.concat(F.lit("sm-"), "id").alias("model_id"), F.lit(True).alias("is_refreshable")],
        "errors": [ws.alias("workspace_id"), F.lit("").alias("workspace_name")],
    }
    for name, columns in rows.items():
        spark.range(MANY).select(*columns).coalesce(1).write.parquet(f"{at}/{name}")
    return {name: spark.read.parquet(f"{at}/{name}") for name in rows}


def test_scope_broadcasts_the_short_list_alone(spark, stored):
    workspaces = stored["workspaces"].unionByName(stored["workspaces"].where("_pos = 7"))  # one is listed again
    elements = spark.createDataFrame([("ws-7", 1), ("ws-7", 2), ("gone", 3), (None, 4)], "workspace_id string, n int")
    asked = elements.select("workspace_id").distinct()
    kept = in_scope(elements, workspaces, asked)
    assert sorted(r["n"] for r in kept.collect()) == [1, 2]
    assert max(broadcast_rows(kept)) <= 3  # 60,001 before
    every = in_scope(stored["models"], workspaces, stored["models"].select("workspace_id"))
    assert len(every.collect()) == MANY and broadcast_rows(every) == []
    whole = in_scope(stored["models"], workspaces)
    assert len(whole.collect()) == MANY and broadcast_rows(whole) == []


def test_names_of_many_errors_are_not_broadcast(stored):
    named = errors_enriched(stored["errors"], stored["workspaces"])
    assert {tuple(r) for r in named.select("workspace_name").collect()} == {("name",)}
    assert broadcast_rows(named) == []
    few = errors_enriched(stored["errors"].limit(5), stored["workspaces"])
    assert [r["workspace_name"] for r in few.collect()] == ["name"] * 5
    assert broadcast_rows(few) and max(broadcast_rows(few)) <= 5


def test_answers_of_many_models_join_by_a_shuffle(landing, stored):
    def page(op, body):
        return {"operation": op, "request_id": f"{op}|ws-7", "workspace_id": "ws-7", "item_id": "sm-7", "status": 200, "body": body}

    cap = Capture(landing([page(K.OP_REFRESH_SCHEDULE, '{"enabled":true}'), page(K.OP_REFRESH_HISTORY, '{"value":[{"status":"ok"}]}')]),
                  "2001-10-01")
    for made in (refresh_schedules, refresh_history):
        table = made(cap, stored["models"])
        assert [r["model_id"] for r in table.collect()] == ["sm-7"] and max(broadcast_rows(table), default=0) <= 1
        table = made(cap, stored["models"].where("model_id IN ('sm-7', 'sm-8')"))
        assert [r["model_id"] for r in table.collect()] == ["sm-7"] and broadcast_rows(table) == [2]


def test_the_threshold_of_the_session_holds(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        for value, rows in (("10MB", 50_000), ("256k", 1_000), ("2000", 10)):
            spark.conf.set(key, value)
            assert is_few(spark.range(rows)) and not is_few(spark.range(2 * rows))
        spark.conf.set(key, "-1")
        assert not is_few(spark.range(0))
    finally:
        spark.conf.set(key, before)
