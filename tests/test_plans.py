"""Physical-plan properties the design relies on at scale."""

import contextlib
import io
import re

from lakecensus.operators.outcomes import light_outcomes, odd_pages, resolve_attempts
from lakecensus.plans import queries as QM

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_landing_scan_prunes_operation_partitions(spark):
    landing = QM.fixture(spark, SF).stored("inventory")
    plan = plan_of(landing.where("operation = 'ListWorkspaceItems'").select("request_id", "body"))
    assert "PartitionFilters: [isnotnull(operation" in plan and "ListWorkspaceItems" in plan
    assert "ReadSchema: struct<request_id:string,body:string>" in plan


def test_odd_pages_read_and_shuffle_no_body(spark):
    plan = plan_of(odd_pages(QM.fixture(spark, SF).stored("attempts")))
    assert "body" not in plan
    assert len([ln for ln in plan.splitlines() if re.match(r"^\(\d+\) Exchange", ln)]) == 1


def test_clean_pages_pass_without_an_exchange(spark):
    landing = QM.fixture(spark, SF).stored("inventory")
    assert "Exchange" not in plan_of(resolve_attempts(landing, repeated=False, used_up=False))
    # pages whose attempts were used up move too, but without bodies and of the operation alone
    plan = plan_of(QM.capture(spark, SF).resolved.where("operation = 'ListWorkspaceItems'"))
    scans = re.findall(r"PartitionFilters: \[([^\n]*)\n(?:PushedFilters[^\n]*\n)?ReadSchema: ([^\n]*)", plan)
    scans = [(filters, schema) for filters, schema in scans if "operation" in filters]
    assert len(scans) == 2 and all("ListWorkspaceItems" in filters for filters, _ in scans)
    assert sum("body:string" in schema for _, schema in scans) == 1


def test_bodies_are_parsed_once_a_table(spark):
    elements = QM.capture(spark, SF).elements("ListWorkspaceItems").select("eid", "e")
    assert plan_of(elements).count("parseJson") == 1
    light = plan_of(light_outcomes(resolve_attempts(QM.fixture(spark, SF).stored("inventory"), repeated=False, used_up=False)))
    assert light.count("parseJson") == 1


def test_refresh_history_has_no_window(spark):
    plan = plan_of(QM.QUERIES["refresh_history"](spark, SF))
    assert "Window" not in plan


def test_history_capture_limits_each_model_before_the_shuffle(spark):
    fx = QM.fixture(spark, SF)
    plan = plan_of(fx.refresh_history())
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) and final


def test_probe_gate_is_a_top_one(spark):
    inv = QM.inventory(spark, SF)
    from lakecensus.operators.powerquery import probe_gate

    plan = plan_of(probe_gate(inv.cap, inv.ordered_models))
    assert "TakeOrderedAndProject" in plan or "Limit" in plan
