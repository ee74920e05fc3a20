"""Attempt resolution, classification, error bodies (FIXTURES section 4 cases)."""

import pytest
from pyspark.sql import functions as F

from lakecensus.operators.outcomes import error_rows, parse_error_text, rate_limit_waits
from lakecensus.operators.paging import Capture
from lakecensus.plans.pipeline import Inventory

OK = '{"value": []}'
E403 = '{"error": {"code": "Forbidden", "message": "no"}}'


def attempts(req, seq, op="ListWorkspaceItems"):
    rows = []
    for i, step in enumerate(seq, start=1):
        status, kind, body = step
        rows.append({"request_id": req, "operation": op, "attempt": i, "status": status, "error_kind": kind,
                     "body": body, "workspace_id": "ws-1", "retry_after": 5 if status == 429 else None})
    return rows


SCENARIOS = {
    "r429_429_200": ([(429, None, ""), (429, None, ""), (200, None, OK)], "ok", 200),
    "r429x3": ([(429, None, "")] * 3, "silent", -1),
    "timeoutx3": ([(None, "timeout", None)] * 3, "logged", -1),
    "r429_429_timeout": ([(429, None, ""), (429, None, ""), (None, "timeout", None)], "logged", -1),
    "timeout_timeout_429": ([(None, "timeout", None), (None, "timeout", None), (429, None, "")], "silent", -1),
    "r403": ([(403, None, E403)], "logged", 403),
    "r401": ([(401, None, E403)], "logged", 401),
    "r404": ([(404, None, "nf")], "silent", 404),
    "r500": ([(500, None, "<html>")], "logged", 500),
    "exception": ([(None, "exception", "boom")], "logged", -1),
    "not_json": ([(200, None, "<html>")], "logged", -1),
    "json_null": ([(200, None, "null")], "silent", 200),
    "fourth_ignored": ([(429, None, "")] * 3 + [(200, None, OK)], "silent", -1),
    "later_after_terminal": ([(403, None, E403), (200, None, OK)], "logged", 403),
}


def test_scenarios(spark, landing):
    rows = [r for name, (seq, _, _) in SCENARIOS.items() for r in attempts(name, seq)]
    cap = Capture(landing(rows), "2001-10-01 00:00:00")
    got = {r["request_id"]: r for r in cap.light().collect()}
    assert set(got) == set(SCENARIOS)
    for name, (_, outcome, code) in SCENARIOS.items():
        assert (got[name]["outcome"], got[name]["http_status_code"]) == (outcome, code), name
    assert got["r403"]["requires_admin"] and not got["r401"]["requires_admin"]


def test_dax_flavour_no_retry(spark, landing):
    rows = [
        {"request_id": "d1", "operation": "ExecuteDaxTables", "status": 429, "body": "x", "query": "EVALUATE 1"},
        {"request_id": "d2", "operation": "ExecuteDaxTables", "status": 404, "body": "x", "query": "EVALUATE 1"},
        {"request_id": "d3", "operation": "ExecuteDaxTables", "status": 400, "body": E403, "query": "EVALUATE 1"},
        {"request_id": "d4", "operation": "ExecuteDaxTables", "status": 200, "body": "oops", "query": "EVALUATE 1"},
        {"request_id": "d5", "operation": "ExecuteDaxTables", "error_kind": "timeout", "query": "EVALUATE 1"},
    ]
    cap = Capture(landing(rows), "2001-10-01 00:00:00")
    got = {r["request_id"]: (r["outcome"], r["http_status_code"]) for r in cap.light().collect()}
    assert got == {"d1": ("logged", 429), "d2": ("logged", 404), "d3": ("logged", 400), "d4": ("logged", -1),
                   "d5": ("logged", -1)}
    err = {r["operation"] for r in error_rows(cap.light(), cap.run_ts).collect()}
    assert err == {"ExecuteDAX: EVALUATE 1"}


def test_error_body_parsing(spark):
    bodies = [E403, '{"error": {"code": "C"}}', '{"other": 1}', '{"error": null}', "null", "[1, 2]", "<html>", "",
              '{"error": {"code": "C", "message": null}}']
    df = spark.createDataFrame([(b,) for b in bodies], "t string")
    code, msg = parse_error_text(F.col("t"))
    got = [(r[0], r[1]) for r in df.select(code, msg).collect()]
    assert got == [("Forbidden", "no"), ("C", bodies[1]), ("", bodies[2]), ("", bodies[3]), ("", "null"),
                   ("", bodies[5]), ("", "<html>"), ("", ""), ("C", bodies[8])]


def test_error_rows_defaults_and_timeout_message(spark, landing):
    rows = attempts("t", [(None, "timeout", None)] * 3)
    rows += [{"request_id": "u", "operation": None, "url": "https://x/y", "status": 500, "body": "bad"}]
    cap = Capture(landing(rows), "2001-10-01 00:00:00")
    got = {r["http_status_code"]: r for r in error_rows(cap.light(), cap.run_ts).collect()}
    assert got[-1]["error_message"] == "Request timed out after 60s"
    assert got[500]["operation"] == "https://x/y" and got[500]["item_id"] == "" and got[500]["error_code"] == ""


def test_rate_limit_waits(spark, landing):
    rows = attempts("a", [(429, None, ""), (429, None, ""), (200, None, OK)])
    rows += [{"request_id": "b", "operation": "ListReports", "status": 429, "retry_after": None}]
    got = {r["operation"]: (r["waits"], r["wait_seconds"]) for r in rate_limit_waits(landing(rows)).collect()}
    assert got == {"ListWorkspaceItems": (2, 10), "ListReports": (1, 10)}


def of_run(run, rows):
    return [{**r, "run_id": run} for r in rows]


def test_runs_of_one_landing_are_kept_apart(spark, landing):
    page = '{"value": [{"id": "a"}]}'
    rows = of_run("r1", attempts("q", [(429, None, ""), (200, None, page)]))
    rows += of_run("r2", attempts("q", [(429, None, ""), (403, None, E403)]))
    both = Capture(landing(rows), "2001-10-01 00:00:00")
    got = {(r["run_id"], r["outcome"], r["http_status_code"]) for r in both.light().collect()}
    assert got == {("r1", "ok", 200), ("r2", "logged", 403)}
    assert [r["run_id"] for r in both.elements("ListWorkspaceItems").collect()] == ["r1"]
    one = Capture(landing(rows), "2001-10-01 00:00:00", run_id="r2").one_run()
    assert [(r["run_id"], r["outcome"]) for r in one.light().collect()] == [("r2", "logged")]
    with pytest.raises(ValueError, match="r1.*r2"):
        Inventory(both)


def test_attempts_captured_twice_count_once(spark, landing):
    page = '{"value": [{"id": "a"}, {"id": "b"}]}'
    rows = attempts("first", [(200, None, page)]) * 3
    rows += attempts("later", [(429, None, ""), (200, None, page)]) * 2
    rows += attempts("used", [(429, None, "")] * 3) * 2
    rows += attempts("late", [(None, "timeout", None), (429, None, ""), (None, "timeout", None)])
    rows += attempts("no_first", [(429, None, ""), (200, None, page)])[1:]
    cap = Capture(landing(rows), "2001-10-01 00:00:00")
    got = sorted((r["request_id"], r["outcome"], r["http_status_code"]) for r in cap.light().collect())
    assert got == [("first", "ok", 200), ("late", "logged", -1), ("later", "ok", 200), ("used", "silent", -1)]
    assert cap.elements("ListWorkspaceItems").count() == 4
    assert error_rows(cap.light(), cap.run_ts).first()["error_message"] == "Request timed out after 60s"
    waits = rate_limit_waits(landing(rows)).first()
    assert (waits["waits"], waits["wait_seconds"]) == (5, 25)


def test_of_differing_copies_the_earliest_stays(spark, landing):
    import datetime as dt

    rows = [{**attempts("x", [(200, None, body)])[0], "requested_at": dt.datetime(2001, 1, 1, 0, 0, second)}
            for body, second in (('{"value": [2, 2]}', 9), ('{"value": [1]}', 3), ('{"value": []}', 7))]
    assert Capture(landing(rows), "2001-10-01 00:00:00").elements("ListWorkspaceItems").count() == 1
