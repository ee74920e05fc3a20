"""Blocked time against a plain sweep; drift of schemas against planted fields."""

import datetime as dt
import json
import random

import pytest

from lakecensus.functions import constants as K
from lakecensus.operators import drift, waits
from lakecensus.operators.paging import Capture
from lakecensus.session import Staging


def plain_union(intervals):
    total, far = 0, None
    for begin, end in sorted(intervals):
        if far is None or begin > far:
            far = begin
        total += max(0, end - far)
        far = max(far, end)
    return total


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_union_of_intervals(spark, ranges):
    r = random.Random(ranges)
    rows = []
    for group, n, span in (("busy", 400, 50), ("sparse", 30, 10_000), (None, 60, 300), ("one", 1, 5)):
        rows += [(group, b, b + r.choice([0, 1, 7, 40])) for b in (r.randrange(span) for _ in range(n))]
    rows += [("open", 5, None), ("open", 8, 9)]
    df = spark.createDataFrame(rows, "g string, begin long, end long").repartition(4)
    got = {x["g"]: x["covered"] for x in waits.union_length(df, ["g"], Staging(spark), ranges).collect()}
    want = {g: plain_union([(b, e) for h, b, e in rows if h == g and e is not None]) for g in {g for g, _, _ in rows}}
    assert got == want


def test_a_hot_second_is_spread_over_tasks(spark):
    df = spark.range(20_000).selectExpr("'op' AS g", "1000000000 + id AS begin", "1000000000 + id + 5000 AS end")
    staging = Staging(spark)
    dealt = {}
    put = staging.put

    def spy(name, table, **measures):
        out = put(name, table, **measures)
        dealt.update({x["_rng"]: x["count"] for x in out[0].groupBy("_rng").count().collect()})
        return out

    staging.put = spy
    assert waits.union_length(df, ["g"], staging, 16).first()["covered"] == 19_999 + 5000
    assert len(dealt) == 16 and max(dealt.values()) < 3 * 20_000 / 16


def test_blocked_time_of_parallel_requests(spark, landing):
    at = lambda s: dt.datetime(2001, 1, 1) + dt.timedelta(seconds=s)
    row = lambda q, s, wait, op="ListReports", attempt=1: {
        "request_id": q, "operation": op, "status": 429, "retry_after": wait, "attempt": attempt, "requested_at": at(s)}
    rows = [row("a", 0, 10), row("b", 4, 10), row("c", 30, None), row("a", 0, 10), row("d", 12, 4, "ListDatasets"), row("e", 0, 99, "ExecuteDaxProbe"),
            row("f", 0, 99, attempt=4)]
    got = {r["operation"]: (r["waits"], r["wait_seconds"], r["blocked_us"]) for r in waits.blocked_time(landing(rows), Staging(spark)).collect()}
    assert got == {"ListReports": (3, 30, 24_000_000), "ListDatasets": (1, 4, 4_000_000), None: (4, 34, 26_000_000)}


def test_planted_fields_are_found(spark, landing):
    elements = [{"id": "a", "displayName": "A", "type": "T", "state": "Active", "capacityId": None, "tags": [{"k": 1}, {"k": "x"}, 5]},
                {"id": 7, "displayName": "B", "type": "T", "state": "Active", "nested": {"deep": {"er": True}}}]
    cap = Capture(landing([{"request_id": "w", "operation": K.OP_LIST_WORKSPACES, "status": 200, "body": json.dumps({"value": elements})}]),
                  "2001-10-01 00:00:00")
    got = {(r["path"], r["kind"]): (r["rows"], r["share"], r["finding"]) for r in drift.schema_drift(cap, [K.OP_LIST_WORKSPACES]).collect()}
    assert got == {
        ("id", "STRING"): (1, 0.5, "read"), ("id", "NUMBER"): (1, 0.5, "other kind"), ("displayName", "STRING"): (2, 1.0, "read"),
        ("type", "STRING"): (2, 1.0, "read"), ("state", "STRING"): (2, 1.0, "read"), ("capacityId", "NULL"): (1, 0.5, "read"),
        ("description", "STRING"): (0, 0.0, "missing"), ("tags", "ARRAY"): (1, 0.5, "unknown"), ("tags[].k", "NUMBER"): (1, 0.5, "unknown"),
        ("tags[].k", "STRING"): (1, 0.5, "unknown"), ("nested", "OBJECT"): (1, 0.5, "unknown"), ("nested.deep", "OBJECT"): (1, 0.5, "unknown"),
        ("nested.deep.er", "BOOLEAN"): (1, 0.5, "unknown")}
