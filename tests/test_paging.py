"""Page stitching keeps the prefix the extractor would have read."""

import pytest

from lakecensus.operators import paging
from lakecensus.operators.paging import Capture


def page(req, no, values, link=True, status=200, op="ListWorkspaceItems"):
    import json

    body = {"value": values}
    if link:
        body["nextLink" if no % 2 == 0 else "@odata.nextLink"] = f"next/{no + 1}"
    return {"request_id": req, "operation": op, "page_no": no, "status": status,
            "body": json.dumps(body) if status == 200 else "err", "workspace_id": "ws"}


def chain(req, n, fail_at=None, end_at=None, drop=None):
    rows = []
    for i in range(n):
        if drop is not None and i == drop:
            continue
        last = i == n - 1 or (end_at is not None and i == end_at)
        rows.append(page(req, i, [{"i": i}], link=not last, status=500 if i == fail_at else 200))
    return rows


CHAINS = {
    "clean": (dict(n=4), [0, 1, 2, 3]),
    "fail_first": (dict(n=3, fail_at=0), []),
    "fail_middle": (dict(n=4, fail_at=2), [0, 1]),
    "fail_last": (dict(n=3, fail_at=2), [0, 1]),
    "ends_early": (dict(n=4, end_at=1), [0, 1]),
    "gap": (dict(n=5, drop=2), [0, 1]),
    "single": (dict(n=1), [0]),
}


@pytest.mark.parametrize("broadcast_bytes", [None, -1])
def test_stitching(spark, landing, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(paging, "BROADCAST_CUTS_MAX_BYTES", broadcast_bytes)
    rows = [r for name, (kw, _) in CHAINS.items() for r in chain(name, **kw)]
    cap = Capture(landing(rows), "2001-10-01 00:00:00")
    got = {}
    for r in cap.elements("ListWorkspaceItems").select("request_id", "page_no").collect():
        got.setdefault(r["request_id"], []).append(r["page_no"])
    for name, (_, expected) in CHAINS.items():
        assert sorted(got.get(name, [])) == expected, name


def test_value_key_and_nulls(spark, landing):
    rows = [
        {"request_id": "a", "operation": "X", "status": 200, "body": '{"items": [1, 2]}'},
        {"request_id": "b", "operation": "X", "status": 200, "body": '{"value": null}'},
        {"request_id": "c", "operation": "X", "status": 200, "body": '{"value": [1, 2, 3]}'},
    ]
    cap = Capture(landing(rows), "2001-10-01 00:00:00")
    assert cap.elements("X", value_key="items", paged=False).count() == 2
    assert cap.elements("X", paged=False).count() == 3


def test_single_endpoint_reads_page_zero_only(spark, landing):
    rows = chain("h", 3)
    for r in rows:
        r["operation"] = "GetRefreshHistory"
    cap = Capture(landing(rows), "2001-10-01 00:00:00")
    assert [r["page_no"] for r in cap.elements("GetRefreshHistory").collect()] == [0]
