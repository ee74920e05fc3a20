"""Walks along links against the sequential walk; captures without page numbers."""

import json
import math
import random

from pyspark.sql import functions as F

from lakecensus.operators import links as L
from lakecensus.operators.paging import Capture
from lakecensus.session import Staging

OP = "ListWorkspaceItems"


def sequential(starts, pages):
    out = set()
    for start, node in starts:
        seen, at = set(), 0
        while node in pages and node not in seen:
            out.add((start, node, at))
            seen.add(node)
            node, at = pages[node], at + 1
    return out


class Counting(Staging):
    puts = 0

    def put(self, name, df, **measures):
        self.puts += name == "walk"
        return super().put(name, df, **measures)


def walked(spark, starts, pages):
    staging = Counting(spark)
    links = spark.createDataFrame([*pages.items()], "node string, next string").repartition(3)
    got = L.walks(spark.createDataFrame(starts, "start long, node string"), links, staging)
    return {tuple(r) for r in got.select("start", "node", "position").collect()}, staging.puts - 1


def test_random_graphs(spark):
    r = random.Random(4)
    for n, straight in ((1, 0.0), (12, 0.0), (40, 0.7), (60, 0.95)):
        pages = {f"p{i}": r.choice([None, "gone", f"p{r.randrange(n)}", f"p{r.randrange(n)}"]) if r.random() > straight else f"p{(i + 1) % n}"
                 for i in range(n)}
        starts = [(i, f"p{r.randrange(n + 2)}") for i in range(9)]
        got, _ = walked(spark, starts, pages)
        assert got == sequential(starts, pages)


def test_rounds_grow_with_the_logarithm(spark):
    long = {f"p{i}": f"p{i + 1}" if i < 499 else None for i in range(500)}
    got, rounds = walked(spark, [(1, "p0"), (2, "p250")], long)
    assert got == sequential([(1, "p0"), (2, "p250")], long) and rounds <= math.ceil(math.log2(500)) + 1
    ring = {f"p{i}": f"p{(i + 1) % 60}" for i in range(60)} | {"in": "p7"}
    got, rounds = walked(spark, [(1, "in"), (2, "p59")], ring)
    assert got == sequential([(1, "in"), (2, "p59")], ring) and rounds <= math.ceil(math.log2(61)) + 1


def answer(url, next_=None, status=200, attempt=1, run="r", key="nextLink"):
    body = {"value": [{"of": url}]} | ({key: next_} if next_ is not None else {})
    return {"run_id": run, "operation": OP, "url": url, "attempt": attempt, "status": status, "request_id": None, "page_no": None,
            "body": json.dumps(body) if status == 200 else "no"}


def test_captures_without_page_numbers(spark, landing):
    rows = [
        answer("a/0", "a/1"), answer("a/1", "a/2", status=429), answer("a/1", "a/2", attempt=2, key="@odata.nextLink"), answer("a/2", ""),
        answer("b/0", "b/1"), answer("b/1", status=403), answer("c/0", "a/1"), answer("d/0", "d/1"), answer("d/1", "d/0"),
        answer("e/0", "gone"), answer("orphan", "a/0"), answer("a/0", "a/1"),  # the last is a copy
        answer("a/0", None, run="r2"), answer("b/0", "a/0", run="r2"),
    ]
    random.Random(1).shuffle(rows)
    starts = spark.createDataFrame([(OP, q, f"{q}/0") for q in "abcdef"], "operation string, request_id string, url string")
    numbered = L.number_pages(landing(rows), starts)
    cap = Capture(numbered, "2001-10-01 00:00:00")
    got = {}
    of = F.try_variant_get("e", "$.of", "string").alias("of")
    for r in sorted(cap.elements(OP).select("run_id", "request_id", "page_no", of).collect()):
        got.setdefault((r["run_id"], r["request_id"]), []).append(r["of"])
    assert got == {("r", "a"): ["a/0", "a/1", "a/2"], ("r", "b"): ["b/0"], ("r", "c"): ["c/0", "a/1", "a/2"], ("r", "d"): ["d/0", "d/1"],
                   ("r", "e"): ["e/0"], ("r2", "a"): ["a/0"], ("r2", "b"): ["b/0", "a/0"]}
    failed = cap.light(OP).where("outcome = 'logged'").collect()
    assert [(r["request_id"], r["page_no"], r["http_status_code"]) for r in failed] == [("b", 1, 403)]


def test_single_page_operations_have_page_zero(spark, landing):
    rows = [{**answer("h/0", "h/1"), "operation": "GetRefreshHistory"}, {**answer("h/1"), "operation": "GetRefreshHistory"}]
    starts = spark.createDataFrame([("GetRefreshHistory", "h", "h/0")], "operation string, request_id string, url string")
    assert [(r["request_id"], r["page_no"], r["url"]) for r in L.number_pages(landing(rows), starts).collect()] == [("h", 0, "h/0")]
