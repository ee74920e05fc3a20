"""Run-to-run changes against brute force, and intervals over several runs."""

import datetime as dt
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lakecensus.operators import changes as C
from lakecensus.sources.schemas import OUTPUTS

SCHEMA = "k1 long, k2 string, v string, n long, sid string, extracted_at timestamp"


def rows_of(r, n):
    return [(r.choice([1, 2, 3, None]), r.choice(["a", "b", None, ""]), r.choice(["x", "", None]), r.choice([1, None]), str(r.random()),
             dt.datetime(2001, 1, r.randint(1, 9))) for _ in range(n)]


def bags(rows):
    out = defaultdict(Counter)
    for k1, k2, v, n, _, _ in rows:
        out[k1, k2][v, n] += 1
    return out


def brute_force(old, new):
    a, b = bags(old), bags(new)
    kind = lambda k: "added" if k not in a else "removed" if k not in b else "same" if a[k] == b[k] else "changed"
    return {k: (kind(k), sum(a[k].values()) if k in a else 0, sum(b[k].values()) if k in b else 0) for k in {*a, *b}}


def test_differences_of_bags_with_null_keys(spark):
    r = random.Random(1)
    kinds = set()
    for n in (3, 12, 40, 0):
        old, new = rows_of(r, n), rows_of(r, n)
        new += old[: n // 2]
        frames = [spark.createDataFrame(x, SCHEMA).repartition(3) for x in (old, new)]
        got = {(x["k1"], x["k2"]): (x["change"], x["old_rows"], x["new_rows"])
               for x in C.snapshot_difference(*frames, ["k1", "k2"], ["sid"]).collect()}
        want = brute_force(old, new)
        assert got == want
        kinds |= {k for k, _, _ in want.values()}
        listed = Counter((x["change"], x["k1"], x["k2"]) for x in C.changed_rows(*frames, ["k1", "k2"], ["sid"]).collect())
        assert listed == Counter({(c, *k): (a if c == "removed" else b) for k, (c, a, b) in want.items() if c != "same"})
    assert kinds >= {"added", "removed", "changed"}


def test_order_null_and_empty(spark):
    one = spark.createDataFrame([(1, "a", None, 1, "s", None), (1, "a", "x", 2, "s", None)], SCHEMA)
    flipped = spark.createDataFrame([(1, "a", "x", 2, "t", None), (1, "a", None, 1, "u", None)], SCHEMA)
    emptied = spark.createDataFrame([(1, "a", "", 1, "s", None), (1, "a", "x", 2, "s", None)], SCHEMA)
    kind = lambda a, b: C.snapshot_difference(a, b, ["k1", "k2"], ["sid"]).first()["change"]
    assert kind(one, flipped) == "same" and kind(one, emptied) == "changed"
    assert kind(one, one.unionByName(one)) == "changed"


def test_intervals_over_runs(spark):
    runs = [("a1", "b1", "c1"), ("a1", "b2", None), ("a2", "b2", None), ("a2", "b2", "c1")]
    history = None
    for day, state in enumerate(runs, 1):
        snapshot = spark.createDataFrame([(v[0], v) for v in state if v], "k string, v string")
        history = C.close_intervals(history, snapshot, F.lit(f"2001-01-0{day} 00:00:00"), ["k"])
    got = sorted(((r["v"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day) for r in history.collect()), key=str)
    assert got == [("a1", 1, 3), ("a2", 3, None), ("b1", 1, 2), ("b2", 2, None), ("c1", 1, 2), ("c1", 4, None)]
    # a point in time gives the state of its run
    for day, state in enumerate(runs, 1):
        at = F.lit(f"2001-01-0{day} 12:00:00").cast("timestamp")
        then = history.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))
        assert {r["v"] for r in then.collect()} == {v for v in state if v}


def test_every_table_has_a_key_of_its_columns():
    assert set(C.KEYS) == set(OUTPUTS)
    for table, (key, ignore) in C.KEYS.items():
        assert {*key, *ignore} <= set(OUTPUTS[table].fieldNames()) and not {*key} & {*ignore}
