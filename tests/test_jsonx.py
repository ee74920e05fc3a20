"""X1-X8 null rules against a plain-Python restatement of the extractor's dict access."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

import pytest
from pyspark.sql import functions as F

from lakecensus.functions import jsonx as J

CASES = ['{}', '{"a": null}', '{"a": ""}', '{"a": false}', '{"a": 0}', '{"a": 0.0}', '{"a": []}', '{"a": {}}',
         '{"a": "false"}', '{"a": "x"}', '{"a": 3}', '{"a": true}', '{"a": [1]}', '{"a": {"b": 1}}']


def py_truthy(d):
    return bool(d.get("a"))


def py_get_default(d):
    v = d.get("a", "")
    return v if v is None or isinstance(v, str) else None if isinstance(v, (dict, list)) else str(v).lower() if isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(c,) for c in CASES], "body string").select("body", J.parse("body").alias("v"))
    return {r["body"]: r for r in df.select(
        "body",
        J.truthy("v", "$.a").alias("truthy"),
        J.get_default("v", "$.a", "D").alias("get_default"),
        J.get_or("v", "$.a", "D").alias("get_or"),
        J.present("v", "$.a").alias("present"),
    ).collect()}


@pytest.mark.parametrize("body", CASES)
def test_truthy(rows, body):
    assert rows[body]["truthy"] == py_truthy(json.loads(body))


@pytest.mark.parametrize("body", CASES)
def test_get_default_missing_only(rows, body):
    d = json.loads(body)
    got = rows[body]["get_default"]
    if "a" not in d:
        assert got == "D"
    elif d["a"] is None:
        assert got is None  # explicit null stays NULL
    elif isinstance(d["a"], str):
        assert got == d["a"]


@pytest.mark.parametrize("body", CASES)
def test_get_or_all_falsy(rows, body):
    d = json.loads(body)
    got = rows[body]["get_or"]
    if not d.get("a"):
        assert got == "D"
    elif isinstance(d["a"], str):
        assert got == d["a"]


def test_first_truthy_and_nested(spark):
    df = spark.createDataFrame([
        ('{"p": {"u": {"n": ""}, "g": {"e": "g@x"}}}',),
        ('{"p": {"u": {"n": "u@x"}, "g": {"e": "g@x"}}}',),
        ('{"p": {"u": null}}',),
        ('{}',),
    ], "body string").select(J.parse("body").alias("v"))
    got = [r[0] for r in df.select(J.first_truthy("v", ["$.p.u.n", "$.s.a", "$.p.g.e"])).collect()]
    assert got == ["g@x", "u@x", "", ""]


def test_array_csv(spark):
    df = spark.createDataFrame([('{"d": ["Mon", "Tue"]}',), ('{"d": []}',), ('{"d": null}',), ('{}',)], "body string")
    got = [r[0] for r in df.select(J.array_csv(J.parse("body"), "$.d")).collect()]
    assert got == ["Mon,Tue", "", "", ""]


def test_dynamic_member_exact_case(spark):
    df = spark.createDataFrame([
        ('{"type": "s3", "s3": {"url": "u"}}',),
        ('{"type": "S3", "s3": {"url": "u"}}',),
        ('{"type": "a.b", "a.b": {"url": "dots"}}',),
        ('{"type": "s3", "s3": "not an object"}',),
        ('{"s3": {"url": "u"}}',),
    ], "body string").select(J.parse("body").alias("t"))
    member = J.dynamic_member("t", J.get_default("t", "$.type"))
    got = [r[0] for r in df.select(J.get_or(member, "$.url")).collect()]
    assert got == ["u", "", "dots", "", ""]


def test_json_or_empty(spark):
    df = spark.createDataFrame([('{"errorCode": "E1"}',), ("{bad",), ("",), (None,), ("[1]",)], "s string")
    got = [r[0] for r in df.select(J.get_or(J.json_or_empty(F.col("s")), "$.errorCode")).collect()]
    assert got == ["E1", "", "", "", ""]


json_scalars = st.one_of(
    st.none(), st.booleans(), st.integers(min_value=-(2**62), max_value=2**62),
    st.floats(allow_nan=False, allow_infinity=False, width=64), st.text(max_size=5),
)
json_values = st.recursive(
    json_scalars,
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.text(max_size=3), inner, max_size=3)),
    max_leaves=6,
)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.just("<missing>"), json_values), min_size=1, max_size=12))
def test_truthiness_property(spark, values):
    bodies = [json.dumps({} if v == "<missing>" else {"a": v}) for v in values]
    df = spark.createDataFrame([(b,) for b in bodies], "body string").select(J.parse("body").alias("v"))
    got = df.select(J.truthy("v", "$.a"), J.get_or("v", "$.a", "D"), J.present("v", "$.a")).collect()
    for b, (t, g, p) in zip(bodies, got):
        d = json.loads(b)
        assert t == bool(d.get("a")), b
        assert p == ("a" in d), b
        if not d.get("a"):
            assert g == "D", b
        elif isinstance(d["a"], str):
            assert g == d["a"], b
