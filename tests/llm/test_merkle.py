import hashlib
import zlib

import pytest
from helpers import DOCS, awkward, clashing, empty, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakecensus.llm import merkle
from lakecensus.llm.common import crc32, hot_splits, table
from lakecensus.llm.queries import op2_merkle_fingerprints

TEXT = st.text(alphabet=st.sampled_from(list("abcdefgh   \n\té日")), max_size=200)


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT)
def test_roots_test_equality(a, b):
    fa, fb = merkle.fingerprint(a), merkle.fingerprint(b)
    assert (fa == fb) == (a == b) and (fa.split(":")[0] == fb.split(":")[0]) == (a == b)
    assert merkle.likeness(fa, fa) == 1.0 and 0 <= merkle.likeness(fa, fb) <= 1
    assert merkle.likeness(fa, fb) == merkle.likeness(fb, fa)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_leaves_cover_the_text(text):
    raw = text.encode()
    if raw:
        ends, lines = merkle._runs(raw)
        assert ends[-1] == len(raw) and ends == sorted(set(ends)) and len(ends) == len(lines)
        assert [raw[:e].count(b"\n") - raw[:e].endswith(b"\n") for e in ends] == lines


def brute_likeness(a, b):
    from collections import Counter

    def leaves(text):
        return Counter(x for s in merkle.tree(text)[1] for p in s for x in p)

    x, y = leaves(a), leaves(b)
    most = max(sum(x.values()), sum(y.values()))
    return 1.0 if a == b or not most else sum((x & y).values()) / most


def test_edits_are_located():
    lines = [f"line {i} has some words of its own, number {i * i}" for i in range(60)]
    a = "\n".join(lines)
    b = "\n".join([*lines[:30], "a new line in the middle", *lines[30:45], lines[45] + " changed", *lines[46:]])
    fa, fb = merkle.fingerprint(a), merkle.fingerprint(b)
    assert 0.9 < merkle.likeness(fa, fb) < 1 and merkle.likeness(fa, fb) == pytest.approx(brute_likeness(a, b), abs=0.02)
    gone, new = merkle.edits(fa, fb)
    assert len(gone) == 1 and len(new) == 2
    assert merkle.edits(fa, fa) == ([], [])


def test_defined_cases():
    assert merkle.fingerprint(None) == merkle.fingerprint("") and merkle.likeness(merkle.fingerprint(""), merkle.fingerprint(None)) == 1.0
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("a b")) == 0.0
    assert merkle.edited_text("abcde", "XYZ") == "abcXY" and merkle.edited_text("abcde", "X") == "abcX"
    assert merkle.edited_text("", "X") == "" and merkle.edited_text("é😀", "日本") == "é日"


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op2_merkle_fingerprints(spark, sf).collect()}
    docs = sorted((r["doc_id"], r["text"] or "") for r in table(spark, sf, "documents").collect())
    assert sorted(got) == [d for d, _ in docs]
    near_edited = []
    for (d, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        r, half = got[d], len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == merkle.fingerprint(text) and r["edited_fingerprint"] == merkle.fingerprint(edited)
        assert r["near_next"] == pytest.approx(brute_likeness(text, following), abs=0.05)
        if len(text) > 400:
            near_edited.append(r["near_edited"])
            assert r["near_edited"] > r["near_next"] or text == following
    assert 0.35 < sum(near_edited) / len(near_edited) < 0.65


def in_order(docs):
    """Nulls first, then by key, the text's checksum and the text."""
    order = sorted((r["doc_id"] is not None, r["doc_id"] or 0, zlib.crc32((r["text"] or "").encode()), r["text"] or "")
                   for r in docs.collect())
    return [(d if has else None, t) for has, d, _, t in order]


def check_next(spark, docs, ranges):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        order = in_order(docs)
        want = sorted(((d, t, n) for (d, t), (_, n) in zip(order, order[1:] + order[:1])), key=repr)
        got = merkle.with_next(docs, lambda text, following: (text, following), {"own": "string", "following": "string"})
        assert rows(got) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("ranges", ["1", "3", "40"])
def test_next_documents(spark, ranges):
    for docs in (awkward(spark), clashing(awkward(spark)), awkward(spark).where("doc_id = 3"), empty(spark)):
        check_next(spark, docs, ranges)


@pytest.mark.parametrize("hot, null", [(400, 0), (0, 300), (300, 300)])
def test_next_documents_of_hot_keys(spark, hot, null):
    texts = [f"text {i} of a key" for i in range(hot)] + ["twice", "twice"]
    docs = spark.createDataFrame(
        [(7, t, "en", "a", 1) for t in texts] + [(None, f"none {i}", "en", "a", 1) for i in range(null)]
        + [(i, f"other {i}", "en", "a", 1) for i in range(-50, 100) if i != 7] + [(8, None, "en", "a", 0)], DOCS)
    check_next(spark, docs, "12")
    splits, many, nulls = hot_splits(docs, "doc_id", 12)
    rng, ranges = merkle.key_ranges(F.col("doc_id"), crc32(F.coalesce("text", F.lit(""))), splits, many, nulls)
    sizes = docs.groupBy(rng.alias("rng")).count().collect()
    assert 0 <= min(r["rng"] for r in sizes) and max(r["rng"] for r in sizes) < ranges
    assert max(r["count"] for r in sizes) < 0.3 * (hot + null + 150)  # a key of more than half is several ranges


def test_fingerprints_of_a_table(spark):
    docs = awkward(spark)
    got = merkle.fingerprints(docs).join(docs.select("doc_id", "text"), "doc_id").where(F.col("doc_id") != 8).collect()
    assert all(r["fingerprint"] == merkle.fingerprint(r["text"]) for r in got)
