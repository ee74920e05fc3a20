"""Ranked search against brute force; the compiled sums against plain sums."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import PROSE, awkward, clashing, empty
from lakecensus.llm import search as S

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans(S.UPPER, S.LOWER)


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k=50):
    docs = [(i, Counter(terms(t))) for i, t in docs]
    docs = [(i, tf, sum(tf.values())) for i, tf in docs if tf]
    n_docs, tokens = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, tf, _ in docs for t in tf)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in wanted.items():
        found = []
        for key, tf, n in docs:
            m = 50 + (50 * n * n_docs) // tokens
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                        for t in ts if tf[t])
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def asked(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


ITEMS = [(1, " ".join(PROSE[:12])), (2, " ".join(PROSE[:6]) + " THE the w5 w77"), (3, None), (4, ""), (5, "nothing-here-at_all zzz"),
         (6, "é\x1cñ ß 日本 x y one"), (7, " ".join(PROSE)), (8, " ".join(PROSE)), (None, "cat moon"), (1, "river boats"), (9, "w1 w2 w3")]


def test_awkward_rows(spark):
    docs, items = awkward(spark), asked(spark, ITEMS)
    want = brute_force([(r["doc_id"], r["text"]) for r in docs.collect()], ITEMS)
    assert {w[0] for w in want} >= {1, 2, 6, 7, 8, 9, None} and not {3, 4} & {w[0] for w in want}
    got = S.search(clashing(docs), items.selectExpr("*", "'x' AS item", "'y' AS term", "1 AS rank", "2 AS key"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_blocks_batches_and_bounded_candidates(spark, monkeypatch):
    docs, items = awkward(spark).repartition(3), asked(spark, ITEMS)
    want = brute_force([(r["doc_id"], r["text"]) for r in docs.collect()], ITEMS, 2)
    for name, value in (("BLOCK_TERMS", 20), ("CELLS", 1), ("KEPT_CELLS", 1), ("SPAN", 40)):
        monkeypatch.setattr(S, name, value)
    assert len(list(S._blocks(items, "item_id", "text"))) > 2
    assert sorted(map(tuple, S.search(docs, items, 2).collect()), key=repr) == want


def test_ties_rank_by_key(spark):
    docs = spark.createDataFrame([(i, "the cat sat") for i in range(200, 100, -1)] + [(None, "the cat sat"), (7, "a dog lay")],
                                 "doc_id long, text string").repartition(7)
    got = S.search(docs, asked(spark, [(1, "cat dog")])).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [7, *range(101, 150)] and [r["rank"] for r in got] == [*range(1, 51)]


def test_empty_tables(spark):
    docs, items = awkward(spark), asked(spark, ITEMS)
    for got in (S.search(empty(spark), items), S.search(docs, asked(spark, [])), S.search(docs, asked(spark, [(1, "--")]))):
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.collect() == []


def test_string_keys(spark):
    docs = awkward(spark).selectExpr("concat('d', doc_id) AS url", "text AS body")
    items = asked(spark, ITEMS).selectExpr("concat('q', item_id) AS name", "text AS question")
    got = S.search(docs, items, 50, "url", "body", "name", "question")
    want = brute_force([(r["doc_id"], r["text"]) for r in awkward(spark).collect()], ITEMS)
    assert sorted(((r["name"], r["score"]) for r in got.collect()), key=repr) == sorted(
        ((i if i is None else f"q{i}", s) for i, _, _, s in want), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 30), st.sets(st.sampled_from([bytes([97 + i]) for i in range(12)]), max_size=12), max_size=14))
def test_compiled_sums_are_the_plain_sums(items):
    plan = S.compile_items(items)
    assert plan.ids == [i for i, ts in items.items() if ts]
    if not plan.ids:
        return
    value = {t: 3 ** n for n, t in enumerate(sorted(plan.vocabulary))}
    acc = np.zeros(plan.size, dtype=np.int64)
    for t, n in plan.vocabulary.items():
        acc[plan.leaf[n]] += value[t]
    for start, a, b in plan.levels:
        assert max(*a, *b) < start  # parts are there before their sum
        acc[start:start + len(a)] = acc[a] + acc[b]
    got = np.add.reduceat(acc[plan.parts], plan.first)
    assert got.tolist() == [sum(value[t] for t in items[i]) for i in plan.ids]
    assert plan.additions() <= sum(len(ts) - 1 for ts in items.values() if ts)


def test_shared_terms_are_summed_once():
    shared = {f"s{n}".encode() for n in range(20)}
    items = {n: shared | {f"own{n}".encode()} for n in range(10)} | {99: shared}
    plan = S.compile_items(items)
    assert plan.leaves == 11 and plan.additions() == 10  # the shared terms are one leaf
    twins = S.compile_items({n: shared for n in range(5)})
    assert twins.leaves == 1 and twins.additions() == 0


def test_long_texts_in_spans():
    text = ("Word ünd 9x-" * 9 + " ") * 200
    whole = S.counted(text, {b"word": 0, "ünd".encode(): 1})
    span, S.SPAN = S.SPAN, 50
    try:
        assert S.counted(text, {b"word": 0, "ünd".encode(): 1}) == whole
        assert S.counted("x" * 500, {}) == (1, Counter())
    finally:
        S.SPAN = span
    assert whole[0] == len(terms(text))


@pytest.mark.parametrize("text", ["İstanbul", "ẞK", "a\x7fb", "A0_z~é{|}"])
def test_terms_of_bytes_and_of_signs_agree(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(S.terms(S.F.col("t"))).first()[0]
    assert got == terms(text) == [t.decode() for t in S._TERM_BYTES.findall(text.encode().lower())]
