import hashlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import awkward, clashing, empty, rows, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakecensus.llm import mixing
from lakecensus.llm.common import table


def highest_quotients(votes, seats, caps):
    got = [0] * len(votes)
    for _ in range(seats):
        free = [(-v / (2 * g + 1), i) for i, (v, g, c) in enumerate(zip(votes, got, caps)) if v > 0 and g < c]
        if not free:
            break
        got[min(free)[1]] += 1
    return got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 40)), min_size=1, max_size=8), st.integers(0, 150))
def test_seats_by_highest_quotients(sides, seats):
    votes, caps = [v for v, _ in sides], [c for _, c in sides]
    assert mixing.sainte_lague(votes, seats, caps).tolist() == highest_quotients(votes, seats, caps)


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]).tolist() == [50, 100, 150]
    # the third may take 30 at most; its excess goes to the others by weight 1 : 2
    got = mixing.targets([100, 190, 10], [1, 2, 3])
    assert got.tolist() == pytest.approx([90, 180, 30])
    assert mixing.targets([0, 10], [1, 2]).tolist() == pytest.approx([0, 10])
    assert mixing.targets([], []).tolist() == []


def seeded(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16)


def brute(docs, block, docs_per_shard, cap=mixing.CAP, seed=mixing.SEED):
    """Every block of every shard by itself."""
    got = docs.collect()
    tag = {id(r): seeded(r["text"] or "") for r in got}
    deal = {id(r): seeded(seed, r["doc_id"], tag[id(r)]) for r in got}
    at = {id(r): seeded(seed + 1, r["doc_id"], tag[id(r)]) for r in got}
    names = sorted({r["source"] for r in got}, key=lambda s: (s is None, s or ""))
    size = [sum(len(words(r["text"])) for r in got if r["source"] == s) for s in names]
    target = mixing.targets(size, [1 + i % 3 for i in range(len(names))], cap)
    shards = defaultdict(list)
    for r in got:
        i = names.index(r["source"])
        n = -(-sum(x["source"] == r["source"] for x in got) // docs_per_shard)
        shards[i, deal[id(r)] % n].append(r)
    count = {k: sum(len(words(r["text"])) for r in v) for k, v in shards.items()}
    blocks = {k: -(-v // block) for k, v in count.items()}
    have = [sum(b for (i, _), b in blocks.items() if i == j) for j in range(len(names))]
    votes = [t * b / s if s else 0 for t, b, s in zip(target, have, size)]
    seats = highest_quotients(votes, round(sum(votes)), [cap * b for b in have])
    taken = defaultdict(int)
    for j in range(len(names)):
        mine = sorted(k for k in shards if k[0] == j)
        quota = highest_quotients([count[k] for k in mine], seats[j], [cap * blocks[k] for k in mine])
        for k, q in zip(mine, quota):
            n, t = blocks[k], count[k]
            if not n:
                continue
            stream = [r["doc_id"] for r in sorted(shards[k], key=lambda r: (at[id(r)], r["doc_id"])) for _ in words(r["text"])]
            start = seeded(seed + 2, j, k[1]) % n
            times = [q // n + ((b - start) % n < q % n) for b in range(n)]
            for b in range(n):
                for d in stream[b * t // n:(b + 1) * t // n]:
                    taken[d] += times[b]
    return {r["doc_id"]: (len(words(r["text"])), size[names.index(r["source"])], target[names.index(r["source"])],
                          taken[r["doc_id"]]) for r in got}


@pytest.mark.parametrize("block,per", [(64, 4096), (7, 12)])
def test_mix_by_brute_force(spark, block, per):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = brute(docs, block, per)
    got = {r["doc_id"]: r for r in mixing.mix(docs, block=block, docs_per_shard=per).collect()}
    assert set(got) == set(want)
    for d, (size, source_size, target, taken) in want.items():
        r = got[d]
        assert (r["size"], r["source_size"], r["taken"]) == (size, source_size, taken), d
        assert r["target"] == pytest.approx(target) and r["taken"] <= 3 * size


def test_sources_meet_their_targets_and_reruns_agree(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = mixing.mix(docs)
    per = out.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] / r["target"] - 1) < 0.01 for r in per)
    assert rows(out) == rows(mixing.mix(docs.repartition(5)))


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = mixing.mix(docs)
    got = out.collect()
    assert len(got) == docs.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert [r["size"] for r in got if r["doc_id"] in (5, 6, 7)] == [0, 0, 0]
    assert rows(mixing.mix(clashing(docs))) == rows(out)
    assert rows(mixing.mix(empty(spark))) == []


def test_mixed_documents_hold_the_words_taken(spark):
    docs = awkward(spark)
    plan = mixing.mix(docs, block=8)
    mixed = mixing.mixed_documents(docs, block=8)
    assert mixed.schema.simpleString() == docs.schema.simpleString()
    got = mixed.collect()
    assert sum(len(words(r["text"])) for r in got) == plan.agg(F.sum("taken")).first()[0]
    whole = {(r["doc_id"], r["text"]) for r in docs.collect()}
    text = defaultdict(set)
    for d, t in whole:
        text[d].add(t)
    for r in got:
        assert any(r["text"] in t for t in text[r["doc_id"]] if t) and r["n_chars"] == len(r["text"])
    assert mixing.mixed_documents(empty(spark)).count() == 0
    assert mixing.mixed_documents(clashing(docs), block=8).count() == len(got)


def test_passage_keeps_white_space():
    assert mixing.passage(" a  b\tc d ", 1, 3) == "b\tc"
    assert np.asarray(mixing.sainte_lague([], 3)).tolist() == []


def test_sql_with_other_parameters_and_bound_caps(spark):
    import duckdb

    from lakecensus.llm.oracles import op6

    docs = awkward(spark, [(100 + i, "a few words " * (i % 9), "en", f"s{i % 4}", 1) for i in range(60)]) \
        .where("doc_id is not null and source is not null").dropDuplicates(["doc_id"])
    got = sorted((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"])
                 for r in mixing.mix(docs, block=7, docs_per_shard=12).collect())
    con = duckdb.connect()
    con.register("frame", docs.toPandas())
    con.execute("CREATE TABLE documents AS SELECT * FROM frame")
    want = con.execute(op6(3, 7, 12, mixing.SEED)).fetchall()
    assert got == sorted((d, n, s, round(t, 6), k) for d, n, s, t, k in want)
    assert any(abs(t - 3 * s) < 1e-6 for _, _, s, t, _ in got)


def test_repeated_rows_take_one_part_each(spark):
    text = "some words that a few rows of this table have in common with others"
    docs = spark.createDataFrame([(1000 + i % 40, text, "en", f"s{i % 40}", 1) for i in range(80)], awkward(spark).schema)
    plan = mixing.mix(docs, block=8).groupBy("doc_id").agg(F.sum("taken").alias("n")).where("n > 0")
    got = defaultdict(int)
    for r in mixing.mixed_documents(docs, block=8).collect():
        got[r["doc_id"]] += len(words(r["text"]))
    assert got == {r["doc_id"]: r["n"] for r in plan.collect()}


def test_numbers_of_a_hot_value_come_from_several_hands(spark):
    rows_ = spark.range(5000).selectExpr("if(id < 4990, 'hot', 'rare') as _mix_same", "id")
    got = mixing._numbered(rows_).collect()
    for name, n in (("hot", 4990), ("rare", 10)):
        assert sorted(r["_mix_nth"] for r in got if r["_mix_same"] == name) == list(range(n))
    assert sorted(r["id"] for r in got) == list(range(5000))
