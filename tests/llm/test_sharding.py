import hashlib
import math
import zlib

import pytest
from helpers import awkward, clashing, empty, rows

from lakecensus.llm import sharding


def brute(key, weights):
    best = None
    for s, w in enumerate(weights):
        u = (int(hashlib.md5(f"{'null' if key is None else key}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        score = -w / math.log(u)
        if best is None or score > best[0]:
            best = (score, s)
    return best[1]


@pytest.mark.parametrize("weights", [[1.0] * 5, [3.0, 1.0, 0.5], [2.0]])
def test_shard_of_every_key_by_brute_force(spark, weights):
    docs = awkward(spark)
    out = sharding.shard(docs, weights).collect()
    assert len(out) == docs.count()
    for r in out:
        assert r["shard"] == brute(r["doc_id"], weights)
        assert r["grown_shard"] == brute(r["doc_id"], [*weights, weights[-1]])
    text = {r["doc_id"]: r["text"] for r in docs.where("doc_id is not null").collect()}
    for r in out:
        if r["doc_id"] is not None:
            raw = (text[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))


def test_slots_are_gapless_and_ordered(spark):
    docs = spark.range(3000).selectExpr("id * 7 - 900 as doc_id", "cast(id as string) as text")
    out = sharding.shard(docs, [1.0] * 16).collect()
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append((r["slot"], r["doc_id"]))
    for got in by.values():
        got.sort()
        assert [s for s, _ in got] == list(range(len(got)))
        assert [d for _, d in got] == sorted(d for _, d in got)
    assert len(by) == 16 and max(map(len, by.values())) < 2 * min(map(len, by.values()))


def test_growth_moves_rows_only_into_the_new_shard(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'' as text")
    out = sharding.shard(docs, [1.0] * 15 + [2.0], [1.0] * 15 + [2.0, 1.0]).collect()
    moved = [r for r in out if r["shard"] != r["grown_shard"]]
    assert all(r["grown_shard"] == 16 for r in moved) and 0.7 < len(moved) / (4000 / 18) < 1.3
    heavy = sum(r["shard"] == 15 for r in out)
    assert 1.6 < heavy / (4000 / 17) < 2.4


@pytest.mark.parametrize("chunk", [1, 7, 10000])
def test_hot_keys_and_copies_are_numbered_in_order(spark, monkeypatch, chunk):
    monkeypatch.setattr(sharding, "CHUNK", chunk)
    made = spark.range(2000).selectExpr(
        # keys: null, 5 and -3 hold most rows; texts: one of them mostly the same
        "case when id % 3 = 0 then null when id % 3 = 1 then 5 when id % 5 = 0 then -3 else id end as doc_id",
        "case when id % 3 = 1 and id % 7 > 0 then 'same' when id % 11 = 0 then null else cast(id % 400 as string) end as text")
    out = sharding.shard(made, [1.0, 2.0, 1.0]).collect()
    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, zlib.crc32((r["text"] or "").encode()),
                   len((r["text"] or "").encode()) + 1) for r in made.collect())
    for s in range(3):
        got = sorted((r["slot"], r["doc_id"], r["text_crc32"], r["size"]) for r in out if r["shard"] == s)
        assert [g[0] for g in got] == list(range(len(got)))
        mine = [w for w in want if brute(w[1] if w[0] else None, [1.0, 2.0, 1.0]) == s]
        assert [(k is not None, k or 0, c, n) for _, k, c, n in got] == mine


def test_hot_keys_get_ranges_of_their_own(spark):
    from lakecensus.llm.common import hot_splits

    docs = spark.range(900).selectExpr("case when id % 3 = 0 then null when id % 3 = 1 then 5 else id end as doc_id")
    splits, hot, nulls = hot_splits(docs, "doc_id", 12)
    assert list(hot) == [5] and 5 <= hot[5] <= 7 and nulls == 4 and splits == sorted(set(splits))
    assert hot_splits(docs.limit(0), "doc_id", 12) == ([], {}, 1) == hot_splits(docs, "doc_id", 1)


def test_other_columns_and_empty_tables(spark):
    docs = awkward(spark)
    assert rows(sharding.shard(clashing(docs), [1.0] * 4)) == rows(sharding.shard(docs, [1.0] * 4))
    assert rows(sharding.shard(empty(spark), [1.0] * 4)) == []
    with pytest.raises(ValueError):
        sharding.rendezvous(docs["doc_id"], [1.0, 0.0])
