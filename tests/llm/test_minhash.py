import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from helpers import DOCS, PROSE, awkward, clashing, empty, rows

from lakecensus.llm import minhash
from lakecensus.llm.common import table


def shingles(text):
    ws = minhash.word_list(text)
    return frozenset(tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))) if ws else frozenset()


def brute(pairs):
    """{node: (set size, component)} by comparing all texts that share a shingle."""
    sets, where = [(d, shingles(t)) for d, t in pairs], defaultdict(list)
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(i)
    for i, (d, s) in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x] if j > i).items():
            e, t = sets[j]
            if 100 * n >= 75 * (len(s) + len(t) - n):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets}


def check(docs):
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r["doc_id"]
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    return got


def test_documents_by_brute_force(spark):
    assert len(check(table(spark, "/root/testdata/sf0.001", "documents"))) == 200


def edited(rng, base, n):
    out = list(base)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def group(spark):
    """One large group of near copies around the threshold, chains, copies, and others."""
    rng = random.Random(3)
    base = [rng.choice(PROSE) + str(rng.randrange(9)) for _ in range(150)]
    texts = [edited(rng, base, rng.randrange(0, 14)) for _ in range(300)]
    chain = [rng.choice(PROSE) + str(rng.randrange(99)) for _ in range(200)]
    for i in range(12):  # each links with its neighbours only
        texts.append(" ".join(chain))
        chain = chain[22:] + [f"c{i}-{k}" for k in range(22)]
    texts += [texts[5]] * 40 + [" ".join(rng.sample(PROSE, 30)) for _ in range(50)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return spark.createDataFrame([(i * 3 - 7, texts[k], "en", "a", 1) for i, k in enumerate(order)], DOCS)


def test_large_group_and_chains_by_brute_force(group):
    check(group)


def test_tiles_lose_no_link(group, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 16)
    check(group.where("doc_id % 2 = 0"))


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = minhash.near_duplicates(docs)
    by = {r["doc_id"]: r for r in got.collect() if r["doc_id"] is not None}
    assert [by[d]["component_id"] for d in (1, 2, 3, 4, 8, 9)] == [1, 1, 1, 1, 8, 8]
    assert [(by[d]["n_shingles"], by[d]["component_id"], by[d]["kept"]) for d in (5, 6, 7)] == [(0, d, True) for d in (5, 6, 7)]
    assert (by[8]["n_shingles"], by[14]["n_shingles"]) == (1, 11996)
    null = sorted((r["component_id"] or 0, r["kept"]) for r in got.collect() if r["doc_id"] is None)
    assert null == [(0, True), (1, False)]  # a text of its own, and a copy of document 1
    assert rows(minhash.near_duplicates(clashing(docs))) == rows(got)
    assert rows(minhash.near_duplicates(empty(spark))) == []
    kept = minhash.kept_documents(clashing(docs))
    assert kept.columns == clashing(docs).columns
    want = brute({(r["doc_id"], r["text"]) for r in docs.where("doc_id is not null").collect()})
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, *sorted(d for d, (_, c) in want.items() if d == c)]


def test_circulant_signature_by_its_definition():
    sigma, _ = minhash._permutations()
    rng = np.random.default_rng(minhash.SEED)
    rng.permutation(1 << minhash.UNIVERSE_BITS)
    pi = rng.permutation(1 << minhash.UNIVERSE_BITS)
    hashes = minhash.shingle_hashes([minhash.word_list(" ".join(PROSE))])[0]
    places = sigma[(hashes >> np.uint64(44)).astype(np.int64)].astype(np.int64)
    want = [int(pi[(places + k) % len(pi)].min()) & 0xFFFF for k in range(minhash.COORDINATES)]
    assert minhash.signature(hashes).tolist() == want


def test_signatures_estimate_similarity():
    rng = random.Random(1)
    errors = []
    for _ in range(40):
        base = [str(rng.randrange(10 ** 9)) for _ in range(300)]
        a, b = minhash.shingle_hashes([minhash.word_list(" ".join(base)), minhash.word_list(edited(rng, base, rng.randrange(30)))])
        both = len(np.intersect1d(a, b))
        errors.append((minhash.signature(a) == minhash.signature(b)).mean() - both / (len(a) + len(b) - both))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 200)]
    got = dict(minhash.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


def test_signatures_drop_fewer_pairs_than_the_bands():
    n, low = minhash.COORDINATES, math.ceil(minhash.MIN_EST * minhash.COORDINATES)
    tail = sum(math.comb(n, k) * 0.75 ** k * 0.25 ** (n - k) for k in range(low))
    assert tail < (1 - 0.75 ** minhash.ROWS) ** minhash.BANDS < 3e-7
    one = np.arange(n, dtype="<u2")
    for agree, found in ((low, 1), (low - 1, 0)):
        other = np.where(np.arange(n) < agree, one, one + 1000).astype("<u2")
        tile = pd.DataFrame({"comp": [1, 2], "own": [0, 0], "n": [90, 100], "b1": 0, "b2": 0,
                             "sketch": [one.tobytes(), other.tobytes()]})
        assert len(minhash._across(tile)[0]) == found
