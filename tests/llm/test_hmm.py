import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from helpers import awkward, clashing, empty, rows
from pyspark.sql import functions as F

from lakecensus.llm import hmm
from lakecensus.llm.common import table
from lakecensus.llm.minhash import word_list
from lakecensus.llm.queries import op8_hidden_markov_scores


@pytest.fixture
def model():
    rng = np.random.default_rng(0)
    uni = np.zeros(hmm.CLASSES)
    uni[:40] = rng.random(40)
    uni[hmm.END], uni[hmm.UNKNOWN] = 0.3, 0.01
    uni /= uni.sum()
    out = hmm.first_guess(uni, 3)
    out["start"], out["move"] = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3)
    return out, uni, rng


def forward(model, seq):
    """Plain forward-backward: log likelihood lift and expected counts of one sequence."""
    move, lift = model["move"], model["lift"]
    a = [model["start"]]
    for c in seq:
        a.append((a[-1] @ move) * lift[c])
    b = [np.ones(len(move))]
    for c in seq[::-1]:
        b.append(move @ (lift[c] * b[-1]))
    b = b[::-1]
    p = a[-1].sum()
    moves, emit = np.zeros_like(move), np.zeros((hmm.CLASSES, len(move)))
    for t, c in enumerate(seq):
        moves += np.outer(a[t], lift[c] * b[t + 1]) * move / p
        emit[c] += a[t + 1] * b[t + 1] / p
    return math.log(p), a[0] * b[0] / p, moves, emit


def test_forward_and_expected_counts_by_plain_recursion(model, monkeypatch):
    m, _, rng = model
    monkeypatch.setattr(hmm, "STEP", 5)
    monkeypatch.setattr(hmm, "RESCALE", 2)
    seqs = [rng.integers(0, 40, n).tolist() for n in (1, 3, 5, 6, 10, 23, 1, 47)]
    want = [forward(m, s) for s in seqs]
    lens = np.array([len(s) for s in seqs])
    flat = np.concatenate([np.array(s) for s in seqs])
    _, _, lift = hmm.chained(hmm.Segments(flat, lens), m)
    assert lift.tolist() == pytest.approx([w[0] for w in want])
    start, moves, emit, lift = hmm.expected(hmm.Segments(flat, lens), m)
    assert abs(lift - hmm.chained(hmm.Segments(flat, lens), m)[2].sum()) < 1e-9
    assert np.allclose(start, sum(w[1] for w in want)) and np.allclose(moves, sum(w[2] for w in want))
    assert np.allclose(emit, sum(w[3] for w in want))


def test_likelihood_by_listing_all_state_paths(model):
    m, _, _ = model
    seq = [0, 7, 3, 39]
    total = 0.0
    for path in product(range(3), repeat=len(seq) + 1):
        p = m["start"][path[0]]
        for a, b, c in zip(path, path[1:], seq):
            p *= m["move"][a, b] * m["lift"][c, b]
        total += p
    _, _, lift = hmm.chained(hmm.Segments(np.array(seq), np.array([4])), m)
    assert lift[0] == pytest.approx(math.log(total))


def test_training_raises_the_likelihood_and_keeps_a_distribution(model):
    _, uni, rng = model
    seqs = [rng.integers(0, 20, 60) if i % 2 else rng.integers(20, 40, 60) for i in range(40)]
    seg = hmm.Segments(np.concatenate(seqs), np.full(40, 60))
    m, seen = hmm.first_guess(uni, 3), []
    for _ in range(6):
        seen.append(hmm.chained(seg, m)[2].sum())
        assert np.allclose((uni[:, None] * m["lift"]).sum(axis=0), 1) and (m["lift"][hmm.UNKNOWN] == 1).all()
        assert np.allclose(m["move"].sum(axis=1), 1)
        m = hmm.update(m, *hmm.expected(seg, m)[:3], uni)
    assert all(b > a - 1 for a, b in zip(seen, seen[1:])) and seen[-1] > seen[0] + 100


def base_scores(docs, held):
    counts, ends = Counter(), 0
    for d, t in docs:
        if not held(d):
            counts.update(word_list(t))
            ends += 1
    tokens = sum(counts.values()) + ends
    every = tokens + len(counts) + (ends > 0) + 1
    return {d: (len(w) + 1, sum(x in counts for x in w) + (ends > 0), tokens,
                sum(math.log10((counts[x] + 1) / every) for x in w) + math.log10((ends + 1) / every))
            for d, w in ((d, word_list(t)) for d, t in docs)}


def fold(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    want = base_scores([(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()], fold)
    got = op8_hidden_markov_scores(spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        n, known, tokens, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, tokens, fold(r["doc_id"]))
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_awkward_rows_and_blocks(spark):
    held = F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    docs = awkward(spark)
    out = hmm.score(docs, held, most_rounds=1)
    want = Counter()
    pairs = [(i, r["doc_id"], r["text"]) for i, r in enumerate(docs.collect())]
    scores = base_scores([(i, t) for i, _, t in pairs], lambda i: (pairs[i][1] or 1) % 3 == 0)
    for i, d, _ in pairs:
        want[d, *scores[i][:3], round(scores[i][3], 3)] += 1
    got = Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in out.collect())
    assert got == want
    other = hmm.score(clashing(docs), held, most_rounds=1)
    assert rows(other.selectExpr("doc_id", "round(score, 6)")) == rows(out.selectExpr("doc_id", "round(score, 6)"))
    assert rows(hmm.score(empty(spark), held)) == []


def test_without_training_rows_the_base_is_the_score(spark):
    out = hmm.score(awkward(spark).where("doc_id in (1, 6)"), F.lit(True)).collect()
    assert len(out) == 2
    for r in out:
        assert (r["train_tokens"], r["n_known"]) == (0, 0) and r["score"] == pytest.approx(r["base_score"]) == 0.0


def test_scores_of_all_documents_by_the_plain_recursion(spark):
    """The query's scores with its own trained model, word by word."""
    import zlib
    from collections import Counter

    import pandas as pd

    from helpers import words
    from lakecensus.llm.common import table

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows_, facts = hmm.sequences(docs, held)
    model = hmm.baum_welch(rows_, facts)
    gains = model["gains"]
    assert gains == sorted(gains) and gains[-1] - gains[-2] < hmm.TOLERANCE <= gains[-2] - gains[-3]
    texts = {r["doc_id"]: ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words(r["text"])] for r in docs.collect()}
    train = {i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2}
    counts = Counter(w for i in train for w in texts[i])
    hashes = dict(zip(counts, pd.util.hash_array(np.array([w.encode() for w in counts], dtype=object), categorize=False).view(np.int64)))
    own = {w: n for n, w in enumerate(sorted(counts, key=lambda w: (-counts[w], hashes[w]))[:hmm.OWN])}
    every = sum(counts.values()) + len(train) + len(counts) + 1 + 1
    assert facts["tokens"] == sum(counts.values()) + len(train) and facts["types"] == len(counts) + 1

    def plain(ws):
        a, log, base = model["start"], 0.0, 0.0
        for w in [*ws, None]:
            cls = hmm.END if w is None else own.get(w, hmm.OWN + zlib.crc32(w.encode()[-3:]) % hmm.SUFFIXES) if w in counts else hmm.UNKNOWN
            a = (a @ model["move"]) * model["lift"][cls]
            log, a = log + np.log10(a.sum()), a / a.sum()
            base += np.log10((len(train) if w is None else counts[w]) + 1) - np.log10(every)
        return log + base, base

    got = {r["doc_id"]: (r["score"], r["base_score"]) for r in hmm.scored(rows_, model).withColumn("doc_id", F.col("id").cast("long")).collect()}
    assert set(got) == set(texts)
    for i, ws in texts.items():
        assert np.allclose(got[i], plain(ws), rtol=1e-9, atol=1e-6), i
