"""The prefix trie against brute force over dictionaries of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import words
from lakecensus.llm import trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def nodes_of(sequences):
    """{conv_id: [(sign, words), ...]} -> the rows of every node."""
    members, last, ends = defaultdict(list), {(): 0}, defaultdict(list)
    for c, steps in sequences.items():
        for d in range(len(steps) + 1):
            node = tuple(s for s, _ in steps[:d])
            members[node].append(c)
            if d:
                last[node] = steps[d - 1][1]
        ends[tuple(s for s, _ in steps)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        kids = children[node]
        below[node] = (sum(below[k][0] for k in kids) if kids else 1,
                       (len(members[node]) - 1) * last[node] + sum(below[k][1] for k in kids))
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), *below[n],
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items()), key=repr)


def rebuilt(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            turns[c].append(((turn is not None, turn or 0, role, digest), ((role, text), len(words(text)))))
    own = {c: [step for _, step in sorted(t, key=lambda x: x[0])] for c, t in turns.items()}
    out = {}
    for c, steps in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(first, [])[:h] + steps[h:]
    return out


def got(df):
    assert tuple(df.columns) == T.RESULT
    return sorted(map(tuple, df.collect()), key=repr)


def sequence_rows(spark, sequences):
    rows = [(c, [s.encode() for s, _ in steps], [w for _, w in steps]) for c, steps in sequences.items()]
    return spark.createDataFrame(rows, "conv_id long, digests array<binary>, words array<long>").repartition(3)


def drawn(r, n, signs, longest, copies):
    out = {}
    weight = {}
    while len(out) < n:
        steps = [r.choice(signs) for _ in range(r.randint(0, longest))]
        for _ in range(r.choice(copies)):
            out[r.randint(-500, 10**6)] = [(s, weight.setdefault(tuple(steps[:i + 1]), r.randint(0, 9))) for i, s in enumerate(steps)]
    return out


@pytest.mark.parametrize("n,signs,longest,copies,ranges", [
    (60, "ab", 5, [1], 8), (120, "a", 6, [1, 2, 9], 8), (200, "abc", 4, [1, 1, 30], 40), (90, "ab", 30, [1, 2], 23),
    (40, "abcdefgh", 3, [1], 64), (150, "a", 2, [40], 11)])
def test_sequences_over_many_ranges(spark, n, signs, longest, copies, ranges):
    sequences = drawn(random.Random(n), n, signs, longest, copies)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        assert got(T.trie(sequence_rows(spark, sequences))) == nodes_of(sequences)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_open_nodes_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(T, "BROADCAST_OPEN", 0)
    sequences = drawn(random.Random(1), 80, "ab", 6, [1, 2])
    assert got(T.trie(sequence_rows(spark, sequences))) == nodes_of(sequences)


def test_equal_and_empty_sequences(spark):
    same = {c: [("a", 3), ("b", 4)] for c in range(70)}
    assert got(T.trie(sequence_rows(spark, same))) == nodes_of(same)
    none = {c: [] for c in range(30)}
    assert got(T.trie(sequence_rows(spark, none))) == nodes_of(none)
    one = {7: [("a", 1)]}
    assert got(T.trie(sequence_rows(spark, one))) == nodes_of(one)


def awkward_rows():
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant"]), f"text {r.randint(0, 3)} of a few words") for c in range(45) for t in range(r.randint(1, 6))]
    rows += [(60, None, "user", "no turn"), (60, 0, "user", "turn nought"), (60, None, "system", "no turn either"), (60, 0, None, None),
             (61, 1, "user", ""), (61, 1, "user", ""), (62, 0, "user", None), (None, 0, "user", "no conversation"), (None, None, None, None),
             (80, 0, "a", "bc"), (81, 0, "ab", "c"), (-7, 0, "user", "below nought"), (-7, 1, "user", "and more"), (0, 9, "user", "w " * 50_000)]
    rows += [(100 + c, 0, "user", "the same") for c in range(25)]
    return rows + [(203, t, "user", f"turn {t} of a long one") for t in range(700)]


def test_awkward_conversations(spark):
    rows = awkward_rows()
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.selectExpr("*", "'x' AS rng", "'y' AS digests", "1 AS words", "2 AS pos", "'z' AS depth", "3 AS turns", "4 AS _head")
    assert got(T.conversation_trie(extra)) == nodes_of(rebuilt(rows))
    # whatever the order of the rows
    assert got(T.conversation_trie(df.repartition(5))) == got(T.conversation_trie(df.coalesce(1)))


def test_empty_table(spark):
    assert got(T.conversation_trie(spark.createDataFrame([], SCHEMA))) == []
    assert got(T.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-1, 5), min_size=1, max_size=40), st.data())
def test_sparse_table_searches(values, data):
    table = T.Minima(np.array(values))
    at = data.draw(st.integers(0, len(values) - 1))
    floor = data.draw(st.integers(-1, 6))
    right, left = at, at
    while right + 1 < len(values) and values[right + 1] >= floor:
        right += 1
    while left > 0 and values[left] >= floor:
        left -= 1
    one, bound = np.array([at]), np.array([floor])
    assert table.right(one, bound).tolist() == [right] and table.left(one, bound).tolist() == [left]
    to = data.draw(st.integers(at, len(values) - 1))
    assert table.least(one, np.array([to])).tolist() == [min(values[at:to + 1])]
