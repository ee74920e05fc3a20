"""Byte-level BPE against the tiktoken library, against the plain merges, and back to the text."""

import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import awkward, clashing, empty
from lakecensus.llm import bytebpe
from lakecensus.llm.queries import op13_byte_bpe

PATHS = [P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_multi_50k.tiktoken")]
PATH = PATHS[0]


def library(path):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bytebpe.read_ranks(path), special_tokens={})


def ids(packed):
    return [i for i, in struct.iter_unpack("<I", packed)]


@pytest.mark.parametrize("path", PATHS)
def test_tokens_fit_as_the_merges_say(path):
    ranks = bytebpe.read_ranks(path)
    t, r = bytebpe.Transducer(ranks), random.Random(5)
    tokens = list(ranks.values())
    short = [i for i in tokens if len(t.bytes_of[i]) <= 3]
    answers = set()
    for n in range(20000):
        pair = [r.choice(short if n % 2 else tokens) for _ in range(2)]
        two = [t.bytes_of[i] for i in pair]
        answers.add(want := bytebpe.merge(ranks, b"".join(two)) == two)
        assert t.fits(*pair) == want, two
    assert answers == {True, False}


def test_small_vocabularies_of_any_order():
    # ranks in any order, tokens that no merge makes, tokens lower than their parts
    r = random.Random(11)
    for _ in range(60):
        more = {bytes(r.choice(b"abc") for _ in range(r.randint(2, 5))) for _ in range(r.randint(1, 14))}
        order = r.sample(range(256, 256 + len(more)), len(more))
        ranks = {bytes([b]): b for b in range(256)} | dict(zip(sorted(more), order))
        t = bytebpe.Transducer(ranks, max_states=r.choice([2, 5, 1000]))
        for _ in range(60):
            piece = bytes(r.choice(b"abcd") for _ in range(r.randint(1, 24)))
            want = [ranks[piece]] if piece in ranks else [ranks[x] for x in bytebpe.merge(ranks, piece)]
            assert t.encode(piece) == want, (ranks, piece)


@pytest.mark.parametrize("path", PATHS)
def test_texts_as_the_library(path):
    c, lib = bytebpe.Codec(path, P.PATTERN), library(path)
    r = random.Random(3)
    signs = ["a", "aa", "the", "ing", " ", "\n", "é", "日本", "😀", "x", "1", "!!", "'s", "\t", "\x85", "\x1c", "  ", "ß", " s"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 100_000, "".join(r.choice("abcdef") for _ in range(60_000)), " " * 30_000 + "x", "=-" * 20_000, "<|endoftext|>"]
    for text in texts:
        packed = c.encode(text)
        assert ids(packed) == lib.encode_ordinary(text) and c.decode(packed) == text


def test_long_texts_give_their_pieces_one_by_one(monkeypatch):
    c = bytebpe.Codec(PATH, P.PATTERN)
    text = "some words, and 'll more of them  \n\n at the end " * 50
    listed = c.encode(text)
    monkeypatch.setattr(bytebpe, "LONG_TEXT", 10)
    assert c.encode(text) == listed


def test_pieces_and_states_are_forgotten_beyond_the_bounds(monkeypatch):
    monkeypatch.setattr(bytebpe, "MAX_PIECES", 3)
    c, lib = bytebpe.Codec(PATH, P.PATTERN), library(PATH)
    c.transducer.max_states = 4
    text = "a text of more than three different pieces, and far more than four states " * 3
    assert ids(c.encode(text)) == lib.encode_ordinary(text)
    assert len(c) <= 3 and len(c.transducer.states) <= 5


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=12), st.lists(st.integers(0, 12), max_size=3))
def test_utf8_machine_reads_any_portions(data, cuts):
    out, state, at = "", b"", 0
    for cut in [*sorted(min(c, len(data)) for c in cuts), len(data)]:
        chars, state = bytebpe.Utf8Machine.read(state, data[at:cut])
        out, at = out + chars, cut
    assert out + ("�" if state else "") == data.decode(errors="replace")


def test_decodes_ids_of_cut_characters():
    c, lib = bytebpe.Codec(PATH, P.PATTERN), library(PATH)
    whole = lib.encode_ordinary("日本😀é and more")
    for n in range(len(whole)):
        assert c.machine.text(whole[n:]) == lib.decode(whole[n:]) and c.machine.text(whole[:n]) == lib.decode(whole[:n])


def expected(text):
    t = text or ""
    got = library(PATH).encode_ordinary(t)
    return (len(got), hashlib.sha256(struct.pack(f"<{len(got)}I", *got)).hexdigest(),
            hashlib.sha256(t.encode()).hexdigest())


def test_awkward_rows(spark):
    docs = clashing(awkward(spark)).cache()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = bytebpe.digests(docs, PATH, P.PATTERN).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *expected(t))) for i, t in texts)
    # the operator keeps the other columns and replaces one that is named like its own
    both = bytebpe.decode(bytebpe.encode(docs, PATH, P.PATTERN), PATH, P.PATTERN, text="again")
    assert set(both.columns) == {*docs.columns, "again"} and both.schema["ids"].dataType.simpleString() == "binary"
    back = both.collect()
    assert sorted((r["again"], r["key"]) for r in back) == sorted((t or "", "x-key") for _, t in texts)
    assert bytebpe.digests(empty(spark), PATH, P.PATTERN).collect() == []


def test_query_is_the_library(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in op13_byte_bpe(spark, sf).collect()}
    assert got == {d["doc_id"]: expected(d["text"]) for d in docs}


def test_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError):
        bytebpe.Transducer({b"a": 0})
