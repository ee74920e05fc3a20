import zlib
from itertools import groupby

import numpy as np
import pytest
from helpers import awkward, clashing, empty, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakecensus.llm import packing, tokencount
from lakecensus.llm.common import table
from lakecensus.llm.queries import SEPARATOR, op7_token_counts, op9_packing, tokenizer_path


def whole(text, plain=False):
    tok = packing.tokenizer(tokenizer_path(), plain)
    return tok.model.encode(text or "", add_special_tokens=False).ids


ODD = st.text(alphabet=st.one_of(st.sampled_from(list("abzABZ019.,!?;:&%$#*|<>' \t\n\x0b\x1c\x85\xa0éÉßİΣσςǅﬁ日あ😀́")),
                                 st.characters(exclude_categories=["Cs"])), max_size=40)


@settings(max_examples=500, deadline=None)
@given(ODD, st.booleans())
def test_words_give_the_ids_of_whole_texts(text, plain):
    tok = packing.tokenizer(tokenizer_path(), plain)
    assert np.frombuffer(tok.encode([text])[0], tok.dtype).tolist() == whole(text, plain)


def test_words_of_documents_and_special_tokens(spark, monkeypatch):
    texts = [r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    texts += ["a<|endoftext|>, b", "<|ENDOFTEXT|>. x", "<|startoftext|>", "don't 's. I'LL", "x" * 3000 + " y"]
    tok = packing.tokenizer(tokenizer_path())
    monkeypatch.setattr(packing, "CACHED", 50)  # forgets again and again
    assert [np.frombuffer(x, tok.dtype).tolist() for x in tok.encode(texts)] == [whole(t) for t in texts]
    assert tok.simple


def check(docs, packed, window):
    """Every id in one piece; sequences gapless and full but the last."""
    ids = {}
    for r in docs.collect():
        ids.setdefault(r["doc_id"], []).append(whole(r["text"]) + [2])
    got = packed.collect()
    flat = {}
    for r in got:
        flat.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r))
    total = sum(len(x) for v in ids.values() for x in v)
    assert sorted(flat) == list(range(-(-total // window)))
    for seq, parts in flat.items():
        at = 0
        for offset, length, _ in sorted(parts, key=lambda p: p[0]):
            assert offset == at and length > 0
            at += length
        assert at == (window if seq < len(flat) - 1 else total - window * (len(flat) - 1))
    for key, mine in groupby(sorted(got, key=lambda r: repr(r["doc_id"])), key=lambda r: r["doc_id"]):
        mine = sorted(mine, key=lambda r: (r["sequence_id"], r["offset"]))
        texts, at = [], []
        for r in mine:
            if r["start"] == 0:
                texts.append([])
            assert r["start"] == len(texts[-1])
            texts[-1] += np.frombuffer(r["ids"], "<u4").tolist()
            at.append(r["doc_tokens"])
        assert sorted(texts) == sorted(ids[key]) and {len(t) for t in texts} == set(at)


@pytest.mark.parametrize("window", [7, 4096])
def test_packing_round_trip(spark, window):
    docs = awkward(spark).repartition(5)
    check(docs, packing.pack(docs, tokenizer_path(), window), window)
    check(docs, packing.pack(clashing(docs), tokenizer_path(), window), window)
    assert rows(packing.pack(empty(spark), tokenizer_path(), window)) == []


def test_packing_query(spark):
    sf = "/root/testdata/sf0.001"
    text = {r["doc_id"]: whole(r["text"]) + [2] for r in table(spark, sf, "documents").collect()}
    got = op9_packing(spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(text)
    for r in got:
        part = text[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(text[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())


def counted(stream, separator):
    """(start, tokens, closed) of the documents of one flat stream."""
    out, start = [], 0
    for i, x in enumerate(stream):
        if x == separator:
            out.append((start, i - start, True))
            start = i + 1
    return out + ([(start, len(stream) - start, False)] if start < len(stream) else [])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 9]), max_size=30), min_size=1, max_size=4), st.integers(1, 6))
def test_separator_scan_by_brute_force(spark, files, block):
    parts = [(f, b, np.array(ids[b * block:(b + 1) * block], dtype="<u2").tobytes())
             for f, ids in enumerate(files) for b in range(-(-len(ids) // block))]
    blocks = spark.createDataFrame([(f, b, bytearray(p)) for f, b, p in parts], "file int, block long, payload binary")
    got = sorted((r["file"], r["doc_no"], r["start"], r["n_tokens"], r["closed"])
                 for r in tokencount.count_tokens(blocks, 9, 2).collect())
    assert got == [(f, i, *d) for f, ids in enumerate(files) for i, d in enumerate(counted(ids, 9))]


def test_null_and_empty_payloads(spark):
    blocks = spark.createDataFrame([(0, 0, None), (1, 0, bytearray()), (2, 0, bytearray(b"\x01\x00")), (2, 1, None)],
                                   "file int, block long, payload binary")
    assert [tuple(r) for r in tokencount.count_tokens(blocks, 9, 2).collect()] == [(2, 0, 0, 1, False)]
    nulls = spark.createDataFrame([(None, None, bytearray(b"\x01\x00")), (None, 3, bytearray(b"\x01\x00\x09\x00"))],
                                  "file int, block long, payload binary")
    assert [tuple(r) for r in tokencount.count_tokens(nulls, 9, 2).collect()] == [(None, 0, 0, 2, True)]


def test_flat_files_and_their_counts(spark, tmp_path):
    docs = awkward(spark).repartition(3)
    blocks = tokencount.flat_files(docs, tokenizer_path(), SEPARATOR, block=100).cache()
    got = sorted(r["n_tokens"] for r in tokencount.count_tokens(blocks, SEPARATOR, 2).collect())
    assert got == sorted(len(whole(r["text"], True)) for r in docs.collect())
    for f, parts in groupby(sorted(blocks.collect(), key=lambda r: (r["file"], r["block"])), key=lambda r: r["file"]):
        (tmp_path / f"{f}.bin").write_bytes(b"".join(r["payload"] for r in parts))
    again = tokencount.count_tokens(tokencount.read_flat_files(spark, str(tmp_path), 2, block=64), SEPARATOR, 2)
    assert sorted(r["n_tokens"] for r in again.collect()) == got and again.where("not closed").count() == 0
    assert tokencount.flat_files(empty(spark), tokenizer_path(), SEPARATOR).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 9]), max_size=40), min_size=1, max_size=3), st.integers(1, 3))
def test_scan_of_ranges_by_brute_force(spark, files, ranges):
    parts = [(f, b, bytearray(np.array(ids[b * 2:b * 2 + 2], dtype="<u2").tobytes()))
             for f, ids in enumerate(files) for b in range(-(-len(ids) // 2))]
    blocks = spark.createDataFrame(parts, "file int, block long, payload binary")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(tokencount, "RANGE", ranges)
        got = sorted(tuple(r) for r in tokencount.count_tokens(blocks, 9, 2).collect())
    assert got == [(f, i, *d) for f, ids in enumerate(files) for i, d in enumerate(counted(ids, 9))]


@pytest.mark.parametrize("block", [3, 64, 1 << 16])
def test_files_are_read_in_byte_ranges(spark, tmp_path, block):
    folder = tmp_path / "a folder, 100% odd"
    folder.mkdir()
    streams = {"a b.bin": [9] * 5 + [1] * 700 + [9], "é#%20.bin": [1] * 130, "empty.bin": [], "c.bin": [9, 9, 2]}
    for name, ids in streams.items():
        (folder / name).write_bytes(np.array(ids, dtype="<u4").tobytes() + (b"xyz" if name == "c.bin" else b""))
    got = sorted((r["file"].split("/")[-1], *tuple(r)[1:])
                 for r in tokencount.count_flat_files(spark, str(folder), 9, 4, block).collect())
    assert got == sorted((name, i, *d) for name, ids in streams.items() for i, d in enumerate(counted(ids, 9)))
    for r in tokencount.read_flat_files(spark, str(folder), 4, block).groupBy("file").agg(
            F.sum(F.octet_length("payload")).alias("n")).collect():
        assert r["n"] == 4 * len(streams[r["file"].split("/")[-1]])


def test_a_file_beyond_two_gigabytes(spark, tmp_path):
    tokens = (1 << 30) + 50  # of two bytes; the file has a hole and takes no disk
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate(2 * tokens)
        for at in (7, (1 << 30) + 20):
            f.seek(2 * at)
            f.write(np.array([9], dtype="<u2").tobytes())
    got = sorted(tuple(r)[1:] for r in tokencount.count_flat_files(spark, str(tmp_path), 9, 2, 1 << 20).collect())
    assert got == [(0, 0, 7, True), (1, 8, (1 << 30) + 12, True), (2, (1 << 30) + 21, 29, False)]


def test_written_files_and_their_documents(spark, tmp_path):
    for docs, n in ((awkward(spark).repartition(3), "a"), (clashing(awkward(spark)), "b")):
        folder = f"file://{tmp_path}/{n}"
        keys = tokencount.write_flat_files(docs, tokenizer_path(), folder, SEPARATOR)
        (tmp_path / n / "999999-lost.bin").write_bytes(b"\x01\x00")  # what a lost attempt left
        got = tokencount.count_documents(keys, folder, SEPARATOR, 2, block=100).collect()
        assert sorted((repr(r["doc_id"]), r["n_tokens"]) for r in got) == sorted(
            (repr(r["doc_id"]), len(whole(r["text"], True))) for r in docs.collect())
        assert all(r["closed"] for r in got) and len({(r["file"], r["start"]) for r in got}) == len(got)
    keys = tokencount.write_flat_files(empty(spark), tokenizer_path(), f"{tmp_path}/c", SEPARATOR)
    assert rows(tokencount.count_documents(keys, f"{tmp_path}/c", SEPARATOR, 2)) == []


def test_file_systems_of_paths():
    for path in ("/a b/c%20.bin", "file:/a b/c%20.bin", "file:///a b/c%20.bin"):
        system, where = tokencount.file_system(path)
        assert system.type_name == "local" and where == "/a b/c%20.bin"


def test_token_count_query(spark):
    sf = "/root/testdata/sf0.001"
    got = op7_token_counts(spark, sf).collect()
    want = {r["doc_id"]: len(whole(r["text"], True)) for r in table(spark, sf, "documents").collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want and len(got) == len(want)
    assert all(r["closed"] for r in got)
