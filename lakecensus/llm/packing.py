"""Packing by concatenate and cut.

Pass 1 tokenises every document in the scan, counts a running offset inside its partition and
stages the ids. The partitions' totals are summed to global offsets (one light row per
partition). Pass 2 cuts every document at the fixed window borders of the one long stream: a
document that crosses a border gives a boundary record per window. No text or id is shuffled.

Defined cases: null and empty texts are one end token; repeated rows are packed like any other;
a document longer than a window spans several; only the last window of all is not full; an empty
table gives no rows. ``key`` is carried as it is, null included.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lakecensus.llm.common import staged

WINDOW = 4096
END_ID = 2
CACHED = 500_000  # most words a worker remembers; beyond it starts again
LONGEST_CACHED = 64
TAIL = b".,!?;:&%$#*|"
_STEM_ENDS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_LOADED: dict[tuple[str, bool], "WordTokenizer"] = {}


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in a byte-level vocabulary: a printable byte is its own,
    the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer(dict):
    """Word -> ids as little-endian bytes of ``dtype``, for a tokenizer that lower-cases, drops white
    space and never joins letters with other signs. Words are remembered; a new one is put together
    from its stem and its tail of signs. Stems of letters alone need none of the tokenizer's text
    steps and go straight to its merges; anything else is encoded as it is."""

    def __init__(self, path: str, plain: bool = False):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = plain  # their strings in a text are then ordinary text
        self.code, self.dtype = ("H", "<u2") if self.model.get_vocab_size() <= 1 << 16 else ("I", "<u4")
        steps = json.loads(self.model.to_str())
        kinds = [[x["type"] for x in (steps[a] or {}).get(b, [])]
                 for a, b in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        self.simple = kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]
        self.merges, self.signs = self.model.model.tokenize, _byte_signs()

    def _ids(self, ids) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _encode(self, word: bytes) -> bytes:
        text = word.decode()
        if self.simple and text.isalpha() and unicodedata.is_normalized("NFC", text):
            lower = "".join(map(str.lower, text))  # sign by sign, as the tokenizer does
            if lower.isalpha():
                mapped = lower if lower.isascii() else "".join(map(self.signs.__getitem__, lower.encode()))
                return self._ids([t.id for t in self.merges(mapped)])
        return self._ids(self.model.encode(text, add_special_tokens=False).ids)

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(TAIL)
        if not self.simple or b"<|" in word or not stem or stem[-1] not in _STEM_ENDS:  # <| may begin a special token
            ids = self._encode(word)
        else:
            lower, tail = stem.lower(), word[len(stem):]
            ids = self._encode(word) if lower == word else self[lower] + (self[tail] if tail else b"")
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHED:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        # bytes are split at the six ASCII white-space characters, which no token holds
        return [b"".join(map(self.__getitem__, t.encode().split())) for t in texts]


def tokenizer(path: str, plain: bool = False) -> WordTokenizer:
    if (path, plain) not in _LOADED:
        _LOADED[path, plain] = WordTokenizer(path, plain)
    return _LOADED[path, plain]


def token_stream(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 end_id: int = END_ID) -> DataFrame:
    """Rows of (key, part, start in the part, n_tokens, ids as little-endian bytes of ``width``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, at, tok = TaskContext.get().partitionId(), 0, tokenizer(path)
        end = np.array([end_id], dtype=tok.dtype).tobytes()
        width = len(end)
        for batch in batches:
            ids = [x + end for x in tok.encode([t or "" for t in batch["text"]])]
            n = np.array([len(x) // width for x in ids], dtype=np.int64)
            ends = at + np.cumsum(n)
            yield pd.DataFrame({"key": batch["key"], "part": part, "start": ends - n, "n_tokens": n,
                                "width": width, "ids": ids})
            at = int(ends[-1]) if len(n) else at

    kind = docs.schema[key].dataType.simpleString()
    # keys travel as strings: pandas would make floats of integers beside a null
    return docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(
        run, "key string, part int, start long, n_tokens long, width int, ids binary"
    ).withColumn("key", F.col("key").cast(kind))


def global_offsets(stream: DataFrame) -> DataFrame:
    """(part, base): tokens in all parts before; one light row per partition of the stream."""
    totals = stream.groupBy("part").agg(F.max(F.col("start") + F.col("n_tokens")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def cut(stream: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of (key, start, length, doc_tokens, sequence_id, offset, ids as unsigned 32-bit)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            first, n = b["at"].to_numpy(), b["n_tokens"].to_numpy()
            pieces = (first + n - 1) // window - first // window + 1  # windows that a document meets
            row = np.repeat(np.arange(len(b)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            seq = first[row] // window + nth
            lo = np.maximum(first[row], seq * window)
            hi = np.minimum(first[row] + n[row], (seq + 1) * window)
            start = lo - first[row]
            ids, widths = b["ids"].tolist(), b["width"].tolist()
            cuts = [np.frombuffer(ids[r], f"<u{widths[r]}")[s:e].astype("<u4").tobytes()
                    for r, s, e in zip(row.tolist(), start.tolist(), (start + hi - lo).tolist())]
            yield pd.DataFrame({"key": b["key"].take(row).array, "start": start, "length": hi - lo,
                                "doc_tokens": n[row], "sequence_id": seq, "offset": lo - seq * window, "ids": cuts})

    kind = stream.schema["key"].dataType.simpleString()
    # the offsets have one row of 12 bytes per partition of the stream, whatever the rows
    placed = stream.join(F.broadcast(global_offsets(stream)), "part")
    return placed.select(F.col("key").cast("string"), "n_tokens", "width", "ids",
                         (F.col("base") + F.col("start")).alias("at")).mapInPandas(
        run, "key string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    ).withColumn("key", F.col("key").cast(kind))


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    return cut(staged(token_stream(docs, path, key, text, end_id), "tokens"), window).withColumnRenamed("key", key)
