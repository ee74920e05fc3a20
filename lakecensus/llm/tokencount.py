"""Token counts of flat token files by a separator scan.

A flat file is a run of token ids without an index; documents end with a separator id. Blocks of
it are searched on their own, one vector comparison each, and give their separators' places. The
documents are stitched by a prefix scan over the blocks of a file: a block's first token is the
sum of the lengths before, and the separator before it is the last one of any earlier block. The
scan reads four numbers a block, inside ranges of blocks first and then over the ranges' sums, so that no
task holds a file's blocks; only places of separators are shuffled, never a token.

Files are listed by Spark, without their contents, and read in byte ranges inside tasks, whatever their size:
any file system that pyarrow opens by its URI serves. ``write_flat_files`` makes such files of documents and
lists each file's keys in order, which ties the counts to documents again.

Defined cases: a file's blocks are numbered by distinct numbers in order, null
first; a null file is a file; a null payload is an empty block; consecutive separators bound documents without
tokens; tokens after a file's last separator are a document that isn't ``closed``; a file without
separators is one such document; a file without tokens has none; bytes after a file's last whole token are left out.
Written files: a null text is empty; null and repeated keys are listed as they are; an empty table gives no file.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from lakecensus.llm.common import partitions, staged
from lakecensus.llm.packing import tokenizer

BLOCK = 1 << 16  # tokens
SPAN = 64  # blocks that one row of the list of byte ranges stands for
RANGE = 4096  # blocks that one task scans on its own


def flat_files(docs: DataFrame, path: str, separator: int, block: int = BLOCK, text: str = "text") -> DataFrame:
    """Documents as flat token files (a special token's string in a text is ordinary text), one per partition of the scan, in rows of (file, block,
    payload): little-endian ids, the separator after every document, cut without regard to them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, at, tok = TaskContext.get().partitionId(), 0, tokenizer(path, plain=True)
        end = np.array([separator], dtype=tok.dtype).tobytes()
        size, rest = block * len(end), b""
        for b in batches:
            rest += b"".join(x + end for x in tok.encode([t or "" for t in b["text"]]))
            full = len(rest) // size
            if full:
                yield pd.DataFrame({"file": file, "block": np.arange(at, at + full),
                                    "payload": [rest[i * size:(i + 1) * size] for i in range(full)]})
                at, rest = at + full, rest[full * size:]
        if rest:
            yield pd.DataFrame({"file": [file], "block": [at], "payload": [rest]})

    return docs.select(F.col(text).alias("text")).mapInPandas(run, "file int, block long, payload binary")


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI as Spark writes it, and the path there."""
    named = re.match(r"([A-Za-z][A-Za-z0-9+.-]+):(.*)", uri, re.DOTALL)
    if not named or named[1] == "file":
        return fs.LocalFileSystem(), "/" + (named[2] if named else uri).lstrip("/")
    return fs.FileSystem.from_uri(quote({"s3a": "s3", "s3n": "s3"}.get(named[1], named[1]) + f":{named[2]}", safe=":/@"))


def write_flat_files(docs: DataFrame, path: str, folder: str, separator: int, key: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """Write documents to flat token files under ``folder``, one per partition of the scan, the separator after every
    document; return each file's keys in order, rows of (file, doc_no, key).

    An attempt of a task writes a file of its own name. The list is staged at once, so that it names the files of
    the attempts that Spark committed; what a lost one left behind is in the folder and not in the list."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok, at, out = tokenizer(path, plain=True), 0, None
        end = np.array([separator], dtype=tok.dtype).tobytes()
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        system, where = file_system(folder)
        try:
            for b in batches:
                if out is None and len(b):
                    system.create_dir(where, recursive=True)
                    out = system.open_output_stream(f"{where}/{name}")
                for ids in tok.encode([t or "" for t in b["text"]]):
                    out.write(ids + end)
                yield pd.DataFrame({"file": name, "doc_no": np.arange(at, at + len(b)), "key": b["key"]})
                at += len(b)
        finally:
            if out is not None:
                out.close()

    # keys travel as strings: pandas would make floats of integers beside a null
    listed = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(
        run, "file string, doc_no long, key string")
    return staged(listed, "flat-keys").withColumn("key", F.col("key").cast(docs.schema[key].dataType))


def spans(spark: SparkSession, paths, width: int, block: int = BLOCK) -> DataFrame:
    """Byte ranges of SPAN blocks of the files, rows of (file, span, length of the file), dealt evenly over tasks.

    Spark lists the files; their contents aren't read."""
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    last = F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / (SPAN * block * width))
    return files.select(F.col("path").alias("file"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("span"),
                        "length").repartition(partitions(spark), "file", "span")


def _blocks(b: pd.DataFrame, width: int, block: int) -> Iterator[tuple[str, int, bytes]]:
    """The blocks of some byte ranges, read one at a time."""
    size = block * width
    for file, span, length in zip(b["file"], b["span"], b["length"]):
        system, where = file_system(file)
        whole = length // width * width
        with system.open_input_file(where) as f:
            for at in range(span * SPAN, (span + 1) * SPAN):
                if at * size < whole or at == 0:
                    yield file, at, f.read_at(min(size, whole - at * size), at * size)


def read_flat_files(spark: SparkSession, paths, width: int, block: int = BLOCK) -> DataFrame:
    """Flat token files on storage as rows of (file, block, payload)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, at, payload in _blocks(b, width, block):
                yield pd.DataFrame({"file": [file], "block": [at], "payload": [payload]})

    return spans(spark, paths, width, block).mapInPandas(run, "file string, block long, payload binary")


def search_flat_files(spark: SparkSession, paths, separator: int, width: int, block: int = BLOCK) -> DataFrame:
    """``separators`` of flat files on storage: a block's tokens are compared where they are read and go no further."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, at, payload in _blocks(b, width, block):
                ids = np.frombuffer(payload, dtype=f"<u{width}")
                yield pd.DataFrame({"file": [file], "block": [at], "n": [len(ids)], "at": [np.flatnonzero(ids == separator)]})

    return spans(spark, paths, width, block).mapInPandas(run, "file string, block long, n long, at array<long>")


def separators(blocks: DataFrame, separator: int, width: int) -> DataFrame:
    """Per block: its number of tokens and the places of separators in it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = [np.frombuffer(p or b"", dtype=f"<u{width}") for p in b["payload"]]
            yield pd.DataFrame({"file": b["file"], "block": b["block"], "n": [len(x) for x in ids],
                                "at": [np.flatnonzero(x == separator) for x in ids]})

    kind = blocks.schema["file"].dataType.simpleString()
    return blocks.select("file", "block", "payload").mapInPandas(
        run, f"file {kind}, block long, n long, at array<long>")


def scan(light: DataFrame, size: int) -> DataFrame:
    """Rows of (file, block, n, closings, end: place of the last separator) with the sums over all blocks before:
    ``first`` token, ``docs`` closed, ``last`` separator (-1: none), and whether a block is its file's ``tail``."""
    light = light.withColumn("rng", F.floor(F.col("block") / size))
    inside = Window.partitionBy("file", "rng").orderBy("block")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = light.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).select(
        "file", "rng", "block", "n", "first", "closings", (F.col("first") + F.col("end")).alias("here"),
        F.coalesce(F.sum("closings").over(before), F.lit(0)).alias("docs"),
        F.max(F.col("first") + F.col("end")).over(before).alias("last"),
        F.row_number().over(inside).alias("nth"))
    sums = local.groupBy("file", "rng").agg(F.sum("n").alias("n"), F.sum("closings").alias("closings"),
                                            F.max("here").alias("here"), F.count(F.lit(1)).alias("size"))
    over = Window.partitionBy("file").orderBy("rng")
    ahead = over.rowsBetween(Window.unboundedPreceding, -1)
    base = sums.withColumn("b_first", F.coalesce(F.sum("n").over(ahead), F.lit(0))).select(
        F.col("file").alias("b_file"), F.col("rng").alias("b_rng"), "b_first", "size",
        F.coalesce(F.sum("closings").over(ahead), F.lit(0)).alias("b_docs"),
        F.coalesce(F.max(F.col("b_first") + F.col("here")).over(ahead), F.lit(-1)).alias("b_last"),
        F.lead("size").over(over).isNull().alias("ends"))
    return local.join(base, _same("file", "b_file") & _same("rng", "b_rng")).select(
        "file", "block", (F.col("b_first") + F.col("first")).alias("first"), "closings",
        (F.col("b_docs") + F.col("docs")).alias("docs"),
        F.coalesce(F.col("b_first") + F.col("last"), F.col("b_last")).alias("last"),
        (F.col("ends") & (F.col("nth") == F.col("size"))).alias("tail"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def stitch(found: DataFrame) -> DataFrame:
    """Documents of searched blocks: rows of (file, doc_no, start, n_tokens without the separator, closed)."""
    found = staged(found, "separators")
    # the scan runs over four numbers a block; the places join its result by block
    light = found.select("file", "block", "n", F.size("at").cast("long").alias("closings"),
                         F.get("at", F.size("at") - 1).alias("end"))
    places = found.select(F.col("file").alias("_file"), F.col("block").alias("_block"), "n", "at")
    placed = scan(light, RANGE).join(places, _same("file", "_file") & _same("block", "_block"))
    ends = F.transform("at", lambda p: F.col("first") + p)
    # the tail after a file's last separator ends at the file's end
    tail = F.when(F.col("tail"), F.array(F.col("first") + F.col("n"))).otherwise(F.array().cast("array<long>"))
    ends = placed.withColumn("ends", F.concat(ends, tail))
    starts = ends.select("file", "docs", "closings", "ends", F.concat(F.array("last"), "ends").alias("marks"))
    rows = starts.select("file", "docs", "closings", "marks", F.posexplode("ends").alias("i", "end"))
    out = rows.select(
        "file", (F.col("docs") + F.col("i")).alias("doc_no"), (F.get("marks", "i") + 1).alias("start"),
        (F.col("end") - F.get("marks", "i") - 1).alias("n_tokens"), (F.col("i") < F.col("closings")).alias("closed"))
    return out.where("closed or n_tokens > 0")


def count_tokens(blocks: DataFrame, separator: int, width: int) -> DataFrame:
    """``stitch`` of flat files given as rows of (file, block, payload)."""
    return stitch(separators(blocks, separator, width))


def count_flat_files(spark: SparkSession, paths, separator: int, width: int, block: int = BLOCK) -> DataFrame:
    """``stitch`` of flat files on storage; ``file`` is the path."""
    return stitch(search_flat_files(spark, paths, separator, width, block))


def count_documents(keys: DataFrame, folder: str, separator: int, width: int, key: str = "doc_id",
                    block: int = BLOCK) -> DataFrame:
    """The counts of ``write_flat_files``' files by document: (key, file, doc_no, start, n_tokens, closed)."""
    spark = keys.sparkSession
    if keys.isEmpty():
        return keys.select(F.col("key").alias(key), "file", "doc_no", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("start", "long"), ("n_tokens", "long"), ("closed", "boolean"))])
    found = count_flat_files(spark, folder, separator, width, block).withColumn("file", F.regexp_extract("file", "[^/]+$", 0))
    return keys.join(found, ["file", "doc_no"], "left").select(
        F.col("key").alias(key), "file", "doc_no", "start", "n_tokens", "closed")
