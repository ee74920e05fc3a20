"""Document fingerprints: a Merkle tree over sections, paragraphs and runs of words.

A paragraph is a line. Within it, a run of words ends at white space after TAIL bytes that hash to
a multiple of RUN, so borders depend on the words next to them alone and an edit moves no others; a run of more than
LONGEST bytes is cut into pieces of that length.
A section ends at a blank line or after any paragraph whose hash is a multiple of SECTION.
Leaves are digests of runs, a paragraph's digest is taken over its leaves', a section's over its
paragraphs', the root over its sections'. The fingerprint is the root (equal roots: equal texts)
and the leaves, with | between sections and , between paragraphs: equal stretches of it are equal
subtrees, so two fingerprints are compared from the top and only differing branches are opened.

Likeness is the share of leaves in common: matched leaves / the larger number of leaves.

Defined cases: null texts count as empty; empty texts have a root and no leaf, and are alike;
repeated keys and null keys have an order (nulls first, then by the text's CRC-32, then by text); the last document's next
is the first, of a single document itself; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecensus.llm.common import crc32, hot_splits, partitions, range_of

RUN = 8
LONGEST = 256  # bytes of a run; longer ones are cut from their start
TAIL = 6  # bytes before a white space that decide whether a run ends there
SECTION = 4
LEAF = 8  # hex digits of a leaf in the fingerprint
MAX_RANGES = 8192
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _runs(raw: bytes) -> tuple[list[int], list[int]]:
    """Ends of the word runs of a text and the paragraph each is in; a line feed ends both."""
    b = np.frombuffer(raw, dtype=np.uint8)
    line_ends = np.flatnonzero(b == 0x0A)
    at = np.flatnonzero(_WHITE[b])
    at = at[at >= TAIL]
    key = np.zeros(len(at), dtype=np.uint64)
    for i in range(1, TAIL + 1):
        key = (key << np.uint64(8)) | b[at - i]
    mixed = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    ends = np.union1d(at[mixed % RUN == 0], line_ends) + 1
    if not len(ends) or ends[-1] != len(b):
        ends = np.append(ends, len(b))
    starts = np.append(0, ends[:-1])
    for s, e in zip(starts[ends - starts > LONGEST].tolist(), ends[ends - starts > LONGEST].tolist()):
        ends = np.append(ends, np.arange(s + LONGEST, e, LONGEST))
    ends.sort()
    return ends.tolist(), np.searchsorted(line_ends, ends - 1).tolist()


def tree(text: str | None) -> tuple[str, list[list[list[str]]]]:
    """(root, sections of paragraphs of leaf digests), all in hex."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    sections: list[list[list[str]]] = []
    digests: list[bytes] = []
    if raw:
        ends, lines = _runs(raw)
        paragraphs: list[tuple[list[bytes], bool]] = []
        start, line = 0, -1
        for end, at in zip(ends, lines):
            run = raw[start:end]
            if at != line:
                paragraphs.append(([], True))
                line = at
            paragraphs[-1][0].append(_digest(run))
            if run.strip():
                paragraphs[-1] = (paragraphs[-1][0], False)
            start = end
        open_, parts = [], []
        for leaves, blank in paragraphs:
            digest = _digest(b"".join(leaves))
            open_.append([x.hex()[:LEAF] for x in leaves])
            parts.append(digest)
            if blank or digest[0] % SECTION == 0:
                sections.append(open_)
                digests.append(_digest(b"".join(parts)))
                open_, parts = [], []
        if open_:
            sections.append(open_)
            digests.append(_digest(b"".join(parts)))
    return _digest(b"".join(digests)).hex(), sections


def fingerprint(text: str | None) -> str:
    root, sections = tree(text)
    return root + ":" + "|".join(",".join("".join(p) for p in s) for s in sections)


@lru_cache(maxsize=2)
def recent_fingerprint(text: str) -> str:
    """``fingerprint``, remembered: in a scan by key a document's next is the next one's own."""
    return fingerprint(text)


def _branches(fp: str) -> tuple[str, list[str]]:
    root, _, rest = fp.partition(":")
    return root, rest.split("|") if rest else []


def _split_leaves(parts: Counter) -> Counter:
    out: Counter = Counter()
    for p, n in parts.items():
        for i in range(0, len(p), LEAF):
            out[p[i:i + LEAF]] += n
    return out


def _opened(branches: Counter, mark: str) -> Counter:
    out: Counter = Counter()
    for branch, n in branches.items():
        for x in branch.split(mark):
            out[x] += n
    return out


def _leaf_count(fp: str) -> int:
    rest = fp.partition(":")[2]
    return (len(rest) - rest.count("|") - rest.count(",")) // LEAF


def likeness(a: str, b: str) -> float:
    """Share of leaves in common, found from the top: equal sections, then equal paragraphs of
    the others, then equal leaves of what remains."""
    if a == b:
        return 1.0
    (ra, sa), (rb, sb) = _branches(a), _branches(b)
    most = max(_leaf_count(a), _leaf_count(b))
    if ra == rb or most == 0:
        return 1.0
    same, left, right = 0, Counter(sa), Counter(sb)
    for mark in ("|", ",", ""):
        if mark == ",":
            left, right = _opened(left, ","), _opened(right, ",")
        elif mark == "":
            left, right = _split_leaves(left), _split_leaves(right)
        both = left & right
        same += sum((len(x) - x.count(",")) // LEAF * n for x, n in both.items())
        left, right = left - both, right - both
    return same / most


def edits(a: str, b: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """The (section, paragraph) places of each fingerprint whose branch the other doesn't have."""

    def differing(x: str, y: str) -> list[tuple[int, int]]:
        (_, sx), (_, sy) = _branches(x), _branches(y)
        have = Counter(sy)
        rest, out = [], []
        for i, s in enumerate(sx):
            if have[s] > 0:
                have[s] -= 1
            else:
                rest.append((i, s))
        paragraphs = Counter(p for s, n in have.items() for _ in range(n) for p in s.split(","))
        for i, s in rest:
            for j, p in enumerate(s.split(",")):
                if paragraphs[p] > 0:
                    paragraphs[p] -= 1
                else:
                    out.append((i, j))
        return out

    return differing(a, b), differing(b, a)


def edited_text(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the next text's beginning (or all)."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every document, in the scan."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint, na_action=None)

    return docs.select(key, run(F.col(text)).alias("fingerprint"))


def key_ranges(key: Column, crc: Column, splits: list, hot: dict, nulls: int) -> tuple[Column, int]:
    """Number of the range of a row in the order of (key, checksum), and how many ranges there are.

    Ranges are cut on the key (nulls first); a key that would fill several, and rows without a key,
    fill as many of their own, cut on the checksum, before the other keys of their range.
    """
    times = [nulls, *(hot.get(s, 0) for s in splits)]  # ranges of the null key, then of each cut point's
    last = [*np.cumsum([m + 1 for m in times])] if times else []
    start = [0, *last[:-1]]

    def listed(values: list) -> Column:
        return F.expr(f"array({', '.join(str(int(v)) for v in values)})")

    def inside(m: Column) -> Column:
        return F.shiftright(crc * m, 32).cast("int")

    r = range_of(key, splits)
    place = F.when(key.isNull(), inside(F.lit(nulls)) if nulls > 1 else F.lit(0))
    if hot:
        cut = F.get(F.expr(f"array({', '.join(map(repr, splits))})"), r - 1)
        m = F.get(listed(times), r)
        place = place.when((m > 0) & (key == cut), F.get(listed(start), r) + inside(m))
    return place.otherwise(F.get(listed(last), r) - 1).cast("int"), int(last[-1])


def with_next(docs: DataFrame, each, columns: dict[str, str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and ``each(text, next text)``, named and typed by ``columns``, for every document in
    ascending order of key.

    Rows are cut into ranges of about equal numbers, on the key and, inside keys that fill several
    ranges, on the text's checksum. A range's task reads its documents in order, and, as a guest, the
    first document of the next range (of the first range, after the last), so that texts are shuffled
    once and no task holds more than two of them.
    """
    spark = docs.sparkSession
    splits, hot, nulls = hot_splits(docs, key, min(MAX_RANGES, partitions(spark)))
    light = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rng, ranges = key_ranges(F.col("key"), crc32(F.col("text")), splits, hot, nulls)
    ranged = light.withColumn("rng", rng)
    # the range before, by the ranges that have rows: at most 2 * MAX_RANGES + 1 of them; texts are read
    # here only where a key is hot
    heads = ranged.groupBy("rng").agg(F.min("key").alias("head"), F.max(F.col("key").isNull()).alias("nulls")).collect()
    heads.sort(key=lambda r: r["rng"])
    before = {r["rng"]: heads[i - 1]["rng"] for i, r in enumerate(heads)}
    guests = [(before[r["rng"]], r["rng"], None if r["nulls"] else r["head"]) for r in heads]
    kind = docs.schema[key].dataType.simpleString()
    guest_rows = spark.createDataFrame(guests, f"host int, g_rng int, head {kind}")
    ordered = ranged.withColumn("crc", crc32(F.col("text")))
    first = ordered.join(F.broadcast(guest_rows), (F.col("rng") == F.col("g_rng")) & F.col("key").eqNullSafe(F.col("head"))) \
        .groupBy("host").agg(F.min(F.struct("crc", "text", "key")).alias("g")) \
        .select(F.col("g.key").alias("key"), F.col("g.text").alias("text"), F.col("host").alias("rng"),
                F.col("g.crc").alias("crc"), F.lit(True).alias("guest"))
    rows = ordered.withColumn("guest", F.lit(False)).unionByName(first) \
        .repartitionById(ranges, "rng").sortWithinPartitions("rng", "guest", "key", "crc", "text").drop("crc") \
        .withColumn("key", F.col("key").cast("string"))  # pandas would make floats of integers beside a null

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the document that waits for its next
        for b in batches:
            out = []
            for r in zip(b["rng"], b["guest"], b["key"], b["text"]):
                if held is not None and held[0] == r[0]:
                    out.append((held[2], *each(held[3], r[3])))
                held = None if r[1] else r
            if out:
                yield pd.DataFrame(out, columns=[key, *columns])

    done = rows.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in {key: "string", **columns}.items()))
    return done.withColumn(key, F.col(key).cast(kind))
