"""Ranked lexical search of many items at once, with shared subexpressions evaluated once.

A score is a sum over an item's terms, so items that share terms share partial sums.

1. ``compile_items`` mines the sharing. Terms that stand in exactly the same items are one *leaf*.
   An item is the row of its leaves, those of most items first; a pair of neighbours that two or
   more rows hold becomes a *node*, round after round, until no pair is shared. Leaves, nodes and
   items are a DAG of sums: each node has two parts, each item the few that are left of its row.
2. ``postings`` reads every text once: number of terms, and how often each term of the items stands
   in it. Documents, terms and document frequencies are counted from it, over all documents.
3. ``scores`` turns postings into partial accumulators, leaf by document, once a batch; nodes add two
   rows of them, items a few. A partition keeps each item's best ``k`` so far, whatever it reads.
4. The partitions' best are ranked by item.

Items are taken in blocks of about ``BLOCK_TERMS`` terms (one pass over the documents each), so that
what a worker holds is bounded however many items there are; a longer item is a block by itself.

Terms are maximal runs of ASCII letters and digits and of any signs beyond ASCII; A to Z are
lower-cased. All but a term's weight is 64-bit integer arithmetic (``CONSTANTS`` below).

Defined cases: null texts have no terms; an item without terms and a document without an item's
terms don't rank; equal scores rank by ascending key, a null key last; repeated documents rank each;
the rows of a repeated item are one item with all their terms; a null item is an item; other columns
are ignored, whatever their names; without documents or items there are no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecensus.llm.common import staged

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")  # the same on UTF-8 bytes after lower-casing
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BEST = 50
BLOCK_TERMS = 100_000
SPAN = 1 << 22  # bytes of a text whose terms are listed at once
CELLS = 1 << 21  # accumulators of a batch
KEPT_CELLS = 1 << 18  # candidates that a partition holds before it drops all but each item's best
# constants of the score: weight scale; length floor and slope (of 100); numerator; tf and length factors
WEIGHT, FLOOR, SLOPE, TOP, TF, LENGTH = 1000, 50, 50, 1_000_000_000, 1000, 20


class Plan(NamedTuple):
    """Items compiled to sums. Accumulators are numbered leaves first, then nodes by level."""

    vocabulary: dict[bytes, int]
    leaf: np.ndarray  # by term
    leaves: int
    levels: list[tuple[int, np.ndarray, np.ndarray]]  # first node of the level, its nodes' two parts
    size: int  # accumulators
    parts: np.ndarray  # of all items, one item after the other
    first: np.ndarray  # by item: where its parts begin
    ids: list

    def additions(self) -> int:
        """Additions a document costs, beside those that make the leaves."""
        return self.size - self.leaves + len(self.parts) - len(self.ids)


def compile_items(items: dict) -> Plan:
    """Item -> its set of terms; items without terms are left out."""
    ids = [i for i, terms in items.items() if terms]
    holders: dict[bytes, list[int]] = defaultdict(list)
    for n, i in enumerate(ids):
        for term in items[i]:
            holders[term].append(n)
    together: dict[tuple, list[bytes]] = defaultdict(list)
    for term, where in holders.items():
        together[tuple(where)].append(term)
    # most shared first: like rows begin alike
    groups = sorted(together.items(), key=lambda g: (-len(g[0]), g[0]))
    vocabulary, leaf, rows = {}, [], [[] for _ in ids]
    for number, (where, terms) in enumerate(groups):
        for term in sorted(terms):
            vocabulary[term] = len(leaf)
            leaf.append(number)
        for n in where:
            rows[n].append(number)

    made: dict[tuple[int, int], int] = {}
    parts: list[tuple[int, int] | None] = [None] * len(groups)
    while True:
        seen = Counter(pair for row in rows for pair in {*zip(row, row[1:])})
        if not any(n > 1 for n in seen.values()):
            break
        for r, row in enumerate(rows):
            out, at = [], 0
            while at < len(row):
                pair = (row[at], row[at + 1]) if at + 1 < len(row) else None
                if pair and seen[pair] > 1 and (at + 2 >= len(row) or seen[pair] >= seen[row[at + 1], row[at + 2]]):
                    if pair not in made:
                        made[pair] = len(parts)
                        parts.append(pair)
                    out.append(made[pair])
                    at += 2
                else:
                    out.append(row[at])
                    at += 1
            rows[r] = out

    level = [0] * len(parts)
    for n in range(len(groups), len(parts)):  # parts come before their node
        level[n] = 1 + max(level[p] for p in parts[n])
    order = sorted(range(len(parts)), key=lambda n: (level[n], n))
    place = {n: at for at, n in enumerate(order)}
    levels, at = [], len(groups)
    while at < len(order):
        end = at
        while end < len(order) and level[order[end]] == level[order[at]]:
            end += 1
        two = [[place[p] for p in parts[n]] for n in order[at:end]]
        levels.append((at, np.array([a for a, _ in two]), np.array([b for _, b in two])))
        at = end
    flat = np.array([place[p] for row in rows for p in row], dtype=np.int64)
    first = np.cumsum([0, *(len(row) for row in rows)])[:-1] if rows else np.zeros(0, np.int64)
    return Plan(vocabulary, np.array(leaf, dtype=np.int64), len(groups), levels, len(parts), flat, first, ids)


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def _spans(data: bytes) -> Iterator[bytes]:
    """A text in spans that end where no term goes on."""
    at = 0
    while len(data) - at > SPAN:
        gap = data.find(b" ", at + SPAN)
        if gap < 0:
            break
        yield data[at:gap]
        at = gap
    yield data[at:] if at else data


def counted(text: str | None, vocabulary: dict[bytes, int]) -> tuple[int, dict[bytes, int]]:
    """Terms with repeats, and how often each term of the vocabulary stands in a text."""
    n, tf = 0, Counter()
    for span in _spans((text or "").encode().lower()):  # of bytes, lower() changes A to Z alone
        found = _TERM_BYTES.findall(span)
        n += len(found)
        tf.update(filter(vocabulary.__contains__, found))
    return n, tf


def postings(docs: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    """Rows of (key, n, terms, tf) for documents with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = plan.vocabulary
        for batch in batches:
            ns, which, often = [], [], []
            for value in batch.column("text").to_pylist():
                n, tf = counted(value, number)
                ns.append(n)
                which.append([number[t] for t in tf])
                often.append([*tf.values()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(ns, pa.int64()), pa.array(which, pa.list_(pa.int32())),
                 pa.array(often, pa.list_(pa.int64()))], ["key", "n", "terms", "tf"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, n long, terms array<int>, tf array<long>").where("n > 0")


def weights(listed: DataFrame, plan: Plan, documents: int) -> np.ndarray:
    """By term: floor(1000 ln((2 N + 2) / (2 df + 1))); as many numbers as the block has terms."""
    df = listed.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(WEIGHT * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1))).cast("long")
    out = np.zeros(len(plan.leaf), dtype=np.int64)
    for term, w in df.select("term", weight).toLocalIterator():
        out[term] = w
    return out


def scores(listed: DataFrame, plan: Plan, weight: np.ndarray, documents: int, tokens: int, k: int,
           item_type: str) -> DataFrame:
    """Each partition's best k documents of each item: (item, key, score)."""
    kind = listed.schema["key"].dataType.simpleString()
    width = max(16, CELLS // max(1, plan.size))

    def batch_scores(batch: pa.RecordBatch) -> np.ndarray:
        docs = batch.num_rows
        terms_, tf = batch.column("terms"), batch.column("tf")
        term = terms_.flatten().to_numpy(zero_copy_only=False)
        often = tf.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        of = np.repeat(np.arange(docs), np.diff(terms_.offsets.to_numpy()))
        length = FLOOR + SLOPE * batch.column("n").to_numpy().astype(np.int64) * documents // tokens
        part = weight[term] * (TOP * often // (TF * often + LENGTH * length[of]))
        acc = np.zeros((plan.size, docs), dtype=np.int64)
        np.add.at(acc.reshape(-1), plan.leaf[term] * docs + of, part)
        for start, a, b in plan.levels:
            acc[start:start + len(a)] = acc[a] + acc[b]
        return np.add.reduceat(acc[plan.parts], plan.first, axis=0)

    def best(items: np.ndarray, keys: pa.Array, got: np.ndarray) -> tuple:
        rank = pc.rank(keys, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy()
        order = np.lexsort((rank, -got, items))
        sorted_items = items[order]
        starts = np.flatnonzero(np.r_[True, sorted_items[1:] != sorted_items[:-1]])
        nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        take = order[nth < k]
        return items[take], keys.take(pa.array(take)), got[take]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n_held, limit = 0, max(KEPT_CELLS, 2 * k * len(plan.ids))
        least = np.zeros(len(plan.ids), dtype=np.int64)  # an item's k-th best so far

        def shrink() -> None:
            nonlocal held, n_held
            one = best(np.concatenate([h[0] for h in held]), pa.concat_arrays([h[1] for h in held]),
                       np.concatenate([h[2] for h in held]))
            held, n_held = [one], len(one[0])
            full = np.flatnonzero(np.bincount(one[0], minlength=len(least)) >= k)
            low = np.full(len(least), np.iinfo(np.int64).max)
            np.minimum.at(low, one[0], one[2])
            least[full] = low[full]

        for whole in batches:
            for at in range(0, whole.num_rows, width):
                batch = whole.slice(at, width)
                got = batch_scores(pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([c]) for c in batch.columns], batch.schema.names))
                items, docs = np.nonzero((got > 0) & (got >= least[:, None]))
                if len(items):
                    held.append((items, batch.column("key").take(pa.array(docs)), got[items, docs]))
                    n_held += len(items)
                if n_held > limit:
                    shrink()
        if held:
            shrink()
            items, keys, got = held[0]
            ids = pa.array(plan.ids)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(items)), keys, pa.array(got)], ["item", "key", "score"])

    return listed.mapInArrow(run, f"item {item_type}, key {kind}, score long")


def _blocks(items: DataFrame, item: str, text: str) -> Iterator[dict]:
    """Items with their terms, a block of about BLOCK_TERMS at a time."""
    found = staged(items.select(F.col(item).alias("item"), F.explode(F.array_distinct(terms(F.col(text)))).alias("term"))
                   .distinct(), "search-items")
    n = -(-found.count() // BLOCK_TERMS)
    for b in range(n):
        block: dict = {}
        mine = found.where(F.pmod(F.xxhash64(F.coalesce(F.col("item").cast("string"), F.lit(""))), F.lit(n)) == b)
        for i, term in mine.orderBy("item", "term").toLocalIterator():
            block.setdefault(i, set()).add(term.encode())
        if block:
            yield block


def search(docs: DataFrame, items: DataFrame, k: int = BEST, key: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k best documents of every item: (item, rank from 1, key, score)."""
    out, sums = [], None
    item_type, key_type = (df.schema[c].dataType.simpleString() for df, c in ((items, item), (docs, key)))
    for block in _blocks(items, item, item_text):
        plan = compile_items(block)
        listed = staged(postings(docs, plan, key, text), "search-postings")
        sums = sums or listed.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("tokens")).first()
        if not sums["documents"]:
            break
        out.append(scores(listed, plan, weights(listed, plan, sums["documents"]), sums["documents"], sums["tokens"], k, item_type))
    if not out:
        return docs.sparkSession.createDataFrame([], f"`{item}` {item_type}, rank int, `{key}` {key_type}, score long")
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return (reduce(DataFrame.unionAll, out).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score"))
