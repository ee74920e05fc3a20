"""Mixing sources to target weights by Sainte-Laguë apportionment.

1. Sizes (words) are counted once and staged as light rows.
2. Target per source: its weight's share of all words, at most ``cap`` times its own words; the
   excess is reshared by weight until nothing exceeds (water filling).
3. Every source's rows are dealt by a seeded hash into shards of about ``docs_per_shard`` rows;
   a shard's words, in seeded order, are one stream cut into n blocks of about ``block`` words.
4. Seats (blocks) go to sources by the highest quotients target / (2k + 1), then each source's
   seats go to its shards by words / (2k + 1), never above ``cap`` times a shard's blocks.
5. A shard with q seats takes every block q div n times, and q mod n blocks once more: a cyclic
   run of blocks from a seeded start, so that whole documents stay whole but for the run's ends.

Only per-source totals reach the driver. A source holding most rows has as many more shards.
Defined cases: null text has size 0 and nothing is taken from it; null source is a source (last
in order); equal sizes and ids are ordered by the text's MD5; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lakecensus.llm.common import staged, words

BLOCK = 64
DOCS_PER_SHARD = 4096
CAP = 3
SEED = 20240
DEALS = 64  # hands into which the rows of one id and text are dealt to be numbered
CYCLE = (1.0, 2.0, 3.0)
BROADCAST_SOURCES = 100_000  # the facts of more sources are joined by a shuffle


def sainte_lague(votes, seats: int, caps=None) -> np.ndarray:
    """Seats by the highest quotients votes / (2k + 1), at most caps each; ties go to the first.

    Halving finds a divisor d for which rounding votes / d gives just too few seats or the right
    number; those seats are sure, and the rest go one by one to the highest quotients.
    """
    votes = np.asarray(votes, dtype=np.float64)
    caps = np.full(len(votes), np.inf) if caps is None else np.asarray(caps, dtype=np.float64)
    total = votes.sum()
    seats = int(min(seats, caps[votes > 0].sum())) if total > 0 else 0
    got = np.zeros(len(votes), dtype=np.int64)
    if seats <= 0:
        return got
    # a common divisor d that gives too few seats: floor(votes / d + 1/2), capped
    low, high = 0.0, 2.0 * votes.max() + 1.0
    for _ in range(200):
        d = (low + high) / 2
        if d == low or d == high:
            break
        if np.minimum(np.floor(votes / d + 0.5), caps).sum() > seats:
            low = d
        else:
            high = d
    got = np.minimum(np.floor(votes / high + 0.5), caps).astype(np.int64)
    heap = [(-v / (2 * g + 1), i) for i, (v, g, c) in enumerate(zip(votes, got, caps)) if v > 0 and g < c]
    heapq.heapify(heap)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def targets(sizes, weights, cap: float = CAP) -> np.ndarray:
    """Shares of sum(sizes) by weight, none above cap * size, the excess reshared by weight."""
    sizes, weights = np.asarray(sizes, dtype=np.float64), np.asarray(weights, dtype=np.float64)
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool), sizes.sum()
    while free.any():
        share = left * weights / weights[free].sum()
        over = free & (share > cap * sizes)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = cap * sizes[over]
        left -= out[over].sum()
        free &= ~over
    return out


def text_tag(text: Column) -> Column:
    """52 bits of a text's MD5; null is empty."""
    return seeded(F.coalesce(text, F.lit("")))


def seeded(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts, joined by colons; null parts are left out."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 13), 16, 10).cast("long")


def _overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    return F.greatest(F.lit(0), F.least(b, d) - F.greatest(a, c))


def mix(docs: DataFrame, cycle=CYCLE, cap: int = CAP, block: int = BLOCK,
        docs_per_shard: int = DOCS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """One light row per document: doc_id, tag (of its text), size, source_size, target, taken,
    and what is taken: ``times`` whole copies plus the words [a1, b1) and [a2, b2) once more."""
    spark = docs.sparkSession
    sized = staged(docs.select(
        "doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"),
        text_tag(F.col("text")).alias("tag")), "mix-sizes")
    per = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    per.sort(key=lambda r: (r["source"] is None, r["source"] or ""))  # by code point, null last
    size = [r["size"] for r in per]
    target = targets(size, [cycle[i % len(cycle)] for i in range(len(per))], cap)
    facts = spark.createDataFrame(
        [(i, r["source"], int(r["size"]), float(t), -(-r["rows"] // docs_per_shard))
         for i, (r, t) in enumerate(zip(per, target))],
        "src int, name string, source_size long, target double, shards long")
    if len(per) <= BROADCAST_SOURCES:
        facts = F.broadcast(facts)
    keyed = sized.join(facts, sized["source"].eqNullSafe(F.col("name"))).select(
        "doc_id", "src", "size", "tag", "source_size", "target",
        (seeded(F.lit(seed), F.col("doc_id"), F.col("tag")) % F.col("shards")).alias("shard"),
        seeded(F.lit(seed + 1), F.col("doc_id"), F.col("tag")).alias("at"))

    # words and blocks of every shard; seats of every source
    shards = staged(keyed.groupBy("src", "shard").agg(F.sum("size").alias("words"))
                    .withColumn("blocks", F.ceil(F.col("words") / block).cast("long")), "mix-shards")
    room = {r["src"]: r["n"] for r in shards.groupBy("src").agg(F.sum("blocks").alias("n")).collect()}
    blocks = [room.get(i, 0) for i in range(len(per))]
    # a source's blocks hold size / blocks words each, so that targets are met in words
    votes = [t * b / s if s else 0 for t, b, s in zip(target, blocks, size)]
    seats = sainte_lague(votes, round(sum(votes)), [cap * b for b in blocks])
    seat_rows = spark.createDataFrame([(i, int(s)) for i, s in enumerate(seats)], "src int, seats long")

    def deal(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("shard")
        quota = sainte_lague(group["words"], int(group["seats"].iloc[0]), cap * group["blocks"].to_numpy())
        return group.assign(quota=quota)[["src", "shard", "words", "blocks", "quota"]]

    # one group holds a source's shards: rows / docs_per_shard light rows
    quotas = (
        shards.join(seat_rows, "src").groupBy("src")
        .applyInPandas(deal, "src int, shard long, words long, blocks long, quota long")
        .withColumn("start", F.when(
            F.col("blocks") > 0, seeded(F.lit(seed + 2), F.col("src"), F.col("shard")) % F.col("blocks")))
    )
    order = Window.partitionBy("src", "shard").orderBy("at", "doc_id", "tag", "size")
    placed = keyed.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))) \
        .join(quotas, ["src", "shard"], "left")
    begin, extra = F.col("end") - F.col("size"), F.col("quota") % F.col("blocks")

    def cut(j: Column) -> Column:  # first word of block j
        return F.floor(j * F.col("words") / F.col("blocks"))

    stop = F.col("start") + extra
    s1, e1 = cut(F.col("start")), cut(F.least(stop, F.col("blocks")))
    e2 = cut(F.greatest(F.lit(0), stop - F.col("blocks")))  # the run's part that wraps to the front
    zero = F.lit(0).cast("long")
    whole = F.col("size") > 0

    def some(c: Column) -> Column:
        return F.coalesce(F.when(whole & (F.col("blocks") > 0), c), zero).cast("long")

    return placed.select(
        "doc_id", "tag", "size", "source_size", "target",
        some(F.floor(F.col("quota") / F.col("blocks"))).alias("times"),
        some(F.greatest(s1, begin) - begin).alias("a1"),
        some(F.greatest(s1, begin) - begin + _overlap(begin, F.col("end"), s1, e1)).alias("b1"),
        zero.alias("a2"), some(_overlap(begin, F.col("end"), zero, e2)).alias("b2"),
    ).withColumn("taken", F.col("times") * F.col("size") + F.col("b1") - F.col("a1") + F.col("b2") - F.col("a2"))


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def passage(text: str, a: int, b: int) -> str:
    """The words a .. b - 1 of a text with the white space between them."""
    spans = [m.span() for m in _WORD.finditer(text)]
    return text[spans[a][0]:spans[b - 1][1]]


def _same(doc_id: Column, tag: Column) -> Column:
    """One string of a row's id and its text's tag; a null id is left out."""
    return F.concat_ws(":", tag.cast("string"), doc_id.cast("string"))


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with ``_mix_nth``, their number from 0 among those of equal ``_mix_same``.

    Rows are dealt into DEALS hands, counted and numbered by hand, so that no task holds all rows
    of a hot value; they are staged with their places, so that a retry numbers them alike.
    """
    place = F.monotonically_increasing_id()
    dealt = staged(rows.withColumn("_mix_place", place), "mix-dealt") \
        .withColumn("_mix_hand", F.pmod(F.xxhash64("_mix_place"), F.lit(DEALS)).cast("int"))
    before = Window.partitionBy("_mix_same").orderBy("_mix_hand").rowsBetween(Window.unboundedPreceding, -1)
    hands = dealt.groupBy("_mix_same", "_mix_hand").agg(F.count(F.lit(1)).alias("_mix_rows")) \
        .withColumn("_mix_base", F.coalesce(F.sum("_mix_rows").over(before), F.lit(0))).drop("_mix_rows")
    inside = Window.partitionBy("_mix_same", "_mix_hand").orderBy("_mix_place")
    return dealt.withColumn("_mix_at", F.row_number().over(inside)).join(hands, ["_mix_same", "_mix_hand"]) \
        .withColumn("_mix_nth", F.col("_mix_base") + F.col("_mix_at") - 1) \
        .drop("_mix_place", "_mix_hand", "_mix_base", "_mix_at")


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The mix as documents: each taken copy or passage is a row with its document's columns;
    a passage has its own text and n_chars. Documents the mix does not take go."""
    same = _same(F.col("doc_id"), text_tag(F.col("text")))
    plan = staged(mix(docs, **params).select(
        _same(F.col("doc_id"), F.col("tag")).alias("_mix_same"),
        F.struct("size", "times", "a1", "b1", "a2", "b2").alias("_mix_part"), (F.col("taken") > 0).alias("_mix_taken")),
        "mix-plan")
    parts = plan.where("_mix_taken").drop("_mix_taken")
    many = staged(plan.groupBy("_mix_same").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_mix_same"), "mix-many")
    # the row travels as one value, so that no column of the caller's can be taken for one made here
    rows = docs.select(same.alias("_mix_same"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_mix_row"))
    if many.isEmpty():
        joined = rows.join(parts, "_mix_same")
    else:  # rows repeated with id and text take one part each
        again = _numbered(rows.join(many, "_mix_same", "left_semi")).join(
            _numbered(parts.join(many, "_mix_same", "left_semi")), ["_mix_same", "_mix_nth"]).drop("_mix_nth")
        joined = rows.join(many, "_mix_same", "left_anti").join(parts, "_mix_same").unionByName(again)

    spans = F.concat(
        F.array_repeat(F.struct(F.lit(0).cast("long").alias("a"), F.col("_mix_part.size").alias("b")),
                       F.col("_mix_part.times").cast("int")),
        F.filter(F.array(F.struct(F.col("_mix_part.a1").alias("a"), F.col("_mix_part.b1").alias("b")),
                         F.struct(F.col("_mix_part.a2").alias("a"), F.col("_mix_part.b2").alias("b"))),
                 lambda s: s["b"] > s["a"]))
    out = joined.withColumn("_mix_span", F.explode(spans))

    @F.pandas_udf("string")
    def taken_text(text: pd.Series, a: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([t if i == 0 and j == k else passage(t, i, j) for t, i, j, k in zip(text, a, b, n)])

    new = taken_text("_mix_row.text", "_mix_span.a", "_mix_span.b", "_mix_part.size")
    out = out.withColumn("_mix_text", new)
    return out.select(*[
        F.col("_mix_text").alias(c) if c == "text" else
        F.char_length("_mix_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
        F.col("_mix_row").getField(c).alias(c)
        for c in docs.columns])
