"""Sharding by rendezvous hashing.

Every (key, shard) pair has a score that depends on nothing else; a key lives in the shard with
the highest score. Adding a shard adds one competitor, so a row moves into the new shard or
stays. With weights the score is -w / ln(u), u uniform in (0, 1): a shard gets its share of the
weights. The winner is found by built-in functions in the scan, without a shuffle; only light
rows (key, size, checksum) move, to number the slots of each shard: equal ones are counted where they are read,
ranges are cut on the key and, inside keys that fill ranges of their own, on the checksum.

Defined cases: a null key is one key like any other; a repeated key puts all its rows in one
shard, numbered by (key, checksum, size); null texts count as empty; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lakecensus.llm.common import crc32, hot_splits, partitions, range_of, staged

MAX_RANGES = 512  # bound of the offsets table: shards x 6 x ranges rows, whatever the input
FINER = 4  # ranges inside a hot key, for each that it would fill
CHUNK = 10000  # equal rows that one task numbers


def unit_hash(key: Column, shard: int) -> Column:
    """A number in (0, 1) from the first 52 bits of md5("key:shard")."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{shard}"))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 .. len(weights) - 1) of a key; ties go to the lower shard."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("every shard needs a positive weight")
    scored = [F.struct((F.lit(-float(w)) / F.log(unit_hash(key, s))).alias("score"), F.lit(-s).alias("minus"))
              for s, w in enumerate(weights)]
    best = F.array_max(F.array(*scored)) if len(scored) > 1 else scored[0]
    return (-best["minus"]).cast("int")


def shard(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of (key, size, text_crc32, shard, slot, grown_shard).

    ``slot`` numbers a shard's rows from 0 by key. Rows are counted by (shard, key range), the
    counts are summed to offsets, and each range is numbered on its own: no task holds a shard.
    """
    spark = docs.sparkSession
    grown = list(grown) if grown is not None else [*weights, weights[-1]]
    splits, hot, nulls = hot_splits(docs, key, min(MAX_RANGES, partitions(spark)))
    k = F.col(key)
    light = docs.select(
        k.alias("k"),
        (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long").alias("size"),
        crc32(F.coalesce(F.col(text), F.lit(""))).alias("crc"))
    k = F.col("k")
    equal = staged(light.groupBy("k", "size", "crc").agg(F.count(F.lit(1)).alias("n")), "shard-rows").select(
        "*", rendezvous(k, weights).alias("shard"), rendezvous(k, grown).alias("grown_shard"),
        range_of(k, splits).alias("rng"), _inside(k, F.col("crc"), hot, nulls).alias("sub"))
    place = ["shard", "rng", "sub"]
    counts = equal.groupBy(*place).agg(F.sum("n").alias("m"))
    before = Window.partitionBy("shard").orderBy("rng", "sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*place, F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*place).orderBy("k", "crc", "size").rowsBetween(Window.unboundedPreceding, -1)
    # the offsets table has at most len(weights) * 6 * MAX_RANGES rows
    numbered = equal.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0))) \
        .join(F.broadcast(offsets), place).withColumn("slot", F.col("base") + F.col("ahead"))
    # many equal rows are dealt out in chunks before they are numbered one by one
    zero = F.lit(0).cast("long")
    chunks = numbered.where(F.col("n") > CHUNK) \
        .withColumn("at", F.explode(F.sequence(zero, F.col("n") - 1, F.lit(CHUNK).cast("long")))) \
        .withColumn("slot", F.col("slot") + F.col("at")) \
        .withColumn("n", F.least(F.col("n") - F.col("at"), F.lit(CHUNK))).drop("at") \
        .repartition(partitions(spark), "shard", "slot")
    return numbered.where(F.col("n") <= CHUNK).unionByName(chunks) \
        .withColumn("nth", F.explode(F.sequence(zero, F.col("n") - 1))) \
        .select(F.col("k").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
                (F.col("slot") + F.col("nth")).alias("slot"), "grown_shard")


def _inside(key: Column, crc: Column, hot: dict, nulls: int) -> Column:
    """The range of a hot key's checksum inside its key's range; rows of other keys come after a hot one's."""

    def part(m: Column) -> Column:
        return F.shiftright(crc * m * FINER, 32).cast("int")

    # null keys are the first of the first range
    sub = F.when(key.isNull(), part(F.lit(nulls).cast("long")))
    if hot:
        m = F.element_at(F.create_map(*[F.lit(x) for kv in hot.items() for x in kv]), key).cast("long")
        sub = sub.when(m.isNotNull(), part(m))
    return sub.otherwise(F.lit(FINER * (MAX_RANGES + 1)))
