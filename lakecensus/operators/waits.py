"""Time that rate limits blocked (E8, A8): the union of the waits, beside their sum.

Captures run in parallel, so waits overlap and their sum overstates the time in which an operation
was held up. The union is found by a sweep: in order of their beginning, a wait adds what lies
beyond the furthest end so far. Ranges of (group, beginning) are cut from the data, so that a busy
second or operation is spread over tasks like any other; inside a range the furthest end is a
running maximum, and what earlier ranges reached is one row per group and range, scanned in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.operators.outcomes import PAGE, is_dax
from lakecensus.session import Staging


def waits(landing: DataFrame, max_attempts: int = K.MAX_ATTEMPTS) -> DataFrame:
    """(PAGE, attempt, begin, end) of every 429 inside the attempt budget, in microseconds; an
    attempt captured more than once counts once."""
    begin = F.unix_micros(F.min("requested_at"))
    seconds = F.max(F.coalesce("retry_after", F.lit(K.DEFAULT_RETRY_AFTER_S)))
    return landing.where(
        (F.col("status") == 429) & ~is_dax(F.col("operation")) & (F.col("attempt") <= max_attempts)
    ).groupBy(*PAGE, "attempt").agg(begin.alias("begin"), (begin + seconds.cast("long") * 1_000_000).alias("end"))


def union_length(intervals: DataFrame, by: list[str], staging: Staging, ranges: int | None = None) -> DataFrame:
    """(by, covered): length of the union of (begin, end) in each group; null bounds are left out."""
    spark = intervals.sparkSession
    # of intervals that begin together the longest covers the others
    bare = intervals.where("begin IS NOT NULL AND end IS NOT NULL").groupBy(*by, "begin").agg(F.max("end").alias("end"))
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt, _ = staging.put("intervals", bare.repartitionByRange(n, *by, "begin").withColumn("_rng", F.spark_partition_id()))
    inside = Window.partitionBy(*by, "_rng").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*by).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    reached = dealt.groupBy(*by, "_rng").agg(F.max("end").alias("_end")).select(*by, "_rng", F.max("_end").over(before).alias("_carried"))
    on = [F.col(f"i.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*by, "_rng"]]
    condition: Column = on[0]
    for c in on[1:]:
        condition = condition & c
    swept = dealt.withColumn("_far", F.max("end").over(inside)).alias("i").join(reached.alias("r"), condition).select(
        "i.*", F.greatest("begin", "_far", "_carried").alias("_from"))
    return swept.groupBy(*by).agg(F.sum(F.greatest(F.col("end") - F.col("_from"), F.lit(0))).alias("covered"))


def blocked_time(landing: DataFrame, staging: Staging, max_attempts: int = K.MAX_ATTEMPTS) -> DataFrame:
    """Per run and operation, and per run over all operations (operation null): number of waits,
    seconds waited, microseconds blocked."""
    found, _ = staging.put("waits", waits(landing, max_attempts).select("run_id", "operation", "begin", "end"))
    every = found.unionByName(found.withColumn("operation", F.lit(None).cast("string")))
    by = ["run_id", "operation"]
    sums = every.groupBy(*by).agg(F.count(F.lit(1)).alias("waits"), (F.sum(F.col("end") - F.col("begin")) / 1_000_000).cast("long").alias("wait_seconds"))
    union = union_length(every, by, staging)
    return sums.alias("s").join(
        union.alias("u"), F.col("s.run_id").eqNullSafe(F.col("u.run_id")) & F.col("s.operation").eqNullSafe(F.col("u.operation")), "left").select(
        "s.*", F.coalesce("covered", F.lit(0)).alias("blocked_us"))
