"""Helpers shared by the operators: words, staging on the shared folder, range splits."""

from __future__ import annotations

import math
import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecensus.session import ensure_checkpoint_dir

# Words are runs of anything but these six ASCII white-space characters.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

# Arrow batches into Python workers: whichever bound is met first closes the batch.
ARROW_ROWS = "500"
ARROW_BYTES = str(4 << 20)


def tune(spark: SparkSession) -> SparkSession:
    """Bound what one Arrow batch holds, so that a batch of long texts fits a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged_path(spark: SparkSession, what: str) -> str:
    """A new folder's path under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"


def staged(df: DataFrame, what: str) -> DataFrame:
    """Write to the session's shared checkpoint folder and read back: cuts the lineage, and a
    lost executor re-reads files instead of repeating the work."""
    spark = df.sparkSession
    path = staged_path(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def words(text: Column) -> Column:
    """The words of a text as an array; null and white space give none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def crc32(value: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes."""
    return F.crc32(value.cast("string").cast("binary"))


def range_splits(df: DataFrame, key: str, n: int) -> list:
    """At most n - 1 ascending cut points of ``key`` with about equally many rows between them.

    One pass over the key column alone; what reaches the driver is bounded by n.
    """
    if n < 2:
        return []
    at = F.expr(f"array({', '.join(f'{i / n!r}D' for i in range(1, n))})")
    got = df.agg(F.percentile_approx(key, at, F.lit(20 * n)).alias("s")).first()["s"]
    return sorted(set(got or []))


def hot_splits(df: DataFrame, key: str, n: int) -> tuple[list, dict, int]:
    """``range_splits``, the keys that are more than one of the cut points with how many they are (at most n in sum),
    and how many of n ranges the rows without a key fill (at least 1)."""
    cuts = F.lit(None)
    if n > 1:
        cuts = F.percentile_approx(key, F.expr(f"array({', '.join(f'{i / n!r}D' for i in range(1, n))})"), F.lit(20 * n))
    got = df.agg(cuts.alias("s"), F.count(F.lit(1)).alias("rows"), F.count(key).alias("keys")).first()
    times = Counter(got["s"] or [])
    nulls = max(1, round(n * (got["rows"] - got["keys"]) / max(1, got["rows"])))
    return sorted(times), {k: m for k, m in times.items() if m > 1}, nulls


def range_of(key: Column, splits: list) -> Column:
    """Number of cut points at or below the key: 0 to len(splits); null keys come first.

    The cut points are searched in two levels, so a row costs about twice their root's comparisons.
    """
    if not splits:
        return F.lit(0)
    step = max(1, math.isqrt(len(splits)))
    groups = [splits[i:i + step] for i in range(0, len(splits), step)]

    def below(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda s: s <= key))

    def listed(values: list) -> str:
        return f"array({', '.join(repr(v) for v in values)})"

    group = below(F.expr(listed([g[0] for g in groups[1:]]))) if len(groups) > 1 else F.lit(0)
    fine = F.get(F.expr(f"array({', '.join(map(listed, groups))})"), group)
    return F.coalesce(group * step + below(fine), F.lit(0))
