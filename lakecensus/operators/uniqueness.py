"""Uniqueness of ids (X19, X20) without moving them.

Rows are counted by a 64-bit hash of their id: 8 bytes a row are shuffled, whatever an id's length, and a
hash that one row has proves that row's id unique. Only the ids of the hashes that repeat, copies and the
rare chance meeting, are compared themselves, so the answer is exact. A sketch of fixed size can't tell a
single copy among many ids; this costs no more than the hashes where there is none.

Null ids are rows without an id: counted as rows, never as ids nor as copies of each other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakecensus.session import Staging

BROADCAST_HASHES = 100_000  # more repeated hashes are joined by a shuffle


def _crowded(rows: DataFrame, key: str, staging: Staging) -> tuple[DataFrame, dict]:
    """The hashes that several rows' ids have, staged, and what was counted on the way."""
    seen = Observation(f"ids-{uuid.uuid4().hex}")
    counted = rows.select(F.when(F.col(key).isNotNull(), F.xxhash64(key)).alias("_hash")).groupBy("_hash").agg(
        F.count(F.lit(1)).alias("_rows"))
    alone = F.count_if((F.col("_rows") == 1) & F.col("_hash").isNotNull())
    crowd = F.count_if((F.col("_rows") > 1) & F.col("_hash").isNotNull())
    several = counted.observe(seen, F.sum("_rows").alias("rows"), alone.alias("alone"), crowd.alias("crowded")) \
        .where("_rows > 1 AND _hash IS NOT NULL").select("_hash")
    hashes, _ = staging.put("hashes", several)
    return hashes, {k: v or 0 for k, v in seen.get.items()}


def _compared(rows: DataFrame, key: str, hashes: DataFrame, crowded: int) -> DataFrame:
    """(id, rows) of the ids with these hashes."""
    few = F.broadcast(hashes) if crowded <= BROADCAST_HASHES else hashes
    ids = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.xxhash64(key).alias("_hash"))
    return ids.join(few, "_hash", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("rows"))


def repeated_ids(rows: DataFrame, key: str, staging: Staging) -> DataFrame:
    """(id, rows): the ids that several rows have, and how many."""
    hashes, seen = _crowded(rows, key, staging)
    return _compared(rows, key, hashes, seen["crowded"]).where("rows > 1")


def id_counts(rows: DataFrame, key: str, staging: Staging) -> DataFrame:
    """One row: ``rows`` and ``distinct_ids``."""
    hashes, seen = _crowded(rows, key, staging)
    total, alone = F.lit(seen["rows"]).cast("long").alias("rows"), F.lit(seen["alone"]).cast("long")
    if not seen["crowded"]:
        return rows.sparkSession.range(1).select(total, alone.alias("distinct_ids"))
    return _compared(rows, key, hashes, seen["crowded"]).agg(F.count(F.lit(1)).alias("_n")).select(
        total, (alone + F.col("_n")).alias("distinct_ids"))
