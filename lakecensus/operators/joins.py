"""Which side of a join may be broadcast: counted in rows, not read off the size of files.

Spark plans a join of stored tables from their compressed files, and a column of ids that take a byte
each in a file takes a hundred in the driver, which collects and hashes what is broadcast: 900,000
workspace ids were planned as 1 MB and held 105. Tables that grow with the input are counted first:
few rows are broadcast, more are joined by a shuffle, whatever their files look like.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_BYTES = 200  # of a row of ids and names in a broadcast, which holds the key and the row


def broadcast_limit(spark: SparkSession) -> int:
    """The session's spark.sql.autoBroadcastJoinThreshold in bytes (10 MB by default)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * units[suffix])
    return int(raw)


def is_few(table: DataFrame) -> bool:
    """Whether a table has no more rows than may be broadcast."""
    return table.count() * ROW_BYTES <= broadcast_limit(table.sparkSession)


def side(table: DataFrame, few: bool | None = None) -> DataFrame:
    """A table of ids and names as the right side of a join, broadcast if it has ``few`` rows
    (counted, unless the caller knows) and otherwise shuffled with the left one."""
    return F.broadcast(table) if (is_few(table) if few is None else few) else table.hint("merge")
