"""Single tables in a place of their own (K1, K2, K4), for formats and readers that know no store.

The tables of a run are published together by ``lakecensus.sources.store``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakecensus.session import Staging


def _write(df: DataFrame, path: str, fmt: str) -> int:
    seen = Observation(f"rows_{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("overwrite").option(
        "overwriteSchema", "true").save(path)
    return int(seen.get["rows"])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", on_empty: str = "skip") -> int | None:
    """Overwrite a table, schema replaced; an empty frame keeps the table unless ``on_empty`` is
    ``"overwrite"``. Returns the rows written (observed while writing), None when kept.

    Files are written once, beside the table, and moved in its place. Formats with commits of their
    own (delta) write in place; there the plan is staged first to know whether it is empty."""
    if on_empty not in ("skip", "overwrite"):
        raise ValueError(f"on_empty is {on_empty!r}, not 'skip' or 'overwrite'")
    spark = df.sparkSession
    if fmt == "delta":
        if on_empty == "skip":
            df, seen = Staging(spark).put("incoming", df, rows=F.count(F.lit(1)))
            if not seen["rows"]:
                return None
        return _write(df, path, fmt)
    path = path.rstrip("/")
    incoming, outgoing = (f"{path}.{what}-{uuid.uuid4().hex}" for what in ("incoming", "outgoing"))
    n = _write(df, incoming, fmt)
    new, at, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (incoming, path, outgoing))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if n == 0 and on_empty == "skip":
        fs.delete(new, True)
        return None
    if fs.exists(at):
        fs.rename(at, old)
    fs.rename(new, at)
    fs.delete(old, True)
    return n
