"""Reading a stored landing table of captured attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakecensus.sources.schemas import LANDING


def read_landing(spark: SparkSession, path: str, fmt: str = "parquet", run_id: str | None = None) -> DataFrame:
    """Read a landing table with the fixed schema (parquet, or JSON lines with ``fmt="json"``).

    Store it partitioned by ``operation`` (and ``run_id`` when runs accumulate): every endpoint
    view filters on its operation, so each table's plan reads only its own files.
    """
    df = spark.read.schema(LANDING).format(fmt).load(path).select(*LANDING.fieldNames())
    return df.where(df["run_id"] == run_id) if run_id is not None else df
