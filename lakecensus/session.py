"""Session settings the engine relies on.

Only runtime SQL settings are touched, so ``configure`` is safe to call on a session that
someone else built (a cluster job, the verification driver).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings every transform in the package assumes.
ENGINE_CONF = {
    # naive timestamps in bodies are read as UTC, and written as UTC
    "spark.sql.session.timeZone": "UTC",
    # DAX result rows: two keys that collide after bracket stripping -> the later one wins
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # a JSON object with a repeated key keeps the last value, as json.loads does
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in ENGINE_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    On a cluster this must be a shared folder named by ``spark.checkpoint.dir``: what executors
    write to a folder of their own machine nobody else can read, so a session without one is
    refused there. A local folder is only invented for a local master, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"master {sc.master}: set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="lakecensus-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


class Staging:
    """Tables that one run writes and reads again, in one folder under the checkpoint directory.

    Writing cuts the lineage, gives Spark real sizes to plan joins from, and lets a lost executor
    read files instead of repeating the work. ``clean`` deletes the folder when the run's results
    have been written; it is never done behind a result's back."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakecensus-run-{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
        """The table read back, and what ``measures`` observed while it was written."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        if measures:
            df = df.observe(seen, *[m.alias(k) for k, m in measures.items()])
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get if measures else {}

    def clean(self) -> None:
        delete(self.spark, self.folder)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system its path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "lakecensus") -> SparkSession:
    """Session for tests, the bench and local runs (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark
