import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lakecensus.session import configure

    s = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakecensus-test-ckpt-"))
    yield s


@pytest.fixture()
def landing(spark):
    """Build a landing DataFrame from dicts (missing keys -> NULL)."""
    from lakecensus.sources.schemas import LANDING

    def make(rows):
        full = []
        for r in rows:
            d = {f.name: None for f in LANDING.fields}
            d.update({"run_id": "r", "page_no": 0, "attempt": 1})
            d.update(r)
            full.append(tuple(d[f.name] for f in LANDING.fields))
        return spark.createDataFrame(full, LANDING)

    return make
