"""A capture stored as typed values: what one run's landing says, parsed once for all tables.

    path/light                    outcomes of every page, without bodies
    path/elements/<operation>     elements of listings, stitched: request context, page_no, pos, e
    path/asked/<operation>        the workspaces that a listing has elements of
    path/objects/<operation>      answers that are one object
    path/dax/<operation>          rows of DAX results, keys normalised

``e`` is a VARIANT, which Spark's writer shreds: the fields that most elements share become typed
columns of the Parquet files, and a table that extracts four of them reads those four. One folder
an operation keeps their fields apart. ``ShreddedCapture`` has the interface of ``Capture``, so all
tables and reports are made from either.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.functions.scalars import stable_id
from lakecensus.operators.paging import CONTEXT, Capture
from lakecensus.session import Staging

WRITERS = 4
OBJECTS = (K.OP_GET_WORKSPACE, K.OP_REFRESH_SCHEDULE, K.OP_DATAFLOW_SCHEDULE)
LISTINGS = (
    K.OP_LIST_WORKSPACES, K.OP_ROLE_ASSIGNMENTS, K.OP_LIST_ITEMS, K.OP_LIST_DATASETS, K.OP_MODEL_DATASOURCES,
    K.OP_DATAFLOW_DATASOURCES, K.OP_GEN2_DATASOURCES, K.OP_SHORTCUTS, K.OP_REFRESH_HISTORY, K.OP_LIST_REPORTS,
    K.OP_LIST_DATAFLOWS, K.OP_LIST_LAKEHOUSES,
)


STORED = (*LISTINGS, *OBJECTS, *K.DAX_OPERATIONS)


def shred(cap: Capture, path: str, operations: tuple[str, ...] = STORED) -> "ShreddedCapture":
    """Store a capture of one run, or these operations of it, under ``path``, which must not exist yet."""
    path = path.rstrip("/")
    paged = [op for op in K.PAGED_OPERATIONS if op in operations]
    cap.one_run().warm(paged)
    every = set(STORED) <= set(operations)
    tables = {"light": lambda: cap.light() if every else cap.light(*operations)}
    tables |= {f"elements/{op}": lambda op=op: cap.elements(op).drop("eid") for op in LISTINGS if op in operations}
    tables |= {f"asked/{op}": lambda op=op: cap.asked(op) for op in paged}
    tables |= {f"objects/{op}": lambda op=op: cap.objects(op) for op in OBJECTS if op in operations}
    tables |= {f"dax/{op}": lambda op=op: cap.dax_rows(op) for op in K.DAX_OPERATIONS if op in operations}
    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(lambda name: tables[name]().write.parquet(f"{path}/{name}"), tables))
    return ShreddedCapture(cap.spark, path, cap.run_ts)


class ShreddedCapture:
    """A stored capture, read per endpoint."""

    def __init__(self, spark: SparkSession, path: str, run_ts: Column | str):
        self.spark, self.path = spark, path.rstrip("/")
        self.run_ts = F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts
        self.staging = Staging(spark)
        self._tables: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.path}/{name}")
        return self._tables[name]

    @property
    def run_ids(self) -> dict:
        runs = self.light().agg(F.min("run_id").alias("first"), F.max("run_id").alias("last")).first()
        return runs.asDict()

    def asked(self, operation: str) -> DataFrame:
        """The workspaces that a listing has elements of, each once."""
        return self._table(f"asked/{operation}")

    def one_run(self) -> "ShreddedCapture":
        return self  # only captures of one run are stored

    def warm(self, operations=()) -> "ShreddedCapture":
        return self  # chains are stitched already

    def light(self, *operations: str) -> DataFrame:
        table = self._table("light")
        return table.where(F.col("operation").isin(*operations)) if operations else table

    def outcomes_of(self, operation: str) -> DataFrame:
        return self.light(operation).where(F.col("page_no") == 0)

    def elements(self, operation: str) -> DataFrame:
        return self._table(f"elements/{operation}").select(
            *CONTEXT, "page_no", "pos", "e", stable_id(*map(F.col, ("run_id", "request_id", "page_no", "pos"))).alias("eid"))

    def objects(self, operation: str) -> DataFrame:
        return self._table(f"objects/{operation}")

    def dax_rows(self, operation: str) -> DataFrame:
        return self._table(f"dax/{operation}")

    def clean(self) -> None:
        """Delete what a run over the stored capture has staged; the capture itself stays."""
        self.staging.clean()
        self.staging = Staging(self.spark)


class GrowingCapture(ShreddedCapture):
    """A stored capture that takes an operation in when it is first read: a table pays for the endpoints
    that it is made from, and a run of all tables for each of them once. ``source`` gives the capture of
    some operations; those asked for together (``warm``, ``light``) are resolved and stored together."""

    def __init__(self, spark: SparkSession, path: str, run_ts: Column | str, source: Callable[..., Capture]):
        super().__init__(spark, path, run_ts)
        self.source = source
        self._parts: dict[str, ShreddedCapture] = {}
        self._growing = threading.Lock()

    def warm(self, operations=STORED) -> "GrowingCapture":
        with self._growing:
            missing = tuple(op for op in dict.fromkeys(operations) if op in STORED and op not in self._parts)
            if missing:
                cap = self.source(*missing)
                part = shred(cap, f"{self.path}/{uuid.uuid4().hex}", missing)
                cap.clean()  # what it staged is in the stored tables
                self._parts.update({op: part for op in missing})
        return self

    def _table(self, name: str) -> DataFrame:
        operation = name.split("/")[-1]
        return self.warm((operation,))._parts[operation]._table(name)

    def light(self, *operations: str) -> DataFrame:
        self.warm(operations or STORED)
        parts = {id(p): p for p in (self._parts[op] for op in (operations or STORED))}
        return reduce(DataFrame.unionByName, [p.light(*operations) for p in parts.values()])
