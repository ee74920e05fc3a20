"""Versioned tables under one root, published together (K1-K4), with the run's counters.

    root/<table>/v<version>-<unique>/part-*.parquet   what one run wrote of a table, once
    root/_commits/<version>.json                      which folder each table has in a version

Readers look up the last commit record and read the folders it names; folders that no record names
don't exist for them. A run writes its folders first and its record last, in one exclusive step: a
writer killed at any moment leaves the last run whole, and of two writers that started from the
same version one wins and the other gets ``CommitConflict``. Nothing is overwritten, so readers of
an older version go on undisturbed until ``vacuum`` removes it.

Counters are observed in the pass that writes a table and kept in the record: the ledger of runs is
the commit records read as a table.
"""

from __future__ import annotations

import json
import os
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WRITERS = 4  # tables written at the same time
COMMITS = "_commits"
LEDGER = "version long, run_id string, table_name string, metric string, value long"


class CommitConflict(RuntimeError):
    """Another writer has published the version that this one was to become."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._at = self._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _listed(self, *parts: str) -> list[str]:
        path = self._path(*parts)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    # --- reading --------------------------------------------------------------------------
    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._listed(COMMITS) if n.endswith(".json") and n[:-5].isdigit()]

    def record(self, version: int | None = None) -> dict:
        """The commit record of a version, or of the last; before the first there are no tables."""
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "run_id": None, "tables": {}, "metrics": {}}
        version = known[-1] if version is None else version
        if version not in known:
            raise LookupError(f"{self.root} has no version {version}")
        stream = self._fs.open(self._path(COMMITS, f"{version:020d}.json"))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def read(self, table: str, version: int | None = None) -> DataFrame:
        tables = self.record(version)["tables"]
        if table not in tables:
            raise LookupError(f"{self.root} has no table {table} in this version")
        entry = tables[table]
        return self.spark.read.schema(StructType.fromJson(entry["schema"])).parquet(f"{self.root}/{table}/{entry['folder']}")

    def ledger(self) -> DataFrame:
        """The counters of every published run: one row per version, table and counter."""
        if not self.versions():
            return self.spark.createDataFrame([], LEDGER)
        kept = "version long, run_id string, metrics map<string,map<string,long>>"
        records = self.spark.read.schema(kept).json(f"{self.root}/{COMMITS}")
        return records.select("version", "run_id", F.explode("metrics").alias("table_name", "m")).select(
            "version", "run_id", "table_name", F.explode("m").alias("metric", "value"))

    # --- writing --------------------------------------------------------------------------
    def _write(self, name: str, df: DataFrame, version: int, counters: dict[str, Column]) -> tuple[dict, dict]:
        folder = f"v{version:020d}-{uuid.uuid4().hex}"
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counters.items()])
        counted.write.parquet(f"{self.root}/{name}/{folder}")
        counts = {n: int(v or 0) for n, v in seen.get.items()}
        return {"folder": folder, "version": version, "schema": json.loads(df.schema.json())}, counts

    def publish(self, tables: dict[str, DataFrame], run_id: str | None = None, on_empty: str = "skip",
                counters: dict[str, dict[str, Column]] | None = None, metrics: dict[str, dict[str, int]] | None = None) -> dict:
        """Write every table once and publish them together; returns the commit record.

        The last table is written after all others (K3). An empty table keeps the folder of the
        version before (K2) unless ``on_empty`` is ``"overwrite"``. ``counters`` are aggregates by
        table, observed while writing; ``metrics`` are values that the run already has."""
        if on_empty not in ("skip", "overwrite"):
            raise ValueError(f"on_empty is {on_empty!r}, not 'skip' or 'overwrite'")
        before = self.record()
        version = before["version"] + 1
        *first, last = tables
        one = lambda name: self._write(name, tables[name], version, (counters or {}).get(name, {}))
        with ThreadPoolExecutor(WRITERS) as pool:
            written = dict(zip(first, pool.map(one, first)))
        written[last] = one(last)
        kept = {n: e for n, (e, counts) in written.items() if counts["rows"] or on_empty == "overwrite"}
        record = {"version": version, "run_id": run_id, "tables": {**before["tables"], **kept},
                  "metrics": {n: counts for n, (_, counts) in written.items()} | (metrics or {})}
        self._commit(version, json.dumps(record))
        return record

    def _commit(self, version: int, text: str) -> None:
        """Make the record appear whole under its name, or fail because the name is taken."""
        name, draft = f"{version:020d}.json", f".{uuid.uuid4().hex}"
        self._fs.mkdirs(self._path(COMMITS))
        stream = self._fs.create(self._path(COMMITS, draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        to = self._path(COMMITS, name)
        try:
            if self._fs.getUri().getScheme() == "file":  # a rename there may replace; a link never does
                folder = self._path(COMMITS).toUri().getPath()
                os.link(f"{folder}/{draft}", f"{folder}/{name}")
                os.remove(f"{folder}/{draft}")
            else:
                kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
                never = self.spark.sparkContext._gateway.new_array(kind, 1)
                never[0] = kind.NONE
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at.toUri(), self.spark._jsc.hadoopConfiguration())
                context.rename(self._path(COMMITS, draft), to, never)
        except FileExistsError:
            raise CommitConflict(f"{self.root}: version {version} has been published by another writer") from None
        except Exception as failed:
            if "FileAlreadyExists" not in str(failed):
                raise
            raise CommitConflict(f"{self.root}: version {version} has been published by another writer") from None

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove records older than the last ``keep`` and the folders that no kept record names,
        except folders of versions still to come, which a running writer may be filling."""
        versions = self.versions()
        kept = [self.record(v) for v in versions[-keep:]]
        named = {(t, e["folder"]) for r in kept for t, e in r["tables"].items()}
        gone = []
        for table in self._listed():
            for folder in self._listed(table) if not table.startswith(("_", ".")) else []:
                if folder.startswith("v") and int(folder[1:21]) <= (versions or [0])[-1] and (table, folder) not in named:
                    self._fs.delete(self._path(table, folder), True)
                    gone.append(f"{table}/{folder}")
        for v in versions[:-keep]:
            self._fs.delete(self._path(COMMITS, f"{v:020d}.json"), False)
        return gone
