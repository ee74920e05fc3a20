"""The full run: landing -> outcomes -> stitched pages -> twelve tables (+ summaries).

Every table is one lazy plan over the shared capture; ``Inventory.tables()`` returns them in
write order (access errors last).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.operators import datasources as D
from lakecensus.operators import normalize as N
from lakecensus.operators import planning as P
from lakecensus.operators import powerquery as Q
from lakecensus.operators import refresh as R
from lakecensus.operators import reporting as E
from lakecensus.operators.joins import is_few, side
from lakecensus.operators.outcomes import error_rows
from lakecensus.operators.paging import Capture
from lakecensus.sources.schemas import OUTPUTS, conform
from lakecensus.sources.shredded import STORED
from lakecensus.sources.sink import write_table
from lakecensus.sources.store import Store

SCOPES = ("current", "all")


class Inventory:
    """One extraction run over a capture.

    ``scope="all"`` reads the workspace listing; ``scope="current"`` reads only
    ``current_workspace_id`` (F1). ``preflight=False`` asks model datasources of every model
    (the first version's behaviour) instead of the viable ones only.
    """

    def __init__(self, capture: Capture, scope: str = "all", current_workspace_id: str | None = None,
                 preflight: bool = True, case_insensitive_shortcuts: bool = False, stage: bool = True):
        if scope not in SCOPES:
            raise ValueError(f"scope {scope!r} is not one of {', '.join(SCOPES)}")
        if scope == "current" and not current_workspace_id:
            raise ValueError("scope='current' needs current_workspace_id")
        self.cap = capture.one_run()
        self.scope = scope
        self.current = current_workspace_id
        self.preflight = preflight
        self.case_insensitive_shortcuts = case_insensitive_shortcuts
        self.stage = stage

    def _staged(self, name: str, df: DataFrame) -> DataFrame:
        """Write an entity table that several later tables read (workspaces, items, models,
        dataflows) once, to the shared checkpoint folder, and read it back: every consumer
        then scans a small parquet table (with statistics, so joins on it are planned from
        its real size) instead of re-parsing the landing, and the lineage is cut."""
        if not self.stage:
            return df
        return self.cap.staging.put(name, df)[0]

    def _together(self, *names: str) -> None:
        """Stage entity tables that don't depend on each other at the same time: each is a small
        job, and one's last tasks don't leave the cluster idle."""
        missing = [n for n in names if n not in self.__dict__]
        if self.stage and len(missing) > 1:
            with ThreadPoolExecutor(len(missing)) as pool:
                list(pool.map(lambda n: getattr(self, n), missing))

    # --- entity tables (with listing-order columns) -------------------------------------
    @cached_property
    def workspaces(self) -> DataFrame:
        self.cap.warm((K.OP_LIST_WORKSPACES,))
        if self.scope == "current":
            return self._staged("workspaces", N.norm_workspace_single(self.cap, self.current))
        return self._staged("workspaces", N.norm_workspaces(self.cap))

    @cached_property
    def users(self) -> DataFrame:
        self.cap.warm((K.OP_LIST_WORKSPACES, K.OP_ROLE_ASSIGNMENTS))
        return N.norm_users(self.cap, self.workspaces)

    @cached_property
    def items(self) -> DataFrame:
        self.cap.warm((K.OP_LIST_WORKSPACES, K.OP_LIST_ITEMS))
        return self._staged("items", N.norm_items(self.cap, self.workspaces))

    @cached_property
    def models(self) -> DataFrame:
        self.cap.warm((K.OP_LIST_WORKSPACES, K.OP_LIST_DATASETS))
        return self._staged("models", N.norm_models(self.cap, self.workspaces))

    @cached_property
    def ordered_models(self) -> DataFrame:
        """Models with ``_ws_order``, the position of their workspace in the listing (for
        "first viable model" in the extractor's iteration order)."""
        models = self.models
        of_models = models.select("workspace_id").distinct()
        few = is_few(of_models)
        held = self.workspaces.join(side(of_models, few), "workspace_id", "left_semi")
        ws_order = held.groupBy("workspace_id").agg(F.min(F.struct("_page", "_pos")).alias("_ws_order"))
        return models.join(side(ws_order, few), "workspace_id", "left")

    @cached_property
    def reports(self) -> DataFrame:
        self.cap.warm((K.OP_LIST_WORKSPACES, K.OP_LIST_REPORTS))
        return N.norm_reports(self.cap, self.workspaces)

    @cached_property
    def dataflows(self) -> DataFrame:
        self.cap.warm((K.OP_LIST_WORKSPACES, K.OP_LIST_DATAFLOWS))
        return self._staged("dataflows", N.norm_dataflows(self.cap, self.workspaces))

    @cached_property
    def other_assets(self) -> DataFrame:
        return N.other_assets(self.items)

    # --- derived tables -----------------------------------------------------------------
    def datasource_branches(self) -> dict[str, DataFrame]:
        self.cap.warm((K.OP_LIST_WORKSPACES, K.OP_LIST_ITEMS, K.OP_LIST_DATASETS, K.OP_LIST_DATAFLOWS, K.OP_SHORTCUTS))
        self.workspaces  # staged first: the others read it
        self._together("items", "models", "dataflows")
        models = N.viable_models(self.models) if self.preflight else self.models
        return {
            "SemanticModel": D.ds_models(self.cap, models),
            "Dataflow": D.ds_gen1(self.cap, self.dataflows),
            "DataflowGen2": D.ds_gen2(self.cap, self.items),
            "Lakehouse": D.ds_shortcuts(self.cap, self.items, self.case_insensitive_shortcuts),
        }

    @cached_property
    def datasources(self) -> DataFrame:
        return D.datasources_all(list(self.datasource_branches().values()))

    @cached_property
    def schedules(self) -> DataFrame:
        return R.refresh_schedules(self.cap, self.models)

    @cached_property
    def history(self) -> DataFrame:
        return R.refresh_history(self.cap, self.models)

    @cached_property
    def power_queries(self) -> DataFrame:
        return Q.power_queries(self.cap, self.ordered_models)

    @cached_property
    def errors(self) -> DataFrame:
        raw = error_rows(self.cap.light(), self.cap.run_ts)
        if self.scope == "current":
            raw = raw.where(F.col("workspace_id").isin(self.current, ""))
        return E.errors_enriched(raw, self.workspaces)

    @cached_property
    def planned(self) -> DataFrame:
        self.cap.warm((K.OP_LIST_WORKSPACES, K.OP_LIST_ITEMS, K.OP_LIST_DATASETS, K.OP_LIST_DATAFLOWS))
        self.workspaces  # staged first: the others read it
        self._together("items", "models", "dataflows")
        return P.plan_workspace_requests(self.workspaces).unionByName(
            P.plan_entity_requests(self.models, self.dataflows, self.items, self.preflight)
        )

    # --- run ----------------------------------------------------------------------------
    def tables(self) -> dict[str, DataFrame]:
        self.cap.warm(STORED)
        self.workspaces  # staged first: the others read it
        self._together("items", "models", "dataflows")
        frames = {
            "meta_workspaces": self.workspaces,
            "meta_workspace_users": self.users,
            "meta_workspace_items": self.items,
            "meta_semantic_models": self.models,
            "meta_datasources": self.datasources,
            "meta_refresh_schedules": self.schedules,
            "meta_refresh_history": self.history,
            "meta_reports": self.reports,
            "meta_dataflows": self.dataflows,
            "meta_other_assets": self.other_assets,
            "meta_power_queries": self.power_queries,
            "meta_access_errors": self.errors,
        }
        return {name: conform(df, OUTPUTS[name]) for name, df in frames.items()}

    def coverage(self) -> dict[str, dict[str, int]]:
        """R4 / R5 as counters, from the staged outcomes and models."""
        datasources = E.ds_coverage(self.planned, self.cap.light(K.OP_MODEL_DATASOURCES), self.models).first()
        queries = Q.pq_coverage(self.cap, self.ordered_models).first()
        return {name: {k: int(v) for k, v in row.asDict().items()}
                for name, row in (("datasource_coverage", datasources), ("power_query_coverage", queries))}

    def publish(self, store: Store, on_empty: str = "skip") -> dict | None:
        """Write all tables and counters as the store's next version, together; the commit record.
        Like the extractor, a run whose workspace list (or current workspace) came back empty stops
        before writing anything, the error table included (None)."""
        self.cap.warm(STORED)  # all endpoints at once
        if self.workspaces.isEmpty():  # a staged, small table: cheap
            return None
        run = self.cap.run_ids["first"]
        return store.publish(self.tables(), run, on_empty, E.counters(), self.coverage())

    def write(self, root: str, fmt: str = "parquet", on_empty: str = "skip") -> dict[str, int | None]:
        """``publish`` into a store under ``root``; rows written by table (None: kept as it was).
        ``fmt="delta"`` writes each table in place instead, errors last."""
        if fmt == "delta":
            if self.workspaces.isEmpty():
                return {}
            return {n: write_table(df, f"{root.rstrip('/')}/{n}", fmt, on_empty) for n, df in self.tables().items()}
        record = self.publish(Store(self.cap.spark, root), on_empty)
        if record is None:
            return {}
        return {n: record["metrics"][n]["rows"] if e["version"] == record["version"] else None
                for n, e in ((n, record["tables"].get(n, {"version": None})) for n in OUTPUTS)}
