"""Registered queries (Spark) and their SQL oracles (DuckDB, straight from the test tables).

Each query takes (spark, sf_dir): it derives the emulated capture from the test tables
(stored once per process, see ``Fixture.stored``), runs the engine, and returns a DataFrame.
Timestamps are returned as TIMESTAMP_NTZ in UTC so that they compare with DuckDB's TIMESTAMP.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from lakecensus.functions import constants as K
from lakecensus.functions.scalars import parse_ts, strip_bracket_name
from lakecensus.operators import changes as C
from lakecensus.operators import drift as D
from lakecensus.operators import normalize as N
from lakecensus.operators import outcomes as O
from lakecensus.operators import planning as P
from lakecensus.operators import powerquery as Q
from lakecensus.operators import reporting as E
from lakecensus.operators import uniqueness as U
from lakecensus.operators import waits as W
from lakecensus.operators.links import number_pages
from lakecensus.operators.paging import Capture, chain_audit
from lakecensus.plans.pipeline import Inventory
from lakecensus.session import configure, ensure_checkpoint_dir
from lakecensus.sources import fixtures as X
from lakecensus.sources.schemas import OUTPUTS, conform
from lakecensus.sources.shredded import STORED, GrowingCapture
from lakecensus.sources.store import Store

_FIXTURES: dict[tuple[int, str], X.Fixture] = {}
_CAPTURES: dict[tuple[int, str, str], Capture] = {}
_SHREDDED: dict[tuple[int, str], GrowingCapture] = {}
_STORES: dict[tuple[int, str], Store] = {}
_INVENTORIES: dict[tuple[int, str, str], Inventory] = {}


def reset() -> None:
    """Forget resolved captures and staged runs (stored landings, stored captures and published runs
    are kept)."""
    _CAPTURES.clear()
    _INVENTORIES.clear()


def fixture(spark: SparkSession, sf_dir: str) -> X.Fixture:
    key = (id(spark), sf_dir)
    if key not in _FIXTURES:
        _FIXTURES[key] = X.Fixture(spark, sf_dir)
    return _FIXTURES[key]


def capture(spark: SparkSession, sf_dir: str, kind: str = "inventory") -> Capture:
    configure(spark)
    key = (id(spark), sf_dir, kind)
    if key not in _CAPTURES:
        _CAPTURES[key] = Capture(fixture(spark, sf_dir).stored(kind), X.RUN_TS)
    return _CAPTURES[key]


def shredded(spark: SparkSession, sf_dir: str) -> GrowingCapture:
    """The capture stored as typed values; like the landing it comes from, an operation is written once
    per process, when a table is first made from it."""
    key = (id(spark), sf_dir)
    if key not in _SHREDDED:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakecensus-shredded-{uuid.uuid4().hex}"
        landing = fixture(spark, sf_dir).stored
        _SHREDDED[key] = GrowingCapture(spark, path, X.RUN_TS, lambda *ops: Capture(landing("inventory", *ops), X.RUN_TS))
    return _SHREDDED[key]


def inventory(spark: SparkSession, sf_dir: str, scope: str = "all") -> Inventory:
    configure(spark)
    key = (id(spark), sf_dir, scope)
    if key not in _INVENTORIES:
        cur = X.CURRENT_WORKSPACE if scope == "current" else None
        _INVENTORIES[key] = Inventory(shredded(spark, sf_dir), scope=scope, current_workspace_id=cur)
    return _INVENTORIES[key]


def for_compare(df: DataFrame) -> DataFrame:
    return df.select(
        [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
         for f in df.schema.fields]
    )


def _table(name: str, attr: str, scope: str = "all") -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inv = inventory(spark, sf_dir, scope)
        return for_compare(conform(getattr(inv, attr), OUTPUTS[name]))
    run.__name__ = attr
    return run


def _ds_branch(branch: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inv = inventory(spark, sf_dir)
        return for_compare(conform(inv.datasource_branches()[branch], OUTPUTS["meta_datasources"]))
    return run


def q_viable_models(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return for_compare(conform(N.viable_models(inv.models), OUTPUTS["meta_semantic_models"]))


def q_resolve_attempts(spark, sf_dir):
    cap = capture(spark, sf_dir, "attempts")
    return cap.resolved.select("request_id", "page_no", "attempt", "status", "error_kind", "exhausted")


def q_classify_outcomes(spark, sf_dir):
    cap = capture(spark, sf_dir, "attempts")
    return cap.light().select("request_id", "page_no", "outcome", "http_status_code", "requires_admin")


def q_error_rows(spark, sf_dir):
    cap = capture(spark, sf_dir, "attempts")
    return for_compare(conform(O.error_rows(cap.light(), cap.run_ts), OUTPUTS["meta_access_errors"]))


def q_rate_limit_waits(spark, sf_dir):
    return O.rate_limit_waits(capture(spark, sf_dir, "attempts").landing)


def q_stitch_pages(spark, sf_dir):
    cap = capture(spark, sf_dir, "chains")
    el = cap.elements(K.OP_LIST_LAKEHOUSES)
    return el.select("request_id", "page_no", "pos",
                     F.try_variant_get("e", "$.role", "string").alias("role"),
                     F.try_variant_get("e", "$.text", "string").alias("text"))


def q_page_chain_audit(spark, sf_dir):
    """Per chain, pages captured and read, and whether a failed page ended it."""
    return chain_audit(capture(spark, sf_dir, "chains"), K.OP_LIST_LAKEHOUSES).drop("run_id", "operation")


def q_errors_admin(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return for_compare(conform(E.errors_admin(inv.errors), OUTPUTS["meta_access_errors"]))


def published(spark: SparkSession, sf_dir: str) -> Store:
    """The store that a run over the capture was published to; like the landing, it is written
    once per process, and counts are read from its ledger as a user would, after the run."""
    key = (id(spark), sf_dir)
    if key not in _STORES:
        store = Store(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakecensus-store-{uuid.uuid4().hex}")
        inventory(spark, sf_dir).publish(store)
        _STORES[key] = store
    return _STORES[key]


def q_error_counts(spark, sf_dir):
    return E.error_counts(published(spark, sf_dir).ledger())


def q_ds_counts(spark, sf_dir):
    return E.ds_counts(published(spark, sf_dir).ledger())


def q_pq_counts(spark, sf_dir):
    return E.pq_counts(published(spark, sf_dir).ledger())


def q_run_summary(spark, sf_dir):
    return E.run_summary(published(spark, sf_dir).ledger(), list(OUTPUTS))


def q_run_ledger(spark, sf_dir):
    """Every counter of the run."""
    return published(spark, sf_dir).ledger()


def q_classify_dax_outcomes(spark, sf_dir):
    cap = capture(spark, sf_dir)
    out = cap.light(*K.DAX_OPERATIONS)
    return out.select(
        "request_id", "item_id", "outcome", "http_status_code", "requires_admin",
        F.substring(F.concat(F.lit(K.DAX_LABEL_PREFIX), F.col("query")), 1, len(K.DAX_LABEL_PREFIX) + K.DAX_LABEL_CHARS).alias("label"),
    )


def q_dax_rows(spark, sf_dir):
    """Partition rows of every OK INFO.PARTITIONS call, keys normalised."""
    cap = capture(spark, sf_dir)
    r = F.col("r")
    return Q.dax_rows(cap, K.OP_DAX_PARTITIONS).select(
        "model_id", "row_pos",
        Q.int_of(r["TableID"], -1).alias("table_id"),
        F.try_variant_get(r["Name"], "$", "string").alias("name"),
        Q.code_of(r["Type"]).alias("type_code"),
        Q.code_of(r["Mode"]).alias("mode_code"),
        F.length(F.try_variant_get(r["QueryDefinition"], "$", "string")).alias("query_chars"),
    )


def q_pq_probe_gate(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    gate = Q.probe_gate(inv.cap, inv.ordered_models).agg(F.count(F.lit(1)).alias("_n"))
    return gate.select((F.col("_n") > 0).alias("probe_ok"))


def q_pq_coverage(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return Q.pq_coverage(inv.cap, inv.ordered_models)


def q_ds_coverage(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return E.ds_coverage(inv.planned, inv.cap.light(K.OP_MODEL_DATASOURCES), inv.models)


def q_plan_workspace_requests(spark, sf_dir):
    return P.plan_workspace_requests(inventory(spark, sf_dir).workspaces)


def q_plan_entity_requests(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return P.plan_entity_requests(inv.models, inv.dataflows, inv.items)


def q_uncovered_requests(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    outcomes = inv.cap.light()  # first, so that all operations are captured together
    return E.uncovered_requests(inv.planned, outcomes)


def q_model_name_lookup(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return E.model_names(inv.reports, inv.ordered_models)


def q_find_item(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return E.find_item(inv.items, inv.workspaces, "red widget")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "refresh_history": _table("meta_refresh_history", "history"),
    "norm_workspaces": _table("meta_workspaces", "workspaces"),
    "norm_workspace_single": _table("meta_workspaces", "workspaces", scope="current"),
    "scope_filter": _table("meta_workspace_users", "users", scope="current"),
    "norm_users": _table("meta_workspace_users", "users"),
    "norm_items": _table("meta_workspace_items", "items"),
    "norm_models": _table("meta_semantic_models", "models"),
    "norm_reports": _table("meta_reports", "reports"),
    "norm_dataflows": _table("meta_dataflows", "dataflows"),
    "other_assets": _table("meta_other_assets", "other_assets"),
    "viable_models": q_viable_models,
    "ds_models": _ds_branch("SemanticModel"),
    "ds_gen1": _ds_branch("Dataflow"),
    "ds_gen2": _ds_branch("DataflowGen2"),
    "ds_shortcuts": _ds_branch("Lakehouse"),
    "datasources_all": _table("meta_datasources", "datasources"),
    "refresh_schedules": _table("meta_refresh_schedules", "schedules"),
    "power_queries": _table("meta_power_queries", "power_queries"),
    "errors_enriched": _table("meta_access_errors", "errors"),
    "errors_admin": q_errors_admin,
    "error_counts": q_error_counts,
    "ds_counts": q_ds_counts,
    "pq_counts": q_pq_counts,
    "run_summary": q_run_summary,
    "run_ledger": q_run_ledger,
    "resolve_attempts": q_resolve_attempts,
    "classify_outcomes": q_classify_outcomes,
    "error_rows": q_error_rows,
    "rate_limit_waits": q_rate_limit_waits,
    "stitch_pages": q_stitch_pages,
    "page_chain_audit": q_page_chain_audit,
    "classify_dax_outcomes": q_classify_dax_outcomes,
    "dax_rows": q_dax_rows,
    "pq_probe_gate": q_pq_probe_gate,
    "pq_coverage": q_pq_coverage,
    "ds_coverage": q_ds_coverage,
    "plan_workspace_requests": q_plan_workspace_requests,
    "plan_entity_requests": q_plan_entity_requests,
    "uncovered_requests": q_uncovered_requests,
    "model_name_lookup": q_model_name_lookup,
    "find_item": q_find_item,
}


def _cols(attr: str, table: str, cols: list[str]):
    """A focused projection of one output table: the columns one helper decides."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = for_compare(conform(getattr(inventory(spark, sf_dir), attr), OUTPUTS[table]))
        return df.select(*cols)
    return run


def q_scan_landing(spark, sf_dir):
    """The attempt log of one operation, read through the operation partition."""
    lt = capture(spark, sf_dir, "attempts").landing
    return lt.where(F.col("operation") == K.OP_LIST_LAKEHOUSES).select("request_id", "attempt", "status", "error_kind")


def q_strip_bracket_names(spark, sf_dir):
    """Normalised column names of every partition row (collisions collapsed)."""
    cap = capture(spark, sf_dir)
    rows = Q.dax_rows(cap, K.OP_DAX_PARTITIONS)
    return rows.select("model_id", "row_pos", F.explode(F.map_keys("r")).alias("column_name"))


def q_stable_ids(spark, sf_dir):
    """Rows and distinct surrogate or given ids per table."""
    inv = inventory(spark, sf_dir)
    inv.cap.warm(STORED)  # the errors are those of all operations
    parts = [
        ("meta_workspace_users", inv.users, "id"), ("meta_datasources", inv.datasources, "datasource_id"),
        ("meta_refresh_history", inv.history, "refresh_id"), ("meta_power_queries", inv.power_queries, "query_id"),
        ("meta_access_errors", inv.errors, "error_id"),
    ]
    out = None
    for name, df, key in parts:
        counts = U.id_counts(df, key, inv.cap.staging).select(F.lit(name).alias("table_name"), "rows", "distinct_ids")
        out = counts if out is None else out.unionByName(counts)
    return out


def q_repeated_ids(spark, sf_dir):
    """Principals with several role assignments, ids that a table repeats."""
    inv = inventory(spark, sf_dir)
    return U.repeated_ids(inv.users, "user_email", inv.cap.staging)


def q_sink_roundtrip(spark, sf_dir):
    """K1-K4: all twelve tables published together, read back through the commit record."""
    store = published(spark, sf_dir)
    out = None
    for i, name in enumerate(OUTPUTS):
        there = name in store.record()["tables"]
        back = (store.read(name).agg(F.count(F.lit(1)).alias("rows")) if there
                else spark.range(1).select(F.lit(0).cast("long").alias("rows")))
        back = back.select(F.lit(i).alias("table_order"), F.lit(name).alias("table_name"), "rows")
        out = back if out is None else out.unionByName(back)
    return out


def q_run_duration(spark, sf_dir):
    """Whole seconds from a run's first to its last request."""
    lt = capture(spark, sf_dir, "attempts").landing
    span = lt.groupBy("run_id").agg(F.min("requested_at").alias("started"), F.max("requested_at").alias("finished"))
    return span.select("run_id", E.run_duration_seconds(F.col("started"), F.col("finished")).alias("duration_s"))


QUERIES.update({
    "run_duration": q_run_duration,
    "scan_landing": q_scan_landing,
    "json_get_default": _cols("items", "meta_workspace_items", ["item_id", "created_by_email"]),
    "json_get_or": _cols("workspaces", "meta_workspaces", ["workspace_id", "capacity_id", "description"]),
    "first_truthy": _cols("users", "meta_workspace_users", ["id", "user_email"]),
    "json_truthy": _cols("models", "meta_semantic_models", ["model_id", "is_refreshable"]),
    "json_dynamic_key": _cols("datasources", "meta_datasources",
                              ["source_item_type", "datasource_id", "datasource_type", "server", "database", "url", "gateway_id"]),
    "service_exception": _cols("history", "meta_refresh_history", ["refresh_id", "service_exception_code", "service_exception_message"]),
    "array_csv": _cols("schedules", "meta_refresh_schedules", ["schedule_id", "days", "times"]),
    "parse_ts": _cols("items", "meta_workspace_items", ["item_id", "created_date", "last_modified_date"]),
    "partition_labels": _cols("power_queries", "meta_power_queries", ["query_id", "partition_type", "storage_mode"]),
    "strip_bracket_names": q_strip_bracket_names,
    "stable_ids": q_stable_ids,
    "repeated_ids": q_repeated_ids,
    "sink_roundtrip": q_sink_roundtrip,
})


# --- inputs in the forms that the extractor's parsers take ---------------------------------------
WHITE_EDGES = ("", " ", "\t", "\n", "\u00a0", "\u2003", "\x1c")


def edged(text, n):
    """A text with white space around it, by a number."""
    pads = F.array(*[F.lit(p) for p in WHITE_EDGES])
    return F.concat(F.get(pads, (n % len(WHITE_EDGES)).cast("int")), text, F.get(pads, (n % 5).cast("int")))


def timestamp_texts(events: DataFrame) -> DataFrame:
    """An event's time written in one of twenty forms, by its id, with white space around it."""
    e, t = F.col("event_id"), F.col("ts").cast("timestamp")

    def form(pattern, at=t):
        return F.date_format(at, pattern)

    day = F.concat(F.year(F.date_add(F.date_trunc("week", t).cast("date"), 3)).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(t).cast("string"), 2, "0"))
    forms = [
        form("yyyy-MM-dd'T'HH:mm:ss'Z'"), form("yyyy-MM-dd HH:mm:ss"), form("yyyy-MM-dd'T'HH:mm"), form("yyyy-MM-dd'T'HH"),
        form("yyyy-MM-dd"), form("yyyyMMdd'T'HHmmss"), form("yyyyMMdd"), form("yyyy-MM-dd'x'HHmm"),
        F.concat(day, F.lit("-"), (F.weekday(t) + 1).cast("string")), F.replace(day, F.lit("-"), F.lit("")),
        F.concat(day, F.lit("-"), (F.weekday(t) + 1).cast("string"), form("'T'HH:mm:ss'Z'")),
        form("yyyy-MM-dd'T'HH:mm:ss',250'"), form("yyyy-MM-dd'T'HH:mm:ss'.1234567Z'"), form("yyyy-MM-dd'T'HH:mm:ss'+0130'"),
        form("yyyy-MM-dd'T'HH:mm:ss'-02'"), form("yyyy-MM-dd'T'HH:mm:ss'+00:00:30'"), form("yyyy-MM-dd'T'HH:mm:ss' +20:15'"),
        form("yyyy-MM'/'dd HH:mm"), F.lit(""), form("yyyy-MM-dd'T25'':00'"),
    ]
    return events.select("event_id", edged(F.get(F.array(*forms), (e % len(forms)).cast("int")), e).alias("text"))


def q_timestamp_forms(spark, sf_dir):
    """Every form of a timestamp that the extractor's parser takes, and some that it doesn't."""
    configure(spark)
    texts = timestamp_texts(fixture(spark, sf_dir).table("events"))
    return for_compare(texts.select("event_id", parse_ts(F.col("text")).alias("parsed")))


def q_column_name_forms(spark, sf_dir):
    """Column names of part names, bare, bracketed or qualified, with white space around them."""
    i, name = F.col("p_partkey"), F.col("p_name")
    forms = [name, F.concat(F.lit("["), name, F.lit("]")), F.concat(F.lit("[Table].["), name, F.lit("]")),
             F.concat(F.lit("[A].[B].["), name, F.lit("]")), F.concat(F.lit("["), name)]
    text = edged(F.get(F.array(*forms), (i % len(forms)).cast("int")), i)
    return fixture(spark, sf_dir).table("part").select("p_partkey", strip_bracket_name(text).alias("column_name"))


QUERIES.update({"timestamp_forms": q_timestamp_forms, "column_name_forms": q_column_name_forms})


# --- two runs in one landing ---------------------------------------------------------------------
RUN_TABLES = {"meta_workspaces": "workspaces", "meta_workspace_users": "users", "meta_workspace_items": "items",
              "meta_semantic_models": "models", "meta_reports": "reports", "meta_other_assets": "other_assets"}
RUN_OPERATIONS = {"meta_workspaces": K.OP_LIST_WORKSPACES, "meta_workspace_users": K.OP_ROLE_ASSIGNMENTS,
                  "meta_workspace_items": K.OP_LIST_ITEMS, "meta_semantic_models": K.OP_LIST_DATASETS,
                  "meta_reports": K.OP_LIST_REPORTS, "meta_other_assets": K.OP_LIST_ITEMS}


def two_runs(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = tuple(RUN_TABLES)) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Listing tables of both runs of a landing that holds them, by table, from their operations alone."""
    configure(spark)
    operations = tuple(dict.fromkeys([K.OP_LIST_WORKSPACES, *(RUN_OPERATIONS[t] for t in tables)]))
    landing = fixture(spark, sf_dir).stored("runs", *operations)
    keys = {run: (id(spark), sf_dir, "|".join((run, *operations))) for run in X.RUNS}
    for run, key in keys.items():
        if key not in _INVENTORIES:
            _INVENTORIES[key] = Inventory(Capture(landing, X.RUN_TS, run_id=run).warm(operations))
    runs = [_INVENTORIES[key] for key in keys.values()]
    return {t: tuple(conform(getattr(inv, RUN_TABLES[t]), OUTPUTS[t]) for inv in runs) for t in tables}


def q_run_changes(spark, sf_dir):
    """Keys added, removed, changed and the same from one run of a landing to the next, by table."""
    return C.difference_counts(two_runs(spark, sf_dir))


def q_item_history(spark, sf_dir):
    """Validity intervals of the items over both runs."""
    old, new = two_runs(spark, sf_dir, ("meta_workspace_items",))["meta_workspace_items"]
    key, ignore = C.KEYS["meta_workspace_items"]
    first, second = (F.lit(t).cast("timestamp") for t in (X.RUN_TS, X.SECOND_TS))
    history = C.close_intervals(C.close_intervals(None, old, first, key, ignore), new, second, key, ignore)
    return for_compare(history.select("item_id", "item_name", "valid_from", "valid_to"))


QUERIES.update({"run_changes": q_run_changes, "item_history": q_item_history})


def q_follow_links(spark, sf_dir):
    """P1 / P2 without page numbers: every element of every walk, with the page's place in it."""
    configure(spark)
    fx = fixture(spark, sf_dir)
    key = (id(spark), sf_dir, "wire")
    if key not in _CAPTURES:
        _CAPTURES[key] = Capture(number_pages(fx.stored("wire"), fx.wire_starts()), X.RUN_TS)
    return _CAPTURES[key].elements(K.OP_LIST_LAKEHOUSES).select(
        "request_id", "page_no", F.try_variant_get("e", "$.role", "string").alias("role"),
        F.try_variant_get("e", "$.text", "string").alias("text"))


QUERIES["follow_links"] = q_follow_links


def q_blocked_time(spark, sf_dir):
    """Waits, seconds waited and time blocked, by operation and in all."""
    cap = capture(spark, sf_dir, "attempts")
    return W.blocked_time(cap.landing, cap.staging)


def q_schema_drift(spark, sf_dir):
    """Fields of workspaces and models against those that are read; a field of another case is planted."""
    return D.schema_drift(capture(spark, sf_dir), (K.OP_LIST_WORKSPACES, K.OP_LIST_DATASETS))


QUERIES.update({"blocked_time": q_blocked_time, "schema_drift": q_schema_drift})
