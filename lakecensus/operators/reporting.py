"""Error enrichment (J9, F12, F13), coverage (R4, J10) and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.operators.joins import is_few, side


def workspace_names(workspaces: DataFrame) -> DataFrame:
    """{workspace_id: workspace_name}, the later listing row winning."""
    return workspaces.groupBy("workspace_id").agg(
        F.max_by("workspace_name", F.struct("_page", "_pos")).alias("_ws_name")
    )


def errors_enriched(errors: DataFrame, workspaces: DataFrame) -> DataFrame:
    """J9 + F12: fill workspace_name when it is empty and the workspace id is known."""
    named = errors.select("workspace_id").distinct()
    few = is_few(named)
    names = workspace_names(workspaces.join(side(named, few), "workspace_id", "left_semi"))
    cols = [c for c in errors.columns]
    joined = errors.join(side(names, few), "workspace_id", "left")
    fill = (F.col("workspace_name") == "") & (F.col("workspace_id") != "")
    return joined.select(
        *[
            (F.when(fill, F.coalesce(F.col("_ws_name"), F.lit(""))).otherwise(F.col("workspace_name")).alias(c)
             if c == "workspace_name" else F.col(c))
            for c in cols
        ]
    )


def errors_admin(errors: DataFrame) -> DataFrame:
    """the rows that need elevated rights."""
    return errors.where(F.col("requires_admin"))


SOURCE_COUNTERS = {"semantic_model_sources": "SemanticModel", "dataflow_gen1_sources": "Dataflow",
                   "dataflow_gen2_sources": "DataflowGen2", "lakehouse_shortcuts": "Lakehouse"}
PARTITION_COUNTERS = {"m_partitions": "M", "sql_partitions": "SQL", "dax_partitions": "DAX"}


def counters() -> dict[str, dict[str, Column]]:
    """Aggregates by table, beside its rows (A1, K4), observed while it is written."""
    return {
        "meta_datasources": {n: F.count_if(F.col("source_item_type") == t) for n, t in SOURCE_COUNTERS.items()},
        "meta_power_queries": {n: F.count_if(F.col("partition_type") == t) for n, t in PARTITION_COUNTERS.items()},
        "meta_access_errors": {"errors_requiring_admin": F.count_if(F.col("requires_admin"))},
    }


def ledger_row(ledger: DataFrame, table: str, names: dict[str, str]) -> DataFrame:
    """One row of a table's counters in its last run: {counter: column name}."""
    rows = ledger.where(F.col("table_name") == table)
    return rows.agg(*[F.max_by(F.when(F.col("metric") == m, F.col("value")), F.when(F.col("metric") == m, F.col("version"))).alias(c)
                      for m, c in names.items()])


def error_counts(ledger: DataFrame) -> DataFrame:
    """A6."""
    return ledger_row(ledger, "meta_access_errors", {"rows": "errors", "errors_requiring_admin": "errors_requiring_admin"})


def ds_counts(ledger: DataFrame) -> DataFrame:
    """A2: datasources by source type (the run summary's four sub-counts) and in total."""
    return ledger_row(ledger, "meta_datasources", {"rows": "datasources", **{n: n for n in SOURCE_COUNTERS}})


def pq_counts(ledger: DataFrame) -> DataFrame:
    """A3: partitions by type (M, SQL, DAX) and in total."""
    return ledger_row(ledger, "meta_power_queries", {"rows": "partitions", **{n: n for n in PARTITION_COUNTERS}})


def run_summary(ledger: DataFrame, tables: list[str]) -> DataFrame:
    """A1: rows per output table in its last run, as observed when it was written."""
    order = F.array_position(F.array(*[F.lit(t) for t in tables]), F.col("table_name"))
    return (ledger.where(F.col("metric") == "rows").groupBy("table_name").agg(F.max_by("value", "version").alias("rows"))
            .where(order > 0).select((order - 1).cast("int").alias("table_order"), "table_name", "rows"))


def run_duration_seconds(started, finished):
    """Whole seconds between two timestamps (columns)."""
    return F.unix_timestamp(finished) - F.unix_timestamp(started)


def ds_coverage(planned: DataFrame, outcomes: DataFrame, models: DataFrame) -> DataFrame:
    """Model-datasource calls tried / ok / failed, and pre-flight skips.
    ``ok`` counts any body (an empty object included), unlike F8."""
    storage = F.upper(F.coalesce(F.col("target_storage_mode"), F.lit("")))
    skipped = models.agg(
        F.count_if((storage == K.DIRECT_LAKE_MODE) | ~F.col("is_refreshable")).alias("skipped_preflight")
    )
    tried = planned.where(F.col("operation") == K.OP_MODEL_DATASOURCES).select("request_id")
    got = outcomes.where((F.col("operation") == K.OP_MODEL_DATASOURCES) & (F.col("page_no") == 0)).select(
        "request_id", "outcome"
    )
    counts = tried.join(side(got), "request_id", "left").agg(
        F.count(F.lit(1)).alias("tried"),
        F.count_if(F.col("outcome") == "ok").alias("ok"),
        F.count_if(F.coalesce(F.col("outcome"), F.lit("missing")) != "ok").alias("failed"),
    )
    return counts.crossJoin(skipped)


def uncovered_requests(planned: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Planned requests whose first page gave no body -- logged, silent, or never
    captured -- with the reason."""
    first = outcomes.where(F.col("page_no") == 0).select("request_id", "outcome", "http_status_code")
    reason = F.coalesce(F.col("outcome"), F.lit("missing"))
    return planned.join(first, "request_id", "left").where(reason != "ok").select(
        "request_id", "operation", "workspace_id", "item_id", reason.alias("reason"), "http_status_code")


def find_item(items: DataFrame, workspaces: DataFrame, name: str) -> DataFrame:
    """the first item, in listing order, whose display name is exactly ``name`` (no row if none)."""
    order = workspaces.select("workspace_id", F.struct("_page", "_pos").alias("_ws"))
    return (items.where(F.col("item_name") == name).join(order, "workspace_id")
            .orderBy("_ws", "_page", "_pos").limit(1).select("item_id", "workspace_id", "item_name", "item_type"))


def model_names(reports: DataFrame, ordered_models: DataFrame) -> DataFrame:
    """Each report's model and its name (a later listing row wins; "" for unknown ids)."""
    names = ordered_models.groupBy("model_id").agg(
        F.max_by("model_name", F.struct("_ws_order", "_page", "_pos")).alias("model_name"))
    return reports.select("report_id", F.col("linked_model_id").alias("model_id")).join(names, "model_id", "left").select(
        "report_id", "model_id", F.coalesce("model_name", F.lit("")).alias("model_name"))
