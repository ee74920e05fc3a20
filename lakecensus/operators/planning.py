"""Request planning (R1-R3, X22): which calls a run makes, as data.

Request ids follow one convention, shared with the capture: ``operation|workspace[|item]``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.functions.scalars import api_family

WS = K.WORKSPACE_API_BASE
BI = K.BI_API_BASE

# (operation, URL template over the workspace id) for the per-workspace listings.
WORKSPACE_ENDPOINTS = [
    (K.OP_ROLE_ASSIGNMENTS, WS + "/workspaces/%s/roleAssignments"),
    (K.OP_LIST_ITEMS, WS + "/workspaces/%s/items"),
    (K.OP_LIST_DATASETS, BI + "/groups/%s/datasets"),
    (K.OP_LIST_REPORTS, BI + "/groups/%s/reports"),
    (K.OP_LIST_DATAFLOWS, BI + "/groups/%s/dataflows"),
]
# URL templates over (workspace id, item id) for the per-entity calls.
ENTITY_URLS = {
    K.OP_MODEL_DATASOURCES: BI + "/groups/%s/datasets/%s/datasources",
    K.OP_DATAFLOW_DATASOURCES: BI + "/groups/%s/dataflows/%s/datasources",
    K.OP_GEN2_DATASOURCES: BI + "/groups/%s/dataflows/%s/datasources",
    K.OP_SHORTCUTS: WS + "/workspaces/%s/lakehouses/%s/shortcuts",
    K.OP_REFRESH_SCHEDULE: BI + "/groups/%s/datasets/%s/refreshSchedule",
    K.OP_REFRESH_HISTORY: BI + "/groups/%s/datasets/%s/refreshes?$top=50",
    K.OP_DATAFLOW_SCHEDULE: BI + "/groups/%s/dataflows/%s/refreshSchedule",
    K.OP_DAX_TABLES: BI + "/groups/%s/datasets/%s/executeQueries",
    K.OP_DAX_PARTITIONS: BI + "/groups/%s/datasets/%s/executeQueries",
    K.OP_DAX_PROBE: BI + "/groups/%s/datasets/%s/executeQueries",
}


def request_key(operation: Column, workspace_id: Column, item_id: Column | None = None) -> Column:
    parts = [operation, workspace_id] + ([item_id] if item_id is not None else [])
    return F.concat_ws("|", *parts)


def plan_workspace_requests(workspaces: DataFrame) -> DataFrame:
    """Every workspace x the five per-workspace listings (a 5-row broadcast side)."""
    spark = workspaces.sparkSession
    templates = spark.createDataFrame(WORKSPACE_ENDPOINTS, "operation string, template string")
    planned = workspaces.select("workspace_id").crossJoin(F.broadcast(templates))
    url = F.expr("format_string(template, workspace_id)")
    return planned.select(
        request_key(F.col("operation"), F.col("workspace_id")).alias("request_id"),
        "operation",
        "workspace_id",
        F.lit(None).cast("string").alias("item_id"),
        url.alias("url"),
        api_family(url).alias("api_family"),
    )


def _entity(df: DataFrame, operation: str, id_col: str) -> DataFrame:
    url = F.format_string(ENTITY_URLS[operation], F.col("workspace_id"), F.col(id_col))
    return df.select(
        request_key(F.lit(operation), F.col("workspace_id"), F.col(id_col)).alias("request_id"),
        F.lit(operation).alias("operation"),
        "workspace_id",
        F.col(id_col).alias("item_id"),
        url.alias("url"),
        api_family(url).alias("api_family"),
    )


def plan_entity_requests(models: DataFrame, dataflows: DataFrame, items: DataFrame, preflight: bool = True) -> DataFrame:
    """R2: per-entity calls. Filters (F3-F6) are applied before planning, as the extractor does."""
    storage = F.upper(F.coalesce(F.col("target_storage_mode"), F.lit("")))
    viable = models.where((storage != K.DIRECT_LAKE_MODE) & F.col("is_refreshable"))
    refreshable = models.where(F.col("is_refreshable"))
    parts = [
        _entity(viable if preflight else models, K.OP_MODEL_DATASOURCES, "model_id"),
        _entity(dataflows, K.OP_DATAFLOW_DATASOURCES, "dataflow_id"),
        _entity(items.where(F.col("item_type").isin(*K.DATAFLOW_GEN2_TYPES)), K.OP_GEN2_DATASOURCES, "item_id"),
        _entity(items.where(F.col("item_type") == "Lakehouse"), K.OP_SHORTCUTS, "item_id"),
        _entity(refreshable, K.OP_REFRESH_SCHEDULE, "model_id"),
        _entity(refreshable, K.OP_REFRESH_HISTORY, "model_id"),
        _entity(dataflows, K.OP_DATAFLOW_SCHEDULE, "dataflow_id"),
        _entity(viable, K.OP_DAX_TABLES, "model_id"),
        _entity(viable, K.OP_DAX_PARTITIONS, "model_id"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
