"""Normalisers N1-N5, N10-N12: one projection per output table, over endpoint elements.

Each returns the table's columns plus ``_page``/``_pos`` (listing order), which the pipeline
drops when it conforms the table to its schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.functions import jsonx as J
from lakecensus.functions.scalars import parse_ts
from lakecensus.operators.joins import is_few, side
from lakecensus.operators.paging import Capture

ORDER = ["page_no AS _page", "pos AS _pos"]


def workspace_columns(e: Column) -> list[Column]:
    return [
        J.get_default(e, "$.id").alias("workspace_id"),
        J.get_default(e, "$.displayName").alias("workspace_name"),
        J.get_default(e, "$.type").alias("workspace_type"),
        J.get_default(e, "$.state").alias("state"),
        J.get_or(e, "$.capacityId").alias("capacity_id"),
        J.get_or(e, "$.description").alias("description"),
        J.truthy(e, "$.capacityId").alias("is_on_dedicated_capacity"),
    ]


def norm_workspaces(cap: Capture) -> DataFrame:
    """Every listed workspace."""
    e = F.col("e")
    return cap.elements(K.OP_LIST_WORKSPACES).select(*workspace_columns(e), cap.run_ts.alias("extracted_at"), *[F.expr(x) for x in ORDER])


def norm_workspace_single(cap: Capture, workspace_id: str) -> DataFrame:
    """The current workspace, from its own GET (a bare object)."""
    e = F.col("e")
    return (
        cap.objects(K.OP_GET_WORKSPACE)
        .where(F.col("workspace_id") == F.lit(workspace_id))
        .where(J.truthy_value(e))  # `if not data: return`
        .select(*workspace_columns(e), cap.run_ts.alias("extracted_at"), F.lit(0).alias("_page"), F.lit(0).alias("_pos"))
    )


def in_scope(elements: DataFrame, workspaces: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """keep responses of requests made for in-scope workspaces. ``asked``, the stored list of the
    workspaces that have such responses, is what is joined, with the workspaces and then with the
    elements: where it is short it is broadcast, however many workspaces there are, and both stay where
    they are."""
    scope = workspaces.select("workspace_id")
    if asked is None:
        return elements.join(side(scope), "workspace_id", "left_semi")
    few = is_few(asked)
    known = scope.join(side(asked, few), "workspace_id", "left_semi").distinct()  # a workspace may be listed again
    return elements.join(side(known, few), "workspace_id", "left_semi")


def norm_users(cap: Capture, workspaces: DataFrame) -> DataFrame:
    """Role assignments; id = '{workspace}_{principal id}', email = first truthy of three."""
    e = F.col("e")
    el = cap.elements(K.OP_ROLE_ASSIGNMENTS)
    principal_id = F.coalesce(J.vget(e, "$.principal.id", "string"), F.col("eid"))
    return in_scope(el.select(
        F.concat_ws("_", F.col("workspace_id"), principal_id).alias("id"),
        F.col("workspace_id"),
        J.first_truthy(
            e,
            [
                "$.principal.userDetails.userPrincipalName",
                "$.principal.servicePrincipalDetails.aadAppId",
                "$.principal.groupDetails.email",
            ],
        ).alias("user_email"),
        J.get_default(e, "$.principal.displayName").alias("display_name"),
        J.get_default(e, "$.principal.type").alias("principal_type"),
        J.get_default(e, "$.role").alias("workspace_role"),
        cap.run_ts.alias("extracted_at"),
        *[F.expr(x) for x in ORDER],
    ), workspaces, cap.asked(K.OP_ROLE_ASSIGNMENTS))


def norm_items(cap: Capture, workspaces: DataFrame) -> DataFrame:
    """The item catalogue of every workspace."""
    e = F.col("e")
    el = cap.elements(K.OP_LIST_ITEMS)
    return in_scope(el.select(
        J.get_default(e, "$.id").alias("item_id"),
        F.col("workspace_id"),
        J.get_default(e, "$.displayName").alias("item_name"),
        J.get_default(e, "$.type").alias("item_type"),
        J.get_or(e, "$.description").alias("description"),
        parse_ts(J.first_truthy(e, ["$.createdDate", "$.createdDateTime"], None)).alias("created_date"),
        parse_ts(J.first_truthy(e, ["$.lastUpdatedDate", "$.lastModifiedDateTime"], None)).alias("last_modified_date"),
        J.get_default(e, "$.createdBy.userIdentity.userPrincipalName").alias("created_by_email"),
        cap.run_ts.alias("extracted_at"),
        *[F.expr(x) for x in ORDER],
    ), workspaces, cap.asked(K.OP_LIST_ITEMS))


def norm_models(cap: Capture, workspaces: DataFrame) -> DataFrame:
    """Semantic models. ``LastRefreshTime`` is read with its capital L (keys are case
    sensitive)."""
    e = F.col("e")
    el = cap.elements(K.OP_LIST_DATASETS)
    return in_scope(el.select(
        J.get_default(e, "$.id").alias("model_id"),
        F.col("workspace_id"),
        J.get_default(e, "$.name").alias("model_name"),
        J.get_or(e, "$.configuredBy").alias("configured_by"),
        J.get_or(e, "$.targetStorageMode").alias("target_storage_mode"),
        J.truthy(e, "$.isRefreshable").alias("is_refreshable"),
        J.get_or(e, "$.contentProviderType").alias("content_provider_type"),
        parse_ts(J.vget(e, "$.createdDate")).alias("created_date"),
        parse_ts(J.vget(e, "$.LastRefreshTime")).alias("modified_date"),
        cap.run_ts.alias("extracted_at"),
        *[F.expr(x) for x in ORDER],
    ), workspaces, cap.asked(K.OP_LIST_DATASETS))


def norm_reports(cap: Capture, workspaces: DataFrame) -> DataFrame:
    """Reports; linked_model_id is the report's datasetId."""
    e = F.col("e")
    el = cap.elements(K.OP_LIST_REPORTS)
    return in_scope(el.select(
        J.get_default(e, "$.id").alias("report_id"),
        F.col("workspace_id"),
        J.get_default(e, "$.name").alias("report_name"),
        J.get_or(e, "$.reportType").alias("report_type"),
        J.get_or(e, "$.datasetId").alias("linked_model_id"),
        J.get_or(e, "$.webUrl").alias("web_url"),
        J.get_or(e, "$.embedUrl").alias("embed_url"),
        J.get_or(e, "$.createdBy").alias("created_by_email"),
        parse_ts(J.vget(e, "$.createdDateTime")).alias("created_date"),
        parse_ts(J.vget(e, "$.modifiedDateTime")).alias("modified_date"),
        cap.run_ts.alias("extracted_at"),
        *[F.expr(x) for x in ORDER],
    ), workspaces, cap.asked(K.OP_LIST_REPORTS))


def norm_dataflows(cap: Capture, workspaces: DataFrame) -> DataFrame:
    """N11 + J5: Gen1 dataflows, left-joined to their schedule (no schedule -> {})."""
    e = F.col("e")
    flows = in_scope(cap.elements(K.OP_LIST_DATAFLOWS).select(
        "workspace_id", J.get_default(e, "$.objectId").alias("dataflow_id"), J.get_default(e, "$.name").alias("dataflow_name"),
        J.get_or(e, "$.description").alias("description"), J.get_or(e, "$.configuredBy").alias("configured_by"),
        J.vget(e, "$.lastRefreshTime").alias("_last"), *[F.expr(x) for x in ORDER]), workspaces, cap.asked(K.OP_LIST_DATAFLOWS))
    schedule = {
        "is_refresh_scheduled": (J.truthy(e, "$.enabled"), F.lit(False)), "refresh_schedule_days": (J.array_csv(e, "$.days"), F.lit("")),
        "refresh_schedule_times": (J.array_csv(e, "$.times"), F.lit("")), "notify_option": (J.get_or(e, "$.notifyOption"), F.lit("")),
        "notification_email": (J.get_or(e, "$.notificationGroupMailAddress"), F.lit("")),
    }
    sched = cap.objects(K.OP_DATAFLOW_SCHEDULE).select(
        "workspace_id", F.col("item_id").alias("dataflow_id"), *[c.alias(n) for n, (c, _) in schedule.items()])
    return flows.join(side(sched), ["workspace_id", "dataflow_id"], "left").select(
        "dataflow_id", "workspace_id", "dataflow_name", "description", "configured_by",
        *[F.coalesce(F.col(n), none).alias(n) for n, (_, none) in schedule.items()],
        parse_ts(F.col("_last")).alias("last_refresh_time"),
        F.lit("").alias("last_refresh_status"),
        cap.run_ts.alias("extracted_at"),
        "_page", "_pos",
    )


def other_assets(items: DataFrame) -> DataFrame:
    """N12 + F2: items of the other-asset types, renamed."""
    return items.where(F.col("item_type").isin(*K.OTHER_ASSET_TYPES)).select(
        F.col("item_id").alias("asset_id"),
        "workspace_id",
        F.col("item_name").alias("asset_name"),
        F.col("item_type").alias("asset_type"),
        "description",
        "created_date",
        "last_modified_date",
        "extracted_at",
        "_page",
        "_pos",
    )


def viable_models(models: DataFrame) -> DataFrame:
    """F5 + F6: models that can answer datasource and DAX calls (not Direct Lake, refreshable)."""
    storage = F.upper(F.coalesce(F.col("target_storage_mode"), F.lit("")))
    return models.where((storage != K.DIRECT_LAKE_MODE) & F.col("is_refreshable"))
