"""Fixed schemas: the landing table (input) and the twelve output tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S, B, L, T, I = StringType(), BooleanType(), LongType(), TimestampType(), IntegerType()


def _struct(spec: str, types: dict) -> StructType:
    fields = []
    for item in spec.split(","):
        name, code = item.split()
        fields.append(StructField(name, types[code], True))
    return StructType(fields)


_CODES = {"s": S, "b": B, "l": L, "t": T, "i": I}

# One row per HTTP attempt (page_no is the 0-based position in a continuation chain,
# attempt is 1-based; (request_id, page_no, attempt) is unique, and request_id is unique per
# operation within a run). `query` holds the POST text for DAX calls and is null for GETs.
LANDING = _struct(
    "run_id s, operation s, request_id s, workspace_id s, item_id s, item_type s, item_name s, "
    "url s, query s, page_no i, attempt i, status i, retry_after i, error_kind s, body s, "
    "requested_at t",
    _CODES,
)

OUTPUTS: dict[str, StructType] = {
    name: _struct(spec + ", extracted_at t", _CODES)
    for name, spec in {
        "meta_workspaces": "workspace_id s, workspace_name s, workspace_type s, state s, capacity_id s, "
        "description s, is_on_dedicated_capacity b",
        "meta_workspace_users": "id s, workspace_id s, user_email s, display_name s, principal_type s, "
        "workspace_role s",
        "meta_workspace_items": "item_id s, workspace_id s, item_name s, item_type s, description s, "
        "created_date t, last_modified_date t, created_by_email s",
        "meta_semantic_models": "model_id s, workspace_id s, model_name s, configured_by s, "
        "target_storage_mode s, is_refreshable b, content_provider_type s, created_date t, modified_date t",
        "meta_datasources": "datasource_id s, source_item_id s, source_item_type s, source_item_name s, "
        "workspace_id s, datasource_type s, server s, database s, url s, gateway_id s, gateway_name s, "
        "credential_type s, credential_username s, shortcut_name s, shortcut_path s",
        "meta_refresh_schedules": "schedule_id s, model_id s, workspace_id s, is_enabled b, notify_option s, "
        "notification_email s, days s, times s, timezone s",
        "meta_refresh_history": "refresh_id s, model_id s, workspace_id s, start_time t, end_time t, "
        "status s, refresh_type s, service_exception_code s, service_exception_message s",
        "meta_reports": "report_id s, workspace_id s, report_name s, report_type s, linked_model_id s, "
        "web_url s, embed_url s, created_by_email s, created_date t, modified_date t",
        "meta_dataflows": "dataflow_id s, workspace_id s, dataflow_name s, description s, configured_by s, "
        "is_refresh_scheduled b, refresh_schedule_days s, refresh_schedule_times s, notify_option s, "
        "notification_email s, last_refresh_time t, last_refresh_status s",
        "meta_other_assets": "asset_id s, workspace_id s, asset_name s, asset_type s, description s, "
        "created_date t, last_modified_date t",
        "meta_power_queries": "query_id s, model_id s, model_name s, workspace_id s, table_id l, "
        "table_name s, partition_name s, partition_type s, storage_mode s, query_expression s",
        "meta_access_errors": "error_id s, workspace_id s, workspace_name s, item_id s, item_type s, "
        "item_name s, operation s, http_status_code l, error_code s, error_message s, requires_admin b",
    }.items()
}

# Write order of the run: access errors last, as they depend on every other step.
TABLE_ORDER = list(OUTPUTS)


def conform(df, schema: StructType):
    """Select the schema's columns, in order, cast to the declared types."""
    from pyspark.sql import functions as F

    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
