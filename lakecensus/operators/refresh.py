"""Refresh schedules (N8, J6, F8) and refresh history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.functions import jsonx as J
from lakecensus.functions.scalars import parse_ts
from lakecensus.operators.joins import side
from lakecensus.operators.paging import Capture


def refreshable(models: DataFrame) -> DataFrame:
    """F5."""
    return models.where(F.col("is_refreshable"))


def refresh_schedules(cap: Capture, models: DataFrame) -> DataFrame:
    """One row per refreshable model whose schedule response is a non-empty object."""
    m = refreshable(models).select("workspace_id", "model_id")
    s = F.col("e")
    resp = cap.objects(K.OP_REFRESH_SCHEDULE).where(J.truthy_value(s))  # `if not data: continue`
    return resp.select(
        F.col("item_id").alias("model_id"),
        "workspace_id",
        J.truthy(s, "$.enabled").alias("is_enabled"),
        J.get_or(s, "$.notifyOption").alias("notify_option"),
        J.get_or(s, "$.notificationGroupMailAddress").alias("notification_email"),
        J.array_csv(s, "$.days").alias("days"),
        J.array_csv(s, "$.times").alias("times"),
        J.get_or(s, "$.localTimeZoneId", "UTC").alias("timezone"),
        cap.run_ts.alias("extracted_at"),
    ).join(side(m), ["workspace_id", "model_id"], "inner").withColumn("schedule_id", F.concat_ws("_", "model_id", "workspace_id"))


def refresh_history(
    cap: Capture,
    models: DataFrame,
    days: int = K.REFRESH_HISTORY_DAYS,
    top: int = K.REFRESH_HISTORY_TOP,
) -> DataFrame:
    """The first ``top`` refreshes of each model's response, kept when they started within
    ``days`` of the run (or have no start time).

    The endpoint is read as one response per model (no continuation), so "first ``top`` in
    response order" is a position filter on page 0 -- no window, no shuffle, and a model with
    a huge history costs the same as any other.
    """
    m = refreshable(models).select("workspace_id", "model_id")
    e = F.col("e")
    cutoff = cap.run_ts - F.expr(f"INTERVAL {int(days)} DAYS")
    svc = J.json_or_empty(J.get_or(e, "$.serviceExceptionJson", None))
    rows = cap.elements(K.OP_REFRESH_HISTORY).where(F.col("pos") < top).select(
        F.col("eid").alias("refresh_id"), F.col("item_id").alias("model_id"), "workspace_id",
        J.vget(e, "$.startTime").alias("_start"), J.vget(e, "$.endTime").alias("_end"),
        J.get_default(e, "$.status").alias("status"), J.get_or(e, "$.refreshType").alias("refresh_type"), svc.alias("_svc"))
    # bound in an array, so that the filter doesn't parse the time a second time
    timed = rows.select("*", F.explode(F.array(parse_ts(F.col("_start")))).alias("start_time"))
    return (
        timed.where(F.col("start_time").isNull() | (F.col("start_time") >= cutoff))
        .join(side(m), ["workspace_id", "model_id"], "inner")
        .select(
            "refresh_id",
            "model_id",
            "workspace_id",
            "start_time",
            parse_ts(F.col("_end")).alias("end_time"),
            "status",
            "refresh_type",
            J.get_or("_svc", "$.errorCode").alias("service_exception_code"),
            J.get_or("_svc", "$.errorDescription").alias("service_exception_message"),
            cap.run_ts.alias("extracted_at"),
        )
    )
