"""Power-query partitions from captured DAX results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.functions import jsonx as J
from lakecensus.functions.isotime import strip
from lakecensus.functions.scalars import partition_type_label, stable_id, storage_mode_label, strip_bracket_name
from lakecensus.operators.joins import is_few, side
from lakecensus.operators.normalize import viable_models
from lakecensus.operators.paging import Capture

INT_TEXT = r"^[+-]?\d+(_\d+)*\z"
DAX_RESULT = "struct<results:array<struct<tables:array<struct<rows:array<map<string,variant>>>>>>>"


def dax_rows(cap: Capture, operation: str) -> DataFrame:
    """Rows of the first table of the first result set of each OK DAX call,
    one row per result row, keys normalised ('[T].[C]' -> 'C'; a later duplicate wins).

    Columns: request context, ``model_id`` (= item_id), ``row_pos``, ``r`` (map<string,variant>).
    """
    return cap.dax_rows(operation).withColumnRenamed("item_id", "model_id")


def read_dax_rows(bodies: DataFrame) -> DataFrame:
    """The rows in answers of DAX calls. The body is parsed with a schema of maps (not VARIANT) to
    keep the key order of each row; one that is no JSON has no rows, so its outcome isn't asked for."""
    parsed = F.from_json(F.col("body"), DAX_RESULT)
    rows = F.try_element_at(F.try_element_at(parsed["results"], F.lit(1))["tables"], F.lit(1))["rows"]
    return bodies.select(
        "run_id", "request_id", "workspace_id", "item_id", "item_name", F.posexplode(rows).alias("row_pos", "r"),
    ).withColumn("r", F.transform_keys("r", lambda k, v: strip_bracket_name(k)))


def _kind(x: Column) -> Column:
    return F.schema_of_variant(x)


def int_of(x: Column, default: int | None = None) -> Column:
    """``int(value)``: integral numbers as is, other numbers truncated, numeric text
    parsed; anything else (and a missing value) -> ``default``."""
    k = _kind(x)
    text = strip(F.try_variant_get(x, "$", "string"))
    as_int = (
        F.when(k.isin("TINYINT", "SMALLINT", "INT", "BIGINT"), F.try_variant_get(x, "$", "bigint"))
        .when(k.startswith("DECIMAL") | k.isin("FLOAT", "DOUBLE"), F.try_variant_get(x, "$", "double").cast("bigint"))
        .when(k == "STRING", F.when(text.rlike(INT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint")))
    )
    return F.coalesce(as_int, F.lit(default).cast("bigint")) if default is not None else as_int


def code_of(x: Column) -> Column:
    """Dictionary-key semantics of a JSON code: numbers equal to an integer (2, 2.0) and
    booleans (as 0/1) match; strings never do."""
    k = _kind(x)
    d = F.try_variant_get(x, "$", "double")
    return (
        F.when(k == "BOOLEAN", F.try_variant_get(x, "$", "boolean").cast("int"))
        .when(k.isin("TINYINT", "SMALLINT", "INT", "BIGINT") | k.startswith("DECIMAL") | k.isin("FLOAT", "DOUBLE"),
              F.when(d == F.floor(d), d.cast("bigint")))
    )


def probe_gate(cap: Capture, ordered_models: DataFrame) -> DataFrame:
    """J12 + L2: one row when the probe on the first viable model (listing order) succeeded,
    else no row. ``ordered_models`` carries ``_ws_order``, ``_page``, ``_pos``."""
    first = (
        viable_models(ordered_models)
        .orderBy("_ws_order", "_page", "_pos")
        .limit(1)
        .select("workspace_id", F.col("model_id").alias("item_id"))
    )
    probe_ok = cap.outcomes_of(K.OP_DAX_PROBE).where(F.col("outcome") == "ok").select("workspace_id", "item_id")
    return first.join(probe_ok, ["workspace_id", "item_id"], "left_semi").select(F.lit(True).alias("probe_ok"))


def power_queries(cap: Capture, ordered_models: DataFrame) -> DataFrame:
    """One row per named partition of every viable model whose two DAX calls succeeded,
    provided the probe passed."""
    viable = viable_models(ordered_models).select("workspace_id", "model_id", "model_name")
    ok = cap.light(K.OP_DAX_TABLES, K.OP_DAX_PARTITIONS, K.OP_DAX_PROBE).where(
        (F.col("page_no") == 0) & (F.col("outcome") == "ok"))
    ok_tables, ok_parts = (
        ok.where(F.col("operation") == op).select("workspace_id", F.col("item_id").alias("model_id"))
        for op in (K.OP_DAX_TABLES, K.OP_DAX_PARTITIONS))
    served = (
        viable.join(side(ok_tables), ["workspace_id", "model_id"], "left_semi")
        .join(side(ok_parts), ["workspace_id", "model_id"], "left_semi")  # J11
        .join(probe_gate(cap, ordered_models), how="left_semi", on=F.lit(True))  # J12
    )

    tables = (
        dax_rows(cap, K.OP_DAX_TABLES)
        .select(
            "workspace_id", "model_id", "row_pos",
            int_of(F.col("r")["TableID"], -1).alias("table_id"),
            F.when(F.col("r")["Name"].isNull(), F.lit("")).otherwise(F.try_variant_get(F.col("r")["Name"], "$", "string")).alias("name"),
        )
        .groupBy("workspace_id", "model_id", "table_id")
        .agg(F.max_by("name", "row_pos").alias("table_name"), F.max(F.lit(True)).alias("_matched"))  # J13: later row wins
    )
    r = F.col("r")
    parts = dax_rows(cap, K.OP_DAX_PARTITIONS).select(
        "run_id", "request_id", "workspace_id", "model_id", "row_pos",
        int_of(r["TableID"], -1).alias("table_id"),
        F.try_variant_get(r["Name"], "$", "string").alias("partition_name"),
        partition_type_label(code_of(r["Type"])).alias("partition_type"),
        storage_mode_label(code_of(r["Mode"])).alias("storage_mode"),
        J.text_or(F.when(J.truthy_value(r["QueryDefinition"]), F.try_variant_get(r["QueryDefinition"], "$", "string"))).alias("query_expression"),
    ).where(F.coalesce(F.col("partition_name"), F.lit("")) != "")  # F9

    return (
        parts.join(side(served, is_few(viable)), ["workspace_id", "model_id"], "inner")
        .join(side(tables, is_few(dax_rows(cap, K.OP_DAX_TABLES))), ["workspace_id", "model_id", "table_id"], "left")  # J8
        .select(
            stable_id(F.col("run_id"), F.col("request_id"), F.col("row_pos")).alias("query_id"),
            "model_id",
            "model_name",
            "workspace_id",
            "table_id",
            F.when(F.col("_matched").isNull(), F.concat(F.lit("TableID_"), F.col("table_id").cast("string")))
            .otherwise(F.col("table_name"))
            .alias("table_name"),
            "partition_name",
            "partition_type",
            "storage_mode",
            "query_expression",
            cap.run_ts.alias("extracted_at"),
        )
    )


def pq_coverage(cap: Capture, ordered_models: DataFrame) -> DataFrame:
    """Models total / skipped / successful, and whether the probe passed."""
    m = ordered_models
    storage = F.upper(F.coalesce(F.col("target_storage_mode"), F.lit("")))
    preflight_skip = (storage == K.DIRECT_LAKE_MODE) | ~F.col("is_refreshable")
    ok_t = cap.outcomes_of(K.OP_DAX_TABLES).where(F.col("outcome") == "ok").select("workspace_id", F.col("item_id").alias("model_id"), F.lit(True).alias("t_ok"))
    ok_p = cap.outcomes_of(K.OP_DAX_PARTITIONS).where(F.col("outcome") == "ok").select("workspace_id", F.col("item_id").alias("model_id"), F.lit(True).alias("p_ok"))
    per_model = m.join(side(ok_t), ["workspace_id", "model_id"], "left").join(side(ok_p), ["workspace_id", "model_id"], "left")
    skipped = preflight_skip | F.col("t_ok").isNull() | F.col("p_ok").isNull()
    counts = per_model.agg(
        F.count(F.lit(1)).alias("models_total"),
        F.count_if(preflight_skip).alias("models_skipped_preflight"),
        F.count_if(skipped).alias("models_skipped"),
        F.count_if(~skipped).alias("models_succeeded"),
    )
    gate = probe_gate(cap, ordered_models).agg(F.count(F.lit(1)).alias("_n"))
    return counts.crossJoin(gate).select("*", (F.col("_n") > 0).alias("probe_ok")).drop("_n")
