"""Datasources: four branches (N6 / N7 row builders) and their UNION ALL.

Every branch is "entity list join response elements" on (workspace_id, item id), J3/J4: the
entity side is small next to the responses, and Spark picks the join strategy from sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.functions import jsonx as J
from lakecensus.operators.joins import side
from lakecensus.operators.paging import Capture

DS_COLUMNS = [
    "datasource_id", "source_item_id", "source_item_type", "source_item_name", "workspace_id",
    "datasource_type", "server", "database", "url", "gateway_id", "gateway_name", "credential_type",
    "credential_username", "shortcut_name", "shortcut_path", "extracted_at",
]


def datasource_row(e: Column, source_type: str, run_ts: Column) -> list[Column]:
    """A datasource record; server falls back to the connection url."""
    return [
        F.coalesce(J.vget(e, "$.datasourceId"), F.col("eid")).alias("datasource_id"),
        F.col("item_id").alias("source_item_id"),
        F.lit(source_type).alias("source_item_type"),
        F.col("workspace_id"),
        J.get_default(e, "$.datasourceType").alias("datasource_type"),
        J.first_truthy(e, ["$.connectionDetails.server", "$.connectionDetails.url"]).alias("server"),
        J.get_or(e, "$.connectionDetails.database").alias("database"),
        J.get_or(e, "$.connectionDetails.url").alias("url"),
        J.get_or(e, "$.gatewayId").alias("gateway_id"),
        F.lit("").alias("gateway_name"),
        J.get_or(e, "$.credentialDetails.credentialType").alias("credential_type"),
        J.get_or(e, "$.credentialDetails.username").alias("credential_username"),
        F.lit("").alias("shortcut_name"),
        F.lit("").alias("shortcut_path"),
        run_ts.alias("extracted_at"),
    ]


def shortcut_row(e: Column, run_ts: Column, case_insensitive: bool = False) -> list[Column]:
    """A lakehouse shortcut as a datasource. The connection object is the member of
    ``target`` named by ``target.type`` (exact case unless ``case_insensitive``)."""
    target = J.vget(e, "$.target", "variant")
    target_type = J.get_default(e, "$.target.type")
    if case_insensitive:
        keys = F.map_keys(J.vget(target, "$", "map<string,variant>"))
        match = F.element_at(F.filter(keys, lambda k: F.lower(k) == F.lower(target_type)), 1)
        conn = J.dynamic_member(target, match)
    else:
        conn = J.dynamic_member(target, target_type)
    server = J.first_truthy(conn, ["$.location", "$.url", "$.endpoint"])
    return [
        F.col("eid").alias("datasource_id"),
        F.col("item_id").alias("source_item_id"),
        F.lit("Lakehouse").alias("source_item_type"),
        F.col("workspace_id"),
        target_type.alias("datasource_type"),
        server.alias("server"),
        J.first_truthy(conn, ["$.subpath", "$.bucket", "$.path"]).alias("database"),
        F.coalesce(F.nullif(J.get_or(conn, "$.url"), F.lit("")), server).alias("url"),
        J.get_or(conn, "$.connectionId").alias("gateway_id"),
        F.lit("").alias("gateway_name"),
        F.lit("").alias("credential_type"),
        F.lit("").alias("credential_username"),
        J.get_default(e, "$.name").alias("shortcut_name"),
        J.get_default(e, "$.path").alias("shortcut_path"),
        run_ts.alias("extracted_at"),
    ]


def _responses(cap: Capture, operation: str, sources: DataFrame, row: list[Column]) -> DataFrame:
    """Rows of `operation`'s elements for the given (workspace_id, source_item_id, source_item_name);
    fields are extracted before the join."""
    return cap.elements(operation).select(*row).join(side(sources), ["workspace_id", "source_item_id"], "inner").select(*DS_COLUMNS)


def ds_models(cap: Capture, models: DataFrame) -> DataFrame:
    """[A] datasources of the (viable) semantic models."""
    src = models.select("workspace_id", F.col("model_id").alias("source_item_id"), F.col("model_name").alias("source_item_name"))
    return _responses(cap, K.OP_MODEL_DATASOURCES, src, datasource_row(F.col("e"), "SemanticModel", cap.run_ts))


def ds_gen1(cap: Capture, dataflows: DataFrame) -> DataFrame:
    """[B] datasources of Gen1 dataflows."""
    src = dataflows.select("workspace_id", F.col("dataflow_id").alias("source_item_id"), F.col("dataflow_name").alias("source_item_name"))
    return _responses(cap, K.OP_DATAFLOW_DATASOURCES, src, datasource_row(F.col("e"), "Dataflow", cap.run_ts))


def gen2_items(items: DataFrame) -> DataFrame:
    """items typed as a Gen2 dataflow (three spellings)."""
    return items.where(F.col("item_type").isin(*K.DATAFLOW_GEN2_TYPES))


def lakehouse_items(items: DataFrame) -> DataFrame:
    """F4."""
    return items.where(F.col("item_type") == "Lakehouse")


def ds_gen2(cap: Capture, items: DataFrame) -> DataFrame:
    """[C] datasources of Gen2 dataflows (items catalogue, same endpoint family)."""
    src = gen2_items(items).select("workspace_id", F.col("item_id").alias("source_item_id"), F.col("item_name").alias("source_item_name"))
    return _responses(cap, K.OP_GEN2_DATASOURCES, src, datasource_row(F.col("e"), "DataflowGen2", cap.run_ts))


def ds_shortcuts(cap: Capture, items: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """[D] lakehouse shortcuts (a paged listing per lakehouse)."""
    src = lakehouse_items(items).select("workspace_id", F.col("item_id").alias("source_item_id"), F.col("item_name").alias("source_item_name"))
    return _responses(cap, K.OP_SHORTCUTS, src, shortcut_row(F.col("e"), cap.run_ts, case_insensitive))


def datasources_all(branches: list[DataFrame]) -> DataFrame:
    """UNION ALL of the branches, no dedup."""
    return reduce(lambda a, b: a.unionByName(b), [b.select(*DS_COLUMNS) for b in branches])
