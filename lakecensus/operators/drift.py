"""Drift of the endpoints' schemas (S1-S16): which fields answers hold, against those that the
tables read.

Elements are taken apart level by level into (path, kind) pairs, which are counted where they are
read and merged; what is shuffled and kept is one row per field and kind, whatever the rows. Fields
inside arrays are counted at ``path[]``, once per array element.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.functions import jsonx as J
from lakecensus.operators.paging import Capture

# the fields that the normalisers read, with the kinds they expect; null is always allowed
READ: dict[str, dict[str, str]] = {
    K.OP_LIST_WORKSPACES: {"id": "STRING", "displayName": "STRING", "type": "STRING", "state": "STRING", "capacityId": "STRING",
                           "description": "STRING"},
    K.OP_ROLE_ASSIGNMENTS: {
        "role": "STRING", "principal": "OBJECT", "principal.id": "STRING", "principal.displayName": "STRING", "principal.type": "STRING",
        "principal.userDetails": "OBJECT", "principal.userDetails.userPrincipalName": "STRING",
        "principal.servicePrincipalDetails": "OBJECT", "principal.servicePrincipalDetails.aadAppId": "STRING",
        "principal.groupDetails": "OBJECT", "principal.groupDetails.email": "STRING"},
    K.OP_LIST_ITEMS: {
        "id": "STRING", "displayName": "STRING", "type": "STRING", "description": "STRING", "createdDate": "STRING", "createdDateTime": "STRING",
        "lastUpdatedDate": "STRING", "lastModifiedDateTime": "STRING", "createdBy": "OBJECT", "createdBy.userIdentity": "OBJECT",
        "createdBy.userIdentity.userPrincipalName": "STRING"},
    K.OP_LIST_DATASETS: {
        "id": "STRING", "name": "STRING", "configuredBy": "STRING", "targetStorageMode": "STRING", "isRefreshable": "BOOLEAN",
        "contentProviderType": "STRING", "createdDate": "STRING", "LastRefreshTime": "STRING"},
    K.OP_LIST_REPORTS: {
        "id": "STRING", "name": "STRING", "reportType": "STRING", "datasetId": "STRING", "webUrl": "STRING", "embedUrl": "STRING",
        "createdBy": "STRING", "createdDateTime": "STRING", "modifiedDateTime": "STRING"},
    K.OP_LIST_DATAFLOWS: {"objectId": "STRING", "name": "STRING", "description": "STRING", "configuredBy": "STRING", "lastRefreshTime": "STRING"},
}
DEPTH = 4  # levels of fields that are looked into: one more than any table reads


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, NUMBER or NULL of a VARIANT."""
    schema = F.schema_of_variant(v)
    return (F.when(F.is_variant_null(v), "NULL").when(schema.startswith("OBJECT"), "OBJECT").when(schema.startswith("ARRAY"), "ARRAY")
            .when(schema.isin("STRING", "BOOLEAN"), schema).otherwise("NUMBER"))


def fields(elements: DataFrame, by: list[str], e: str = "e", depth: int = DEPTH) -> DataFrame:
    """(by, path, kind, rows): every field of the elements, and how many hold it."""
    level = elements.select(*by, F.lit("").alias("path"), F.col(e).alias("v"))
    parts = []
    for _ in range(depth):
        members = F.explode(J.vget("v", "$", "map<string,variant>")).alias("name", "v")
        inside = level.where(F.col("v").isNotNull()).select(*by, "path", members)
        named = inside.select(*by, F.concat("path", F.when(F.col("path") == "", "").otherwise("."), "name").alias("path"), "v",
                              kind(F.col("v")).alias("kind"))
        parts.append(named.groupBy(*by, "path", "kind").agg(F.count(F.lit(1)).alias("rows")))
        arrays = named.where("kind = 'ARRAY'").select(
            *by, F.concat("path", F.lit("[]")).alias("path"), F.explode(J.vget("v", "$", "array<variant>")).alias("v"))
        level = named.where("kind = 'OBJECT'").select(*by, "path", "v").unionByName(arrays)
    return reduce(DataFrame.unionByName, parts).groupBy(*by, "path", "kind").agg(F.sum("rows").alias("rows"))


def schema_drift(cap: Capture, operations=None) -> DataFrame:
    """(operation, path, kind, rows, share, finding) of the listings' fields. ``share`` is of the
    elements of the operation; finding is ``read``, ``other kind`` (a field that is read, of a kind
    that wasn't expected), ``unknown`` (nobody reads it) or ``missing`` (read, but in no answer)."""
    operations = list(operations or READ)
    cap.warm(operations)
    elements = reduce(DataFrame.unionByName, [cap.elements(op).select("operation", "e") for op in operations])
    totals = elements.groupBy("operation").agg(F.count(F.lit(1)).alias("_all"))
    spark = cap.spark
    expected = spark.createDataFrame([(op, path, k) for op in operations for path, k in READ[op].items()], "operation string, path string, _kind string")
    seen = fields(elements, ["operation"])
    finding = (F.when(F.col("_kind").isNull(), "unknown").when(F.col("kind").isNull(), "missing")
               .when((F.col("kind") == F.col("_kind")) | (F.col("kind") == "NULL"), "read").otherwise("other kind"))
    # both sides are as many rows as there are fields
    return seen.join(expected, ["operation", "path"], "full").join(totals, "operation", "left").select(
        "operation", "path", F.coalesce("kind", "_kind").alias("kind"), F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce(F.col("rows") / F.col("_all"), F.lit(0.0)).alias("share"), finding.alias("finding"))
