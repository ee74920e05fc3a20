"""DAX rows, gates and fallbacks (N13), and single tables (K1, K2, K4)."""

import json
import tempfile

from pyspark.sql import functions as F

from lakecensus.operators.paging import Capture
from lakecensus.plans.pipeline import Inventory
from lakecensus.sources.sink import write_table


def dax_body(rows):
    return json.dumps({"results": [{"tables": [{"rows": rows}]}]})


def capture(landing, probe_status=200, parts_status=200):
    ws = json.dumps({"value": [{"id": "ws-1", "displayName": "W"}]})
    models = json.dumps({"value": [
        {"id": "m1", "name": "M1", "isRefreshable": True, "targetStorageMode": "PremiumFiles"},
        {"id": "m2", "name": "M2", "isRefreshable": True, "targetStorageMode": "abf"},
    ]})
    tables = dax_body([{"[TableID]": 1, "[Name]": "Sales"}, {"[TableID]": 2, "[Name]": None}])
    parts = dax_body([
        {"[Partition].[TableID]": 1, "[Name]": "decoy", "[Partition].[Name]": "P1", "[Type]": 2, "[Mode]": 0,
         "[QueryDefinition]": "let x = 1 in x"},
        {"[TableID]": 2, "[Name]": "P2", "[Type]": 2.0, "[Mode]": 9, "[QueryDefinition]": None},
        {"[TableID]": "3", "[Name]": "P3", "[Type]": "2", "[Mode]": 1},
        {"[Name]": "P4", "[Type]": 4},
        {"[TableID]": 1, "[Name]": "", "[Type]": 2},
    ])
    rows = [
        {"request_id": "w", "operation": "ListWorkspaces", "status": 200, "body": ws},
        {"request_id": "d", "operation": "ListDatasets", "workspace_id": "ws-1", "status": 200, "body": models},
        {"request_id": "t", "operation": "ExecuteDaxTables", "workspace_id": "ws-1", "item_id": "m1", "status": 200, "body": tables},
        {"request_id": "p", "operation": "ExecuteDaxPartitions", "workspace_id": "ws-1", "item_id": "m1",
         "status": parts_status, "body": parts if parts_status == 200 else "{}"},
        {"request_id": "q", "operation": "ExecuteDaxProbe", "workspace_id": "ws-1", "item_id": "m1",
         "status": probe_status, "body": dax_body([{"[OK]": 1}])},
    ]
    return Capture(landing(rows), "2001-10-01 00:00:00")


def test_power_queries(spark, landing):
    inv = Inventory(capture(landing))
    got = {r["partition_name"]: r for r in inv.power_queries.collect()}
    assert set(got) == {"P1", "P2", "P3", "P4"}
    assert (got["P1"]["table_name"], got["P1"]["partition_type"], got["P1"]["storage_mode"]) == ("Sales", "M", "Import")
    assert got["P1"]["query_expression"] == "let x = 1 in x"
    assert (got["P2"]["table_name"], got["P2"]["partition_type"], got["P2"]["storage_mode"]) == (None, "M", "Unknown")
    assert got["P2"]["query_expression"] == ""
    assert (got["P3"]["table_id"], got["P3"]["table_name"], got["P3"]["partition_type"]) == (3, "TableID_3", "Unknown")
    assert (got["P4"]["table_id"], got["P4"]["table_name"]) == (-1, "TableID_-1")


def test_failed_probe_empties_result(spark, landing):
    assert Inventory(capture(landing, probe_status=400)).power_queries.count() == 0


def test_failed_partitions_call_skips_model(spark, landing):
    inv = Inventory(capture(landing, parts_status=403))
    assert inv.power_queries.count() == 0
    assert inv.errors.where(F.col("requires_admin")).count() == 1


def test_sink_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="lakecensus-sink-")
    path = f"{root}/t"
    assert write_table(spark.range(3), path) == 3
    assert write_table(spark.range(5).withColumnRenamed("id", "x"), path) == 5  # overwrite, schema replaced
    assert spark.read.parquet(path).columns == ["x"]
    assert write_table(spark.range(0), path) is None  # empty: previous table kept
    assert spark.read.parquet(path).count() == 5
    assert write_table(spark.range(0), path, on_empty="overwrite") == 0
    assert spark.read.parquet(path).count() == 0


def test_scope_validation(spark, landing):
    import pytest

    cap = capture(landing)
    with pytest.raises(ValueError):
        Inventory(cap, scope="some")
    with pytest.raises(ValueError):
        Inventory(cap, scope="current")


def test_preflight_flag_and_case_insensitive_shortcuts(spark, landing):
    ws = json.dumps({"value": [{"id": "ws-1", "displayName": "W"}]})
    models = json.dumps({"value": [{"id": "m1", "name": "M1", "isRefreshable": False}]})
    items = json.dumps({"value": [{"id": "lh", "displayName": "LH", "type": "Lakehouse"}]})
    ds = json.dumps({"value": [{"datasourceId": "d1", "datasourceType": "Sql", "connectionDetails": {"server": "s"}}]})
    sc = json.dumps({"value": [{"name": "a", "path": "/p", "target": {"type": "S3", "s3": {"location": "loc", "bucket": "b"}}}]})
    rows = [
        {"request_id": "w", "operation": "ListWorkspaces", "status": 200, "body": ws},
        {"request_id": "d", "operation": "ListDatasets", "workspace_id": "ws-1", "status": 200, "body": models},
        {"request_id": "i", "operation": "ListWorkspaceItems", "workspace_id": "ws-1", "status": 200, "body": items},
        {"request_id": "x", "operation": "GetSemanticModelDatasources", "workspace_id": "ws-1", "item_id": "m1",
         "status": 200, "body": ds},
        {"request_id": "s", "operation": "GetLakehouseShortcuts", "workspace_id": "ws-1", "item_id": "lh",
         "status": 200, "body": sc},
    ]
    cap = Capture(landing(rows), "2001-10-01 00:00:00")
    assert Inventory(cap).datasource_branches()["SemanticModel"].count() == 0  # not refreshable: skipped
    assert Inventory(cap, preflight=False).datasource_branches()["SemanticModel"].count() == 1
    exact = Inventory(cap).datasource_branches()["Lakehouse"].first()
    loose = Inventory(cap, case_insensitive_shortcuts=True).datasource_branches()["Lakehouse"].first()
    assert (exact["server"], exact["database"]) == ("", "")
    assert (loose["server"], loose["database"]) == ("loc", "b")


def test_read_landing_parquet_and_json(spark, landing):
    from lakecensus.sources.landing import read_landing

    df = landing([{"request_id": "a", "operation": "ListReports", "status": 200, "body": '{"value": [1]}'},
                  {"request_id": "b", "operation": "ListReports", "status": 404, "run_id": "other"}])
    root = tempfile.mkdtemp(prefix="lakecensus-landing-")
    df.write.partitionBy("operation").parquet(f"{root}/p")
    df.write.json(f"{root}/j")
    assert read_landing(spark, f"{root}/p").count() == 2
    assert read_landing(spark, f"{root}/j", fmt="json", run_id="r").count() == 1
    assert read_landing(spark, f"{root}/p").columns == df.columns


def test_run_without_workspaces_writes_nothing(spark, landing):
    rows = [
        {"request_id": "w", "operation": "ListWorkspaces", "status": 403, "body": '{"error": {"code": "X"}}'},
        {"request_id": "d", "operation": "ListDatasets", "workspace_id": "ws-1", "status": 200, "body": '{"value": []}'},
    ]
    inv = Inventory(Capture(landing(rows), "2001-10-01 00:00:00"))
    root = tempfile.mkdtemp(prefix="lakecensus-empty-run-")
    assert inv.write(root) == {}
    assert inv.errors.count() == 1  # the error is still visible as a DataFrame
