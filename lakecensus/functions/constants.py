"""Fixed values that must equal the extractor's for identical results."""

# --- fixed values -----------------------------------------------------------------------
# Item types routed to meta_other_assets.
OTHER_ASSET_TYPES = (
    "Lakehouse", "Notebook", "Warehouse", "DataPipeline",
    "MLModel", "MLExperiment", "SparkJobDefinition",
    "KQLDatabase", "KQLQueryset", "Eventstream", "Reflex",
    "Environment", "MirroredDatabase", "GraphQLApi",
)
# Item types that are a Gen2 dataflow.
DATAFLOW_GEN2_TYPES = ("DataflowsGen2", "DataflowGen2", "Dataflow Gen2")
# INFO.PARTITIONS() [Type] code -> label; anything else is "Unknown".
PARTITION_TYPE_LABELS = {1: "Data", 2: "M", 3: "DAX", 4: "SQL", 7: "Historical"}
# INFO.PARTITIONS() [Mode] code -> label; anything else is "Unknown".
STORAGE_MODE_LABELS = {0: "Import", 1: "DirectQuery", 2: "Default", 3: "Push", 4: "Streaming", 5: "PushStreaming"}
# API roots, and the host that marks the workspace-API family.
WORKSPACE_API_BASE = "https://api.fabric.microsoft.com/v1"
BI_API_BASE = "https://api.powerbi.com/v1.0/myorg"
WORKSPACE_API_HOST = "fabric.microsoft.com"
# Attempt policy.
MAX_ATTEMPTS = 3
DEFAULT_RETRY_AFTER_S = 10
TIMEOUT_MESSAGE = "Request timed out after 60s"
# Refresh history: window and the per-model $top.
REFRESH_HISTORY_DAYS = 30
REFRESH_HISTORY_TOP = 50
# Storage mode that marks a Direct Lake model (compared upper-cased).
DIRECT_LAKE_MODE = "ABF"
# DAX queries sent per viable model, and the probe.
DAX_TABLES = (
    "EVALUATE "
    "SELECTCOLUMNS(INFO.TABLES(), "
    '  "TableID",  [ID], '
    '  "Name",     [Name])'
)
DAX_PARTITIONS = (
    "EVALUATE "
    "SELECTCOLUMNS(INFO.PARTITIONS(), "
    '  "TableID",         [TableID], '
    '  "Name",            [Name], '
    '  "Type",            [Type], '
    '  "Mode",            [Mode], '
    '  "QueryDefinition", [QueryDefinition])'
)
DAX_PROBE = 'EVALUATE ROW("OK", 1)'
DAX_LABEL_PREFIX = "ExecuteDAX: "
DAX_LABEL_CHARS = 60
# --- end of fixed values ----------------------------------------------------------------

# Operation names used in the landing table (the extractor's own labels).
OP_LIST_WORKSPACES = "ListWorkspaces"
OP_GET_WORKSPACE = "GetWorkspace"
OP_ROLE_ASSIGNMENTS = "GetWorkspaceRoleAssignments"
OP_LIST_ITEMS = "ListWorkspaceItems"
OP_LIST_DATASETS = "ListDatasets"
OP_MODEL_DATASOURCES = "GetSemanticModelDatasources"
OP_DATAFLOW_DATASOURCES = "GetDataflowDatasources"
OP_GEN2_DATASOURCES = "GetDataflowGen2Datasources"
OP_SHORTCUTS = "GetLakehouseShortcuts"
OP_REFRESH_SCHEDULE = "GetRefreshSchedule"
OP_REFRESH_HISTORY = "GetRefreshHistory"
OP_LIST_REPORTS = "ListReports"
OP_LIST_DATAFLOWS = "ListDataflows"
OP_DATAFLOW_SCHEDULE = "GetDataflowRefreshSchedule"
OP_LIST_LAKEHOUSES = "ListLakehouses"
# DAX calls (POST); the error label is built from the query text instead.
OP_DAX_TABLES = "ExecuteDaxTables"
OP_DAX_PARTITIONS = "ExecuteDaxPartitions"
OP_DAX_PROBE = "ExecuteDaxProbe"

DAX_OPERATIONS = (OP_DAX_TABLES, OP_DAX_PARTITIONS, OP_DAX_PROBE)
# Listings that follow continuation links; every other GET reads one page.
PAGED_OPERATIONS = (
    OP_LIST_WORKSPACES, OP_ROLE_ASSIGNMENTS, OP_LIST_ITEMS, OP_LIST_DATASETS, OP_SHORTCUTS,
    OP_LIST_REPORTS, OP_LIST_DATAFLOWS, OP_LIST_LAKEHOUSES,
)
