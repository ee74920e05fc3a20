"""DuckDB SQL for every registered query, computed straight from the test tables' columns
(the fixture mapping of FIXTURES.md section 3), never by parsing the emulated JSON."""

from __future__ import annotations

from lakecensus.functions import constants as K
from lakecensus.sources import fixtures as X

TS = f"TIMESTAMP '{X.RUN_TS}'"
RUN = f"'{X.RUN_ID}'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _case(expr: str, mapping: dict[int, str]) -> str:
    whens = " ".join(f"WHEN {k} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE 'Unknown' END"


def _sid(*parts: str) -> str:
    return f"sha256(concat_ws('|', {RUN}, " + ", ".join(parts) + "))"


ERR = X.ERR
ITEM_TYPES = _list(X.ITEM_TYPES)
OTHER = ", ".join(_q(t) for t in K.OTHER_ASSET_TYPES)
GEN2 = ", ".join(_q(t) for t in K.DATAFLOW_GEN2_TYPES)

WORKSPACES = f"""
SELECT 'ws-' || c_custkey AS workspace_id, c_name AS workspace_name,
  CASE WHEN c_custkey % 10 = 0 THEN 'Personal' ELSE 'Workspace' END AS workspace_type,
  'Active' AS state,
  CASE WHEN c_custkey % 4 = 3 THEN 'cap-' || c_nationkey ELSE '' END AS capacity_id,
  CASE WHEN c_custkey % 6 IN (0, 3) THEN '' ELSE c_mktsegment END AS description,
  c_custkey % 4 = 3 AS is_on_dedicated_capacity,
  {TS} AS extracted_at
FROM customer"""

USERS_BASE = f"""
SELECT j, w, r,
  'ws-' || w || '_' || coalesce(CASE WHEN j % 13 <> 0 THEN 'pr-' || j END,
     {_sid("'GetWorkspaceRoleAssignments|ws-' || w", "(r // 100)::VARCHAR", "(r % 100)::VARCHAR")}) AS id,
  'ws-' || w AS workspace_id,
  CASE WHEN j % 8 = 4 THEN 'g' || j || '@example.com' WHEN j % 4 = 0 THEN 'u' || j || '@example.com'
       WHEN j % 4 = 1 THEN 'app-' || j WHEN j % 4 = 2 THEN 'g' || j || '@example.com' ELSE '' END AS user_email,
  'Principal ' || j AS display_name,
  CASE j % 4 WHEN 1 THEN 'ServicePrincipal' WHEN 2 THEN 'Group' ELSE 'User' END AS principal_type,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Admin' WHEN '2' THEN 'Member' WHEN '3' THEN 'Contributor'
       ELSE 'Viewer' END AS workspace_role,
  {TS} AS extracted_at
FROM (SELECT o_orderkey AS j, o_orderkey % {X.USER_WORKSPACES} AS w, o_orderkey // {X.USER_WORKSPACES} AS r,
             o_orderpriority FROM orders)
WHERE w % 20 NOT IN (7, 13) AND NOT (w % 20 = 17 AND r >= {X.PAGE_SIZE})"""

USER_COLS = "id, workspace_id, user_email, display_name, principal_type, workspace_role, extracted_at"
USERS = f"SELECT {USER_COLS} FROM ({USERS_BASE})"

ITEMS_BASE = f"""
SELECT *, 'it-' || i AS item_id, 'ws-' || w AS workspace_id, p_name AS item_name,
  {ITEM_TYPES}[p_size % {len(X.ITEM_TYPES)} + 1] AS item_type
FROM (
  SELECT *, CASE WHEN i % 3 = 0 THEN 0 ELSE 1 + q % {X.ITEM_SPREAD} END AS w,
         CASE WHEN i % 3 = 0 THEN q ELSE (q // {X.ITEM_SPREAD}) * 2 + (i % 3 - 1) END AS r,
         TIMESTAMP '2020-01-01 00:00:00' + to_seconds(i * 3607) AS created
  FROM (SELECT *, p_partkey AS i, p_partkey // 3 AS q FROM part))"""

ITEMS = f"""
SELECT item_id, workspace_id, item_name, item_type,
  CASE WHEN i % 5 >= 3 THEN p_type ELSE '' END AS description,
  CASE i % 4 WHEN 2 THEN NULL WHEN 3 THEN created + INTERVAL 123456 MICROSECOND ELSE created END AS created_date,
  CASE WHEN i % 3 = 2 THEN NULL ELSE created + to_minutes(i % 1000) END AS last_modified_date,
  CASE WHEN i % 6 <> 0 THEN 'owner' || (i % 50) || '@example.com' ELSE '' END AS created_by_email,
  {TS} AS extracted_at
FROM ({ITEMS_BASE})"""

MODELS_BASE = f"""
SELECT s_suppkey AS m, s_name, 'ws-' || (s_suppkey % {X.MODEL_WORKSPACES}) AS ws,
  s_suppkey // {X.MODEL_WORKSPACES} AS rank,
  (s_suppkey % 5 <> 0 AND s_suppkey % 17 <> 6) AS refreshable,
  (s_suppkey % 5 <> 0 AND s_suppkey % 17 <> 6 AND s_suppkey % 7 <> 0) AS viable
FROM supplier"""

MODELS = f"""
SELECT 'sm-' || m AS model_id, ws AS workspace_id, s_name AS model_name,
  CASE WHEN m % 4 = 0 THEN '' ELSE 'owner' || (m % 50) || '@example.com' END AS configured_by,
  CASE WHEN m % 7 = 0 THEN (CASE WHEN m % 2 = 0 THEN 'Abf' ELSE 'ABF' END) WHEN m % 7 = 3 THEN ''
       ELSE 'PremiumFiles' END AS target_storage_mode,
  refreshable AS is_refreshable,
  CASE m % 3 WHEN 0 THEN 'PbixInImportMode' WHEN 1 THEN 'RealTimeInPushMode' ELSE '' END AS content_provider_type,
  TIMESTAMP '2019-06-01 00:00:00' + to_days(m::INTEGER) AS created_date,
  CASE WHEN m % 4 <> 1 THEN TIMESTAMP '2001-09-01 00:00:00' + to_hours(m) END AS modified_date,
  {TS} AS extracted_at
FROM ({MODELS_BASE})"""

REPORTS = f"""
SELECT 'rp-' || j AS report_id, 'ws-' || (j % {X.USER_WORKSPACES}) AS workspace_id, 'Report ' || j AS report_name,
  CASE WHEN j % 5 = 0 THEN 'PaginatedReport' ELSE 'PowerBIReport' END AS report_type,
  CASE WHEN j % 7 = 0 THEN '' ELSE 'sm-' || (j % 100) END AS linked_model_id,
  'https://app.example.com/reports/rp-' || j AS web_url,
  CASE WHEN j % 3 <> 0 THEN 'https://app.example.com/embed?r=' || j ELSE '' END AS embed_url,
  CASE WHEN j % 4 = 0 THEN '' ELSE 'owner' || (j % 50) || '@example.com' END AS created_by_email,
  o_orderdate AS created_date,
  CASE WHEN j % 2 = 0 THEN o_orderdate + INTERVAL 1 DAY END AS modified_date,
  {TS} AS extracted_at
FROM (SELECT o_orderkey AS j, o_orderdate FROM orders)"""

DATAFLOWS = f"""
SELECT 'df-' || d AS dataflow_id, 'ws-' || (d % {X.DATAFLOW_WORKSPACES}) AS workspace_id, 'Dataflow ' || d AS dataflow_name,
  CASE WHEN d % 3 = 0 THEN '' ELSE coalesce(url, '') END AS description,
  'owner' || (d % 50) || '@example.com' AS configured_by,
  d % 4 = 0 AS is_refresh_scheduled,
  CASE WHEN d % 4 = 0 THEN 'Monday,Thursday' ELSE '' END AS refresh_schedule_days,
  CASE WHEN d % 4 = 0 THEN '06:00,18:00' ELSE '' END AS refresh_schedule_times,
  CASE WHEN d % 4 = 0 THEN 'MailOnFailure' ELSE '' END AS notify_option,
  CASE WHEN d % 4 = 0 THEN 'ops@example.com' ELSE '' END AS notification_email,
  CASE WHEN d % 2 = 0 THEN TIMESTAMP '2001-09-15 00:00:00' + to_seconds(d * 60) END AS last_refresh_time,
  '' AS last_refresh_status,
  {TS} AS extracted_at
FROM (SELECT page_id AS d, url FROM pages)"""

OTHER_ASSETS = f"""
SELECT item_id AS asset_id, workspace_id, item_name AS asset_name, item_type AS asset_type, description,
  created_date, last_modified_date, extracted_at
FROM ({ITEMS}) WHERE item_type IN ({OTHER})"""

VIABLE_MODELS = f"""
SELECT * FROM ({MODELS}) WHERE upper(target_storage_mode) <> 'ABF' AND is_refreshable"""

DS_COLS = ("datasource_id, source_item_id, source_item_type, source_item_name, workspace_id, datasource_type, server, "
           "database, url, gateway_id, gateway_name, credential_type, credential_username, shortcut_name, shortcut_path, "
           "extracted_at")

DS_MODELS = f"""
SELECT {DS_COLS} FROM (
  SELECT CASE WHEN k = 1 THEN 'dsrc-' || m || '-1' WHEN m % 6 <> 1 THEN 'dsrc-' || m || '-0'
              ELSE {_sid("'GetSemanticModelDatasources|' || ws || '|sm-' || m", "'0'", "k::VARCHAR")} END AS datasource_id,
    'sm-' || m AS source_item_id, 'SemanticModel' AS source_item_type, s_name AS source_item_name, ws AS workspace_id,
    CASE WHEN k = 0 THEN 'Sql' ELSE 'Web' END AS datasource_type,
    CASE WHEN k = 0 THEN 'sql' || m || '.example.net' ELSE 'https://data.example.com/' || m END AS server,
    CASE WHEN k = 0 THEN 'db' || m ELSE '' END AS database,
    CASE WHEN k = 0 THEN '' ELSE 'https://data.example.com/' || m END AS url,
    CASE WHEN k = 0 AND m % 2 = 0 THEN 'gw-' || (m % 7) ELSE '' END AS gateway_id,
    '' AS gateway_name,
    CASE WHEN k = 0 THEN 'OAuth2' ELSE '' END AS credential_type,
    CASE WHEN k = 0 THEN 'svc' || m ELSE '' END AS credential_username,
    '' AS shortcut_name, '' AS shortcut_path, {TS} AS extracted_at
  FROM ({MODELS_BASE}) CROSS JOIN (SELECT unnest([0, 1]) AS k)
  WHERE viable AND m % 9 NOT IN (2, 5, 7) AND k < m % 3)"""

DS_GEN1 = f"""
SELECT 'dfsrc-' || d AS datasource_id, 'df-' || d AS source_item_id, 'Dataflow' AS source_item_type,
  'Dataflow ' || d AS source_item_name, 'ws-' || (d % {X.DATAFLOW_WORKSPACES}) AS workspace_id, 'Web' AS datasource_type,
  coalesce(url, '') AS server, '' AS database, coalesce(url, '') AS url, '' AS gateway_id, '' AS gateway_name,
  '' AS credential_type, '' AS credential_username, '' AS shortcut_name, '' AS shortcut_path, {TS} AS extracted_at
FROM (SELECT page_id AS d, url FROM pages) WHERE d % 5 <> 4"""

DS_GEN2 = f"""
SELECT 'g2src-' || i AS datasource_id, item_id AS source_item_id, 'DataflowGen2' AS source_item_type,
  item_name AS source_item_name, workspace_id, 'Lakehouse' AS datasource_type, 'onelake.example.com' AS server,
  'lh' || i AS database, '' AS url, '' AS gateway_id, '' AS gateway_name, '' AS credential_type,
  '' AS credential_username, '' AS shortcut_name, '' AS shortcut_path, {TS} AS extracted_at
FROM ({ITEMS_BASE}) WHERE item_type IN ({GEN2}) AND i % 2 = 0"""

DS_SHORTCUTS = f"""
SELECT {_sid("'GetLakehouseShortcuts|' || workspace_id || '|' || item_id", "'0'", "k::VARCHAR")} AS datasource_id,
  item_id AS source_item_id, 'Lakehouse' AS source_item_type, item_name AS source_item_name, workspace_id,
  CASE t WHEN 0 THEN 'adlsGen2' WHEN 1 THEN 'oneLake' WHEN 2 THEN 'googleCloudStorage' ELSE 's3Compatible' END AS datasource_type,
  CASE t WHEN 0 THEN 'https://acct' || i || '.dfs.core.windows.net' WHEN 3 THEN 'https://s3.example.com' ELSE '' END AS server,
  CASE t WHEN 0 THEN '/c' || k WHEN 1 THEN 'Files/x' || k WHEN 3 THEN 'bkt' || i ELSE '' END AS database,
  CASE t WHEN 0 THEN 'https://acct' || i || '.dfs.core.windows.net' WHEN 3 THEN 'https://s3.example.com' ELSE '' END AS url,
  CASE WHEN t IN (0, 3) THEN 'conn-' || i ELSE '' END AS gateway_id,
  '' AS gateway_name, '' AS credential_type, '' AS credential_username,
  'sc' || k AS shortcut_name, '/Tables/t' || k AS shortcut_path, {TS} AS extracted_at
FROM (SELECT *, (i + k) % 4 AS t FROM ({ITEMS_BASE}) CROSS JOIN (SELECT unnest([0, 1]) AS k))
WHERE item_type = 'Lakehouse' AND k < i % 3"""

DATASOURCES_ALL = f"{DS_MODELS} UNION ALL {DS_GEN1} UNION ALL {DS_GEN2} UNION ALL {DS_SHORTCUTS}"

SCHEDULES = f"""
SELECT 'sm-' || m || '_' || ws AS schedule_id, 'sm-' || m AS model_id, ws AS workspace_id,
  m % 2 = 0 AS is_enabled,
  CASE WHEN m % 3 = 0 THEN 'MailOnFailure' ELSE 'NoNotification' END AS notify_option,
  CASE WHEN m % 3 = 0 THEN 'team' || m || '@example.com' ELSE '' END AS notification_email,
  CASE WHEN m % 8 = 5 THEN '' WHEN m % 2 = 0 THEN 'Monday,Wednesday,Friday' ELSE '' END AS days,
  '07:00,19:30' AS times,
  CASE WHEN m % 5 IN (1, 2) THEN 'UTC' ELSE 'W. Europe Standard Time' END AS timezone,
  {TS} AS extracted_at
FROM ({MODELS_BASE}) WHERE refreshable AND m % 8 NOT IN (6, 7)"""

HISTORY = f"""
WITH li AS (
  SELECT *, CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey ELSE 1 END AS mid,
         CASE WHEN l_orderkey % 97 <> 0 THEN l_shipdate END AS start_ts
  FROM lineitem WHERE l_shipdate <= {TS}),
r AS (
  SELECT *, row_number() OVER (PARTITION BY mid ORDER BY start_ts DESC NULLS FIRST, l_orderkey, l_partkey, l_suppkey,
           l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS pos
  FROM li)
SELECT {_sid("'GetRefreshHistory|ws-' || (mid % 25) || '|sm-' || mid", "'0'", "pos::VARCHAR")} AS refresh_id,
  'sm-' || mid AS model_id, 'ws-' || (mid % {X.MODEL_WORKSPACES}) AS workspace_id,
  start_ts AS start_time, l_shipdate + to_hours(l_linenumber) AS end_time,
  l_returnflag AS status,
  CASE WHEN l_linestatus = 'O' THEN 'Scheduled' ELSE 'OnDemand' END AS refresh_type,
  CASE WHEN l_linenumber % 3 = 0 THEN 'E' || (l_partkey % 10) ELSE '' END AS service_exception_code,
  CASE WHEN l_linenumber % 3 = 0 THEN 'Failure on line ' || l_linenumber ELSE '' END AS service_exception_message,
  {TS} AS extracted_at
FROM r JOIN ({MODELS_BASE}) mb ON mb.m = r.mid
WHERE mb.refreshable AND r.pos < {K.REFRESH_HISTORY_TOP}
  AND (start_ts IS NULL OR start_ts >= {TS} - INTERVAL {K.REFRESH_HISTORY_DAYS} DAY)"""

PQ_OK_MODELS = f"""
SELECT * FROM ({MODELS_BASE}) mb
WHERE viable
  AND m NOT IN (SELECT doc_id // {X.DOCS_PER_MODEL} FROM labels WHERE toxic = 1 AND doc_id % {X.DOCS_PER_MODEL} = 0)
  AND m NOT IN (SELECT doc_id // {X.DOCS_PER_MODEL} FROM labels WHERE quality = 0 AND doc_id % {X.DOCS_PER_MODEL} = 1)"""

POWER_QUERIES = f"""
WITH d AS (SELECT *, doc_id // {X.DOCS_PER_MODEL} AS m, CAST(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) AS n
           FROM documents),
tmap AS (SELECT DISTINCT m, n, source FROM d WHERE source <> 'src7'),
ok AS ({PQ_OK_MODELS})
SELECT {_sid("'ExecuteDaxPartitions|' || ok.ws || '|sm-' || ok.m", f"(d.doc_id % {X.DOCS_PER_MODEL})::VARCHAR")} AS query_id,
  'sm-' || ok.m AS model_id, ok.s_name AS model_name, ok.ws AS workspace_id,
  CASE WHEN d.doc_id % 19 = 0 THEN -1 ELSE d.n END AS table_id,
  CASE WHEN d.doc_id % 19 = 0 THEN 'TableID_-1' ELSE coalesce(tmap.source, 'TableID_' || d.n) END AS table_name,
  'Partition-' || d.doc_id AS partition_name,
  CASE WHEN d.doc_id % 13 = 5 THEN 'Unknown' ELSE {_case("d.doc_id % 9", K.PARTITION_TYPE_LABELS)} END AS partition_type,
  {_case("d.doc_id % 7", K.STORAGE_MODE_LABELS)} AS storage_mode,
  CASE WHEN d.doc_id % 17 = 3 THEN '' ELSE coalesce(d.text, '') END AS query_expression,
  {TS} AS extracted_at
FROM d JOIN ok ON d.m = ok.m
LEFT JOIN tmap ON tmap.m = d.m AND tmap.n = d.n
WHERE d.doc_id % 11 <> 0"""

# --- attempt log (events) ----------------------------------------------------------------
EVENTS = f"""
SELECT e.*, event_id // 3 AS req, (event_id % 3 + 1)::INTEGER AS attempt,
  CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_type = 'click' THEN 200 WHEN event_type = 'view' THEN 429
       WHEN event_type = 'purchase' THEN NULL
       WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 403 ELSE 500 END
       WHEN event_type = 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 404 ELSE 500 END END AS status,
  CASE WHEN event_id % 37 = 0 THEN 'exception' WHEN event_type = 'purchase' THEN 'timeout' END AS error_kind,
  CASE WHEN event_id % 37 = 0 THEN 'Connection aborted.'
       WHEN event_type = 'click' AND event_id % 41 = 0 THEN pg.html
       WHEN event_type IN ('click', 'error') THEN props
       WHEN event_type = 'view' THEN {_q(ERR['429'])}
       WHEN event_type = 'signup' AND event_id % 2 = 1 THEN pg.html
       WHEN event_type = 'signup' THEN {_q(ERR['404'])} END AS body,
  ['{K.OP_LIST_LAKEHOUSES}', '{K.OP_LIST_ITEMS}', '{K.OP_LIST_REPORTS}'][(event_id // 3) % 3 + 1] AS operation,
  'ws-' || (user_id % 25) AS workspace_id
FROM events e LEFT JOIN pages pg ON pg.page_id = e.event_id % (SELECT count(*) FROM pages)"""

RESOLVED = f"""
WITH ev AS ({EVENTS}),
pick AS (
  SELECT req, min(attempt) FILTER (WHERE NOT coalesce(status = 429 OR error_kind = 'timeout', false)) AS term,
         max(attempt) AS last
  FROM ev GROUP BY req)
SELECT ev.*, pick.term IS NULL AS exhausted
FROM ev JOIN pick ON ev.req = pick.req AND ev.attempt = coalesce(pick.term, pick.last)"""

RESOLVE_ATTEMPTS = f"""
SELECT 'evt|' || req AS request_id, 0 AS page_no, attempt, status, error_kind, exhausted FROM ({RESOLVED})"""

CLASSIFIED = f"""
SELECT *,
  CASE WHEN exhausted AND error_kind = 'timeout' THEN 'logged' WHEN exhausted THEN 'silent'
       WHEN error_kind = 'exception' THEN 'logged'
       WHEN status = 200 AND try(json(body)) IS NULL THEN 'logged'
       WHEN status = 200 THEN 'ok' WHEN status IN (401, 403) THEN 'logged' WHEN status = 404 THEN 'silent'
       ELSE 'logged' END AS outcome,
  CASE WHEN exhausted OR error_kind IN ('exception', 'timeout') OR status IS NULL
         OR (status = 200 AND try(json(body)) IS NULL) THEN -1 ELSE status END AS http_status_code,
  coalesce(status = 403, false) AS requires_admin,
  CASE WHEN error_kind = 'timeout' THEN {_q(K.TIMEOUT_MESSAGE)}
       WHEN error_kind = 'exception' THEN body
       WHEN status = 200 AND try(json(body)) IS NULL THEN 'Response body is not valid JSON: ' || coalesce(body, '')
       ELSE body END AS error_text
FROM ({RESOLVED})"""

CLASSIFY_OUTCOMES = f"""
SELECT 'evt|' || req AS request_id, 0 AS page_no, outcome, http_status_code::BIGINT AS http_status_code, requires_admin
FROM ({CLASSIFIED})"""

ERROR_ROWS = f"""
SELECT {_sid("'evt|' || req", "'0'", "'error'")} AS error_id, workspace_id, '' AS workspace_name, '' AS item_id,
  '' AS item_type, '' AS item_name, operation, http_status_code::BIGINT AS http_status_code, '' AS error_code,
  error_text AS error_message, requires_admin, {TS} AS extracted_at
FROM ({CLASSIFIED}) WHERE outcome = 'logged'"""

RATE_LIMIT_WAITS = f"""
SELECT operation, count(*) AS waits, sum(trunc(value)::INTEGER % 5)::BIGINT AS wait_seconds
FROM ({EVENTS}) WHERE status = 429 GROUP BY operation"""

# --- page chains (conversations) ---------------------------------------------------------
CHAINS = """
WITH c AS (SELECT conv_id AS c, turn AS t, role, text, max(turn) OVER (PARTITION BY conv_id) AS mx FROM conversations),
cut AS (SELECT DISTINCT c, mx,
          least(mx, CASE WHEN c % 5 = 0 AND mx >= 1 THEN 0 ELSE mx END,
                    CASE WHEN c % 7 = 3 AND mx >= 1 THEN 1 ELSE mx END,
                    CASE WHEN c % 11 = 4 AND mx >= 2 THEN 1 ELSE mx END) AS cut
        FROM c)"""

STITCH_PAGES = CHAINS + """
SELECT 'chain|' || c.c AS request_id, t::INTEGER AS page_no, 0 AS pos, role, text
FROM c JOIN cut USING (c) WHERE t <= cut"""

PAGE_CHAIN_AUDIT = CHAINS + """
SELECT 'chain|' || c AS request_id,
  (mx + 1 - CASE WHEN c % 11 = 4 AND mx >= 2 THEN 1 ELSE 0 END) AS pages_captured,
  cut + 1 AS pages_read,
  (c % 5 = 0 AND mx >= 1) AS ended_by_error
FROM cut"""

# --- access errors of the inventory run -------------------------------------------------------
def _dax_label(q: str) -> str:
    return _q((K.DAX_LABEL_PREFIX + q)[: len(K.DAX_LABEL_PREFIX) + K.DAX_LABEL_CHARS])


ERR_COLS = ("error_id, workspace_id, workspace_name, item_id, item_type, item_name, operation, http_status_code, "
            "error_code, error_message, requires_admin, extracted_at")


def _err(request: str, ws: str, item_id: str, item_type: str, item_name: str, op: str, status: int, code: str,
         message: str, admin: bool, page: str = "'0'") -> str:
    return (f"{_sid(request, page, repr('error'))} AS error_id, {ws} AS workspace_id, {item_id} AS item_id, "
            f"{item_type} AS item_type, {item_name} AS item_name, {op} AS operation, {status}::BIGINT AS http_status_code, "
            f"{_q(code)} AS error_code, {_q(message)} AS error_message, {str(admin).upper()} AS requires_admin")


ERRORS_RAW = f"""
SELECT {_err("'GetWorkspaceRoleAssignments|ws-' || c_custkey", "'ws-' || c_custkey", "''", "''", "''",
             "'GetWorkspaceRoleAssignments'", 403, 'InsufficientPrivileges', 'The caller does not have permission', True)}
FROM customer WHERE c_custkey % 20 = 7
UNION ALL
SELECT {_err("'GetWorkspaceRoleAssignments|ws-' || w", "'ws-' || w", "''", "''", "''", "'GetWorkspaceRoleAssignments'",
             -1, '', '', False, "'1'").replace("-1::BIGINT", "500::BIGINT").replace("'' AS error_message", _q(ERR['500']) + " AS error_message")}
FROM (SELECT DISTINCT o_orderkey % {X.USER_WORKSPACES} AS w FROM orders WHERE o_orderkey // {X.USER_WORKSPACES} >= {X.PAGE_SIZE})
WHERE w % 20 = 17
UNION ALL
SELECT {_err("'GetDataflowRefreshSchedule|ws-' || (d % 50) || '|df-' || d", "'ws-' || (d % 50)", "'df-' || d", "'Dataflow'",
             "'Dataflow ' || d", "'GetDataflowRefreshSchedule'", 403, 'InsufficientPrivileges',
             'The caller does not have permission', True)}
FROM (SELECT page_id AS d FROM pages) WHERE d % 4 = 3
UNION ALL
SELECT {_err("'GetDataflowDatasources|ws-' || (d % 50) || '|df-' || d", "'ws-' || (d % 50)", "'df-' || d", "'Dataflow'",
             "'Dataflow ' || d", "'GetDataflowDatasources'", 401, 'TokenExpired', 'Access token has expired', False)}
FROM (SELECT page_id AS d FROM pages) WHERE d % 5 = 4
UNION ALL
SELECT {_err("'GetSemanticModelDatasources|' || ws || '|sm-' || m", "ws", "'sm-' || m", "'SemanticModel'", "s_name",
             "'GetSemanticModelDatasources'", 403, 'InsufficientPrivileges', 'The caller does not have permission', True)}
FROM ({MODELS_BASE}) WHERE viable AND m % 9 = 2
UNION ALL
SELECT {_err("'GetSemanticModelDatasources|' || ws || '|sm-' || m", "ws", "'sm-' || m", "'SemanticModel'", "s_name",
             "'GetSemanticModelDatasources'", 500, '', ERR['500'], False)}
FROM ({MODELS_BASE}) WHERE viable AND m % 9 = 7
UNION ALL
SELECT {_err("'ExecuteDaxTables|' || ws || '|sm-' || m", "ws", "'sm-' || m", "'SemanticModel'", "s_name",
             _dax_label(K.DAX_TABLES), 400, 'DatasetExecuteQueriesError', 'Query execution failed', False)}
FROM ({MODELS_BASE}) WHERE viable
  AND m IN (SELECT doc_id // {X.DOCS_PER_MODEL} FROM labels WHERE toxic = 1 AND doc_id % {X.DOCS_PER_MODEL} = 0)
UNION ALL
SELECT {_err("'ExecuteDaxPartitions|' || ws || '|sm-' || m", "ws", "'sm-' || m", "'SemanticModel'", "s_name",
             _dax_label(K.DAX_PARTITIONS), 403, 'InsufficientPrivileges', 'The caller does not have permission', True)}
FROM ({MODELS_BASE}) WHERE viable
  AND m IN (SELECT doc_id // {X.DOCS_PER_MODEL} FROM labels WHERE quality = 0 AND doc_id % {X.DOCS_PER_MODEL} = 1)"""

ERRORS_ENRICHED = f"""
SELECT er.error_id, er.workspace_id, coalesce(c.c_name, '') AS workspace_name, er.item_id, er.item_type, er.item_name,
  er.operation, er.http_status_code, er.error_code, er.error_message, er.requires_admin, {TS} AS extracted_at
FROM ({ERRORS_RAW}) er LEFT JOIN customer c ON er.workspace_id = 'ws-' || c.c_custkey"""

ORACLES: dict[str, str] = {
    "refresh_history": HISTORY,
    "norm_workspaces": WORKSPACES,
    "norm_workspace_single": f"SELECT * FROM ({WORKSPACES}) WHERE workspace_id = '{X.CURRENT_WORKSPACE}'",
    "scope_filter": f"SELECT * FROM ({USERS}) WHERE workspace_id = '{X.CURRENT_WORKSPACE}'",
    "norm_users": USERS,
    "norm_items": ITEMS,
    "norm_models": MODELS,
    "norm_reports": REPORTS,
    "norm_dataflows": DATAFLOWS,
    "other_assets": OTHER_ASSETS,
    "viable_models": VIABLE_MODELS,
    "ds_models": DS_MODELS,
    "ds_gen1": DS_GEN1,
    "ds_gen2": DS_GEN2,
    "ds_shortcuts": DS_SHORTCUTS,
    "datasources_all": DATASOURCES_ALL,
    "refresh_schedules": SCHEDULES,
    "power_queries": POWER_QUERIES,
    "errors_enriched": ERRORS_ENRICHED,
    "errors_admin": f"SELECT * FROM ({ERRORS_ENRICHED}) WHERE requires_admin",
    "error_counts": f"SELECT count(*) AS errors, count(*) FILTER (WHERE requires_admin) AS errors_requiring_admin FROM ({ERRORS_RAW})",
    "ds_counts": f"""SELECT count(*) AS datasources,
        count(*) FILTER (WHERE source_item_type = 'SemanticModel') AS semantic_model_sources,
        count(*) FILTER (WHERE source_item_type = 'Dataflow') AS dataflow_gen1_sources,
        count(*) FILTER (WHERE source_item_type = 'DataflowGen2') AS dataflow_gen2_sources,
        count(*) FILTER (WHERE source_item_type = 'Lakehouse') AS lakehouse_shortcuts FROM ({DATASOURCES_ALL})""",
    "pq_counts": f"""SELECT count(*) AS partitions, count(*) FILTER (WHERE partition_type = 'M') AS m_partitions,
        count(*) FILTER (WHERE partition_type = 'SQL') AS sql_partitions,
        count(*) FILTER (WHERE partition_type = 'DAX') AS dax_partitions FROM ({POWER_QUERIES})""",
    "resolve_attempts": RESOLVE_ATTEMPTS,
    "classify_outcomes": CLASSIFY_OUTCOMES,
    "error_rows": ERROR_ROWS,
    "rate_limit_waits": RATE_LIMIT_WAITS,
    "stitch_pages": STITCH_PAGES,
    "page_chain_audit": PAGE_CHAIN_AUDIT,
}

_TABLE_SQL = {
    "meta_workspaces": WORKSPACES, "meta_workspace_users": USERS, "meta_workspace_items": ITEMS,
    "meta_semantic_models": MODELS, "meta_datasources": DATASOURCES_ALL, "meta_refresh_schedules": SCHEDULES,
    "meta_refresh_history": HISTORY, "meta_reports": REPORTS, "meta_dataflows": DATAFLOWS,
    "meta_other_assets": OTHER_ASSETS, "meta_power_queries": POWER_QUERIES, "meta_access_errors": ERRORS_RAW,
}
ORACLES["run_summary"] = " UNION ALL ".join(
    f"SELECT {i} AS table_order, '{name}' AS table_name, (SELECT count(*) FROM ({sql})) AS rows"
    for i, name in enumerate(_TABLE_SQL) for sql in [_TABLE_SQL[name]]
)

# --- planning, coverage and DAX outcomes ------------------------------------------------------
from lakecensus.operators.planning import ENTITY_URLS, WORKSPACE_ENDPOINTS  # noqa: E402

BAD_T = f"SELECT doc_id // {X.DOCS_PER_MODEL} FROM labels WHERE toxic = 1 AND doc_id % {X.DOCS_PER_MODEL} = 0"
BAD_P = f"SELECT doc_id // {X.DOCS_PER_MODEL} FROM labels WHERE quality = 0 AND doc_id % {X.DOCS_PER_MODEL} = 1"


def _url1(template: str, a: str) -> str:
    pre, post = template.split("%s")
    return f"{_q(pre)} || {a} || {_q(post)}"


def _url2(template: str, a: str, b: str) -> str:
    pre, mid, post = template.split("%s")
    return f"{_q(pre)} || {a} || {_q(mid)} || {b} || {_q(post)}"


def _family(url_sql: str) -> str:
    return f"CASE WHEN ({url_sql}) LIKE '%{K.WORKSPACE_API_HOST}%' THEN 'fabric' ELSE 'pbi' END"


PLAN_WORKSPACE = " UNION ALL ".join(
    f"""SELECT '{op}|ws-' || c_custkey AS request_id, '{op}' AS operation, 'ws-' || c_custkey AS workspace_id,
      CAST(NULL AS VARCHAR) AS item_id, {_url1(t, "'ws-' || c_custkey")} AS url,
      {_family(_url1(t, "'ws-' || c_custkey"))} AS api_family FROM customer"""
    for op, t in WORKSPACE_ENDPOINTS
)


def _plan(op: str, src: str, ws: str, item: str) -> str:
    url = _url2(ENTITY_URLS[op], ws, item)
    return (f"SELECT '{op}|' || {ws} || '|' || {item} AS request_id, '{op}' AS operation, {ws} AS workspace_id, "
            f"{item} AS item_id, {url} AS url, {_family(url)} AS api_family FROM {src}")


_VIABLE = f"({MODELS_BASE}) WHERE viable"
_REFRESHABLE = f"({MODELS_BASE}) WHERE refreshable"
_FLOWS = f"(SELECT page_id AS d FROM pages)"
PLAN_ENTITY = " UNION ALL ".join([
    _plan(K.OP_MODEL_DATASOURCES, _VIABLE, "ws", "'sm-' || m"),
    _plan(K.OP_DATAFLOW_DATASOURCES, _FLOWS, f"'ws-' || (d % {X.DATAFLOW_WORKSPACES})", "'df-' || d"),
    _plan(K.OP_GEN2_DATASOURCES, f"({ITEMS_BASE}) WHERE item_type IN ({GEN2})", "workspace_id", "item_id"),
    _plan(K.OP_SHORTCUTS, f"({ITEMS_BASE}) WHERE item_type = 'Lakehouse'", "workspace_id", "item_id"),
    _plan(K.OP_REFRESH_SCHEDULE, _REFRESHABLE, "ws", "'sm-' || m"),
    _plan(K.OP_REFRESH_HISTORY, _REFRESHABLE, "ws", "'sm-' || m"),
    _plan(K.OP_DATAFLOW_SCHEDULE, _FLOWS, f"'ws-' || (d % {X.DATAFLOW_WORKSPACES})", "'df-' || d"),
    _plan(K.OP_DAX_TABLES, _VIABLE, "ws", "'sm-' || m"),
    _plan(K.OP_DAX_PARTITIONS, _VIABLE, "ws", "'sm-' || m"),
])

# Page-0 outcome of every planned request that did not return a body (fixture rules).
NOT_OK = f"""
SELECT 'GetWorkspaceRoleAssignments|ws-' || c_custkey AS request_id,
       CASE WHEN c_custkey % 20 = 7 THEN 'logged' ELSE 'silent' END AS reason,
       CASE WHEN c_custkey % 20 = 7 THEN 403 ELSE -1 END AS http_status_code
FROM customer WHERE c_custkey % 20 IN (7, 13)
UNION ALL
SELECT 'GetSemanticModelDatasources|' || ws || '|sm-' || m, CASE WHEN m % 9 = 5 THEN 'silent' ELSE 'logged' END,
       CASE m % 9 WHEN 2 THEN 403 WHEN 5 THEN 404 ELSE 500 END
FROM {_VIABLE} AND m % 9 IN (2, 5, 7)
UNION ALL
SELECT 'GetDataflowDatasources|ws-' || (d % {X.DATAFLOW_WORKSPACES}) || '|df-' || d, 'logged', 401 FROM {_FLOWS} WHERE d % 5 = 4
UNION ALL
SELECT 'GetDataflowRefreshSchedule|ws-' || (d % {X.DATAFLOW_WORKSPACES}) || '|df-' || d,
       CASE WHEN d % 4 = 2 THEN 'silent' ELSE 'logged' END, CASE WHEN d % 4 = 2 THEN 404 ELSE 403 END
FROM {_FLOWS} WHERE d % 4 IN (2, 3)
UNION ALL
SELECT 'GetRefreshSchedule|' || ws || '|sm-' || m, 'silent', 404 FROM {_REFRESHABLE} AND m % 8 = 6
UNION ALL
SELECT 'GetRefreshHistory|' || ws || '|sm-' || m, 'missing', NULL FROM {_REFRESHABLE}
  AND m NOT IN (SELECT DISTINCT CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey ELSE 1 END FROM lineitem WHERE l_shipdate <= {TS})
UNION ALL
SELECT 'ExecuteDaxTables|' || ws || '|sm-' || m, 'logged', 400 FROM {_VIABLE} AND m IN ({BAD_T})
UNION ALL
SELECT 'ExecuteDaxPartitions|' || ws || '|sm-' || m, 'logged', 403 FROM {_VIABLE} AND m IN ({BAD_P})"""

UNCOVERED = f"""
SELECT p.request_id, p.operation, p.workspace_id, p.item_id, n.reason, n.http_status_code::BIGINT AS http_status_code
FROM ({PLAN_WORKSPACE} UNION ALL {PLAN_ENTITY}) p JOIN ({NOT_OK}) n USING (request_id)"""

_FIRST_VIABLE = f"SELECT m FROM {_VIABLE} ORDER BY m % {X.MODEL_WORKSPACES}, rank LIMIT 1"
DAX_OUTCOMES = f"""
SELECT 'ExecuteDaxTables|' || ws || '|sm-' || m AS request_id, 'sm-' || m AS item_id,
  CASE WHEN m IN ({BAD_T}) THEN 'logged' ELSE 'ok' END AS outcome,
  CASE WHEN m IN ({BAD_T}) THEN 400 ELSE 200 END::BIGINT AS http_status_code, FALSE AS requires_admin,
  {_dax_label(K.DAX_TABLES)} AS label
FROM {_VIABLE}
UNION ALL
SELECT 'ExecuteDaxPartitions|' || ws || '|sm-' || m, 'sm-' || m, CASE WHEN m IN ({BAD_P}) THEN 'logged' ELSE 'ok' END,
  CASE WHEN m IN ({BAD_P}) THEN 403 ELSE 200 END::BIGINT, m IN ({BAD_P}), {_dax_label(K.DAX_PARTITIONS)}
FROM {_VIABLE}
UNION ALL
SELECT 'ExecuteDaxProbe|' || ws || '|sm-' || m, 'sm-' || m, 'ok', 200::BIGINT, FALSE, {_dax_label(K.DAX_PROBE)}
FROM {_VIABLE} AND m IN ({_FIRST_VIABLE})"""

DAX_ROWS = f"""
SELECT 'sm-' || m AS model_id, (doc_id % {X.DOCS_PER_MODEL})::INTEGER AS row_pos,
  CASE WHEN doc_id % 19 = 0 THEN -1 ELSE CAST(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) END AS table_id,
  CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'Partition-' || doc_id END AS name,
  CASE WHEN doc_id % 13 = 5 THEN NULL ELSE doc_id % 9 END AS type_code,
  doc_id % 7 AS mode_code,
  CASE WHEN doc_id % 17 = 3 THEN NULL ELSE length(text)::INTEGER END AS query_chars
FROM (SELECT *, doc_id // {X.DOCS_PER_MODEL} AS m FROM documents)
WHERE m IN (SELECT m FROM {_VIABLE}) AND m NOT IN ({BAD_P})"""

PQ_COVERAGE = f"""
SELECT count(*) AS models_total, count(*) FILTER (WHERE NOT viable) AS models_skipped_preflight,
  count(*) FILTER (WHERE NOT viable OR m IN ({BAD_T}) OR m IN ({BAD_P})) AS models_skipped,
  count(*) FILTER (WHERE viable AND m NOT IN ({BAD_T}) AND m NOT IN ({BAD_P})) AS models_succeeded,
  count(*) FILTER (WHERE viable) > 0 AS probe_ok
FROM ({MODELS_BASE})"""

DS_COVERAGE = f"""
SELECT count(*) FILTER (WHERE viable) AS tried,
  count(*) FILTER (WHERE viable AND m % 9 NOT IN (2, 5, 7)) AS ok,
  count(*) FILTER (WHERE viable AND m % 9 IN (2, 5, 7)) AS failed,
  count(*) FILTER (WHERE NOT viable) AS skipped_preflight
FROM ({MODELS_BASE})"""

MODEL_NAME_LOOKUP = f"""
SELECT 'rp-' || o_orderkey AS report_id, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'sm-' || (o_orderkey % 100) END AS model_id,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE coalesce(s.s_name, '') END AS model_name
FROM orders LEFT JOIN supplier s ON s.s_suppkey = o_orderkey % 100"""

FIND_ITEM = f"""
SELECT item_id, workspace_id, item_name, item_type FROM ({ITEMS_BASE}) WHERE p_name = 'red widget' ORDER BY w, r LIMIT 1"""

ORACLES.update({
    "plan_workspace_requests": PLAN_WORKSPACE,
    "plan_entity_requests": PLAN_ENTITY,
    "uncovered_requests": UNCOVERED,
    "classify_dax_outcomes": DAX_OUTCOMES,
    "dax_rows": DAX_ROWS,
    "pq_probe_gate": f"SELECT count(*) > 0 AS probe_ok FROM {_VIABLE}",
    "pq_coverage": PQ_COVERAGE,
    "ds_coverage": DS_COVERAGE,
    "model_name_lookup": MODEL_NAME_LOOKUP,
    "find_item": FIND_ITEM,
})


# --- helper-level projections ----------------------------------------------------------------
SCAN_LANDING = f"""
SELECT 'evt|' || req AS request_id, attempt, status, error_kind FROM ({EVENTS}) WHERE operation = '{K.OP_LIST_LAKEHOUSES}'"""

STRIP_NAMES = f"""
SELECT 'sm-' || m AS model_id, (doc_id % {X.DOCS_PER_MODEL})::INTEGER AS row_pos, k AS column_name
FROM (SELECT *, doc_id // {X.DOCS_PER_MODEL} AS m FROM documents)
CROSS JOIN (SELECT unnest(['TableID', 'Name', 'Type', 'Mode', 'QueryDefinition']) AS k)
WHERE m IN (SELECT m FROM {_VIABLE}) AND m NOT IN ({BAD_P}) AND NOT (k = 'TableID' AND doc_id % 19 = 0)"""

STABLE_IDS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows, count(DISTINCT {key}) AS distinct_ids FROM ({sql})"
    for name, sql, key in [
        ("meta_workspace_users", USERS, "id"), ("meta_datasources", DATASOURCES_ALL, "datasource_id"),
        ("meta_refresh_history", HISTORY, "refresh_id"), ("meta_power_queries", POWER_QUERIES, "query_id"),
        ("meta_access_errors", ERRORS_RAW, "error_id"),
    ]
)

ORACLES.update({
    "run_duration": f"SELECT {RUN} AS run_id, (floor(epoch(max(ts)))::BIGINT - floor(epoch(min(ts)))::BIGINT) AS duration_s FROM events",
    "scan_landing": SCAN_LANDING,
    "json_get_default": f"SELECT item_id, created_by_email FROM ({ITEMS})",
    "json_get_or": f"SELECT workspace_id, capacity_id, description FROM ({WORKSPACES})",
    "first_truthy": f"SELECT id, user_email FROM ({USERS})",
    "json_truthy": f"SELECT model_id, is_refreshable FROM ({MODELS})",
    "json_dynamic_key": f"SELECT source_item_type, datasource_id, datasource_type, server, database, url, gateway_id FROM ({DATASOURCES_ALL})",
    "service_exception": f"SELECT refresh_id, service_exception_code, service_exception_message FROM ({HISTORY})",
    "array_csv": f"SELECT schedule_id, days, times FROM ({SCHEDULES})",
    "parse_ts": f"SELECT item_id, created_date, last_modified_date FROM ({ITEMS})",
    "partition_labels": f"SELECT query_id, partition_type, storage_mode FROM ({POWER_QUERIES})",
    "strip_bracket_names": STRIP_NAMES,
    "stable_ids": STABLE_IDS,
    "repeated_ids": f"SELECT user_email AS id, count(*) AS rows FROM ({USERS}) GROUP BY 1 HAVING count(*) > 1",
    "sink_roundtrip": ORACLES["run_summary"],
})

# --- forms of timestamps and column names: what each form keeps of the value ------------------------
_S = "date_trunc('second', ts)"
_FORMS = [
    _S, _S, "date_trunc('minute', ts)", "date_trunc('hour', ts)", "date_trunc('day', ts)", _S, "date_trunc('day', ts)",
    "date_trunc('minute', ts)", "date_trunc('day', ts)", "date_trunc('week', ts)", _S,
    f"{_S} + INTERVAL 250000 MICROSECOND", f"{_S} + INTERVAL 123456 MICROSECOND", f"{_S} - INTERVAL 90 MINUTE",
    f"{_S} + INTERVAL 2 HOUR", f"{_S} - INTERVAL 30 SECOND", f"{_S} - INTERVAL 1215 MINUTE", "NULL", "NULL", "NULL",
]
ORACLES["timestamp_forms"] = (
    f"SELECT event_id, (CASE event_id % {len(_FORMS)} "
    + " ".join(f"WHEN {i} THEN {sql}" for i, sql in enumerate(_FORMS))
    + " END)::TIMESTAMP AS parsed FROM events")
ORACLES["column_name_forms"] = "SELECT p_partkey, p_name AS column_name FROM part"

_COUNTERS = {name: {"rows": "count(*)"} for name in _TABLE_SQL}
_COUNTERS["meta_datasources"] |= {
    n: f"count(*) FILTER (WHERE source_item_type = '{t}')"
    for n, t in (("semantic_model_sources", "SemanticModel"), ("dataflow_gen1_sources", "Dataflow"),
                 ("dataflow_gen2_sources", "DataflowGen2"), ("lakehouse_shortcuts", "Lakehouse"))}
_COUNTERS["meta_power_queries"] |= {n: f"count(*) FILTER (WHERE partition_type = '{t}')"
                                    for n, t in (("m_partitions", "M"), ("sql_partitions", "SQL"), ("dax_partitions", "DAX"))}
_COUNTERS["meta_access_errors"]["errors_requiring_admin"] = "count(*) FILTER (WHERE requires_admin)"
_LEDGER = [(table, metric, f"(SELECT {agg} FROM ({_TABLE_SQL[table]}))") for table, found in _COUNTERS.items() for metric, agg in found.items()]
_LEDGER += [("datasource_coverage", m, f"(SELECT {m} FROM ({DS_COVERAGE}))") for m in ("tried", "ok", "failed", "skipped_preflight")]
_LEDGER += [("power_query_coverage", m, f"(SELECT {m} FROM ({PQ_COVERAGE}))")
            for m in ("models_total", "models_skipped_preflight", "models_skipped", "models_succeeded", "probe_ok")]
ORACLES["run_ledger"] = " UNION ALL ".join(
    f"SELECT 1::BIGINT AS version, {RUN} AS run_id, '{t}' AS table_name, '{m}' AS metric, {sql}::BIGINT AS value" for t, m, sql in _LEDGER)


# --- two runs: the tables' SQL over what each run sees --------------------------------------------------
def _seen(sql: str, run: str) -> str:
    for table, (where, changed) in X.RUNS[run].items():
        replaced = f" REPLACE ({', '.join(f'{e} AS {c}' for c, e in changed.items())})" if changed else ""
        sql = sql.replace(f"FROM {table}", f"FROM (SELECT *{replaced} FROM {table} WHERE {where})")
    return sql


def _of_run(sql: str, run: str) -> str:
    return _seen(f"SELECT * FROM ({sql}) WHERE workspace_id IN (SELECT 'ws-' || c_custkey FROM customer)", run)


_RUN_TABLES = [("meta_workspaces", WORKSPACES, "workspace_id", ""), ("meta_workspace_users", USERS, "workspace_id, display_name", "id, "),
               ("meta_workspace_items", ITEMS, "item_id", ""), ("meta_semantic_models", MODELS, "model_id", ""),
               ("meta_reports", REPORTS, "report_id", ""), ("meta_other_assets", OTHER_ASSETS, "asset_id", "")]


def _run_changes(table: str, sql: str, key: str, ignore: str) -> str:
    old, new = (f"(SELECT {key}, t::VARCHAR AS v FROM (SELECT * EXCLUDE ({ignore}extracted_at) FROM ({_of_run(sql, run)})) t)" for run in X.RUNS)
    return f"""SELECT '{table}' AS table_name, count(*) FILTER (o.v IS NULL) AS added, count(*) FILTER (n.v IS NULL) AS removed,
      count(*) FILTER (o.v <> n.v) AS changed, count(*) FILTER (o.v = n.v) AS same FROM {old} o FULL JOIN {new} n USING ({key})"""


ORACLES["run_changes"] = " UNION ALL ".join(_run_changes(*t) for t in _RUN_TABLES)
_OLD, _NEW = (f"(SELECT item_id, item_name, t::VARCHAR AS v FROM (SELECT * EXCLUDE (extracted_at) FROM ({_of_run(ITEMS, run)})) t)" for run in X.RUNS)
_SECOND = f"TIMESTAMP '{X.SECOND_TS}'"
ORACLES["item_history"] = f"""
SELECT o.item_id, o.item_name, {TS} AS valid_from, CASE WHEN n.v = o.v THEN NULL ELSE {_SECOND} END AS valid_to
FROM {_OLD} o LEFT JOIN {_NEW} n USING (item_id)
UNION ALL
SELECT n.item_id, n.item_name, {_SECOND}, NULL FROM {_NEW} n LEFT JOIN {_OLD} o USING (item_id) WHERE o.v IS NULL OR o.v <> n.v"""


# --- link walks: step by step, with the pages seen so far ---------------------------------------------
ORACLES["follow_links"] = """
WITH RECURSIVE p AS (
  SELECT conv_id AS c, turn AS t, role, text, max(turn) OVER (PARTITION BY conv_id) AS mx FROM conversations),
pages AS (
  SELECT c || '/' || t AS url, role, text, NOT (c % 5 = 3 AND t = 2) AS ok,
    CASE WHEN c % 10 = 7 AND t = 1 THEN 'gone' WHEN c % 6 = 1 AND t = 1 THEN (c - 1) || '/2'
      WHEN c % 9 = 2 AND t = mx THEN c || '/' || least(1, t) WHEN t < mx THEN c || '/' || (t + 1) END AS next
  FROM p),
walk AS (
  SELECT 'wire|' || conv_id AS request_id, 0 AS page_no, conv_id || '/0' AS url, [conv_id || '/0'] AS seen
  FROM conversations WHERE turn = 0
  UNION ALL
  SELECT request_id, page_no + 1, pages.next, list_append(seen, pages.next) FROM walk JOIN pages USING (url)
  WHERE pages.ok AND pages.next IS NOT NULL AND NOT list_contains(seen, pages.next))
SELECT request_id, page_no, role, text FROM walk JOIN pages USING (url) WHERE ok"""


# --- blocked time: one sweep per operation, and one over all --------------------------------------------
_WAITS = f"""SELECT operation, epoch_us(ts) AS s, epoch_us(ts) + 1000000 * (trunc(value)::INTEGER % 5) AS e
FROM ({EVENTS}) WHERE status = 429"""
ORACLES["blocked_time"] = f"""
WITH w AS (SELECT operation, s, e FROM ({_WAITS}) UNION ALL SELECT NULL, s, e FROM ({_WAITS})),
f AS (SELECT *, max(e) OVER (PARTITION BY operation ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM w)
SELECT {RUN} AS run_id, operation, count(*) AS waits, (sum(e - s) // 1000000)::BIGINT AS wait_seconds,
  sum(greatest(0, e - greatest(s, coalesce(far, s))))::BIGINT AS blocked_us
FROM f GROUP BY operation"""

# --- schema drift: kinds of each field by the rules that the listings follow ------------------------------
_WS_FIELDS = {
    ("id", "STRING"): "TRUE", ("displayName", "STRING"): "TRUE", ("type", "STRING"): "TRUE", ("state", "STRING"): "TRUE",
    ("capacityId", "NULL"): "k % 4 = 0", ("capacityId", "STRING"): "k % 4 >= 2",
    ("description", "NULL"): "k % 6 = 3", ("description", "STRING"): "k % 6 NOT IN (0, 3)"}
_REFRESHABLE_KIND = "CASE WHEN k % 5 = 0 THEN 'b' WHEN k % 17 = 6 THEN '' WHEN k % 11 = 3 THEN 's' WHEN k % 13 = 4 THEN 'n' ELSE 'b' END"
_MODEL_FIELDS = {
    ("id", "STRING"): "TRUE", ("name", "STRING"): "TRUE", ("configuredBy", "NULL"): "k % 4 = 0", ("configuredBy", "STRING"): "k % 4 <> 0",
    ("targetStorageMode", "STRING"): "k % 7 <> 3", ("isRefreshable", "BOOLEAN"): f"{_REFRESHABLE_KIND} = 'b'",
    ("isRefreshable", "STRING"): f"{_REFRESHABLE_KIND} = 's'", ("isRefreshable", "NUMBER"): f"{_REFRESHABLE_KIND} = 'n'",
    ("contentProviderType", "STRING"): "k % 3 < 2", ("createdDate", "STRING"): "TRUE", ("LastRefreshTime", "STRING"): "k % 4 <> 1",
    ("lastRefreshTime", "STRING"): "k % 4 = 1"}


def _drift(op: str, source: str, found: dict) -> str:
    what = lambda p, k: "unknown" if p == "lastRefreshTime" else "other kind" if p == "isRefreshable" and k in ("STRING", "NUMBER") else "read"
    return " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{op}' AS operation, '{p}' AS path, '{k}' AS kind, count(*) FILTER ({rule}) AS rows,
          count(*) FILTER ({rule}) / count(*) AS share, '{what(p, k)}' AS finding FROM ({source})) WHERE rows > 0"""
        for (p, k), rule in found.items())


ORACLES["schema_drift"] = (_drift(K.OP_LIST_WORKSPACES, "SELECT c_custkey AS k FROM customer", _WS_FIELDS) + " UNION ALL "
                           + _drift(K.OP_LIST_DATASETS, "SELECT s_suppkey AS k FROM supplier", _MODEL_FIELDS))
