"""Test tables -> landing table: an emulated capture of one extraction run.

The mapping is documented in FIXTURES.md section 3. Every builder is a DataFrame job over a
whole test table; pages are formed from dense keys arithmetically (no window over a listing),
and each page groups at most ``PAGE_SIZE`` elements. The SQL oracles compute the expected
outputs straight from the same columns, never by re-reading this JSON.
"""

from __future__ import annotations

import threading
import uuid
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.operators.planning import ENTITY_URLS, WORKSPACE_ENDPOINTS, request_key
from lakecensus.sources import jsontext as J
from lakecensus.session import ensure_checkpoint_dir
from lakecensus.sources.schemas import LANDING

RUN_ID = "run-0001"
RUN_TS = "2001-10-01 00:00:00"
SECOND_TS = "2001-10-08 00:00:00"
CURRENT_WORKSPACE = "ws-1"
PAGE_SIZE = 100
USER_WORKSPACES = 150      # orders spread over ws-0 .. ws-149 (users and reports)
ITEM_SPREAD = 99           # items outside ws-0 spread over ws-1 .. ws-99
MODEL_WORKSPACES = 25      # models spread over ws-0 .. ws-24
DATAFLOW_WORKSPACES = 50   # dataflows spread over ws-0 .. ws-49
HISTORY_CAPTURED = 100     # most rows of a refresh-history response (the request asks for 50)
DOCS_PER_MODEL = 10

# Item types, indexed by p_size % 19: the other-asset types, the Gen2 spellings, two more.
ITEM_TYPES = list(K.OTHER_ASSET_TYPES) + list(K.DATAFLOW_GEN2_TYPES) + ["Report", "SemanticModel"]

# Attempt patterns: list of (status, error_kind, body) per attempt; body None = the page body.
ERR = {
    "429": '{"error":{"code":"TooManyRequests","message":"Rate limit exceeded"}}',
    "403": '{"error":{"code":"InsufficientPrivileges","message":"The caller does not have permission"}}',
    "401": '{"error":{"code":"TokenExpired","message":"Access token has expired"}}',
    "404": '{"error":{"code":"NotFound","message":"The requested resource was not found"}}',
    "400": '{"error":{"code":"DatasetExecuteQueriesError","message":"Query execution failed"}}',
    "500": "<html><body><h1>500 Internal Server Error</h1></body></html>",
}
PATTERNS: dict[str, list[tuple[int | None, str | None, str | None]]] = {
    "ok": [(200, None, None)],
    "retry429": [(429, None, ERR["429"]), (200, None, None)],
    "timeout_ok": [(None, "timeout", None), (200, None, None)],
    "forbidden": [(403, None, ERR["403"])],
    "unauthorized": [(401, None, ERR["401"])],
    "notfound": [(404, None, ERR["404"])],
    "server_error": [(500, None, ERR["500"])],
    "exhausted429": [(429, None, ERR["429"])] * 3,
    "bad_query": [(400, None, ERR["400"])],
}

EPOCH = {"2020-01-01": 1577836800, "2019-06-01": 1559347200, "2001-09-01": 999302400, "2001-09-15": 1000512000}


def _ts(base: str, seconds: Column) -> Column:
    return F.timestamp_seconds(F.lit(EPOCH[base]) + seconds)


def _v(c: Column) -> Column:
    return c.cast("variant")


def _vnull() -> Column:
    """An explicit JSON null inside ``_json`` (a SQL NULL field is omitted instead)."""
    return F.parse_json(F.lit("null"))


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "true"})


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, int):
        return str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _attempt_map_sql() -> str:
    """map(pattern -> array<struct<attempt, status, error_kind, err_body>>), as one SQL text."""
    entries = []
    for name, steps in PATTERNS.items():
        structs = [
            f"named_struct('attempt', {i + 1}, 'status', CAST({_sql_lit(st)} AS INT), "
            f"'error_kind', CAST({_sql_lit(kind)} AS STRING), 'err_body', CAST({_sql_lit(body)} AS STRING))"
            for i, (st, kind, body) in enumerate(steps)
        ]
        entries.append(f"'{name}', array({', '.join(structs)})")
    return f"map({', '.join(entries)})"


# Two runs over a world that moves between them: rows that a run doesn't see, columns that it sees
# changed. The texts are SQL that the oracles read too.
RUNS: dict[str, dict[str, tuple[str, dict[str, str]]]] = {
    "run-0001": {
        "customer": ("c_custkey % 8 <> 5", {}),
        "orders": ("o_orderkey % 11 <> 3", {}),
        "part": ("p_partkey % 14 <> 9", {}),
        "supplier": ("s_suppkey % 6 <> 5", {}),
    },
    "run-0002": {
        "customer": ("c_custkey % 9 <> 4", {"c_name": "CASE WHEN c_custkey % 7 = 2 THEN concat(c_name, ' v2') ELSE c_name END"}),
        "orders": ("o_orderkey % 13 <> 7", {
            "o_orderpriority": "CASE WHEN o_orderkey % 17 = 5 THEN '1-URGENT' ELSE o_orderpriority END",
            "o_orderdate": "CASE WHEN o_orderkey % 19 = 6 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END"}),
        "part": ("p_partkey % 15 <> 2", {"p_name": "CASE WHEN p_partkey % 12 = 1 THEN concat(p_name, ' v2') ELSE p_name END"}),
        "supplier": ("s_suppkey % 8 <> 3", {"s_name": "CASE WHEN s_suppkey % 9 = 1 THEN concat(s_name, ' v2') ELSE s_name END"}),
    },
}


class Fixture:
    """Landing tables derived from the test tables in ``sf_dir``; of one of the RUNS, if named."""

    def __init__(self, spark: SparkSession, sf_dir: str, run: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.run_id, self.edits = run or RUN_ID, RUNS.get(run, {})
        self._stored: dict[str, str] = {}
        self._has: dict[str, set[str]] = {}  # operations that are stored, by kind
        self._storing = threading.RLock()

    def stored(self, kind: str, *operations: str) -> DataFrame:
        """The landing of ``kind`` ('inventory', 'attempts', 'chains', 'runs', 'wire') as a stored table:
        written once, partitioned by operation, under the session's checkpoint directory
        (a shared folder on a cluster), then read back so that operation filters prune files.
        Of 'inventory' and 'runs', ``operations`` alone may be asked for: a table's endpoints are
        captured when it is first read, all that are still missing in one job."""
        with self._storing:
            if kind not in self._stored:
                root = ensure_checkpoint_dir(self.spark)
                self._stored[kind] = f"{root.rstrip('/')}/lakecensus-landing-{uuid.uuid4().hex}/{kind}"
            path, has = self._stored[kind], self._has.setdefault(kind, set())
            if kind in ("inventory", "runs"):
                missing = [op for op in self._builders(kind == "runs") if op not in has and (not operations or op in operations)]
                if missing or not has:
                    build = self.runs_landing if kind == "runs" else self.inventory_landing
                    build(missing).write.mode("append").partitionBy("operation").parquet(path)
                    has.update(missing)
            elif not has:
                build = {"attempts": self.attempts_landing, "chains": self.chains_landing, "wire": self.wire_landing}[kind]
                build().write.partitionBy("operation").parquet(path)
                has.add(kind)
        landing = self.spark.read.schema(LANDING).parquet(path).select(*LANDING.fieldNames())
        return landing.where(F.col("operation").isin(*operations)) if operations else landing

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        seen, changed = self.edits.get(name, ("true", {}))
        return df.where(seen).withColumns({c: F.expr(sql).cast(df.schema[c].dataType) for c, sql in changed.items()})

    # --- landing assembly ---------------------------------------------------------------
    def _landing(self, pages: DataFrame) -> DataFrame:
        """pages: operation, request_id, workspace_id, item_id, item_type, item_name, url,
        query, page_no, body, pattern -> one landing row per attempt."""
        if not hasattr(self, "_attempt_map"):
            self._attempt_map = F.expr(_attempt_map_sql())
        a = F.explode(F.element_at(self._attempt_map, F.col("pattern"))).alias("a")
        rows = pages.select("*", a)
        body = F.when(F.col("a.status") == 200, F.col("body")).otherwise(F.col("a.err_body"))
        return rows.select(
            F.lit(self.run_id).alias("run_id"),
            "operation", "request_id", "workspace_id", "item_id", "item_type", "item_name", "url", "query",
            F.col("page_no").cast("int").alias("page_no"),
            F.col("a.attempt").alias("attempt"),
            F.col("a.status").alias("status"),
            F.when(F.col("a.status") == 429, F.lit(2)).cast("int").alias("retry_after"),
            F.col("a.error_kind").alias("error_kind"),
            body.alias("body"),
            F.lit(RUN_TS).cast("timestamp").alias("requested_at"),
        )

    def _listing(self, operation: str, elements: DataFrame, url: Column, all_workspaces: DataFrame | None,
                 pattern: Column | None = None) -> DataFrame:
        """Group elements (workspace_id, page_no, pos, elem) into pages of a paged listing and
        add continuation links. Workspaces in ``all_workspaces`` without elements get one
        empty page. ``pattern`` may use workspace_id and page_no."""
        key = F.coalesce(F.col("workspace_id"), F.lit("")).alias("_k")
        pages = elements.groupBy(key, "page_no").agg(
            F.array_sort(F.collect_list(F.struct("pos", "elem"))).alias("items")
        )
        # the last page is looked up for workspaces with elements alone: an empty one has page 0. The listings
        # above spread over USER_WORKSPACES at most, whatever the tables' size, so it is broadcast: pages are
        # not moved again, nor gathered by workspace (all of a listing without one)
        last = elements.groupBy(key).agg(F.max("page_no").alias("last_page"))
        kind = pages.schema["items"].dataType
        pages = pages.join(F.broadcast(last), "_k")
        if all_workspaces is not None:
            present = elements.select(key).distinct()
            empty = all_workspaces.select(F.col("workspace_id").alias("_k")).where("_k IS NOT NULL").join(present, "_k", "left_anti")
            first = F.lit(0).cast("long")
            pages = pages.unionByName(empty.select(
                "_k", first.alias("page_no"), F.array().cast(kind).alias("items"), first.alias("last_page")))
        pages = pages.withColumn("workspace_id", F.nullif(F.col("_k"), F.lit("")))
        base_url = url
        next_url = J.s(F.concat(base_url, F.lit("?page="), (F.col("page_no") + 1).cast("string")))
        p = F.col("page_no")
        link = (
            F.when(p < F.col("last_page"), F.when(p % 2 == 0, J.field("nextLink", next_url))
                   .otherwise(J.field("@odata.nextLink", next_url)))
            .when(p % 3 == 0, J.field("nextLink", J.null()))
            .when(p % 3 == 1, J.field("nextLink", J.lit_s("")))
        )
        body = J.obj(J.field("value", J.arr(F.transform("items", lambda x: x["elem"]))), link)
        return pages.select(
            F.lit(operation).alias("operation"),
            request_key(F.lit(operation), F.col("workspace_id")).alias("request_id"),
            "workspace_id",
            F.lit(None).cast("string").alias("item_id"),
            F.lit(None).cast("string").alias("item_type"),
            F.lit(None).cast("string").alias("item_name"),
            base_url.alias("url"),
            F.lit(None).cast("string").alias("query"),
            "page_no",
            body.alias("body"),
            (pattern if pattern is not None else F.lit("ok")).alias("pattern"),
        )

    def _ws_url(self, operation: str) -> Column:
        template = dict(WORKSPACE_ENDPOINTS)[operation]
        return F.format_string(template, F.col("workspace_id"))

    def _entity_page(self, operation: str, df: DataFrame, item_type: str, body: Column, pattern: Column,
                     query: str | None = None) -> DataFrame:
        """One single-page request per entity row (workspace_id, item_id, item_name)."""
        return df.select(
            F.lit(operation).alias("operation"),
            request_key(F.lit(operation), F.col("workspace_id"), F.col("item_id")).alias("request_id"),
            "workspace_id", "item_id",
            F.lit(item_type).alias("item_type"),
            "item_name",
            F.format_string(ENTITY_URLS[operation], F.col("workspace_id"), F.col("item_id")).alias("url"),
            F.lit(query).cast("string").alias("query"),
            F.lit(0).cast("long").alias("page_no"),
            body.alias("body"),
            pattern.alias("pattern"),
        )

    # --- entity sources ---------------------------------------------------------------------
    @cached_property
    def workspace_keys(self) -> DataFrame:
        return self.table("customer").select(F.concat(F.lit("ws-"), F.col("c_custkey")).alias("workspace_id"))

    @staticmethod
    def workspace_object(c: DataFrame) -> Column:
        k = F.col("c_custkey")
        cap = (
            F.when(k % 4 == 0, _vnull()).when(k % 4 == 2, _v(F.lit("")))
            .when(k % 4 == 3, _v(F.concat(F.lit("cap-"), F.col("c_nationkey"))))
        )
        desc = F.when(k % 6 == 3, _vnull()).when(k % 6 != 0, _v(F.col("c_mktsegment")))
        return _json(
            F.concat(F.lit("ws-"), k).alias("id"),
            F.col("c_name").alias("displayName"),
            F.when(k % 10 == 0, "Personal").otherwise("Workspace").alias("type"),
            F.lit("Active").alias("state"),
            cap.alias("capacityId"),
            desc.alias("description"),
        )

    def workspaces(self) -> DataFrame:
        c = self.table("customer")
        k = F.col("c_custkey")
        el = c.select(
            F.lit(None).cast("string").alias("workspace_id"),
            (k / PAGE_SIZE).cast("long").alias("page_no"),
            (k % PAGE_SIZE).alias("pos"),
            self.workspace_object(c).alias("elem"),
        )
        p = F.col("page_no")
        pattern = F.when(p % 5 == 1, "retry429").when(p % 7 == 3, "timeout_ok").otherwise("ok")
        return self._listing(K.OP_LIST_WORKSPACES, el, F.lit(K.WORKSPACE_API_BASE + "/workspaces"), None, pattern)

    def current_workspace(self) -> DataFrame:
        c = self.table("customer").where(F.concat(F.lit("ws-"), F.col("c_custkey")) == CURRENT_WORKSPACE)
        return c.select(
            F.lit(K.OP_GET_WORKSPACE).alias("operation"),
            request_key(F.lit(K.OP_GET_WORKSPACE), F.lit(CURRENT_WORKSPACE)).alias("request_id"),
            F.lit(CURRENT_WORKSPACE).alias("workspace_id"),
            F.lit(None).cast("string").alias("item_id"),
            F.lit(None).cast("string").alias("item_type"),
            F.lit(None).cast("string").alias("item_name"),
            F.lit(K.WORKSPACE_API_BASE + "/workspaces/" + CURRENT_WORKSPACE).alias("url"),
            F.lit(None).cast("string").alias("query"),
            F.lit(0).cast("long").alias("page_no"),
            self.workspace_object(c).alias("body"),
            F.lit("timeout_ok").alias("pattern"),
        )

    def users(self) -> DataFrame:
        o = self.table("orders")
        j = F.col("o_orderkey")
        w = j % USER_WORKSPACES
        r = (j / USER_WORKSPACES).cast("long")

        def email(prefix: str) -> Column:
            return F.concat(F.lit(prefix), j, F.lit("@example.com"))

        user = (
            F.when(j % 8 == 4, F.struct(F.lit("").alias("userPrincipalName")))
            .when(j % 4 == 0, F.struct(email("u").alias("userPrincipalName")))
        )
        service = F.when(j % 4 == 1, F.struct(F.concat(F.lit("app-"), j).alias("aadAppId")))
        group = F.when((j % 8 == 4) | (j % 4 == 2), F.struct(email("g").alias("email")))
        ptype = F.element_at(F.array(*[F.lit(t) for t in ("User", "ServicePrincipal", "Group", "User")]), (j % 4 + 1).cast("int"))
        principal = F.struct(
            F.when(j % 13 != 0, F.concat(F.lit("pr-"), j)).alias("id"),
            F.concat(F.lit("Principal "), j).alias("displayName"),
            ptype.alias("type"),
            user.alias("userDetails"),
            service.alias("servicePrincipalDetails"),
            group.alias("groupDetails"),
        )
        pri = F.substring("o_orderpriority", 1, 1)
        role = F.when(pri == "1", "Admin").when(pri == "2", "Member").when(pri == "3", "Contributor").otherwise("Viewer")
        el = o.select(
            F.concat(F.lit("ws-"), w).alias("workspace_id"),
            (r / PAGE_SIZE).cast("long").alias("page_no"),
            (r % PAGE_SIZE).alias("pos"),
            _json(role.alias("role"), principal.alias("principal")).alias("elem"),
        )
        wn = F.regexp_extract(F.col("workspace_id"), r"(\d+)$", 1).cast("long") % 20
        pattern = (
            F.when((F.col("page_no") == 0) & (wn == 7), "forbidden")
            .when((F.col("page_no") == 0) & (wn == 13), "exhausted429")
            .when((F.col("page_no") == 1) & (wn == 17), "server_error")
            .otherwise("ok")
        )
        return self._listing(K.OP_ROLE_ASSIGNMENTS, el, self._ws_url(K.OP_ROLE_ASSIGNMENTS), self.workspace_keys, pattern)

    def item_rows(self) -> DataFrame:
        """Items with their workspace and in-workspace rank (a third of them in ws-0)."""
        p = self.table("part")
        i = F.col("p_partkey")
        q = (i / 3).cast("long")
        w = F.when(i % 3 == 0, F.lit(0)).otherwise(1 + q % ITEM_SPREAD)
        r = F.when(i % 3 == 0, q).otherwise((q / ITEM_SPREAD).cast("long") * 2 + (i % 3 - 1))
        itype = F.element_at(F.array(*[F.lit(t) for t in ITEM_TYPES]), (F.col("p_size") % len(ITEM_TYPES) + 1).cast("int"))
        return p.select(
            "*",
            F.concat(F.lit("ws-"), w).alias("workspace_id"),
            r.alias("rank"),
            F.concat(F.lit("it-"), i).alias("item_id"),
            F.col("p_name").alias("item_name"),
            itype.alias("item_type"),
        )

    def items(self) -> DataFrame:
        p = self.item_rows()
        i = F.col("p_partkey")
        created = _ts("2020-01-01", i * 3607)
        modified = created + F.make_dt_interval(F.lit(0), F.lit(0), (i % 1000).cast("int"))
        desc = F.when(i % 5 == 1, _vnull()).when(i % 5 == 2, _v(F.lit(""))).when(i % 5 >= 3, _v(F.col("p_type")))
        elem = _json(
            F.col("item_id").alias("id"),
            F.col("item_name").alias("displayName"),
            F.col("item_type").alias("type"),
            desc.alias("description"),
            F.when(i % 4 == 0, J.iso(created)).when(i % 4 == 3, F.lit("")).alias("createdDate"),
            F.when(i % 4 == 1, J.iso(created + F.make_dt_interval(F.lit(0), F.lit(2)), "+02:00"))
            .when(i % 4 == 3, J.iso(created, ".1234567")).alias("createdDateTime"),
            F.when(i % 3 == 0, J.iso(modified)).when(i % 3 == 2, F.lit("junk")).alias("lastUpdatedDate"),
            F.when(i % 3 == 1, J.iso(modified)).alias("lastModifiedDateTime"),
            F.when(i % 6 != 0, F.struct(F.struct(
                F.concat(F.lit("owner"), i % 50, F.lit("@example.com")).alias("userPrincipalName")
            ).alias("userIdentity"))).alias("createdBy"),
        )
        el = p.select(
            "workspace_id",
            (F.col("rank") / PAGE_SIZE).cast("long").alias("page_no"),
            (F.col("rank") % PAGE_SIZE).alias("pos"),
            elem.alias("elem"),
        )
        return self._listing(K.OP_LIST_ITEMS, el, self._ws_url(K.OP_LIST_ITEMS), self.workspace_keys)

    def model_rows(self) -> DataFrame:
        s = self.table("supplier")
        m = F.col("s_suppkey")
        refreshable = (m % 5 != 0) & (m % 17 != 6)
        return s.select(
            "*",
            F.concat(F.lit("ws-"), m % MODEL_WORKSPACES).alias("workspace_id"),
            (m / MODEL_WORKSPACES).cast("long").alias("rank"),
            F.concat(F.lit("sm-"), m).alias("item_id"),
            F.col("s_name").alias("item_name"),
            refreshable.alias("refreshable"),
            (refreshable & (m % 7 != 0)).alias("viable"),
        )

    def models(self) -> DataFrame:
        s = self.model_rows()
        m = F.col("s_suppkey")
        tsm = F.when(m % 7 == 0, F.when(m % 2 == 0, "Abf").otherwise("ABF")).when(m % 7 != 3, F.lit("PremiumFiles"))
        refresh = (
            F.when(m % 5 == 0, _v(F.lit(False))).when(m % 17 == 6, F.lit(None).cast("variant"))
            .when(m % 11 == 3, _v(F.lit("false"))).when(m % 13 == 4, _v(F.lit(1))).otherwise(_v(F.lit(True)))
        )
        cpt = F.when(m % 3 == 0, "PbixInImportMode").when(m % 3 == 1, "RealTimeInPushMode")
        last = J.iso(_ts("2001-09-01", m * 3600))
        elem = _json(
            F.col("item_id").alias("id"),
            F.col("item_name").alias("name"),
            F.when(m % 4 == 0, _vnull()).otherwise(_v(F.concat(F.lit("owner"), m % 50, F.lit("@example.com")))).alias("configuredBy"),
            tsm.alias("targetStorageMode"),
            refresh.alias("isRefreshable"),
            cpt.alias("contentProviderType"),
            J.iso(_ts("2019-06-01", m * 86400), ".000Z").alias("createdDate"),
            F.when(m % 4 != 1, last).alias("LastRefreshTime"),
            F.when(m % 4 == 1, last).alias("lastRefreshTime"),
        )
        el = s.select(
            "workspace_id",
            (F.col("rank") / PAGE_SIZE).cast("long").alias("page_no"),
            (F.col("rank") % PAGE_SIZE).alias("pos"),
            elem.alias("elem"),
        )
        return self._listing(K.OP_LIST_DATASETS, el, self._ws_url(K.OP_LIST_DATASETS), self.workspace_keys)

    def reports(self) -> DataFrame:
        o = self.table("orders")
        j = F.col("o_orderkey")
        w = j % USER_WORKSPACES
        r = (j / USER_WORKSPACES).cast("long")
        elem = _json(
            F.concat(F.lit("rp-"), j).alias("id"),
            F.concat(F.lit("Report "), j).alias("name"),
            F.when(j % 5 == 0, "PaginatedReport").otherwise("PowerBIReport").alias("reportType"),
            F.when(j % 7 == 0, _vnull()).otherwise(_v(F.concat(F.lit("sm-"), j % 100))).alias("datasetId"),
            F.concat(F.lit("https://app.example.com/reports/rp-"), j).alias("webUrl"),
            F.when(j % 3 != 0, F.concat(F.lit("https://app.example.com/embed?r="), j)).alias("embedUrl"),
            F.when(j % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("owner"), j % 50, F.lit("@example.com"))).alias("createdBy"),
            J.iso(F.col("o_orderdate")).alias("createdDateTime"),
            F.when(j % 2 == 0, J.iso(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "+00:00")).alias("modifiedDateTime"),
        )
        el = o.select(
            F.concat(F.lit("ws-"), w).alias("workspace_id"),
            (r / PAGE_SIZE).cast("long").alias("page_no"),
            (r % PAGE_SIZE).alias("pos"),
            elem.alias("elem"),
        )
        return self._listing(K.OP_LIST_REPORTS, el, self._ws_url(K.OP_LIST_REPORTS), self.workspace_keys)

    def dataflow_rows(self) -> DataFrame:
        pg = self.table("pages")
        d = F.col("page_id")
        return pg.select(
            "*",
            F.concat(F.lit("ws-"), d % DATAFLOW_WORKSPACES).alias("workspace_id"),
            (d / DATAFLOW_WORKSPACES).cast("long").alias("rank"),
            F.concat(F.lit("df-"), d).alias("item_id"),
            F.concat(F.lit("Dataflow "), d).alias("item_name"),
        )

    def dataflows(self) -> DataFrame:
        pg = self.dataflow_rows()
        d = F.col("page_id")
        elem = _json(
            F.col("item_id").alias("objectId"),
            F.col("item_name").alias("name"),
            F.when(d % 3 == 0, _vnull()).otherwise(_v(F.col("url"))).alias("description"),
            F.concat(F.lit("owner"), d % 50, F.lit("@example.com")).alias("configuredBy"),
            F.when(d % 2 == 0, J.iso(_ts("2001-09-15", d * 60))).alias("lastRefreshTime"),
        )
        el = pg.select(
            "workspace_id",
            (F.col("rank") / PAGE_SIZE).cast("long").alias("page_no"),
            (F.col("rank") % PAGE_SIZE).alias("pos"),
            elem.alias("elem"),
        )
        return self._listing(K.OP_LIST_DATAFLOWS, el, self._ws_url(K.OP_LIST_DATAFLOWS), self.workspace_keys)

    def dataflow_schedules(self) -> DataFrame:
        pg = self.dataflow_rows()
        d = F.col("page_id")
        on = d % 4 == 0
        body = _json(
            on.alias("enabled"),
            F.when(on, F.array(F.lit("Monday"), F.lit("Thursday"))).otherwise(F.array().cast("array<string>")).alias("days"),
            F.when(on, F.array(F.lit("06:00"), F.lit("18:00"))).otherwise(F.array().cast("array<string>")).alias("times"),
            F.when(on, _v(F.lit("MailOnFailure"))).otherwise(_vnull()).alias("notifyOption"),
            F.when(on, F.lit("ops@example.com")).alias("notificationGroupMailAddress"),
        )
        pattern = F.when(d % 4 == 2, "notfound").when(d % 4 == 3, "forbidden").otherwise("ok")
        return self._entity_page(K.OP_DATAFLOW_SCHEDULE, pg, "Dataflow", body, pattern)

    def dataflow_datasources(self) -> DataFrame:
        pg = self.dataflow_rows()
        d = F.col("page_id")
        ds = F.struct(
            F.concat(F.lit("dfsrc-"), d).alias("datasourceId"),
            F.lit("Web").alias("datasourceType"),
            F.struct(F.col("url").alias("url")).alias("connectionDetails"),
        )
        body = _json(F.array(ds).alias("value"))
        return self._entity_page(K.OP_DATAFLOW_DATASOURCES, pg, "Dataflow", body,
                                 F.when(d % 5 == 4, "unauthorized").otherwise("ok"))

    def model_datasources(self) -> DataFrame:
        s = self.model_rows().where("viable")
        m = F.col("s_suppkey")

        def ds(k: int) -> Column:
            return F.struct(
                (F.when(m % 6 != 1, F.concat(F.lit("dsrc-"), m, F.lit("-0"))) if k == 0
                 else F.concat(F.lit("dsrc-"), m, F.lit("-1"))).alias("datasourceId"),
                F.lit("Sql" if k == 0 else "Web").alias("datasourceType"),
                F.struct(
                    (F.concat(F.lit("sql"), m, F.lit(".example.net")) if k == 0 else F.lit(None).cast("string")).alias("server"),
                    (F.concat(F.lit("db"), m) if k == 0 else F.lit(None).cast("string")).alias("database"),
                    (F.lit(None).cast("string") if k == 0 else F.concat(F.lit("https://data.example.com/"), m)).alias("url"),
                ).alias("connectionDetails"),
                (F.when(m % 2 == 0, _v(F.concat(F.lit("gw-"), m % 7))) if k == 0 else _vnull()).alias("gatewayId"),
                (F.struct(F.lit("OAuth2").alias("credentialType"), F.concat(F.lit("svc"), m).alias("username")) if k == 0
                 else F.lit(None).cast("struct<credentialType:string,username:string>")).alias("credentialDetails"),
            )

        values = F.slice(F.array(ds(0), ds(1)), 1, (m % 3).cast("int"))
        body = F.when(m % 3 == 0, F.lit('{"value":[]}')).otherwise(_json(values.alias("value")))
        pattern = (
            F.when(m % 9 == 2, "forbidden").when(m % 9 == 5, "notfound").when(m % 9 == 7, "server_error").otherwise("ok")
        )
        return self._entity_page(K.OP_MODEL_DATASOURCES, s, "SemanticModel", body, pattern)

    def gen2_datasources(self) -> DataFrame:
        p = self.item_rows().where(F.col("item_type").isin(*K.DATAFLOW_GEN2_TYPES))
        i = F.col("p_partkey")
        ds = F.struct(
            F.concat(F.lit("g2src-"), i).alias("datasourceId"),
            F.lit("Lakehouse").alias("datasourceType"),
            F.struct(F.lit("onelake.example.com").alias("server"), F.concat(F.lit("lh"), i).alias("database")).alias("connectionDetails"),
        )
        body = F.when(i % 2 == 0, _json(F.array(ds).alias("value"))).otherwise(F.lit('{"value":[]}'))
        return self._entity_page(K.OP_GEN2_DATASOURCES, p, "DataflowGen2", body, F.lit("ok"))

    def shortcuts(self) -> DataFrame:
        p = self.item_rows().where(F.col("item_type") == "Lakehouse")
        i = F.col("p_partkey")

        def one(k: int) -> Column:
            t = (i + k) % 4
            target = F.struct(
                F.element_at(F.array(*[F.lit(x) for x in ("adlsGen2", "oneLake", "googleCloudStorage", "s3Compatible")]),
                             (t + 1).cast("int")).alias("type"),
                F.when(t == 0, F.struct(
                    F.concat(F.lit("https://acct"), i, F.lit(".dfs.core.windows.net")).alias("location"),
                    F.lit(f"/c{k}").alias("subpath"),
                    F.concat(F.lit("conn-"), i).alias("connectionId"))).alias("adlsGen2"),
                F.when(t == 1, F.struct(F.lit(f"Files/x{k}").alias("path"), F.lit("ws-0").alias("workspaceId"))).alias("oneLake"),
                F.when(t == 2, F.struct(F.lit("https://gcs.example.com").alias("location"), F.lit("/b").alias("subpath")))
                .alias("GoogleCloudStorage"),
                F.when(t == 3, F.struct(
                    F.lit("https://s3.example.com").alias("url"),
                    F.concat(F.lit("bkt"), i).alias("bucket"),
                    F.concat(F.lit("conn-"), i).alias("connectionId"))).alias("s3Compatible"),
            )
            return F.struct(F.lit(f"sc{k}").alias("name"), F.lit(f"/Tables/t{k}").alias("path"), target.alias("target"))

        values = F.slice(F.array(one(0), one(1)), 1, (i % 3).cast("int"))
        body = F.when(i % 3 == 0, F.lit('{"value":[]}')).otherwise(_json(values.alias("value")))
        return self._entity_page(K.OP_SHORTCUTS, p, "Lakehouse", body, F.lit("ok"))

    def refresh_schedules(self) -> DataFrame:
        s = self.model_rows().where("refreshable")
        m = F.col("s_suppkey")
        days = (
            F.when(m % 8 == 5, _vnull())
            .when(m % 2 == 0, _v(F.array(F.lit("Monday"), F.lit("Wednesday"), F.lit("Friday"))))
            .otherwise(_v(F.array().cast("array<string>")))
        )
        tz = F.when(m % 5 == 2, F.lit("")).when(m % 5 != 1, F.lit("W. Europe Standard Time"))
        full = _json(
            (m % 2 == 0).alias("enabled"),
            F.when(m % 3 == 0, "MailOnFailure").otherwise("NoNotification").alias("notifyOption"),
            F.when(m % 3 == 0, _v(F.concat(F.lit("team"), m, F.lit("@example.com")))).otherwise(_vnull())
            .alias("notificationGroupMailAddress"),
            days.alias("days"),
            F.array(F.lit("07:00"), F.lit("19:30")).alias("times"),
            tz.alias("localTimeZoneId"),
        )
        body = F.when(m % 8 == 7, F.lit("{}")).otherwise(full)
        return self._entity_page(K.OP_REFRESH_SCHEDULE, s, "SemanticModel", body,
                                 F.when(m % 8 == 6, "notfound").otherwise("ok"))

    def refresh_history(self) -> DataFrame:
        """Page 0 of each model's history: the first HISTORY_CAPTURED rows in response order
        (start desc nulls first, then every other column). The per-model limit is planned
        as a group limit, applied on the map side before the shuffle, so the model holding
        half of all rows never lands in one task whole."""
        li = self.table("lineitem").where(F.col("l_shipdate") <= F.lit(RUN_TS).cast("timestamp_ntz"))
        mid = F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey")).otherwise(F.lit(1))
        start = F.when(F.col("l_orderkey") % 97 != 0, F.col("l_shipdate"))
        li = li.select("*", mid.alias("mid"), start.alias("start_ts"))
        order = [F.col("start_ts").desc_nulls_first()] + [F.col(c).asc() for c in (
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")]
        rn = F.row_number().over(Window.partitionBy("mid").orderBy(*order))
        top = li.select("*", rn.alias("rn")).where(F.col("rn") <= HISTORY_CAPTURED)
        ln = F.col("l_linenumber")
        svc = (
            F.when(ln % 3 == 0, F.to_json(F.struct(
                F.concat(F.lit("E"), F.col("l_partkey") % 10).alias("errorCode"),
                F.concat(F.lit("Failure on line "), ln).alias("errorDescription"))))
            .when(ln % 3 == 1, F.lit("{not json"))
        )
        elem = _json(
            F.when(F.col("start_ts").isNull(), _vnull()).otherwise(_v(J.iso(F.col("start_ts")))).alias("startTime"),
            J.iso(F.col("l_shipdate") + F.make_dt_interval(F.lit(0), ln)).alias("endTime"),
            F.col("l_returnflag").alias("status"),
            F.when(F.col("l_linestatus") == "O", "Scheduled").otherwise("OnDemand").alias("refreshType"),
            svc.alias("serviceExceptionJson"),
        )
        pages = top.groupBy("mid").agg(F.array_sort(F.collect_list(F.struct("rn", elem.alias("elem")))).alias("items"))
        body = J.obj(J.field("value", J.arr(F.transform("items", lambda x: x["elem"]))))
        m = F.col("mid")
        df = pages.select(
            F.concat(F.lit("ws-"), m % MODEL_WORKSPACES).alias("workspace_id"),
            F.concat(F.lit("sm-"), m).alias("item_id"),
            F.lit(None).cast("string").alias("item_name"),
            body.alias("body"),
        )
        return self._entity_page(K.OP_REFRESH_HISTORY, df, "SemanticModel", F.col("body"), F.lit("ok"))

    def dax(self) -> DataFrame:
        """INFO.TABLES / INFO.PARTITIONS results per viable model, and the probe."""
        models = self.model_rows().where("viable").select("s_suppkey", "workspace_id", "item_id", "item_name", "rank")
        docs = self.table("documents").select("*", (F.col("doc_id") / DOCS_PER_MODEL).cast("long").alias("s_suppkey"))
        labels = self.table("labels")
        d = F.col("doc_id")
        src_no = F.regexp_extract(F.col("source"), r"(\d+)$", 1).cast("int")

        def envelope(rows: Column) -> Column:
            return J.obj(J.field("results", J.arr_of(J.obj(J.field("tables", J.arr_of(J.obj(J.field("rows", rows))))))))

        tables = (
            docs.where(F.col("source") != "src7").select("s_suppkey", "source", src_no.alias("n")).distinct()
            .groupBy("s_suppkey")
            .agg(F.array_sort(F.collect_list(F.struct("n", J.obj(
                J.field("[TableID]", J.num(F.col("n"))), J.field("[Name]", J.s(F.col("source")))).alias("row")))).alias("rows"))
        )
        qualified = d % 4 == 1
        name_key = F.when(qualified, F.lit("[Partition].[Name]")).otherwise(F.lit("[Name]"))
        part_row = J.obj(
            F.when(d % 19 != 0, F.concat(F.when(qualified, F.lit('"[Partition].[TableID]":')).otherwise(F.lit('"[TableID]":')), J.num(src_no))),
            F.when(d % 50 == 7, J.field("[Name]", J.lit_s("decoy"))),
            F.concat(J.s(name_key), F.lit(":"), J.s(F.when(d % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("Partition-"), d)))),
            J.field("[Type]", F.when(d % 13 == 5, J.lit_s("2")).otherwise(J.num(d % 9))),
            J.field("[Mode]", J.num(d % 7)),
            J.field("[QueryDefinition]", F.when(d % 17 == 3, J.null()).otherwise(J.s(F.col("text")))),
        )
        parts = docs.groupBy("s_suppkey").agg(F.array_sort(F.collect_list(F.struct("doc_id", part_row.alias("row")))).alias("rows"))
        rows_json = lambda c: F.coalesce(J.arr(F.transform(c, lambda x: x["row"])), F.lit("[]"))
        bad_tables = labels.where("toxic = 1").select((F.col("doc_id") / DOCS_PER_MODEL).cast("long").alias("s_suppkey"),
                                                       (F.col("doc_id") % DOCS_PER_MODEL).alias("k")).where("k = 0")
        bad_parts = labels.where("quality = 0").select((F.col("doc_id") / DOCS_PER_MODEL).cast("long").alias("s_suppkey"),
                                                        (F.col("doc_id") % DOCS_PER_MODEL).alias("k")).where("k = 1")
        t = (
            models.join(tables, "s_suppkey", "left").join(bad_tables.select("s_suppkey", F.lit(True).alias("bad")), "s_suppkey", "left")
            .select("workspace_id", "item_id", "item_name", envelope(rows_json(F.col("rows"))).alias("body"),
                    F.when(F.col("bad"), "bad_query").otherwise("ok").alias("pattern"))
        )
        p = (
            models.join(parts, "s_suppkey", "left").join(bad_parts.select("s_suppkey", F.lit(True).alias("bad")), "s_suppkey", "left")
            .select("workspace_id", "item_id", "item_name", envelope(rows_json(F.col("rows"))).alias("body"),
                    F.when(F.col("bad"), "forbidden").otherwise("ok").alias("pattern"))
        )
        first = models.orderBy(F.regexp_extract("workspace_id", r"(\d+)$", 1).cast("long"), "rank").limit(1)
        probe = first.select("workspace_id", "item_id", "item_name",
                             envelope(J.arr_of(J.obj(J.field("[OK]", F.lit("1"))))).alias("body"), F.lit("ok").alias("pattern"))
        return reduce(DataFrame.unionByName, [
            self._entity_page(K.OP_DAX_TABLES, t, "SemanticModel", F.col("body"), F.col("pattern"), K.DAX_TABLES),
            self._entity_page(K.OP_DAX_PARTITIONS, p, "SemanticModel", F.col("body"), F.col("pattern"), K.DAX_PARTITIONS),
            self._entity_page(K.OP_DAX_PROBE, probe, "SemanticModel", F.col("body"), F.col("pattern"), K.DAX_PROBE),
        ])

    # --- captures ---------------------------------------------------------------------------
    def _builders(self, listings: bool = False) -> dict:
        """What makes an operation's pages, by operation; of the ``listings`` that all RUNS have alone."""
        of = {
            K.OP_LIST_WORKSPACES: self.workspaces, K.OP_ROLE_ASSIGNMENTS: self.users, K.OP_LIST_ITEMS: self.items,
            K.OP_LIST_DATASETS: self.models, K.OP_LIST_REPORTS: self.reports,
        }
        return of if listings else of | {
            K.OP_GET_WORKSPACE: self.current_workspace, K.OP_LIST_DATAFLOWS: self.dataflows,
            K.OP_DATAFLOW_SCHEDULE: self.dataflow_schedules, K.OP_DATAFLOW_DATASOURCES: self.dataflow_datasources,
            K.OP_MODEL_DATASOURCES: self.model_datasources, K.OP_GEN2_DATASOURCES: self.gen2_datasources,
            K.OP_SHORTCUTS: self.shortcuts, K.OP_REFRESH_SCHEDULE: self.refresh_schedules,
            K.OP_REFRESH_HISTORY: self.refresh_history, **{op: self.dax for op in K.DAX_OPERATIONS},
        }

    def _pages_of(self, operations: list[str], listings: bool = False) -> DataFrame:
        builders = self._builders(listings)
        parts = [b() for b in dict.fromkeys(builders[op] for op in operations)]
        pages = reduce(DataFrame.unionByName, [p.select(*parts[0].columns) for p in parts])
        return pages.where(F.col("operation").isin(*operations))

    @staticmethod
    def _typed(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType) for f in LANDING.fields])

    def inventory_landing(self, operations: list[str] | None = None) -> DataFrame:
        """Every request of one full run (scope all, plus the current workspace's GET), or those of some operations."""
        wanted = list(self._builders()) if operations is None else operations
        if not wanted:
            return self.spark.createDataFrame([], LANDING)
        return self._typed(self._landing(self._pages_of(wanted)))

    def runs_landing(self, operations: list[str] | None = None) -> DataFrame:
        """The listings of all RUNS, or some of them, in one landing."""
        wanted = list(self._builders(True)) if operations is None else operations
        if not wanted:
            return self.spark.createDataFrame([], LANDING)
        parts = []
        for run in RUNS:
            fx = Fixture(self.spark, self.sf_dir, run)
            parts.append(fx._landing(fx._pages_of(wanted, True)))
        return self._typed(reduce(DataFrame.unionByName, parts))

    def attempts_landing(self) -> DataFrame:
        """events -> a log of GET attempts: request = event_id div 3, attempt = event_id % 3 + 1.
        click -> 200 with props as body (every 41st: an html body); view -> 429; purchase ->
        timeout; error -> 403 / 500 (props as body); signup -> 404 / 500 with a page's html;
        every 37th event -> a transport exception."""
        ev = self.table("events")
        pages = self.table("pages")
        html = pages.select(F.col("page_id").alias("_pid"), F.col("html"))
        e = F.col("event_id")
        ev = ev.join(html, (e % pages.count()) == F.col("_pid"), "left")
        t = F.col("event_type")
        exc = e % 37 == 0
        status = (
            F.when(exc, F.lit(None))
            .when(t == "click", F.lit(200)).when(t == "view", F.lit(429)).when(t == "purchase", F.lit(None))
            .when(t == "error", F.when(e % 2 == 0, F.lit(403)).otherwise(F.lit(500)))
            .when(t == "signup", F.when(e % 2 == 0, F.lit(404)).otherwise(F.lit(500)))
        ).cast("int")
        kind = F.when(exc, "exception").when(t == "purchase", "timeout")
        body = (
            F.when(exc, F.lit("Connection aborted."))
            .when((t == "click") & (e % 41 == 0), F.col("html"))
            .when(t.isin("click", "error"), F.col("props"))
            .when(t == "view", F.lit(ERR["429"]))
            .when((t == "signup") & (e % 2 == 1), F.col("html"))
            .when(t == "signup", F.lit(ERR["404"]))
        )
        req = (e / 3).cast("long")
        op = F.element_at(F.array(F.lit(K.OP_LIST_LAKEHOUSES), F.lit(K.OP_LIST_ITEMS), F.lit(K.OP_LIST_REPORTS)),
                          (req % 3 + 1).cast("int"))
        ws = F.concat(F.lit("ws-"), F.col("user_id") % 25)
        return ev.select(
            F.lit(RUN_ID).alias("run_id"),
            op.alias("operation"),
            F.concat(F.lit("evt|"), req).alias("request_id"),
            ws.alias("workspace_id"),
            F.lit(None).cast("string").alias("item_id"),
            F.lit(None).cast("string").alias("item_type"),
            F.lit(None).cast("string").alias("item_name"),
            F.concat(F.lit(K.WORKSPACE_API_BASE + "/workspaces/"), ws, F.lit("/items")).alias("url"),
            F.lit(None).cast("string").alias("query"),
            F.lit(0).alias("page_no"),
            (e % 3 + 1).cast("int").alias("attempt"),
            status.alias("status"),
            F.when(status == 429, (F.col("value").cast("int") % 5)).cast("int").alias("retry_after"),
            kind.alias("error_kind"),
            body.alias("body"),
            F.col("ts").cast("timestamp").alias("requested_at"),
        ).select(*[F.col(f.name).cast(f.dataType) for f in LANDING.fields])

    def chains_landing(self) -> DataFrame:
        """conversations -> paged chains: request = conv_id, page = turn, one element per turn.
        Turn 1 of every 5th conversation fails (500); in every 7th the last page carries no
        link before the end (turn 1 ends the chain); every 11th loses its middle page."""
        cv = self.table("conversations")
        c, t = F.col("conv_id"), F.col("turn")
        mx = cv.groupBy("conv_id").agg(F.max("turn").alias("mx"))
        cv = cv.join(mx, "conv_id")
        ends_early = (c % 7 == 3) & (t == 1)
        link = F.when((t < F.col("mx")) & ~ends_early, J.field("nextLink", J.s(F.concat(F.lit("chain/"), c, F.lit("?page="), t + 1))))
        elem = J.obj(J.field("role", J.s(F.col("role"))), J.field("text", J.s(F.col("text"))))
        body = J.obj(J.field("value", J.arr_of(elem)), link)
        pattern = F.when((c % 5 == 0) & (t == 1), "server_error").otherwise("ok")
        dropped = (c % 11 == 4) & (t == 2)
        pages = cv.where(~dropped).select(
            F.lit(K.OP_LIST_LAKEHOUSES).alias("operation"),
            F.concat(F.lit("chain|"), c).alias("request_id"),
            F.concat(F.lit("ws-"), c % 25).alias("workspace_id"),
            F.lit(None).cast("string").alias("item_id"),
            F.lit(None).cast("string").alias("item_type"),
            F.lit(None).cast("string").alias("item_name"),
            F.concat(F.lit("chain/"), c).alias("url"),
            F.lit(None).cast("string").alias("query"),
            t.alias("page_no"),
            body.alias("body"),
            pattern.alias("pattern"),
        )
        return self._landing(pages).select(*[F.col(f.name).cast(f.dataType) for f in LANDING.fields])

    def wire_landing(self) -> DataFrame:
        """conversations -> answers as they come off the wire, without page numbers and request ids:
        page = turn, URL by conversation and turn. Every 6th conversation's second page links to the
        third of the one before (walks meet), every 9th's last page back to its second (a circle),
        every 10th's second page to a page that isn't there, and every 5th's third page fails."""
        cv = self.table("conversations")
        c, t = F.col("conv_id"), F.col("turn")
        cv = cv.join(cv.groupBy("conv_id").agg(F.max("turn").alias("mx")), "conv_id")
        url = lambda conv, turn: F.concat(F.lit("wire/"), conv.cast("string"), F.lit("?page="), turn.cast("string"))
        to = (F.when((c % 10 == 7) & (t == 1), F.lit("wire/gone"))
              .when((c % 6 == 1) & (t == 1), url(c - 1, F.lit(2)))
              .when((c % 9 == 2) & (t == F.col("mx")), url(c, F.least(F.lit(1), t)))
              .when(t < F.col("mx"), url(c, t + 1)))
        link = F.when(t % 2 == 0, J.field("nextLink", J.s(to))).otherwise(J.field("@odata.nextLink", J.s(to)))
        elem = J.obj(J.field("role", J.s(F.col("role"))), J.field("text", J.s(F.col("text"))))
        body = J.obj(J.field("value", J.arr_of(elem)), F.when(to.isNotNull(), link))
        pages = cv.select(
            F.lit(K.OP_LIST_LAKEHOUSES).alias("operation"), F.lit(None).cast("string").alias("request_id"),
            F.concat(F.lit("ws-"), c % 25).alias("workspace_id"),
            *[F.lit(None).cast("string").alias(n) for n in ("item_id", "item_type", "item_name")],
            url(c, t).alias("url"), F.lit(None).cast("string").alias("query"), F.lit(None).cast("int").alias("page_no"),
            body.alias("body"), F.when((c % 5 == 3) & (t == 2), "server_error").when(t % 3 == 1, "retry429").otherwise("ok").alias("pattern"))
        return self._typed(self._landing(pages)).orderBy(F.xxhash64("url", "attempt"))

    def wire_starts(self) -> DataFrame:
        """The first URL of every conversation's request."""
        return self.table("conversations").where("turn = 0").select(
            F.lit(K.OP_LIST_LAKEHOUSES).alias("operation"), F.concat(F.lit("wire|"), F.col("conv_id")).alias("request_id"),
            F.concat(F.lit("wire/"), F.col("conv_id"), F.lit("?page=0")).alias("url"))
