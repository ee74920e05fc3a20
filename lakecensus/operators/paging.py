"""The capture: resolved outcomes plus page stitching (P1-P4), and typed views per endpoint.

Page stitching keeps, per request, the contiguous prefix of pages that the extractor would have
read: it stops at the first page without a body (earlier pages are kept) and after the first
page without a continuation link. Clean chains -- almost all of them -- pass through a filter
untouched; only "dirty" requests (a failed page, a page after the end, a gap) are cut.

What several tables need is staged once a run, without bodies: the odd pages of attempt
resolution, the light outcomes of each operation (one parse of its bodies), and the chain cuts
made from them. Small staged tables are broadcast when their measured size is under the session's
broadcast threshold; above it the same joins run by a shuffle. Tables read their elements straight
from the resolved bodies, one parse each.
"""

from __future__ import annotations

import uuid
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.functions import jsonx as J
from lakecensus.functions.scalars import stable_id
from lakecensus.operators.joins import broadcast_limit, side
from lakecensus.operators.outcomes import classify_outcomes, light_outcomes, odd_pages, resolve_attempts, same
from lakecensus.session import Staging

# Bytes of (request_id, cut) that may be shipped to every executor; None -> the session's
# spark.sql.autoBroadcastJoinThreshold (10 MB by default).
BROADCAST_CUTS_MAX_BYTES: int | None = None


def _broadcast_limit(spark) -> int:
    return broadcast_limit(spark) if BROADCAST_CUTS_MAX_BYTES is None else BROADCAST_CUTS_MAX_BYTES


CONTEXT = ["run_id", "operation", "request_id", "workspace_id", "item_id", "item_type", "item_name"]
CHAIN = ["run_id", "operation", "request_id"]


def broadcast_width() -> Column:
    """Bytes that a row of pages or chain cuts takes in a broadcast, which holds its key and the row."""
    return sum((F.coalesce(F.length(c), F.lit(0)) for c in CHAIN), F.lit(80)) * 2


def has_next_link(v: Column) -> Column:
    """``data.get("nextLink") or data.get("@odata.nextLink")`` is truthy."""
    return J.truthy(v, "$.nextLink") | J.truthy(v, '$["@odata.nextLink"]')


def light_pages(light: DataFrame) -> DataFrame:
    """(CHAIN, page_no, ok, has_next) of the pages of paged endpoints."""
    return light.where(F.col("operation").isin(*K.PAGED_OPERATIONS)).select(
        *CHAIN, "page_no", (F.col("outcome") == "ok").alias("ok"), F.coalesce("has_next", F.lit(False)).alias("has_next"))


def chain_summary(pages: DataFrame) -> DataFrame:
    """One row per request: first failed page, last answered one, first page without a link, lowest and
    highest page, page count (partial aggregation: a request with millions of pages is no hot spot)."""
    return pages.groupBy(*CHAIN).agg(
        F.min(F.when(~F.col("ok"), F.col("page_no"))).alias("first_bad"),
        F.max(F.when(F.col("ok"), F.col("page_no"))).alias("last_ok"),
        F.min(F.when(F.col("ok") & ~F.col("has_next"), F.col("page_no"))).alias("first_end"),
        F.min("page_no").alias("lo"),
        F.max("page_no").alias("hi"),
        F.count(F.lit(1)).alias("n"),
    )


def gapped(summary: DataFrame) -> DataFrame:
    """Requests whose page numbers are not exactly 0..hi."""
    return summary.where((F.col("lo") != 0) | (F.col("n") != F.col("hi") + 1)).select(*CHAIN, "lo")


def gap_holes(pages: DataFrame, gaps: DataFrame) -> DataFrame:
    """(CHAIN, first_missing) for gapped requests: page p present and p + 1 absent."""
    keys = pages.select(*CHAIN, "page_no").join(gaps.select(*CHAIN), CHAIN, "left_semi")
    nxt = keys.select(*CHAIN, (F.col("page_no") - 1).alias("page_no"))
    holes = (
        keys.join(nxt, [*CHAIN, "page_no"], "left_anti")
        .groupBy(*CHAIN)
        .agg((F.min("page_no") + 1).alias("first_missing"))
    )
    return gaps.join(holes, CHAIN, "left").select(
        *CHAIN, F.when(F.col("lo") != 0, F.lit(0)).otherwise(F.col("first_missing")).alias("first_missing")
    )


def cuts_from(summary: DataFrame, holes: DataFrame | None = None, end: str = "hi") -> DataFrame:
    """(CHAIN, cut) for the requests whose chain must be cut; cut = last page kept (-1 = none).
    ``end="last_ok"`` lists those alone that have an answer behind the cut: others lose nothing by it."""
    s = summary if holes is None else summary.join(holes, CHAIN, "left")
    missing = F.col("first_missing") if holes is not None else F.lit(None).cast("long")
    cut = F.least(
        F.coalesce(F.col("first_bad") - 1, F.col("hi")),
        F.coalesce(F.col("first_end"), F.col("hi")),
        F.coalesce(missing - 1, F.col("hi")),
    )
    return s.select(*CHAIN, end, cut.alias("cut")).where(F.col("cut") < F.col(end)).select(*CHAIN, "cut")


def chain_cuts(light: DataFrame) -> DataFrame:
    """All of the above as one plan (for reports over small captures; ``Capture`` stages it)."""
    pages = light_pages(light)
    summary = chain_summary(pages)
    return cuts_from(summary, gap_holes(pages, gapped(summary)))


def chain_audit(cap: "Capture", operation: str) -> DataFrame:
    """Per chain of an operation, pages captured and read, and whether a failed page ended it."""
    out = cap.light(operation)
    cuts = chain_cuts(out)
    summary = out.groupBy(*CHAIN).agg(
        F.count(F.lit(1)).alias("pages_captured"),
        F.min(F.when(F.col("outcome") != "ok", F.col("page_no"))).alias("_bad"),
    )
    kept = out.join(cuts, CHAIN, "left").where((F.col("outcome") == "ok") & (F.col("cut").isNull() | (F.col("page_no") <= F.col("cut"))))
    read = kept.groupBy(*CHAIN).agg(F.count(F.lit(1)).alias("pages_read"))
    by_error = (F.col("_bad") - 1) == F.coalesce(F.col("cut"), F.col("_bad") - 1)
    return summary.join(cuts, CHAIN, "left").join(read, CHAIN, "left").select(
        *CHAIN, "pages_captured", F.coalesce("pages_read", F.lit(0)).alias("pages_read"),
        F.coalesce(by_error, F.lit(False)).alias("ended_by_error"))


class Capture:
    """The responses of a landing, resolved and ready to be read per endpoint. ``run_id`` reads
    one run of a landing that holds several."""

    def __init__(self, landing: DataFrame, run_ts: Column | str, max_attempts: int = K.MAX_ATTEMPTS,
                 run_id: str | None = None):
        self.landing = landing if run_id is None else landing.where(F.col("run_id") == run_id)
        self.spark = landing.sparkSession
        self.run_ts = F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts
        self.max_attempts = max_attempts
        self._light: dict[str | None, DataFrame] = {}
        self._cut_cache: dict[str, DataFrame | None] = {}
        self._asked: dict[str, DataFrame] = {}

    @cached_property
    def staging(self) -> Staging:
        return Staging(self.spark)

    def _sized(self, table: DataFrame, size: int | None) -> DataFrame:
        return side(table, (size or 0) <= _broadcast_limit(self.spark))

    @cached_property
    def _odd(self) -> tuple[DataFrame, dict, dict]:
        """The odd pages, staged and measured; of which kinds there are any; the runs of the landing."""
        runs = Observation(f"runs_{uuid.uuid4().hex}")
        seen = self.landing.observe(runs, F.min("run_id").alias("first"), F.max("run_id").alias("last"))
        odd, size = self.staging.put(
            "odd", odd_pages(seen, self.max_attempts), rows=F.count(F.lit(1)), used_up=F.count_if("exhausted"),
            bytes=F.sum(broadcast_width()))
        kinds = {"repeated": size["rows"] > size["used_up"], "used_up": size["used_up"] > 0}
        return self._sized(odd, size["bytes"]), kinds, runs.get

    @property
    def run_ids(self) -> dict:
        """The first and the last run of the landing, by name."""
        return self._odd[2]

    def one_run(self) -> "Capture":
        """Refuse a landing of several runs: the tables of a run can't be told apart in it."""
        runs = self.run_ids
        if runs["first"] != runs["last"]:
            raise ValueError(f"the landing holds runs {runs['first']!r} to {runs['last']!r}: choose one with run_id")
        return self

    @cached_property
    def resolved(self) -> DataFrame:
        odd, kinds, _ = self._odd
        return resolve_attempts(self.landing, self.max_attempts, odd, **kinds)

    @cached_property
    def outcomes(self) -> DataFrame:
        """One row per page with outcome ok / logged / silent, and the body."""
        return classify_outcomes(self.resolved)

    def light(self, *operations: str) -> DataFrame:
        """Outcomes without bodies (LIGHT_COLS, ``has_next``, ``has_items``) of the operations, or of all:
        staged, each operation once a run."""
        paged = F.col("operation").isin(*K.PAGED_OPERATIONS)
        next_link = F.when(paged, has_next_link(F.col("v")))
        items = F.when(paged, J.present(F.col("v"), "$.value[0]"))
        known = [op for op in self._light if op is not None]
        if operations:
            missing = [op for op in dict.fromkeys(operations) if op not in self._light and None not in self._light]
            rows = self.resolved.where(F.col("operation").isin(*missing)) if missing else None
        else:
            missing = [] if None in self._light else [None]
            rows = self.resolved.where(~F.coalesce(F.col("operation").isin(*known), F.lit(False))) if known else self.resolved
        if missing:
            table, _ = self.staging.put("light", light_outcomes(rows, has_next=next_link, has_items=items))
            for op in missing:
                self._light[op] = table
        tables = {id(t): t for op, t in self._light.items() if not operations or op in operations or op is None}
        every = reduce(DataFrame.unionByName, tables.values())
        return every.where(F.col("operation").isin(*operations)) if operations else every

    def warm(self, operations=K.PAGED_OPERATIONS) -> "Capture":
        """Compute the chain cuts of several paged endpoints in one job, so that a plan reading
        several listings pays for one pass, not one each; and which workspaces they have elements of.
        An endpoint joins its own cuts alone, and only those with an answer behind them, so a listing
        that most workspaces refuse doesn't make the bodies of all listings move."""
        missing = [op for op in dict.fromkeys(operations) if op in K.PAGED_OPERATIONS and op not in self._cut_cache]
        if missing:
            light = self.light(*missing)
            pages = light_pages(light)
            asked, _ = self.staging.put("asked", light.where("has_items").select("operation", "workspace_id").distinct())
            # one row per request that isn't plainly 0..hi, all of them read, ending at hi
            plain = ((F.col("lo") == 0) & (F.col("n") == F.col("hi") + 1) & F.col("first_bad").isNull()
                     & (F.coalesce("first_end", "hi") == F.col("hi")))
            odd, n = self.staging.put("chains", chain_summary(pages).where(~plain), rows=F.count(F.lit(1)),
                                      gaps=F.count_if((F.col("lo") != 0) | (F.col("n") != F.col("hi") + 1)))
            cuts, size = None, {}
            if n["rows"]:
                holes = gap_holes(pages, gapped(odd)) if n["gaps"] else None
                cuts, size = self.staging.put("cuts", cuts_from(odd, holes, "last_ok"), **{
                    op: F.sum(F.when(F.col("operation") == op, broadcast_width())) for op in missing})
            for op in missing:
                self._asked[op] = asked.where(F.col("operation") == op).select("workspace_id")
                mine = cuts.where(F.col("operation") == op) if size.get(op) else None
                self._cut_cache[op] = None if mine is None else self._sized(mine, size[op])
        return self

    def bodies(self, operation: str, paged: bool | None = None) -> DataFrame:
        """Resolved rows of one endpoint with an answer that was read (200), after stitching. The
        body may still be no JSON: then it has no elements and no object."""
        if paged is None:
            paged = operation in K.PAGED_OPERATIONS
        kind = F.coalesce(F.col("error_kind"), F.lit(""))
        dax = operation in K.DAX_OPERATIONS
        ok = self.resolved.where(
            (F.col("operation") == operation) & (F.col("status") == 200) & ~F.col("exhausted")
            & ~kind.isin("exception", *(["timeout"] if dax else [])))
        if not paged:
            return ok.where(F.col("page_no") == 0)
        self.warm((operation,))
        cuts = self._cut_cache[operation]
        if cuts is None:
            return ok
        return ok.alias("p").join(
            cuts.alias("c"), same("p", "c", CHAIN) & (F.col("p.page_no") > F.col("c.cut")), "left_anti")

    def pages(self, operation: str, paged: bool | None = None) -> DataFrame:
        """OK pages of one endpoint, after stitching; ``v`` is the parsed body."""
        v = F.filter(F.array(J.parse("body")), lambda x: x.isNotNull() & ~F.is_variant_null(x))
        return self.bodies(operation, paged).select("*", F.explode(v).alias("v"))

    def elements(self, operation: str, value_key: str = "value", paged: bool | None = None) -> DataFrame:
        """One row per element of the page array, with request context, page_no, pos,
        a stable element id (``eid``) and the element ``e`` as VARIANT. One parse a body: what is
        no JSON, or null, has no elements, so nothing needs to be filtered before."""
        path = "$." + value_key if value_key.isidentifier() else f'$["{value_key}"]'
        exploded = self.bodies(operation, paged).select(
            *CONTEXT, "page_no", F.posexplode(J.vget(J.parse("body"), path, "array<variant>")).alias("pos", "e"))
        return exploded.withColumn(
            "eid", stable_id(F.col("run_id"), F.col("request_id"), F.col("page_no"), F.col("pos")))

    def objects(self, operation: str) -> DataFrame:
        """Single-object endpoints: the body itself as ``e`` (one row per request)."""
        return self.pages(operation, paged=False).select(*CONTEXT, "page_no", F.col("v").alias("e"))

    def dax_rows(self, operation: str) -> DataFrame:
        """Rows in the answers of a DAX call, with request context."""
        from lakecensus.operators.powerquery import read_dax_rows

        return read_dax_rows(self.bodies(operation))

    def asked(self, operation: str) -> DataFrame:
        """The workspaces that a listing has elements of, each once."""
        return self.warm((operation,))._asked[operation]

    def outcomes_of(self, operation: str) -> DataFrame:
        """Page-0 light outcome per request (for joins that need to know 'no body')."""
        return self.light(operation).where(F.col("page_no") == 0)

    def clean(self) -> None:
        """Delete what the run has staged, once its results are written."""
        self.staging.clean()
        self._light.clear()
        self._cut_cache.clear()
        self._asked.clear()
        for name in ("staging", "_odd", "resolved", "outcomes"):
            self.__dict__.pop(name, None)
