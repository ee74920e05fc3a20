"""Attempt resolution (E1), outcome classification (E2, E3, E6), error rows
and rate-limit waits (E8).

Scale notes. Attempts are resolved by exception, without moving a body. An answer that ends its
page (anything but a retriable 429 or timeout) passes by a filter. Which pages break that rule is
found from the light columns alone (``odd_pages``: one grouped row per page): pages with several
ending answers (an attempt captured twice, answers after the end), pages without a first attempt,
and pages whose attempts were used up. Those are few; their rows are picked by a join on the page.

Everything is keyed by run, so a landing may hold many runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.functions import jsonx as J
from lakecensus.functions.scalars import dax_label, stable_id

ATTEMPT_COLS = [
    "run_id", "operation", "request_id", "workspace_id", "item_id", "item_type", "item_name",
    "url", "query", "page_no", "attempt", "status", "retry_after", "error_kind", "body", "requested_at",
]


def is_dax(op: Column) -> Column:
    return op.isin(*K.DAX_OPERATIONS)


def retriable(status: Column, error_kind: Column, dax: Column) -> Column:
    """GETs retry on 429 and on timeouts; DAX calls never retry."""
    return ~dax & F.coalesce((status == 429) | (error_kind == "timeout"), F.lit(False))


PAGE = ["run_id", "operation", "request_id", "page_no"]


def same(left: str, right: str, columns: list[str]) -> Column:
    """Equality of two aliased frames on columns that may be null."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def counted(landing: DataFrame, max_attempts: int = K.MAX_ATTEMPTS) -> DataFrame:
    """The attempts within the budget, with ``ends``: whether an answer ends its page. DAX calls
    are never retried, so only their first attempt counts."""
    dax = is_dax(F.col("operation"))
    within = F.coalesce(F.col("attempt") == 1, F.lit(False)) | (~F.coalesce(dax, F.lit(False)) & F.col("attempt").between(2, max_attempts))
    ends = ~F.coalesce(retriable(F.col("status"), F.col("error_kind"), F.coalesce(dax, F.lit(False))), F.lit(False))
    return landing.select(*ATTEMPT_COLS, ends.alias("ends")).where(within)


def odd_pages(landing: DataFrame, max_attempts: int = K.MAX_ATTEMPTS) -> DataFrame:
    """Pages that the filter alone doesn't settle: PAGE, ``chosen`` (the attempt that stands; null if
    the first attempt is missing) and ``exhausted``. Reads and shuffles light columns only."""
    pages = counted(landing, max_attempts).groupBy(*PAGE).agg(
        F.count_if("ends").alias("n_ends"),
        F.bool_or(F.col("attempt") == 1).alias("begun"),
        F.min(F.when(F.col("ends"), F.col("attempt"))).alias("first_end"),
        F.max("attempt").alias("last"),
    )
    exhausted = F.col("n_ends") == 0
    return pages.where((F.col("n_ends") > 1) | ~F.col("begun") | exhausted).select(
        *PAGE, F.when(F.col("begun"), F.coalesce("first_end", "last")).alias("chosen"), exhausted.alias("exhausted"))


def resolve_attempts(landing: DataFrame, max_attempts: int = K.MAX_ATTEMPTS, odd: DataFrame | None = None,
                     repeated: bool = True, used_up: bool = True) -> DataFrame:
    """One row per (run, operation, request, page) -- the first ending answer within the
    budget, else the last attempt (``exhausted`` = true, without its body, which nobody reads).
    Of an attempt captured more than once one row stays (the earliest, ties by content).

    ``odd``: ``odd_pages`` as a stored table, so that its size decides how it is joined;
    ``repeated=False`` says that none of them has an ending answer, ``used_up=False`` that none
    is exhausted."""
    attempts = counted(landing, max_attempts)
    out = [*ATTEMPT_COLS, "exhausted", "attempts_used"]

    def done(df: DataFrame, exhausted: bool) -> DataFrame:
        return df.withColumns({"exhausted": F.lit(exhausted), "attempts_used": F.col("attempt")}).select(*out)

    ending = attempts.where("ends").drop("ends")
    if odd is None and (repeated or used_up):
        odd = odd_pages(landing, max_attempts)

    def picked(rows: DataFrame, pages: DataFrame) -> DataFrame:
        """One row of the chosen attempt of each of the pages."""
        mine = rows.alias("a").join(
            pages.alias("o"), same("a", "o", PAGE) & (F.col("a.attempt") == F.col("o.chosen")), "inner").select("a.*")
        order = Window.partitionBy(*PAGE).orderBy(
            F.col("requested_at").asc_nulls_last(), "status", "error_kind", F.xxhash64("body"), "retry_after")
        return mine.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")

    if repeated:
        odd_ends = odd.where(~F.col("exhausted"))
        clean = ending.alias("a").join(odd_ends.alias("o"), same("a", "o", PAGE), "left_anti")
        parts = [done(clean, False), done(picked(ending, odd_ends), False)]
    else:
        parts = [done(ending, False)]
    if used_up:
        bare = attempts.where(~F.col("ends")).drop("ends").withColumn("body", F.lit(None).cast("string"))
        parts.append(done(picked(bare, odd.where("exhausted")), True))
    return reduce(DataFrame.unionByName, parts)


def classify_outcomes(resolved: DataFrame) -> DataFrame:
    """Outcome in {ok, logged, silent}, with the logged status code, the text to
    parse as the error body, and requires_admin. Adds ``v`` (the body as VARIANT) for 200s."""
    resolved = resolved.select("*", F.when(F.col("status") == 200, J.parse("body")).alias("v"))
    dax = is_dax(F.col("operation"))
    st, kind, v = F.col("status"), F.col("error_kind"), F.col("v")
    not_json = (st == 200) & v.isNull()
    json_null = (st == 200) & v.isNotNull() & F.is_variant_null(v)
    exhausted = F.col("exhausted")

    outcome = (
        F.when(exhausted & (kind == "timeout"), "logged")
        .when(exhausted, "silent")  # 429 on the last attempt: no trace
        .when(kind == "exception", "logged")
        .when(dax & (kind == "timeout"), "logged")
        .when(not_json, "logged")
        .when(json_null & ~dax, "silent")
        .when(st == 200, "ok")
        .when(st.isin(401, 403), "logged")
        .when((st == 404) & ~dax, "silent")
        .otherwise("logged")
    )
    code = F.when(
        exhausted | kind.isin("exception", "timeout") | not_json | st.isNull(), F.lit(-1)
    ).otherwise(st).cast("long")
    error_text = (
        F.when(kind == "timeout", F.lit(K.TIMEOUT_MESSAGE))
        .when(kind == "exception", F.coalesce(F.col("body"), F.lit("exception")))
        .when(not_json, F.concat(F.lit("Response body is not valid JSON: "), F.coalesce(F.col("body"), F.lit(""))))
        .otherwise(F.col("body"))
    )
    return resolved.select(
        "*",
        outcome.alias("outcome"),
        code.alias("http_status_code"),
        error_text.alias("error_text"),
        F.coalesce(st == 403, F.lit(False)).alias("requires_admin"),
    )


LIGHT_COLS = ["run_id", "operation", "request_id", "page_no", "workspace_id", "item_id", "item_type", "item_name", "url",
              "query", "outcome", "http_status_code", "error_text", "requires_admin"]


def light_outcomes(resolved: DataFrame, **more: Column) -> DataFrame:
    """Outcomes without bodies: LIGHT_COLS (``error_text`` of logged outcomes alone) and further
    columns made from the parsed body ``v``. A body is parsed once; nothing filters on what came of
    it, as a filter would be pushed below the parse and repeat it."""
    text = F.when(F.col("outcome") == "logged", F.col("error_text")).alias("error_text")
    return classify_outcomes(resolved).select(
        *[text if c == "error_text" else F.col(c) for c in LIGHT_COLS], *[c.alias(n) for n, c in more.items()])


def parse_error_text(text: Column) -> tuple[Column, Column]:
    """(error_code, error_message) from an error body. A JSON object with an ``error``
    object gives its code (default "") and message (default: the raw text); anything else
    gives ("", raw text)."""
    v = J.parse(text)
    err = J.vget(v, "$.error", "variant")
    usable = F.schema_of_variant(v).startswith("OBJECT") & F.schema_of_variant(err).startswith("OBJECT")
    code = F.when(usable, J.get_default(err, "$.code", "")).otherwise(F.lit(""))
    message = F.when(usable, F.coalesce(J.vget(err, "$.message", "string"), text)).otherwise(text)
    return code, F.coalesce(message, F.lit(""))


def error_rows(outcomes: DataFrame, run_ts: Column) -> DataFrame:
    """One meta_access_errors row per logged outcome, from every operation."""
    logged = outcomes.where(F.col("outcome") == "logged")
    code, message = parse_error_text(F.col("error_text"))
    label = F.when(is_dax(F.col("operation")), dax_label(F.col("query"))).otherwise(
        F.coalesce(F.col("operation"), F.col("url"), F.lit(""))
    )
    return logged.select(
        stable_id(F.col("run_id"), F.col("request_id"), F.col("page_no"), F.lit("error")).alias("error_id"),
        F.coalesce("workspace_id", F.lit("")).alias("workspace_id"),
        F.lit("").alias("workspace_name"),
        F.coalesce("item_id", F.lit("")).alias("item_id"),
        F.coalesce("item_type", F.lit("")).alias("item_type"),
        F.coalesce("item_name", F.lit("")).alias("item_name"),
        label.alias("operation"),
        F.col("http_status_code"),
        code.alias("error_code"),
        message.alias("error_message"),
        F.col("requires_admin"),
        run_ts.alias("extracted_at"),
    )


def rate_limit_waits(landing: DataFrame, max_attempts: int = K.MAX_ATTEMPTS) -> DataFrame:
    """Per operation, the 429 answers inside the attempt budget and the seconds waited; an
    attempt captured more than once counts once."""
    waited = landing.where(
        (F.col("status") == 429) & ~is_dax(F.col("operation")) & (F.col("attempt") <= max_attempts)
    ).groupBy(*PAGE, "attempt").agg(F.max(F.coalesce("retry_after", F.lit(K.DEFAULT_RETRY_AFTER_S))).alias("seconds"))
    return waited.groupBy("operation").agg(
        F.count(F.lit(1)).alias("waits"), F.sum("seconds").cast("long").alias("wait_seconds"))
