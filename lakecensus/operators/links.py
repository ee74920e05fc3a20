"""Page stitching by following links (P1, P2): a capture as it comes off the wire has the URL of
every answer and, in a body, the URL of the next page, but no page numbers.

The extractor walks from a request's first URL from link to link until a page has no link, fails,
or isn't there. Here all walks are taken at once by pointer doubling: round k knows each page's
2^k-th successor and each walk's first 2^k pages, and appends to every walk the successors of the
pages it has. Rounds grow with the logarithm of the longest walk; each is two equi-joins and one
aggregation, staged, so a lost executor repeats one round at most.

Walks may share pages (two requests may link to one) and then each has them. A link back to a page
of the same walk ends it there, where the extractor would go round for ever: a page counts at its
first place in a walk, and a round that brings no walk a new page is the last. Dropping a second
visit never drops what comes after it, as the first visit has the same successors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.functions import jsonx as J
from lakecensus.operators.outcomes import ATTEMPT_COLS, light_outcomes, resolve_attempts, same
from lakecensus.session import Staging

PLACE = ["run_id", "operation", "url"]  # a page of a capture without page numbers


def next_url(v):
    """The link that the extractor follows: the first truthy of the two."""
    return J.first_truthy(v, ["$.nextLink", '$["@odata.nextLink"]'], None)


def walks(starts: DataFrame, links: DataFrame, staging: Staging) -> DataFrame:
    """(start, node, position): all pages of the walk from every start, in order from 0.

    ``starts``: start (any id), node. ``links``: node, next; one row per page that exists, next null
    at an end. Nodes and starts may be any type; a next that is no node ends the walk, a start at
    no node has no page."""
    nodes = links.groupBy("node").agg(F.min("next").alias("next"))  # one link a page
    real = nodes.join(nodes.select(F.col("node").alias("next")), "next", "left_semi").select("node", F.col("next").alias("to"))
    path, _ = staging.put("walk", starts.select("start", "node").distinct().join(nodes.select("node"), "node", "left_semi").select(
        "start", "node", F.lit(0).cast("long").alias("position")))
    jump, _ = staging.put("jump", real)
    step, pages = 1, path.count()
    while True:
        ahead = path.join(jump, "node").select("start", F.col("to").alias("node"), (F.col("position") + step).alias("position"))
        path, n = staging.put("walk", path.unionByName(ahead).groupBy("start", "node").agg(F.min("position").alias("position")),
                              rows=F.count(F.lit(1)))
        if n["rows"] == pages:
            return path
        pages, step = n["rows"], 2 * step
        further = jump.select(F.col("node").alias("to"), F.col("to").alias("further"))
        jump, _ = staging.put("jump", jump.join(further, "to").select("node", F.col("further").alias("to")))


def first_urls(planned: DataFrame) -> DataFrame:
    """(operation, request_id, url) of planned requests, to start their walks from."""
    return planned.select("operation", "request_id", "url")


def number_pages(landing: DataFrame, starts: DataFrame, staging: Staging | None = None,
                 max_attempts: int = K.MAX_ATTEMPTS) -> DataFrame:
    """The landing with ``request_id`` and ``page_no`` as the walks from ``starts`` (operation,
    request_id, url) give them, ready for a ``Capture``. What no walk reaches is left out; a page
    that several walks reach is there for each. Page numbers and request ids of the landing are
    not read; operations without pages have page 0 alone."""
    staging = staging or Staging(landing.sparkSession)
    bare = landing.select(*[F.lit(None).cast(landing.schema[c].dataType).alias(c) if c in ("request_id",)
                            else F.lit(0).cast("int").alias(c) if c == "page_no" else F.col(c) for c in ATTEMPT_COLS])
    # attempts are those of a URL: it stands for the request until the walks are known
    by_url = bare.withColumn("request_id", F.col("url"))
    paged = F.col("operation").isin(*K.PAGED_OPERATIONS)
    links, _ = staging.put("links", light_outcomes(
        resolve_attempts(by_url, max_attempts), next=F.when(paged, next_url(F.col("v")))).select(
            *PLACE, F.when(F.col("outcome") == "ok", F.col("next")).alias("next")))
    node = lambda url: F.struct("run_id", "operation", F.col(url).alias("url"))
    runs = links.select("run_id").distinct()
    found = walks(
        starts.crossJoin(F.broadcast(runs)).select(F.struct("run_id", "operation", "request_id").alias("start"), node("url").alias("node")),
        links.select(node("url").alias("node"), F.when(F.col("next").isNotNull(), node("next")).alias("next")), staging)
    places = found.select("node.*", F.col("start.request_id").alias("_request"), F.col("position").cast("int").alias("_page"))
    return bare.alias("a").join(places.alias("w"), same("a", "w", PLACE)).select(
        *[F.col("w._request").alias(c) if c == "request_id" else F.col("w._page").alias(c) if c == "page_no" else F.col(f"a.{c}")
          for c in ATTEMPT_COLS])
