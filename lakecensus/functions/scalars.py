"""Scalar helpers: timestamps, code labels, DAX column names, ids, URL families."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakecensus.functions import constants as K
from lakecensus.functions import isotime


def parse_ts(s: Column) -> Column:
    """Falsy -> NULL; strip; every 'Z' -> '+00:00'; ISO-8601 -> timestamp; failure -> NULL.

    Naive values are UTC (the session time zone, which ``configure`` pins)."""
    # bound in a lambda, so that the text is made once however often the grammar looks at it
    text = F.replace(isotime.strip(s), F.lit("Z"), F.lit("+00:00"))
    return F.get(F.transform(F.array(text), isotime.parse), F.lit(0))


def _label(code: Column, mapping: dict[int, str]) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit("Unknown"))


def partition_type_label(code: Column) -> Column:
    return _label(code, K.PARTITION_TYPE_LABELS)


def storage_mode_label(code: Column) -> Column:
    return _label(code, K.STORAGE_MODE_LABELS)


def strip_bracket_name(key: Column) -> Column:
    """'[C]' and '[T].[C]' -> 'C': trim, drop one leading '[' and one trailing ']',
    keep what follows the last '].['."""
    inner = F.regexp_replace(F.regexp_replace(isotime.strip(key), r"^\[", ""), r"\]\z", "")
    return F.element_at(F.split(inner, r"\]\.\["), -1)


def stable_id(*parts: Column) -> Column:
    """Surrogate id: a hash of the row's position in the capture, stable under task retry."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def api_family(url: Column) -> Column:
    return F.when(url.contains(K.WORKSPACE_API_HOST), F.lit("fabric")).otherwise(F.lit("pbi"))


def dax_label(query: Column) -> Column:
    return F.concat(F.lit(K.DAX_LABEL_PREFIX), F.substring(query, 1, K.DAX_LABEL_CHARS))
