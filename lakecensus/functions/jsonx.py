"""JSON access with the extractor's null rules, over VARIANT values.

Three different "defaults" exist in the extractor and are easy to confuse:

* ``get_default``  -- ``d.get(k, dflt)``: default only when the key is *missing*; an explicit
  JSON null stays NULL.
* ``get_or``       -- ``d.get(k) or dflt``: default for every falsy value (null, missing,
  ``false``, ``0``, ``""``, ``[]``, ``{}``).
* ``truthy``       -- Python ``bool()`` of the JSON value; the string ``"false"`` is true.

Paths are JSON paths (``$.a.b``; quote odd keys: ``$["@odata.nextLink"]``). A missing
intermediate object counts as missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse(body: ColumnOrName) -> Column:
    """Raw text -> VARIANT; NULL when the text is not JSON."""
    return F.try_parse_json(_c(body))


def vget(v: ColumnOrName, path: str, type_: str = "string") -> Column:
    return F.try_variant_get(_c(v), path, type_)


def present(v: ColumnOrName, path: str) -> Column:
    """True when the key exists, even if its value is JSON null."""
    return vget(v, path, "variant").isNotNull()


def truthy_value(x: Column) -> Column:
    """Python truthiness of one VARIANT value (SQL NULL = missing = false)."""
    kind = F.schema_of_variant(x)
    return (
        F.when(x.isNull() | F.is_variant_null(x), F.lit(False))
        .when(kind == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))
        .when(kind == "STRING", F.length(F.try_variant_get(x, "$", "string")) > 0)
        .when(kind.startswith("ARRAY"), F.to_json(x) != "[]")
        .when(kind.startswith("OBJECT"), F.to_json(x) != "{}")
        .otherwise(F.coalesce(F.try_variant_get(x, "$", "double") != 0, F.lit(True)))
    )


def truthy(v: ColumnOrName, path: str) -> Column:
    return truthy_value(vget(v, path, "variant"))


def get_default(v: ColumnOrName, path: str, default: str | None = "") -> Column:
    return F.when(~present(v, path), F.lit(default)).otherwise(vget(v, path, "string"))


def get_or(v: ColumnOrName, path: str, default: str | None = "") -> Column:
    return F.when(truthy(v, path), vget(v, path, "string")).otherwise(F.lit(default))


def first_truthy(v: ColumnOrName, paths: Sequence[str], default: str | None = "") -> Column:
    """``a or b or c or default`` over several paths."""
    return F.coalesce(*[F.when(truthy(v, p), vget(v, p, "string")) for p in paths], F.lit(default))


def text_or(s: Column, default: str = "") -> Column:
    """``s or default`` for a column already known to be a string."""
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default))


def array_csv(v: ColumnOrName, path: str) -> Column:
    """``",".join(d.get(k, []))``; a missing or null array gives ``""``."""
    return F.coalesce(F.array_join(vget(v, path, "array<string>"), ","), F.lit(""))


def dynamic_member(v: ColumnOrName, key: Column) -> Column:
    """``d.get(key, {}) or {}`` with a key taken from the data (exact case).

    The object is cast to a map so that key text is never spliced into a path string.
    A missing or non-object member gives NULL, which every getter treats as missing.
    """
    member = F.try_element_at(vget(v, "$", "map<string,variant>"), key)
    return F.when(F.schema_of_variant(member).startswith("OBJECT"), member)


def json_or_empty(text: Column) -> Column:
    """Tolerant parse of JSON embedded in a string: falsy or malformed -> NULL (read as {})."""
    return F.when(F.length(text) > 0, F.try_parse_json(text))
