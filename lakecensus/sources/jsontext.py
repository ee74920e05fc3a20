"""Building JSON text with built-in expressions (used to emulate captured bodies).

A field whose value column is NULL is *omitted* (a missing key); use ``null()`` for an
explicit JSON null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def null() -> Column:
    return F.lit("null")


def s(c: Column) -> Column:
    """JSON string literal of a string column (escaped); NULL -> NULL (omitted)."""
    return F.when(c.isNotNull(), F.regexp_replace(F.to_json(F.array(c.cast("string"))), r"^\[|\]$", ""))


def lit_s(text: str) -> Column:
    return s(F.lit(text))


def num(c: Column) -> Column:
    return c.cast("string")


def boolean(c: Column) -> Column:
    return F.when(c, F.lit("true")).when(~c, F.lit("false"))


def field(name: str, json_value: Column) -> Column:
    return F.when(json_value.isNotNull(), F.concat(F.lit('"' + name + '":'), json_value))


def obj(*fields: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def arr(json_items: Column) -> Column:
    """JSON array from an array<string> of JSON texts."""
    return F.concat(F.lit("["), F.array_join(json_items, ","), F.lit("]"))


def arr_of(*json_values: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *json_values), F.lit("]"))


def iso(ts: Column, suffix: str = "Z") -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(suffix))
