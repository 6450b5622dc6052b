"""JSON in model and API responses, often fenced or wrapped in prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unfenced(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, r"(?s)^\s*```[A-Za-z]*\s*", ""), r"(?s)\s*```\s*$", "")


def lenient(s: Column, schema: str) -> Column:
    """The whole text as JSON, else its outermost braces; null where neither parses."""
    s = unfenced(s)
    whole = F.when(F.try_parse_json(s).isNotNull(), F.from_json(s, schema))
    inner = F.regexp_extract(s, r"(?s)(\{.*\})", 1)
    return F.coalesce(whole, F.when(F.try_parse_json(inner).isNotNull(), F.from_json(inner, schema)))


def first_of(s: Column, *paths: str) -> Column:
    """The first of several spellings of a field."""
    return F.coalesce(*[F.get_json_object(s, p) for p in paths])


def texts(values: Column, most: int, length: int) -> Column:
    """At most ``most`` non-blank texts, each cut to ``length``."""
    kept = F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    return F.transform(F.slice(kept, 1, most), lambda x: F.substring(x, 1, length))


def by_position(results: Column, n: Column) -> Column:
    """``array<struct<i, ja>>`` to texts by position 0..n-1; what is missing is empty."""
    found = F.map_from_entries(F.filter(F.transform(results, lambda r: F.struct(r["i"].alias("key"), r["ja"].alias("value"))), lambda r: r["key"].isNotNull()))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.try_element_at(found, i), F.lit("")))).otherwise(F.array().cast("array<string>"))
