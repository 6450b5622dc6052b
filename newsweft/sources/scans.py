"""Scans of paged, dated and structured payloads."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sites
from ..functions.dom import parse
from ..functions.text import nz


def until_empty(pages: DataFrame, base: str, page: str, empty: Column) -> DataFrame:
    """Pages of each base before its first empty one."""
    end = pages.filter(empty).groupBy(base).agg(F.min(page).alias("_end"))
    return pages.join(end, base, "left").filter(F.col("_end").isNull() | (F.col(page) < F.col("_end"))).drop("_end")


def on_day(entries: DataFrame, date: str, day: str) -> DataFrame:
    """Entries of one day. Lists that fall in date are read no further by a fetcher; here the day alone decides."""
    return entries.filter(F.col(date) == F.lit(day).cast("date"))


def json_pages(pages: DataFrame, item: str, size: int) -> DataFrame:
    """Items of ``{"items": [..]}`` pages of ``size``, with their ordinal by offset; a page that is no JSON ends its base."""
    j = pages.withColumn("_i", F.when(F.try_parse_json("body").isNotNull(), F.from_json("body", f"items array<struct<{item.replace(' ', ':')}>>")["items"]))
    read = until_empty(j, "base", "page", F.col("_i").isNull())
    return read.select("base", "page", F.posexplode("_i").alias("_p", "_x")).select("base", "page", ((F.col("page") - 1) * size + F.col("_p")).cast("long").alias("ordinal"), "_x.*")


def links_in(html: Column, scope: str) -> Column:
    """Distinct links inside elements of a scope, in order."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: list(dict.fromkeys(a.attrs["href"] for n in parse(x).find(scope) for a in n.find("a[href]"))))

    return run(html)


_LINKED = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "headline", "published", "description")]))


def linked_data(pages: DataFrame, html: str) -> DataFrame:
    """A row for each article node of a page's linked data; pages without any give none."""

    @F.pandas_udf(_LINKED)
    def run(s: pd.Series) -> pd.Series:
        pick = lambda x, k: None if x.get(k) is None else str(x[k])
        return s.map(lambda x: [{"kind": str(n.get("@type")), "headline": pick(n, "headline"), "published": pick(n, "datePublished"), "description": pick(n, "description")} for n in sites.jsonld(parse(x))])

    rest = [c for c in pages.columns if c != html]
    return pages.withColumn("_n", F.explode(run(F.col(html)))).select(*rest, "_n.*")


def dated_urls(days: DataFrame, base: str, end: str, day: str = "day") -> DataFrame:
    """``day, url``: every spelling of a date as ``9-May-2026`` in an address: day and year with and without padding, month in both cases."""
    d = F.col(day)
    parts = [(F.dayofmonth(d).cast("string"), F.date_format(d, "dd")), (F.lower(F.date_format(d, "MMM")), F.date_format(d, "MMM")), (F.date_format(d, "yyyy"), F.date_format(d, "yy"))]
    forms = [F.concat(F.lit(base), a, F.lit("-"), b, F.lit("-"), c, F.lit(end)) for a in parts[0] for b in parts[1] for c in parts[2]]
    return days.select(day, F.explode(F.array_distinct(F.array(*forms))).alias("url"))


def first_body(tries: DataFrame, key: str) -> DataFrame:
    """``key, body``: the first attempt whose body is not blank; blank where none is."""
    body = nz(F.col("body"))
    return tries.groupBy(key).agg(F.coalesce(F.min_by(body, F.when(body.isNotNull(), F.col("attempt"))), F.lit("")).alias("body"))


def with_oembed(articles: DataFrame, oembed: DataFrame) -> DataFrame:
    """Titles from oEmbed answers where the article has none."""
    o = oembed.select("url", F.get_json_object("body", "$.title").alias("_o"))
    return articles.join(o, "url", "left").withColumn("title", F.coalesce(nz(F.col("title")), nz(F.col("_o")))).drop("_o")


def refill(rows: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Rows without a body take body, title and date of a second source; the others stay as they are."""
    s = second.select(key, *[F.col(c).alias(f"_s_{c}") for c in ("title", "date", "body")])
    blank = nz(F.col("body")).isNull() & nz(F.col("_s_body")).isNotNull()
    j = rows.join(s, key, "left")
    return j.select(*[F.when(blank, F.coalesce(F.col(f"_s_{c}"), F.col(c))).otherwise(F.col(c)).alias(c) if c in ("title", "date", "body") else F.col(c) for c in rows.columns])
