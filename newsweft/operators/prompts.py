"""Texts for a model, put together from tables; their wording is a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import glossary_matches


def rules(articles: DataFrame, glossary: DataFrame, key: str, title_head: str = "title:", body_head: str = "body:", arrow: str = "=>") -> DataFrame:
    """``key, rules``: a line for each term that a title or body has, under a heading each; blank without any."""

    def lines(text: str, ja: str) -> DataFrame:
        t = articles.select(key, F.coalesce(text, F.lit("")).alias("_t"))
        found = glossary_matches(t, glossary, "_t").filter(F.coalesce(ja, F.lit("")) != "")
        term = F.when(F.coalesce("mm", F.lit("")) != "", F.col("mm")).otherwise(F.col("en"))
        line = F.concat(F.lit("- "), term, F.lit(f" {arrow} "), F.col(ja))
        order = F.array_sort(F.collect_set(F.struct(F.coalesce("en", F.lit("")).alias("en"), line.alias("l"))))
        return found.groupBy(key).agg(F.array_join(order["l"], "\n").alias(f"_{text}"))

    j = articles.join(lines("title", "title_ja"), key, "left").join(lines("body", "body_ja"), key, "left")
    part = lambda head, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(head + "\n"), c))
    return j.withColumn("rules", F.concat_ws("\n", part(title_head, "_title"), part(body_head, "_body"))).drop("_title", "_body")


def filled(template: str, fields: dict[str, Column]) -> Column:
    """A template with ``{name}`` places, filled by columns; null counts as blank."""
    out = F.lit(template)
    for name, c in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(c.cast("string"), F.lit("")))
    return out
