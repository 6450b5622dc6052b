"""First-wins deduplication. ``order`` columns make "first" well defined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: Column, order: list[str], keep_blank: bool = True) -> DataFrame:
    """One row a key, the first by ``order``; blank keys are a key of their own, or dropped.

    A struct minimum, summed up before the shuffle: a hot key sends one row a task.
    """
    cols = df.columns
    k = F.coalesce(key, F.lit(""))
    keyed = df.withColumn("_k", k) if keep_blank else df.withColumn("_k", k).filter("_k <> ''")
    lead = [c for c in order if c in cols]
    rest = [c for c in cols if c not in lead]
    return keyed.groupBy("_k").agg(F.min(F.struct(*lead, *rest)).alias("r")).select(*[F.col("r")[c].alias(c) for c in cols])


def collapse_runs(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Drop rows whose value equals that of the row before."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_p", F.lag(value).over(w)).filter(~F.col(value).eqNullSafe(F.col("_p")) | F.col("_p").isNull()).drop("_p")


def identity_key(url: Column, q: Column, title_key: Column, row: Column | None = None) -> Column:
    """What ties an article to its manual ranking: url, else the duplicate key, else 180 characters of title; without any, its row alone."""
    return F.when(url != "", F.concat(F.lit("url:"), url)).when(q != "", F.concat(F.lit("q:"), q)).when(
        title_key != "", F.concat(F.lit("title:"), F.substring(title_key, 1, 180))).otherwise(F.lit("") if row is None else F.concat(F.lit("row:"), row.cast("string")))
