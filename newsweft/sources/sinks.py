"""Sinks: bundles, CSV with a byte-order mark, sheets of rows, day overwrites, digest mails, logs and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_local_date
from ..functions.text import nfc, nz
from ..operators.cutting import greedy_chunks

#: Columns of the exports and their order, rows and bytes of one write.
EXPORT = {"メディア名": "source", "日本語タイトル": "title_ja", "発行日": "date", "URL": "url"}
DAILY_EXPORT = {"発行日": "date", "メディア名": "source", "日本語タイトル": "title_ja", "URL": "url"}
CHUNK_ROWS, CHUNK_BYTES = 25, 1_800_000
#: Subjects of a digest, its limits, tiers that take limited articles, and what marks those.
SUBJECT_ALL, SUBJECT_REGION, SUBJECT_NONE, MORE, LIMITED = "【{brand} {day}】", "エーヤワディ関連記事", "ヘッドライン", "　他", "Businessプラン限定"
FULL_TIERS = ["BUSINESS", "TRIAL"]
HEADLINES = "本日のヘッドライン"


def write_bundle(parts: dict[str, DataFrame], folder: str) -> None:
    for name, df in parts.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that spreadsheet programs take as UTF-8: the mark stands before the first header."""
    first, *rest = df.columns
    df.select(F.col(first).alias("﻿" + first), *rest).write.mode("overwrite").option("header", True).csv(path)


def export(articles: DataFrame, columns: dict[str, str] = EXPORT) -> DataFrame:
    """Articles under export headings: days instead of times, NFC, the original title where there is no translation."""
    title = nfc(F.coalesce(nz(F.col("title_ja")), F.col("title"), F.lit("")))
    day = F.when(F.contains("date", F.lit("T")), F.coalesce(iso_local_date(F.col("date")).cast("string"), F.col("date"))).otherwise(F.coalesce("date", F.lit("")))
    of = {"source": nfc(F.coalesce("source", F.lit(""))), "title_ja": title, "date": day, "url": F.coalesce("url", F.lit(""))}
    return articles.select(*[of[c].alias(n) for n, c in columns.items()])


def append_rows(existing: DataFrame, new: DataFrame, path: str) -> None:
    """Rows behind the existing ones. A sheet that counts filled first cells overwrites rows behind a gap; a table has no such gap."""
    new.select(*existing.columns).write.mode("append").parquet(path)


def start_row(existing: DataFrame, first: str) -> DataFrame:
    """Where a sheet would go on: two and as many as there are filled first cells."""
    return existing.agg((2 + F.count_if(F.trim(F.coalesce(first, F.lit(""))) != "")).alias("start"))


def rows_of_day(rows: DataFrame, day_col: str, day: str, keep: list[str], reset: list[str]) -> DataFrame:
    """Only the rows of a day, of which the ``keep`` columns stay, ``reset`` ones are blank and others go blank too."""
    own = rows.filter(F.trim(day_col) == day)
    return own.select(*[F.col(c) if c in keep and c not in reset else F.lit("").alias(c) for c in rows.columns])


def json_bytes(values: Column) -> Column:
    """Bytes of an array of texts as JSON with blanks behind commas."""
    return F.octet_length(F.to_json(values)) + F.greatest(F.size(values) - 1, F.lit(0))


def write_plan(rows: DataFrame, order: str, cells: list[str], most_rows: int = CHUNK_ROWS, most_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``chunk, first, n, bytes`` of the writes of a sheet, whose first data row is 2."""
    sized = rows.select(F.lit(0).alias("sheet"), F.col(order).cast("long").alias("row"), json_bytes(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cells])).cast("long").alias("bytes"))
    c = greedy_chunks(sized, ["sheet"], ["row"], "bytes", most_rows, most_bytes)
    return c.groupBy("chunk").agg((F.min("row") + 1).alias("first"), F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))


def overwrite_days(df: DataFrame, path: str, day: str) -> None:
    """Replace only the days that ``df`` has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def write_cache(entries: DataFrame, path: str) -> None:
    """Rewrite a body cache; entries without a body are not kept."""
    entries.filter(F.trim(F.coalesce("body", F.lit(""))) != "").write.mode("overwrite").json(path)


def append_usage(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def addresses(c: Column, separators: str = ",") -> Column:
    """Addresses of a list; parts without @ go."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), separators), lambda x: F.trim(x)), lambda x: F.contains(x, F.lit("@")))


def one_line(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def subject(titles: Column, region_only: Column, day: Column, brand: str) -> Column:
    """Subject of a digest: its day, and the first two titles, or what it is about."""
    prefix = F.concat(F.lit(f"【{brand} "), F.year(day), F.lit("/"), F.month(day), F.lit("/"), F.dayofmonth(day), F.lit("】"))
    t = F.filter(F.transform(titles, one_line), lambda x: x != "")
    rest = F.when(F.size(t) >= 2, F.concat(F.get(t, F.lit(0)), F.lit(" / "), F.get(t, F.lit(1)), F.lit(MORE))).when(F.size(t) == 1, F.concat(F.get(t, F.lit(0)), F.lit(MORE))).otherwise(SUBJECT_NONE)
    return F.concat(prefix, F.when(region_only, SUBJECT_REGION).otherwise(rest))


def digests(items: DataFrame, tiers: DataFrame, day: str, brand: str) -> DataFrame:
    """``tier, recipient, subject, html``: one message a recipient of each tier with articles; sending is at the boundary.

    ``items`` has ``rn, source, title, summary, url, is_region``; ``tiers`` has
    ``tier, recipients``. Limited articles go to full tiers only; a tier whose
    articles are all of the region says so.
    """
    t = tiers.withColumn("recipient", F.explode(addresses(F.col("recipients")))).select("tier", "recipient")
    limited = F.contains(F.coalesce("source", F.lit("")), F.lit(LIMITED))
    per = t.select("tier").distinct().join(items, ~limited | F.col("tier").isin(*FULL_TIERS))
    part = F.concat(F.lit("<h2>"), "title", F.lit("</h2><p>"), F.replace(F.coalesce("summary", F.lit("")), F.lit("\n"), F.lit("<br>")), F.lit("</p><a href='"), F.coalesce("url", F.lit("")), F.lit("'>"), F.coalesce("source", F.lit("")), F.lit("</a>"))
    g = per.groupBy("tier").agg(F.array_sort(F.collect_list(F.struct("rn", "title", part.alias("part")))).alias("x"), F.bool_and("is_region").alias("region"))
    head = F.concat(F.lit(f"<strong>{HEADLINES}</strong><br>"), F.array_join(F.transform("x", lambda i: F.concat(F.lit("✓ "), i["title"])), "<br>"), F.lit("<hr>"))
    html = F.concat(head, F.array_join(F.col("x.part"), "<hr>"))
    out = g.select("tier", subject(F.col("x.title"), F.col("region"), F.lit(day).cast("date"), brand).alias("subject"), html.alias("html"))
    return t.join(out, "tier").select("tier", "recipient", "subject", "html")
