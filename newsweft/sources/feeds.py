"""Payload tables to article rows: RSS items, REST posts, sheets, bundles and caches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import nz, squeeze, strip_tags

ITEM = "title string, link string, pubDate string, description string"
POST = "id long, date string, date_gmt string, link string, title string, excerpt string, content string"


def rss_items(payloads: DataFrame, body: str = "body") -> DataFrame:
    """A row for each <item>: the other columns and title, link, pubDate, description; unparsable feeds give none."""
    items = F.regexp_extract_all(F.col(body), F.lit(r"(?s)(<item\b.*?</item>)"), F.lit(1))
    rest = [c for c in payloads.columns if c != body]
    one = payloads.select(*rest, F.posexplode(items).alias("pos", "xml"))
    parsed = one.withColumn("i", F.from_xml("xml", ITEM, {"mode": "PERMISSIVE"}))
    return parsed.select(*rest, "pos", *[squeeze(F.coalesce(F.col("i")[c], F.lit(""))).alias(c) for c in ("title", "link", "pubDate", "description")])


def rest_posts(payloads: DataFrame, body: str = "body") -> DataFrame:
    """A row for each post of a JSON array; a field may be text or ``{rendered}``."""
    posts = F.from_json(F.col(body), f"array<struct<{POST.replace(' string', ':string').replace(' long', ':long')}>>")
    rest = [c for c in payloads.columns if c != body]
    one = payloads.select(*rest, F.posexplode(posts).alias("pos", "p"))
    rendered = lambda c: strip_tags(F.coalesce(nz(F.get_json_object(F.col("p")[c], "$.rendered")), F.col("p")[c]))
    return one.select(*rest, "pos", F.col("p.id").alias("id"), F.col("p.date").alias("date"), F.col("p.link").alias("link"), rendered("title").alias("title"), rendered("excerpt").alias("excerpt"), rendered("content").alias("content"))


def sheet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A positional sheet export: the header row is skipped, missing cells are empty."""
    df = spark.read.option("header", True).option("enforceSchema", True).schema(", ".join(f"`{c}` string" for c in columns)).csv(path)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def usable_payloads(fetches: DataFrame, keys: list[str], blocked: str = r"(?i)(just a moment|attention required|access denied|captcha)") -> DataFrame:
    """The first usable payload of each key: status 200, not blank, no block page in its head; by stage, then attempt."""
    ok = fetches.filter((F.col("status") == 200) & (F.trim("body") != "") & ~F.substring("body", 1, 4000).rlike(blocked))
    return ok.groupBy(*keys).agg(F.min_by(F.struct("body", "stage_rank", "attempt"), F.struct("stage_rank", "attempt")).alias("r")).select(*keys, "r.body", "r.stage_rank", "r.attempt")


CACHE = "item_id string, source string, url string, title string, body string, body_ja string"


def cache_entries(files: DataFrame, body: str = "body") -> DataFrame:
    """``pos`` and the entries of body caches in JSON: a list of entries, or the older map by address; anything else gives none."""
    entry = "struct<" + CACHE.replace(" string", ":string") + ">"
    listed = files.withColumn("_l", F.when(F.startswith(F.trim(body), F.lit("[")), F.from_json(body, f"array<{entry}>")))
    older = F.when(F.startswith(F.trim(body), F.lit("{")), F.from_json(body, f"map<string,{entry}>"))
    mapped = F.transform(F.map_entries(older), lambda e: F.struct(e["value"]["item_id"].alias("item_id"), e["value"]["source"].alias("source"), F.coalesce(nz(e["value"]["url"]), e["key"]).alias("url"),
                                                                  e["value"]["title"].alias("title"), e["value"]["body"].alias("body"), e["value"]["body_ja"].alias("body_ja")))
    rest = [c for c in files.columns if c != body]
    return listed.withColumn("_e", F.coalesce("_l", mapped)).select(*rest, F.posexplode("_e").alias("pos", "e")).select(*rest, "pos", "e.*")


def from_cache(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """``wanted`` (id, url) with the cached body: of the first entry of the id, else of the last one of the address; blank bodies count as none."""
    ok = cache.filter(nz(F.col("body")).isNotNull()).withColumn("_u", F.regexp_replace(F.substring_index(F.trim("url"), "#", 1), "/+$", ""))
    by_id = ok.filter("coalesce(item_id, '') <> ''").groupBy(F.col("item_id").alias("id")).agg(F.min_by("body", "pos").alias("_a"))
    by_url = ok.filter("coalesce(_u, '') <> ''").groupBy("_u").agg(F.max_by("body", "pos").alias("_b"))
    j = wanted.withColumn("_u", F.regexp_replace(F.substring_index(F.trim("url"), "#", 1), "/+$", "")).join(by_id, "id", "left").join(by_url, "_u", "left")
    return j.withColumn("body", F.coalesce("_a", "_b")).drop("_u", "_a", "_b")


def read_through(wanted: DataFrame, cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """Cached bodies, and fetched ones where there is none; ``cached`` says which."""
    own = from_cache(wanted, cache).withColumnRenamed("body", "_own")
    j = own.join(fetched.select("url", F.col("body").alias("_new")), "url", "left")
    return j.withColumn("body", F.coalesce(nz(F.col("_own")), nz(F.col("_new")), F.lit(""))).withColumn("cached", F.col("_own").isNotNull()).drop("_own", "_new")


def read_bundle(spark: SparkSession, folder: str, part: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(f"{folder}/{part}")
