"""Collection by site: list payloads and page payloads to article rows, one plan with a rule a site.

Fetching is at the boundary: ``lists`` holds what list pages, feeds and post
APIs returned (``source, stage, base, page, kind, body``), ``fetches`` what
article pages returned (``url, stage_rank, attempt, status, body``). A collector
turns them into candidates, reads the candidates' pages by the site's rule, and
keeps articles of one day.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, sites, text, urls
from ..functions.dom import parse
from ..operators.dedupe import first_wins
from .feeds import rest_posts, rss_items, usable_payloads


@dataclass(frozen=True)
class Cards:
    """Entries of a list page: the card, and in it link, title and date."""

    card: str
    link: str = "a[href]"
    title: str = ""
    date: str = ""


@dataclass(frozen=True)
class Collector:
    """``stages``: whether later list stages count only where earlier ones found nothing (first) or always (all).
    ``date``: by the page (page), by the list (list), or by either."""

    source: str
    site: str
    cards: Cards = Cards("article")
    stages: str = "first"
    date: str = "page"
    keep_empty: bool = False
    split: bool = False
    hashtags: bool = False
    excluded_titles: tuple[str, ...] = ()
    excluded_paths: tuple[str, ...] = ()
    excluded_hosts: tuple[str, ...] = ()
    host: str = ""
    segments: str = ""
    categories: tuple[str, ...] = ()
    keyword_bases: tuple[str, ...] = ()
    keyword: str = ""
    keywords: tuple[str, ...] = ()
    place_in_title: bool = False


# What each collector takes, in the order of the plan; words and paths as the sites have them.
_DVB = Cards("div.listing_content", "a[href]", "h5", "div.text-gray-500")
_ELEVEN = Cards("div.frontpage-title")
MYANMAR = "မြန်မာ"
COLLECTORS = {c.source: c for c in (
    Collector("Irrawaddy", "irrawaddy", date="either", excluded_paths=("/category/news/asia", "/category/news/world", "/video", "/cartoons"), excluded_hosts=("burma.irrawaddy.com",)),
    Collector("Mizzima (Burmese)", "mizzima", Cards("h3.entry-title"), excluded_titles=("နွေဦးတော်လှန်ရေး နေ့စဉ်မှတ်စု", "ဓာတ်ပုံသတင်း"), keyword_bases=("world",), keyword=MYANMAR),
    Collector("BBC Burmese", "bbc", date="list", keep_empty=True, split=True),
    Collector("Khit Thit Media", "khitthit", Cards("p.entry-title.td-module-title"), keep_empty=True, hashtags=True),
    Collector("DVB", "dvb", _DVB, date="list"),
    Collector("Myanmar Now", "myanmar_now", Cards("li.post-item", "h2 a[href]", "h2", "span.date"), date="list"),
    Collector("GNLM", "gnlm", Cards("h2.entry-title"), stages="all", date="either", host="gnlm.com.mm",
              segments=r"(?i)^/(?!\d{1,2}-[a-z]+-\d{4}/?$|category/|tag/|author/|page/|wp-content/).*(?<!\.pdf)$"),
    Collector("Popular Myanmar", "popular", date="list"),
    Collector("Frontier Myanmar", "frontier", host="frontiermyanmar.net", excluded_paths=("/en/category/doh-athan", "/en/category/whim", "/en/doh-athan", "/en/whim"),
              segments=r"(?i)^/en/(?!(?:feed|login|join-us|membership|magazine|contact-us|terms-of-service|donate|the-frontier-story|work-with-us|opinion|features|podcasts|doh-athan|whim|issue"
                       r"|author|tag|category|page|my|bur|mm|search|privacy-policy|account|register|forgot-password|membership-levels|membership-packages|wp-json)/?$|page|category|tag|author)[^/.]+/?$"),
    Collector("JETRO", "jetro", Cards("li"), place_in_title=True),
    Collector("News Eleven", "eleven", _ELEVEN),
)}
#: Collectors that keep only articles with a word of the list in title or body.
LEGACY = ("Mizzima (Burmese)", "BBC Burmese", "Khit Thit Media", "Irrawaddy", "DVB", "Myanmar Now")

LIST_SCHEMA = "source string, stage int, base string, page int, kind string, body string"
FETCH_SCHEMA = "url string, stage_rank int, attempt int, status int, body string"
ARTICLE = ["source", "title", "url", "date", "body", "row_key"]
_CARD = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("link", "title", "date")]))


def rules(spark: SparkSession, collectors: list[Collector]) -> DataFrame:
    """The collectors' rules as a table, a row a source in the order of the plan; patterns that never match where a rule is empty."""
    never, any_of = "(?!)", lambda words: "|".join(map(re.escape, words)) or "(?!)"
    rows = [(c.source, i, c.stages == "first", c.date, c.keep_empty, c.split, c.hashtags, c.place_in_title, any_of(c.excluded_titles),
             f"^(?:{any_of(c.excluded_paths)})" if c.excluded_paths else never, any_of(c.excluded_hosts), re.escape(c.host) + "$" if c.host else "", c.segments,
             any_of(c.keyword_bases), c.keyword, any_of(c.keywords) if c.keywords else "") for i, c in enumerate(collectors)]
    schema = ("source string, turn int, first_stage boolean, by string, keep_empty boolean, split boolean, hashtags boolean, place_in_title boolean, not_titles string, "
              "not_paths string, not_hosts string, host string, segments string, keyword_bases string, keyword string, keywords string")
    return spark.createDataFrame(rows, schema)


def _by_source(collectors: list[Collector], one):
    """``one(collector, payload)`` for the collector of each row's source; null where there is none."""
    of = {c.source: c for c in collectors}
    return lambda source, payload: pd.Series([one(of[k], x) if k in of else None for k, x in zip(source, payload)])


def _cards(c: Collector, html: str | None) -> list[dict]:
    out = []
    for card in parse(html).find(c.cards.card):
        a = card.first(c.cards.link)
        if a is not None:
            title, date = (n.text() if q and (n := card.first(q)) is not None else "" for q in (c.cards.title, c.cards.date))
            out.append({"link": a.attrs["href"], "title": title or a.text(), "date": date})
    return out


def any_date(c: Column) -> Column:
    """Local date of a time as lists and pages write it: ISO, RFC 822, ``May 9, 2026``, 2026年5月9日."""
    c = F.coalesce(c, F.lit(""))
    iso = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), dates.iso_local_date(c))
    return F.coalesce(iso, F.when(c.contains("年"), dates.ja_to_date(c)), F.when(c.rlike(r"\d{2}:\d{2}"), dates.feed_date(c)), dates.list_date(F.initcap(c)))


def candidates(lists: DataFrame, collectors: list[Collector]) -> DataFrame:
    """``source, url, list_title, list_date, stage, page, pos, needs_keyword``: distinct candidate urls of each source, the first of each."""
    keys = ["source", "stage", "base", "page"]
    rule = F.broadcast(rules(lists.sparkSession, collectors))  # a row a collector
    named = _by_source(collectors, _cards)

    @F.pandas_udf(_CARD)
    def cards_of(source: pd.Series, html: pd.Series) -> pd.Series:
        return named(source, html)

    feed = rss_items(lists.filter("kind = 'rss'").select(*keys, "body")).select(*keys, "pos", "link", "title", F.col("pubDate").alias("date"))
    posts = rest_posts(lists.filter("kind = 'posts'").select(*keys, "body")).select(*keys, "pos", "link", "title", "date")
    read = lists.filter("kind = 'cards'").withColumn("cards", cards_of("source", "body"))
    # Paging ends at the first page without entries: what lies behind is no longer read.
    end = F.min(F.when(F.coalesce(F.size("cards"), F.lit(0)) <= 0, F.col("page"))).over(Window.partitionBy("source", "stage", "base"))
    read = read.withColumn("end", end).filter(F.col("end").isNull() | (F.col("page") < F.col("end")))
    cards = read.select(*keys, F.posexplode("cards").alias("pos", "e")).select(*keys, "pos", "e.link", "e.title", "e.date")
    found = feed.unionByName(posts).unionByName(cards).join(rule, "source")
    found = found.withColumn("url", urls.canonical(urls.absolute(F.col("base"), F.col("link")))).filter(F.col("url").rlike("^https?://"))
    host, path = urls.host(F.col("url")), urls.path(F.col("url"))
    found = found.filter(~F.rlike(F.lower(path), F.col("not_paths")) & ~F.rlike(host, F.concat(F.lit("^(?:"), "not_hosts", F.lit(")$"))) & F.rlike(host, F.col("host")) & F.rlike(path, F.col("segments")))
    found = found.withColumn("needs", F.rlike("base", F.col("keyword_bases")))
    least = F.min("stage").over(Window.partitionBy("source"))
    found = found.withColumn("least", least).filter(~F.col("first_stage") | (F.col("stage") == F.col("least")))
    # A url that any list names without condition is free of it; of its entries the first counts.
    first = F.min(F.struct("stage", "page", "pos", "title", "date")).alias("f")
    one = found.groupBy("source", "url").agg(first, F.bool_and("needs").alias("needs_keyword"))
    return one.select("source", "url", F.col("f.title").alias("list_title"), any_date(F.col("f.date")).alias("list_date"), "f.stage", "f.page", "f.pos", "needs_keyword")


def judged(lists: DataFrame, fetches: DataFrame, collectors: list[Collector], day: str) -> DataFrame:
    """Candidates with what their pages say, and ``reason``: the first rule that one fails, or accepted."""
    named = _by_source(collectors, lambda c, html: sites.read(html, c.site))

    @F.pandas_udf(sites.READ)
    def page_of(source: pd.Series, html: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(list(named(source, html)), columns=sites.READ.names)

    pages = usable_payloads(fetches, ["url"]).select("url", F.col("body").alias("html"))
    j = candidates(lists, collectors).join(F.broadcast(rules(lists.sparkSession, collectors)), "source").join(pages, "url", "left")
    j = j.withColumn("a", page_of("source", "html"))
    j = j.withColumn("page_date", any_date(F.col("a.published")))
    target, page_date, body = F.lit(day).cast("date"), F.col("page_date"), F.coalesce("a.body", F.lit(""))
    date = F.when(F.col("by") == "page", page_date).when((F.col("by") == "either") & (page_date == target), page_date).otherwise(F.coalesce("list_date", page_date))
    title = F.coalesce(text.nz(F.col("a.title")), text.nz(F.col("list_title")), text.nz(urls.slug_title(F.col("url"))), F.lit(""))
    title = F.concat(title, F.when(F.col("place_in_title"), F.coalesce("a.place", F.lit(""))).otherwise(""))
    body = F.when(F.col("hashtags"), text.strip(text.drop_hashtags(body))).otherwise(body)
    j = j.withColumn("title", title).withColumn("date", date).withColumn("body", body)
    both = F.concat_ws("\n", "title", "body")
    reason = (F.when(F.col("date").isNull(), "no_date").when(F.col("date") != target, "date_mismatch").when(F.col("title") == "", "no_title")
              .when(F.rlike("title", F.col("not_titles")), "excluded_title").when(~F.col("keep_empty") & (F.col("body") == ""), "no_body")
              .when(F.col("needs_keyword") & ~F.contains(both, F.col("keyword")), "keyword_miss").when(~F.rlike(both, F.col("keywords")), "keyword_miss").otherwise("accepted"))
    return j.withColumn("reason", reason)


def collect(lists: DataFrame, fetches: DataFrame, day: str, collectors: list[Collector]) -> DataFrame:
    """Articles of a day, the first of each key in the order of the plan; pages of several articles give a row each, with a key of its own."""
    got = judged(lists, fetches, collectors, day).filter("reason = 'accepted'")
    parts = F.when(F.col("split") & sites.day_summary(F.col("title")), sites.split_articles(F.col("html")))
    got = got.withColumn("parts", parts).withColumn("whole", F.coalesce(F.size("parts") <= 0, F.lit(True)))
    got = got.withColumn("p", F.explode(F.when(F.col("whole"), F.array(F.struct("title", "body"))).otherwise(F.col("parts"))))
    key = F.when(F.col("whole"), F.col("url")).otherwise(urls.row_key(F.col("url"), F.col("p.title"), "bbc-title"))
    rows = got.select("source", "p.title", "url", "date", "p.body", key.alias("row_key"), "turn")
    return first_wins(rows, F.col("row_key"), ["turn", "url"], keep_blank=False).select(*ARTICLE)


def plan(cron: str | None = None, only: str | None = None, gated: dict[str, set[str]] | None = None) -> list[Collector]:
    """Collectors in order: sources of ``gated`` only at their own cron slots (never without one), and only the named one if one is named."""
    gated = gated or {}
    chosen = [c for c in COLLECTORS.values() if c.source not in gated or (cron or "").strip() in gated[c.source]]
    same = lambda a, b: a.strip().casefold() == b.strip().casefold()
    return [c for c in chosen if not only or same(c.source, only)]
