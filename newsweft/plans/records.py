"""Queries over the record tables: orders, events, conversations, pages and their kin."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates, numbers, urls
from ..operators import dedupe, joins, layout, windows
from .registry import query, table


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 25)")
def anti_join_new_items(spark, sf_dir):
    stored = table(spark, sf_dir, "lineitem").filter("l_quantity > 25")
    return joins.new_items(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), stored, "o_orderkey", "l_orderkey")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000) OR c_mktsegment = 'BUILDING'")
def semi_join_keep(spark, sf_dir):
    kept = table(spark, sf_dir, "orders").filter("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return joins.keep_or_all(c, kept, "c_custkey", F.col("c_mktsegment") == "BUILDING")


@query("SELECT conv_id, arg_max(text, turn) AS last_text, arg_min(text, turn) AS first_text FROM conversations GROUP BY conv_id")
def lookup_last_first_wins(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    last = joins.pick(c, "conv_id", "turn").select("conv_id", F.col("text").alias("last_text"))
    first = joins.pick(c, "conv_id", "turn", last=False).select("conv_id", F.col("text").alias("first_text"))
    return last.join(first, "conv_id")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 5 = 0 THEN 'X' END, o_orderstatus) AS o_orderstatus, coalesce(CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice * 2 END, o_totalprice) AS o_totalprice FROM orders")
def overlay_outputs(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.filter("o_orderkey % 5 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return joins.overlay(o, new, "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("SELECT p_partkey, 'left' AS side FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity < 5) UNION ALL SELECT DISTINCT l_partkey, 'right' FROM lineitem WHERE l_quantity < 5 AND l_partkey NOT IN (SELECT p_partkey FROM part)")
def integrity_antijoin(spark, sf_dir):
    used = table(spark, sf_dir, "lineitem").filter("l_quantity < 5").select(F.col("l_partkey").alias("p_partkey"))
    return joins.unmatched(table(spark, sf_dir, "part").select("p_partkey"), used, "p_partkey")


@query("SELECT user_id, bool_and(value > 1) AS all_large, bool_or(event_type = 'error') AS any_error, count(*) AS n FROM events GROUP BY user_id")
def bool_and_by_user(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.bool_and(F.col("value") > 1).alias("all_large"), F.bool_or(F.col("event_type") == "error").alias("any_error"), F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders GROUP BY ALL")
def group_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.floor(F.col("value")).cast("long").alias("v"))


@query("SELECT event_id, count(*) OVER w AS n, CAST(sum(CAST(floor(value) AS BIGINT)) OVER w AS BIGINT) AS total FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW)")
def rolling_closed(spark, sf_dir):
    return windows.rolling(_events(spark, sf_dir), ["user_id"], "ts", 3600, "v").select("event_id", "n", "total")


@query("SELECT event_id, count(*) OVER w AS n, CAST(sum(CAST(floor(value) AS BIGINT)) OVER w AS BIGINT) AS total FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)")
def rolling_half_open(spark, sf_dir):
    return windows.rolling(_events(spark, sf_dir), ["user_id"], "ts", 3600, "v", closed=False).select("event_id", "n", "total")


@query("""WITH l AS (SELECT event_id, user_id, ts, CAST(ts + INTERVAL '6 hours 30 minutes' AS DATE) AS day FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS ordinal FROM l)
 SELECT event_id, day, CAST(ordinal AS BIGINT) AS ordinal, ordinal > 2 AS over, ordinal = 3 AS notify FROM r""")
def quota_edges_daily(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", dates.local_date(F.col("ts")).alias("day"))
    return windows.rising_edges(e, ["user_id", "day"], ["ts", "event_id"], F.col("ordinal") > 2).select("event_id", "day", "ordinal", "over", "notify")


@query("SELECT conv_id, turn FROM (SELECT conv_id, turn, max(CASE WHEN length(text) > 400 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS s FROM conversations) WHERE s = 0")
def take_while_stop(spark, sf_dir):
    return windows.take_while_not(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.length("text") > 400).select("conv_id", "turn")


@query("""WITH l AS (SELECT conv_id, turn, CASE WHEN length(text) // 100 = lag(length(text) // 100) OVER (PARTITION BY conv_id ORDER BY turn) THEN 0 ELSE 1 END AS n FROM conversations)
 SELECT conv_id, turn, CAST(sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM l""")
def islands(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    size = F.floor(F.length("text") / 100)
    return windows.islands(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], size == F.lag(size).over(w)).select("conv_id", "turn", "island")


@query("SELECT conv_id, turn, role FROM (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE p IS NULL OR p <> role")
def collapse_consecutive(spark, sf_dir):
    return dedupe.collapse_runs(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "role").select("conv_id", "turn", "role")


@query("SELECT role, conv_id, arg_max(text, turn) FILTER (WHERE text <> '' AND turn % 3 <> 2) AS body, min(turn) AS position FROM conversations GROUP BY ALL")
def cache_upsert(spark, sf_dir):
    """Later non-empty values win; an entry keeps its first position."""
    c = table(spark, sf_dir, "conversations")
    body = F.max_by(F.when((F.col("text") != "") & (F.col("turn") % 3 != 2), F.col("text")), F.when((F.col("text") != "") & (F.col("turn") % 3 != 2), F.col("turn")))
    return c.groupBy("role", "conv_id").agg(body.alias("body"), F.min("turn").alias("position"))


_YEN = "CASE WHEN n = 0 THEN '0円' ELSE (CASE WHEN n // 100000000 > 0 THEN (n // 100000000) || '億' ELSE '' END) || (CASE WHEN n % 100000000 // 10000 > 0 THEN (n % 100000000 // 10000) || '万' ELSE '' END) || (CASE WHEN n % 10000 > 0 THEN CAST(n % 10000 AS VARCHAR) ELSE '' END) || '円' END"
_KYAT = "CASE WHEN n <= 0 THEN '' WHEN n < 10000 THEN n || 'チャット' ELSE (CASE WHEN n // 100000000 > 0 THEN (n // 100000000) || '億' ELSE '' END) || (CASE WHEN n % 100000000 // 10000 > 0 THEN (n % 100000000 // 10000) || '万' ELSE '' END) || 'チャット' END"


@query(f"WITH a AS (SELECT o_orderkey, CAST(floor(o_totalprice * 1000) AS BIGINT) AS n FROM orders) SELECT o_orderkey, {_YEN} AS yen, {_KYAT} AS kyat, CAST(round_even(CAST(n AS DOUBLE) * 0.037, 0) AS BIGINT) AS in_yen, CASE WHEN n >= 10000 THEN n - n % 10000 ELSE n END AS parsed FROM a")
def yen_kyat_format(spark, sf_dir):
    n = F.col("n")
    a = table(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") * 1000).cast("long").alias("n"))
    kyat = numbers.format_kyat(n)
    return a.select("o_orderkey", numbers.format_yen(n).alias("yen"), kyat.alias("kyat"), numbers.kyat_to_yen(n).alias("in_yen"), numbers.parse_kyat(kyat).alias("parsed"))


@query("""SELECT l_orderkey, l_linenumber, CAST(greatest(0, least(100, round_even(l_extendedprice / 500 - 20, 0))) AS INTEGER) AS score, CAST(least(floor(l_quantity / 5), 10) AS INTEGER) AS bin FROM lineitem""")
def clamp_scores(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", numbers.clamp_score(F.col("l_extendedprice") / 500 - 20).alias("score"), F.least(F.floor(F.col("l_quantity") / 5), F.lit(10)).cast("int").alias("bin"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS dash_key, strftime(o_orderdate, '%Y%m%d') AS ja_key, strftime(o_orderdate, '%Y%m%d') AS plain_key, '' AS bad_key, CAST(o_orderdate AS DATE) AS serial, year(o_orderdate) || '年' || month(o_orderdate) || '月' || day(o_orderdate) || '日' AS ja, CAST(o_orderdate AS DATE) AS listed FROM orders WHERE year(o_orderdate) >= 2000
 UNION ALL SELECT o_orderkey, '', '', strftime(o_orderdate, '%Y%m%d'), '', CAST(o_orderdate AS DATE), year(o_orderdate) || '年' || month(o_orderdate) || '月' || day(o_orderdate) || '日', CAST(o_orderdate AS DATE) FROM orders WHERE year(o_orderdate) < 2000""")
def date_keys(spark, sf_dir):
    d = F.to_date("o_orderdate")
    ja = dates.ja_date(d)
    old = F.year(d) < 2000
    key = lambda s: F.when(old, F.lit("")).otherwise(dates.date_key(s))  # noqa: E731  only 20xx is a separated date
    serial = F.datediff(d, F.lit(dates.SERIAL_ORIGIN).cast("date")) + 0.5
    return table(spark, sf_dir, "orders").select("o_orderkey", key(F.date_format(d, "yyyy-M-d")).alias("dash_key"), key(ja).alias("ja_key"), dates.date_key(F.date_format(d, "yyyyMMdd")).alias("plain_key"),
                                                 dates.date_key(F.lit("2026-02-30")).alias("bad_key"), dates.serial_date(serial).alias("serial"), ja.alias("ja"), dates.list_date(F.date_format(d, "MMMM d, yyyy")).alias("listed"))


@query("""SELECT event_id, CAST(ts + INTERVAL '6 hours 30 minutes' AS DATE) AS feed_day, CAST(ts + INTERVAL '6 hours 30 minutes' AS DATE) AS iso_day, CAST(ts AS DATE) AS naive_day FROM events""")
def feed_dates(spark, sf_dir):
    feed = F.concat(F.date_format("ts", "E, d MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return table(spark, sf_dir, "events").select("event_id", dates.feed_date(feed).alias("feed_day"), dates.iso_local_date(iso).alias("iso_day"), dates.iso_local_date(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("naive_day"))


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL")
def props_json(spark, sf_dir):
    k = F.coalesce(F.get_json_object("props", "$.k"), F.get_json_object("props", "$.K")).try_cast("long")
    return table(spark, sf_dir, "events").groupBy("event_type", k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT n_nationkey, c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def media_totals(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"))
    return o.join(c, "o_custkey").join(joins.small(n), "c_nationkey").groupBy(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


_HOST = "lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), ':\\d*$', ''))"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


@query(rf"""SELECT page_id, {_HOST} AS host, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS canonical, regexp_replace(split_part(url, '#', 1), '/+$', '') AS url_key,
 regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') || '#title-' || substr(sha1(url), 1, 16) AS row_key, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') || '/amp/' AS amp FROM pages""")
def url_normalise(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.host(u).alias("host"), urls.canonical(u).alias("canonical"), urls.key(u).alias("url_key"), urls.row_key(u, u).alias("row_key"), urls.amp(u).alias("amp"))


@query(rf"""SELECT page_id, len(list_filter(string_split({_PATH}, '/'), lambda x: x <> '')) >= 2 AND NOT regexp_matches({_PATH}, '(?i)/(category|tag|author|page|feed)(/|$)') AS article, starts_with(lower({_PATH}), '/news') AS excluded FROM pages""")
def url_filters(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.article_shaped(u).alias("article"), urls.excluded(u, ["/news"]).alias("excluded"))


_SLUG = rf"trim(regexp_replace(regexp_replace(url_decode(regexp_replace(regexp_extract(regexp_replace({_PATH}, '/+$', ''), '([^/]*)$', 1), '(?i)\.html?$', '')), '[-_]+', ' ', 'g'), '\s+', ' ', 'g'))"


@query(f"SELECT page_id, array_to_string(list_transform(string_split({_SLUG}, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS title FROM pages")
def slug_titles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.slug_title(F.col("url")).alias("title"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title, len(regexp_extract_all(html, '(?i)<p[\s>]')) AS n_paragraphs, len(regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]+)"', 1)) AS n_links FROM pages""")
def html_titles(spark, sf_dir):
    t = F.trim(F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))
    count = lambda p, g: F.size(F.regexp_extract_all("html", F.lit(p), F.lit(g))).cast("long")
    return table(spark, sf_dir, "pages").select("page_id", t.alias("title"), count(r"(?i)<p[\s>]", 0).alias("n_paragraphs"), count(r'(?i)<a\s[^>]*href="([^"]+)"', 1).alias("n_links"))


@query("SELECT CAST(d AS DATE) AS day, count(o_orderkey) AS n FROM generate_series(DATE '1996-01-01', DATE '1996-03-31', INTERVAL 1 DAY) t(d) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY 1")
def daily_range(spark, sf_dir):
    days = spark.sql("SELECT explode(sequence(DATE'1996-01-01', DATE'1996-03-31', INTERVAL 1 DAY)) AS day")
    o = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("k"))
    return days.join(o, "day", "left").select("day", F.coalesce("k", F.lit(0).cast("long")).alias("n"))


@query("SELECT label, count(*) AS n, round(avg(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 4) AS mean_norm2 FROM embeddings GROUP BY label")
def embedding_norms(spark, sf_dir):
    n2 = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return table(spark, sf_dir, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(n2), 4).alias("mean_norm2"))


@query("""WITH RECURSIVE p AS (SELECT c_nationkey AS g, o_orderkey AS l, l_partkey AS r, max(l_extendedprice) AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
 o AS (SELECT g, l, row_number() OVER (PARTITION BY g ORDER BY l) AS n, list(r ORDER BY s DESC, r) AS rs, list(s ORDER BY s DESC, r) AS ss FROM p GROUP BY g, l),
 w(g, n, l, r, s, used) AS (SELECT DISTINCT g, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST([] AS BIGINT[]) FROM o
 UNION ALL SELECT g, n, l, r, ss[list_position(rs, r)], CASE WHEN r IS NULL THEN used ELSE list_append(used, r) END FROM (SELECT o.g, o.n, o.l, o.rs, o.ss, w.used, list_filter(o.rs, lambda x: NOT list_contains(w.used, x))[1] AS r FROM w JOIN o ON o.g = w.g AND o.n = w.n + 1))
 SELECT g AS nation, l AS o_orderkey, r AS l_partkey, s AS price FROM w WHERE r IS NOT NULL""")
def greedy_one_to_one(spark, sf_dir):
    """Each order of a nation, in order, takes the dearest of its parts that no order before it took."""
    nation = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(nation, "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_extendedprice")
    pairs = lines.join(orders, "o_orderkey").groupBy("nation", "o_orderkey", "l_partkey").agg(F.max("l_extendedprice").alias("price"))
    return layout.greedy_match(pairs, "nation", "o_orderkey", "l_partkey", "price", 0.0, alone=1000)
