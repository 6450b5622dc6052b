"""Queries over payloads, model features, streams and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html, json_text, urls
from ..operators import ml
from ..session import release, shared_folder, written
from ..sources import feeds, sinks
from ..streaming import incremental
from .articles import ARTICLES, articles
from .registry import fixture, literal, query, table

#: Labels up to which they are sent to the texts, so that no text is shuffled for them.
SENT_LABELS = 1_000_000


@query()
def html_articles(spark, sf_dir):
    a = table(spark, sf_dir, "pages").select("page_id", html.article(F.col("html")).alias("a"))
    return a.select("page_id", "a.title", F.size("a.paragraphs").alias("n_paragraphs"), F.array_join("a.paragraphs", "\n").alias("body"))


@query()
def html_links(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(html.article(F.col("html"))["links"]).alias("link"))
    full = urls.canonical(urls.absolute(F.col("url"), F.col("link")))
    return p.select("page_id", full.alias("link")).filter(F.col("link").rlike("^https?://")).distinct()


_ESC = "replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query("WITH " + ARTICLES + r" SELECT source, doc_id, trim(regexp_replace(title, '\s+', ' ', 'g')) AS title, url AS link FROM articles")
def rss_items(spark, sf_dir):
    a = articles(spark, sf_dir)
    safe = F.replace(F.replace(F.replace("title", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    feed = a.select("source", "doc_id", F.concat(F.lit("<rss><channel><item><title>"), safe, F.lit("</title><link>"), "url", F.lit("</link></item></channel></rss>")).alias("body"))
    return feeds.rss_items(feed).select("source", "doc_id", "title", "link")


@query("WITH " + ARTICLES + r" SELECT source, doc_id, doc_id AS id, url AS link, trim(regexp_replace(regexp_replace(title, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM articles")
def rest_posts(spark, sf_dir):
    a = articles(spark, sf_dir)
    post = F.to_json(F.array(F.struct(F.col("doc_id").alias("id"), F.col("url").alias("link"), F.struct(F.col("title").alias("rendered")).alias("title"), F.col("title").alias("excerpt"))))
    return feeds.rest_posts(a.select("source", "doc_id", post.alias("body"))).select("source", "doc_id", "id", "link", "title")


@query("SELECT page_id, CAST(min(CASE WHEN page_id % 3 = 0 THEN 2 ELSE 1 END) AS INTEGER) AS stage_rank FROM pages GROUP BY page_id")
def fetch_fallback(spark, sf_dir):
    """The first stage is blocked for every third page, so the second counts."""
    p = table(spark, sf_dir, "pages")
    stages = p.select("page_id", F.col("html"), F.explode(F.array(F.lit(1), F.lit(2))).alias("stage_rank")).withColumn("attempt", F.lit(1)).withColumn("status", F.lit(200))
    body = F.when((F.col("stage_rank") == 1) & (F.col("page_id") % 3 == 0), "<title>Just a moment</title>").otherwise(F.concat(F.lit("<!-- -->"), "html"))
    return feeds.usable_payloads(stages.withColumn("body", body), ["page_id"]).select("page_id", "stage_rank")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def lenient_json(spark, sf_dir):
    kind = F.col("event_id") % 3
    noisy = F.when(kind == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(kind == 1, F.concat(F.lit("Here it is: "), "props", F.lit(" - done."))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", json_text.lenient(noisy, "k long")["k"].alias("k"))


@query("WITH " + ARTICLES + """, t AS (SELECT doc_id, lower(trim(regexp_replace(title, '\\s+', ' ', 'g'))) AS t FROM articles), g AS (SELECT doc_id, unnest(flatten(list_transform([2, 3, 4, 5, 6], lambda n: list_transform(range(1, length(t) - n + 2), lambda i: substr(t, i, n))))) AS gram FROM t),
 tf AS (SELECT doc_id, gram, count(*) AS n FROM g GROUP BY ALL), v AS (SELECT gram, count(*) AS df, sum(n) AS total FROM tf GROUP BY gram HAVING count(*) >= 2 ORDER BY total DESC, gram LIMIT 20000),
 w AS (SELECT doc_id, gram, (1 + ln(CAST(n AS DOUBLE))) * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS v FROM tf JOIN v USING (gram))
 SELECT doc_id, gram, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) * 1.2, 5) AS value FROM w""")
def tfidf_features(spark, sf_dir):
    """One branch with the model's own parameters over whole titles."""
    most, weight = ml.BRANCHES["headline_a"]
    return ml.tfidf(articles(spark, sf_dir).select("doc_id", "title"), "doc_id", "title", features=most, weight=weight).select("doc_id", "gram", F.round("value", 5).alias("value"))


def _records(spark, sf_dir):
    """Labelled articles as records of the model: headline, the rest as summary, address."""
    from .articles import _rest

    a = articles(spark, sf_dir)
    d = a.select("doc_id", F.col("title").alias("headline_a"), F.lit("").alias("headline_final"), F.lit("").alias("headline_body"), _rest(F.col("body")).alias("summary"), "url", F.lit("").alias("duplicate_key"))
    label = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"), F.lit(1.0).alias("weight"))
    if label.count() <= SENT_LABELS:
        return d.join(F.broadcast(label), "doc_id")
    return written(d.join(label, "doc_id"), "model-records", "zstd")


def _model(spark, sf_dir):
    rows = _records(spark, sf_dir)
    counted = ml.counts(rows, "doc_id")
    space = ml.Space.of(rows, ml.fit(counted, rows.count()))
    release(counted)
    values = written(ml.vectors(rows, "doc_id", space, ("label", "weight")), "model-values", "zstd")
    release(rows)
    return values, space, ml.train(values, space, "label", "weight")


@query()
def lr_scores(spark, sf_dir):
    """All four branches and the metadata of whole records; no SQL twin: a regression has none."""
    values, space, model = _model(spark, sf_dir)
    return ml.decisions(values, space, model, "doc_id").select("doc_id", "score")


@query()
def explain(spark, sf_dir):
    """Why a record has its score: the eight largest contributions of either sign, and the stored detail."""
    values, space, model = _model(spark, sf_dir)
    r = ml.decisions(values, space, model, "doc_id", ml.TOP)
    up, down = (ml.reason_text(F.col(c)) for c in ("up", "down"))
    return r.select("doc_id", "score", up.alias("up"), down.alias("down"), ml.detail_json(F.col("decision"), F.col("probability"), F.col("score"), up, down, F.lit("")).alias("detail"))


@query("""SELECT l_orderkey, p_name AS feature, contribution, positive, CAST(rn AS BIGINT) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, positive ORDER BY abs(contribution) DESC, p_name) AS rn FROM
 (SELECT l_orderkey, p_name || '#' || l_linenumber AS p_name, l_quantity * (p_size - 25) AS contribution, l_quantity * (p_size - 25) > 0 AS positive FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE abs(contribution) > 1e-12) WHERE rn <= 2""")
def top_contributions(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_size")
    c = table(spark, sf_dir, "lineitem").join(p, "l_partkey").select("l_orderkey", F.concat("p_name", F.lit("#"), F.col("l_linenumber").cast("string")).alias("feature"), (F.col("l_quantity") * (F.col("p_size") - 25)).alias("contribution"))
    return ml.top_contributions(c, "l_orderkey", 2)


_NAMES = [
    ("headline_a:ab:c:weight=1.2", "headline_a", "ab:c", 1.2, "E列:ab:c"), ("generic_metadata:has_url:weight=0.6", "generic_metadata", "has_url", 0.6, "メタ情報:has_url"), ("plain", "unknown", "plain", None, "unknown:plain"),
    ("", "unknown", "unknown", None, "unknown:unknown"), ("other:x\ny", "other", "x\ny", None, "other:x\\ny"), ("summary:" + "a" * 50 + ":weight=x", "summary", "a" * 50, None, "I列:" + "a" * 45 + "…"),
]


@fixture(literal("feature VARCHAR, source VARCHAR, raw VARCHAR, weight DOUBLE, shown VARCHAR", _NAMES))
def feature_names(spark, sf_dir):
    f = spark.createDataFrame([r[:1] for r in _NAMES], "feature string")
    return f.select("feature", ml.split_name(F.col("feature")).alias("s"), ml.display_name(F.col("feature")).alias("shown")).select("feature", "s.source", "s.raw", "s.weight", "shown")


_TOP = [(1, "summary:a:weight=1", 0.5), (1, "summary:b:weight=1", -0.25), (1, "headline_a:c:weight=1.2", 1.0), (2, "summary:z:weight=1", -0.1), (2, "summary:0:weight=1", 0.0)]


@fixture(literal("id INTEGER, up VARCHAR, down VARCHAR", [(1, "E列:c(+1.000) / I列:a(+0.500)", "I列:b(-0.250)"), (2, "該当なし", "I列:z(-0.100)")]))
def reason_texts(spark, sf_dir):
    return ml.reasons(ml.top_contributions(spark.createDataFrame(_TOP, "id int, feature string, contribution double"), "id"), "id")


_META = [(1, "x" * 45, "", None, "s" * 1000, "u", ""), (2, None, None, None, None, None, "k")]


@fixture(literal("id INTEGER, gram VARCHAR, value DOUBLE", [(1, "has_url", 0.6), (1, "headline_a_len_bin", 1.2), (1, "summary_len_bin", 6.0), (2, "has_duplicate_key", 0.6)]))
def metadata_features(spark, sf_dir):
    d = spark.createDataFrame(_META, "id int, headline_a string, headline_final string, headline_body string, summary string, url string, duplicate_key string")
    return ml.metadata(d, "id").select("id", "gram", F.round("value", 6).alias("value"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey % 100 AS INTEGER) ELSE NULL END AS score, CASE WHEN o_orderkey % 7 = 0 THEN 'scored' ELSE '' END AS note FROM orders")
def output_alignment(spark, sf_dir):
    """Only some rows are scored; every row keeps its place, with blanks."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    done = o.filter("o_orderkey % 7 = 0").select("o_orderkey", (F.col("o_orderkey") % 100).cast("int").alias("score"), F.lit("scored").alias("note"))
    return ml.aligned(o, done, "o_orderkey", {"score": F.lit(None).cast("int"), "note": F.lit("")})


@query("SELECT event_id, user_id, event_type FROM events")
def stream_incremental(spark, sf_dir):
    """The same files come twice; each event is stored once."""
    target = shared_folder(spark, "events")
    like = table(spark, sf_dir, "events")
    for run in ("a", "b"):
        incremental.append_new(incremental.file_stream(spark, sf_dir, "events.parquet", like), "event_id", target, shared_folder(spark, f"offsets-{run}"))
    return spark.read.schema(like.schema).parquet(target).select("event_id", "user_id", "event_type")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark, sf_dir):
    like = table(spark, sf_dir, "events")
    target = shared_folder(spark, "counts")
    stream = incremental.file_stream(spark, sf_dir, "events.parquet", like).withColumn("ts", F.col("ts").cast("timestamp"))
    incremental.windowed_counts(stream, "ts", ["event_type"], "1 hour", "1 day", target, shared_folder(spark, "offsets"))
    out = incremental.latest(spark.read.parquet(target), ["start", "event_type"])
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("WITH " + ARTICLES + " SELECT doc_id, title, url FROM articles WHERE title <> ''")
def bundle_round_trip(spark, sf_dir):
    a = articles(spark, sf_dir).filter("title <> ''").select("doc_id", "title", "url")
    folder = shared_folder(spark, "bundle")
    sinks.write_bundle({"summaries": a}, folder)
    return feeds.read_bundle(spark, folder, "summaries", "doc_id long, title string, url string")


@query("WITH " + ARTICLES + " SELECT doc_id, date, CASE WHEN date = DATE '2024-01-03' THEN 'new' ELSE 'old' END AS state FROM articles")
def day_overwrite(spark, sf_dir):
    a = articles(spark, sf_dir).select("doc_id", "date")
    folder = shared_folder(spark, "days")
    sinks.overwrite_days(a.withColumn("state", F.lit("old")), folder, "date")
    sinks.overwrite_days(a.filter("date = DATE'2024-01-03'").withColumn("state", F.lit("new")), folder, "date")
    return spark.read.schema("doc_id long, state string, date date").parquet(folder).select("doc_id", "date", "state")
