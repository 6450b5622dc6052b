"""Queries over fixed rows: second scores, dedupe answers, translations, sinks, page layout, limits and settings.

The SQL is the rows that must come out, worked out by hand from the rules.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import amounts, config, dates, json_text, responses, sites, terminology, text
from ..operators import dedupe, layout, prompts, rate, rerank
from ..session import shared_folder
from ..sources import feeds, scans, sinks
from .registry import fixture, literal, query, table

# --- second scores ---

_ROWS = [(2, "20260509", 70), (3, "20260509", 40), (4, "20260509", 90), (5, "20260508", 10), (6, "20260509", 55)]
_TRIES = [
    (1, 1, "m1", 3, "no json"),
    (1, 2, "m2", 3, '```json\n{"articles": [{"row_index": 2, "gemini_score": "80.5", "decision": " keep ", "reasons": "one", "same_day_event_relation": "same_event_duplicate", "same_day_event_key": "Event key one", "same_day_score_source_rows": [3, "5", 0]},'
     '{"row_index": 3, "gemini_score": 150, "reasons": ["a", "", " b ", "c", "d", "e"], "risk_flags": [], "topic_key": "t"}, {"row_index": 0, "gemini_score": 9}]}\n```'),
    (2, 1, "m1", 2, '[{"row_index": 4, "gemini_score": 10, "event_who": "x", "same_day_event_relation": "same_event_duplicate", "same_day_event_key": "event, KEY one"}, {"row_index": 6}]'),
    (3, 4, "m1", 1, '[{"row_index": 5, "gemini_score": 99}]'),  # a fourth try is one too many
]
_ROWSET = "row_index int, date_key string, ml int"
_TRYSET = "batch int, attempt int, model string, size int, body string"


@fixture(literal("row_index INTEGER, ml INTEGER, llm INTEGER, final INTEGER, source VARCHAR, reason VARCHAR", [
    (2, 70, 80, 80, "Gemini採用", "理由: one / 同日内判定: same_event_duplicate"), (3, 40, 100, 100, "Gemini採用", "理由: a / b / c / d / トピックキー: t"),
    (4, 90, 10, 90, "ML採用", "4W: - / x / - / - / 同日内判定: same_event_duplicate"), (5, 10, None, 10, "ML採用（Geminiスコアなし）", ""), (6, 55, 0, 55, "ML採用", "")]))
def rerank_results(spark, sf_dir):
    scored = rerank.results(spark.createDataFrame(_TRIES, _TRYSET))
    return rerank.finals(spark.createDataFrame(_ROWS, _ROWSET), scored)


@fixture(literal("model VARCHAR, n BIGINT", [("m1", 6)]))
def model_usage_counts(spark, sf_dir):
    """Articles by the model that answered each batch first."""
    return rerank.model_usage(spark.createDataFrame(_TRIES, _TRYSET))


@fixture(literal("row_index BIGINT, label VARCHAR, final INTEGER, note VARCHAR", [
    (2, "重複001", 100, "重複001の同日重複グループ3件の最高最終スコア100点にAA列を揃えました。元スコア: 80点。"), (3, "重複001", 100, "重複001の同日重複グループ3件の最高最終スコアとして使用。"),
    (4, "重複001", 100, "重複001の同日重複グループ3件の最高最終スコア100点にAA列を揃えました。元スコア: 90点。")]))
def event_duplicates(spark, sf_dir):
    """Rows of one event key and the named rows of the day are one group; a row of another day is not."""
    rows, scored = spark.createDataFrame(_ROWS, _ROWSET), rerank.results(spark.createDataFrame(_TRIES, _TRYSET))
    final = rerank.finals(rows, scored).select("row_index", "final").join(rows.select("row_index", "date_key"), "row_index")
    return rerank.duplicate_groups(final, scored)


_CANDIDATES = [(i, s, t, d) for i, (s, t, d) in enumerate([(90, False, False), (10, True, False), (10, False, True), (50, False, False), (30, False, False), (5, False, False), (85, False, False)])]


@fixture(literal("cap INTEGER, id INTEGER, priority INTEGER", [(3, 0, 5), (3, 6, 5), (3, 1, 4), *[(7, i, None) for i in range(7)]]))
def rerank_candidates(spark, sf_dir):
    """Three of seven by priority and score; where all fit, all go."""
    rows = spark.createDataFrame(_CANDIDATES, "id int, s int, t boolean, d boolean")
    out = None
    for cap in (3, 7):
        own = rerank.candidates(rows, "s", F.col("t"), F.col("d"), "id", most=cap).select(F.lit(cap).alias("cap"), "id", "priority")
        out = own if out is None else out.unionByName(own)
    return out


@fixture(literal("id INTEGER, payload VARCHAR", [(1, '{"row_index":1,"ml_score":100,"headline":"a b","summary":"","same_day_context":[{"row_index":2,"match_reason":"x"},{"row_index":3,"match_reason":"y"}]}'),
                                               (2, '{"row_index":2,"ml_score":0,"headline":"' + "h" * 140 + '…","summary":"s","same_day_context":[]}')]))
def context_payloads(spark, sf_dir):
    rows = spark.createDataFrame([(1, 170, " a \n b ", None), (2, None, "h" * 150, "s")], "id int, score int, headline string, summary string")
    ctx = spark.createDataFrame([(1, 2, 3, "y"), (1, 1, 2, "x")], "id int, rn bigint, other bigint, reason string")
    return rerank.payloads(rows, ctx, "id")


_CALLS = [
    (1, "one", False, 1, "HTTP 503", None), (1, "one", False, 2, None, "late"), (1, "two", True, 1, None, "other"),
    (2, "one", False, 1, "RESOURCE_EXHAUSTED", None), (2, "two", True, 1, "HTTP 500", None), (2, "two", True, 2, None, "second"),
    (3, "one", False, 1, "HTTP 400", None), (3, "two", True, 1, None, "not due"),
    (4, "one", False, 1, "rate limit", None),
]


@fixture(literal("call INTEGER, model VARCHAR, body VARCHAR", [(1, "one", "late"), (2, "two", "second")]))
def model_fallback(spark, sf_dir):
    return rerank.answered(spark.createDataFrame(_CALLS, "call int, model string, second boolean, attempt int, error string, body string"))


# --- dedupe answers ---

_ITEMS = [("u1/", "DVB"), ("u2", "DVB"), ("u3", "Irrawaddy"), ("u4", "BBC")]
_ANSWER = [("kept", "u1", None, "c1"), ("kept", "zz", None, "c2"), ("removed", "u2", "u1", None), ("removed", "yy", "u9", None)]
_ANSWER_SCHEMA = "kind string, id string, duplicate_of string, cluster string"


@fixture(literal("run VARCHAR, id VARCHAR", [("answered", "u1/"), ("answered", "u3"), *[("unanswered", i) for i, _ in _ITEMS]]))
def answered_dedupe(spark, sf_dir):
    """What the answer keeps, and the exempt source; all if it keeps nothing that is there."""
    items = spark.createDataFrame(_ITEMS, "id string, source string")
    a = spark.createDataFrame(_ANSWER, _ANSWER_SCHEMA)
    run = lambda name, ans: rerank.kept_rows(items, ans, F.col("source") == "Irrawaddy").select(F.lit(name).alias("run"), "id")
    return run("answered", a).unionByName(run("unanswered", a.filter("id = 'zz'")))


@fixture(literal("id VARCHAR, status VARCHAR, duplicate_of VARCHAR, flags VARCHAR", [("u1", "kept", None, ""), ("u2", "removed", "u1", ""), ("u3", "dropped", None, ""), ("u4", "dropped", None, ""), ("zz", "kept", None, "id_not_in_input"), ("yy", "removed", "u9", "id_not_in_input,target_not_in_input")]))
def dedupe_report(spark, sf_dir):
    items = spark.createDataFrame([(i.rstrip("/"),) for i, _ in _ITEMS], "id string")
    return rerank.dedupe_report(items, spark.createDataFrame(_ANSWER, _ANSWER_SCHEMA))


@fixture(literal("cluster VARCHAR, n BIGINT, kept VARCHAR", [("c1", 2, "u1"), ("c3", 1, None)]))
def cluster_summary(spark, sf_dir):
    members = spark.createDataFrame([("c1", "u1"), ("c1", "u2"), ("c3", "u4")], "cluster string, id string")
    return rerank.clusters(spark.createDataFrame(_ANSWER, _ANSWER_SCHEMA), members)


# --- translations ---

_FULL = [("1", "https://x/a/", "orig1"), ("2", "https://x/b#f", "orig2"), ("3", "https://x/c", "orig3"), ("4", "https://x/d", "orig4")]
_BATCH = [(1, "1", "", "first"), (2, "1", "", "second"), (3, "", "https://x/b/", "by url"), (4, "3", "", "  ")]


@fixture(literal("id VARCHAR, body VARCHAR, fallback BOOLEAN", [("1", "second", False), ("2", "by url", False), ("3", "single", False), ("4", "orig4", True)]))
def fulltext_results(spark, sf_dir):
    """By id, the last of it; by address; from the single retry; else the original."""
    items = spark.createDataFrame(_FULL, "id string, url string, original string")
    batch = spark.createDataFrame(_BATCH, "seq int, id string, url string, body_ja string")
    single = spark.createDataFrame([("3", "single")], "id string, body_ja string")
    return rerank.translated(items, batch, single, "body_ja").select("id", F.col("out").alias("body"), "fallback")


@fixture(literal("id INTEGER, batch BIGINT", [(1, 0), (2, 0), (3, 1), (4, 2), (5, 3), (6, 3), (7, 4)]))
def fulltext_batches(spark, sf_dir):
    """Two short ones together, a long one alone, and what then stands alone too."""
    rows = spark.createDataFrame([(1, 1, 10), (1, 2, 10), (1, 3, 10), (1, 4, 6000), (1, 5, 5000), (1, 6, 10), (1, 7, 10)], "g int, id int, n int")
    return rerank.pairs_of_short(rows, ["g"], "id", F.col("n")).select("id", "batch")


@fixture(literal("id INTEGER, pos INTEGER, title VARCHAR", [(1, 0, "甲"), (1, 1, "single"), (1, 2, "t2"), (2, 0, "t0")]))
def title_results(spark, sf_dir):
    """By place in the batch, else the single answer, else the title."""
    d = spark.createDataFrame([(1, '{"results": [{"i": 0, "ja": "甲"}, {"i": 2, "ja": ""}]}', 3), (2, None, 1)], "id int, body string, n int")
    by = json_text.by_position(F.from_json("body", "results array<struct<i:int,ja:string>>")["results"], F.col("n"))
    got = d.select("id", F.posexplode(F.coalesce(by, F.array_repeat(F.lit(""), F.col("n")))).alias("pos", "ja"))
    single = spark.createDataFrame([(1, 1, "single")], "id int, pos int, s string")
    return got.join(single, ["id", "pos"], "left").select("id", "pos", F.coalesce(text.nz(F.col("ja")), "s", F.concat(F.lit("t"), F.col("pos").cast("string"))).alias("title"))


@fixture(literal("id INTEGER, body VARCHAR", [(1, "one"), (2, "two"), (3, "")]))
def refilled_bodies(spark, sf_dir):
    """Only rows without a body take the second source's."""
    rows = spark.createDataFrame([(1, "t", "d", "one"), (2, "t", "d", " "), (3, "t", "d", "")], "id int, title string, date string, body string")
    second = spark.createDataFrame([(1, "x", "x", "other"), (2, "T", None, "two"), (3, "x", "x", "")], "id int, title string, date string, body string")
    return scans.refill(rows, second, "id").select("id", F.coalesce(text.nz(F.col("body")), F.lit("")).alias("body"))


# --- sinks ---

_EXPORTED = [("DVB", "題", "t", "2026-05-08T20:00:00+00:00", "u"), ("BBC", " ", "orig", "2026-05-09", None), ("é", None, None, None, "v")]


@fixture(literal("day VARCHAR, source VARCHAR, title VARCHAR, url VARCHAR", [("2026-05-09", "DVB", "題", "u"), ("2026-05-09", "BBC", "orig", ""), ("", "é", "", "v")]))
def csv_exports(spark, sf_dir):
    """Written with a byte-order mark and read back, in the daily order of columns."""
    a = spark.createDataFrame(_EXPORTED, "source string, title_ja string, title string, date string, url string")
    folder = shared_folder(spark, "export")
    sinks.write_csv(sinks.export(a, sinks.DAILY_EXPORT), folder)
    back = spark.read.option("header", True).csv(folder)
    assert back.columns[0].lstrip("﻿") == "発行日"
    return back.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in zip(back.columns, ("day", "source", "title", "url"))])


@query("SELECT count(*) AS n, count(DISTINCT o_orderkey) AS keys, 2 + count(*) FILTER (WHERE o_orderpriority <> '') AS start FROM orders")
def sheet_append(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    folder = shared_folder(spark, "sheet")
    o.filter("o_orderkey % 2 = 0").write.parquet(folder)
    sinks.append_rows(o, o.filter("o_orderkey % 2 <> 0"), folder)
    back = spark.read.schema("o_orderkey long, o_orderpriority string").parquet(folder)
    return back.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("keys")).crossJoin(sinks.start_row(back, "o_orderpriority"))


@fixture(literal("a VARCHAR, b VARCHAR, k VARCHAR, q VARCHAR", [("2026-05-09", "x", "", "")]))
def keep_day_rows(spark, sf_dir):
    rows = spark.createDataFrame([(" 2026-05-09", "x", "a", "key"), ("2026-05-08", "y", "a", "key"), (None, "z", "a", "key")], "a string, b string, k string, q string")
    return sinks.rows_of_day(rows, "a", "2026-05-09", ["a", "b"], ["k"]).select(F.trim("a").alias("a"), "b", "k", "q")


_WRITES = [(i, "x" * n) for i, n in enumerate([10, 10, 10, 100, 5], 1)]


@fixture(literal("chunk BIGINT, first BIGINT, n BIGINT, bytes BIGINT", [(0, 2, 2, 28), (1, 4, 1, 14), (2, 5, 1, 104), (3, 6, 1, 9)]))
def write_plan(spark, sf_dir):
    """Two rows or 100 bytes a write at most; a larger row goes alone."""
    return sinks.write_plan(spark.createDataFrame(_WRITES, "i int, t string"), "i", ["t"], 2, 100)


@fixture(literal("item_id VARCHAR, body VARCHAR", [("a", "x"), ("c", "z")]))
def body_cache(spark, sf_dir):
    folder = shared_folder(spark, "cache")
    sinks.write_cache(spark.createDataFrame([("a", "x"), ("b", " "), ("c", "z"), ("d", None)], "item_id string, body string"), folder)
    return spark.read.schema("item_id string, body string").json(folder)


@fixture(literal("n BIGINT, total BIGINT", [(3, 60)]))
def usage_log(spark, sf_dir):
    folder = shared_folder(spark, "usage")
    for tag, n in (("a", 10), ("b", 20), ("a", 30)):
        sinks.append_usage(spark.createDataFrame([(tag, n)], "tag string, total_token_count int"), folder)
    return spark.read.schema("tag string, total_token_count int").json(folder).agg(F.count(F.lit(1)).alias("n"), F.sum("total_token_count").alias("total"))


_DIGEST = [(1, "DVB", "T 1", "a\nb", "u1", False), (2, "X (Businessプラン限定)", "T2", "c", "u2", False)]
_TIERS = [("BUSINESS", "x@a, bad, y@b"), ("LITE", "z@c")]


@fixture(literal("tier VARCHAR, recipient VARCHAR, subject VARCHAR, html VARCHAR", [
    *[("BUSINESS", r, "【N 2026/5/9】T 1 / T2　他", "<strong>本日のヘッドライン</strong><br>✓ T 1<br>✓ T2<hr><h2>T 1</h2><p>a<br>b</p><a href='u1'>DVB</a><hr><h2>T2</h2><p>c</p><a href='u2'>X (Businessプラン限定)</a>") for r in ("x@a", "y@b")],
    ("LITE", "z@c", "【N 2026/5/9】T 1　他", "<strong>本日のヘッドライン</strong><br>✓ T 1<hr><h2>T 1</h2><p>a<br>b</p><a href='u1'>DVB</a>")]))
def digest_mails(spark, sf_dir):
    items = spark.createDataFrame(_DIGEST, "rn int, source string, title string, summary string, url string, is_region boolean")
    return sinks.digests(items, spark.createDataFrame(_TIERS, "tier string, recipients string"), "2026-05-09", "N")


@fixture(literal("id INTEGER, subject VARCHAR", [(1, "【N 2026/5/9】エーヤワディ関連記事"), (2, "【N 2026/5/9】a b　他"), (3, "【N 2026/5/9】ヘッドライン"), (4, "【N 2026/5/9】a / b　他")]))
def mail_subject_forms(spark, sf_dir):
    rows = spark.createDataFrame([(1, ["a", "b"], True), (2, [" a\n b ", " "], False), (3, [], False), (4, ["a", "b", "c"], False)], "id int, titles array<string>, region boolean")
    return rows.select("id", sinks.subject(F.col("titles"), F.col("region"), F.lit("2026-05-09").cast("date"), "N").alias("subject"))


@fixture(literal("id INTEGER, n INTEGER, first VARCHAR", [(1, 2, "a@x"), (2, 0, None), (3, 3, "a@x")]))
def mail_addresses(spark, sf_dir):
    rows = spark.createDataFrame([(1, " a@x , b, ,c@y", ","), (2, None, ","), (3, "a@x;b@y c@z", r"[,\s;]+")], "id int, t string, sep string")
    a = F.when(F.col("sep") == ",", sinks.addresses(F.col("t"))).otherwise(sinks.addresses(F.col("t"), r"[,\s;]+"))
    return rows.select("id", F.size(a).alias("n"), F.get(a, F.lit(0)).alias("first"))


# --- page layout ---

_NOISE = [(1, "National", True), (2, "Page 3", True), (3, "9 May 2026", True), (4, "These photos show a hall", True), (5, "Hotline 123", True), (6, "The minister said", False), (7, " ", True), (8, None, True), (9, "The head of state met", True)]


@fixture(literal("id INTEGER, noise BOOLEAN", [(r[0], r[2]) for r in _NOISE]))
def pdf_noise(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _NOISE], "id int, t string").select("id", layout.is_noise(F.col("t")).alias("noise"))


_BYLINES = [(1, "text — Name/ABC", True, None, None), (2, "see page 10", False, 10, None), (3, "FROM PAGE 9 x", False, None, 9), (4, None, False, None, None)]


@fixture(literal("id INTEGER, byline BOOLEAN, see INTEGER, come INTEGER", [(r[0], *r[2:]) for r in _BYLINES]))
def pdf_marks(spark, sf_dir):
    t = F.col("t")
    return spark.createDataFrame([r[:2] for r in _BYLINES], "id int, t string").select("id", layout.is_byline(t).alias("byline"), layout.page_reference(t, "SEE PAGE").alias("see"), layout.page_reference(t, "FROM PAGE").alias("come"))


_LINES = [
    # title, then text of its region in two columns, a caption, a byline and what follows it; another title below and its text
    (1, 1, 1, 1, 100.0, 300.0, 300.0, 320.0, "Big Title", 20.0), (1, 2, 1, 2, 100.0, 322.0, 300.0, 342.0, "Goes On", 20.0),
    (1, 3, 2, 1, 100.0, 350.0, 180.0, 360.0, "first", 10.0), (1, 4, 2, 2, 100.0, 362.0, 180.0, 372.0, "second", 10.0), (1, 5, 3, 1, 200.0, 350.0, 290.0, 360.0, "third", 10.0),
    (1, 6, 3, 2, 200.0, 362.0, 290.0, 372.0, "This photo shows", 10.0), (1, 7, 3, 3, 200.0, 374.0, 290.0, 384.0, "end — Name/ABC", 10.0), (1, 8, 3, 4, 200.0, 386.0, 290.0, 396.0, "after", 10.0),
    (1, 9, 4, 1, 100.0, 500.0, 300.0, 520.0, "Other Title", 20.0), (1, 10, 5, 1, 100.0, 530.0, 180.0, 540.0, "other", 10.0),
]
_LINE = "page int, `order` int, block_no int, line_no int, x0 double, y0 double, x1 double, y1 double, text string, max_size double"


def _titles(lines):
    t = layout.reading_order(lines.filter("max_size >= 12.8"), ["page"])
    g = layout.title_groups(t, ["page"])
    names = g.groupBy("page", "island").agg(F.array_join(F.array_sort(F.collect_list(F.struct("rn", "text")))["text"], " ").alias("title"))
    return layout.boxes(g, ["page", "island"]).join(names, ["page", "island"]).withColumnRenamed("island", "title_id")


@fixture(literal("title_id BIGINT, title VARCHAR, y0 DOUBLE, y1 DOUBLE", [(1, "Big Title Goes On", 300.0, 342.0), (2, "Other Title", 500.0, 520.0)]))
def pdf_titles(spark, sf_dir):
    return _titles(spark.createDataFrame(_LINES, _LINE)).select("title_id", "title", "y0", "y1")


@fixture(literal("title_id BIGINT, body VARCHAR", [(1, "first second third end — Name/ABC"), (2, "other")]))
def pdf_regions(spark, sf_dir):
    lines = spark.createDataFrame(_LINES, _LINE)
    r = layout.region_lines(lines, _titles(lines), ["page"], 600.0, 800.0)
    return r.groupBy("title_id").agg(layout.join_wrapped(F.array_sort(F.collect_list(F.struct("rn", "text")))["text"]).alias("body"))


_WRAPPED = [(1, ["a long-", "word and", " soft­ ", "hyphen"], "a longword and softhyphen"), (2, ["", None, "x  y"], "x y"), (3, [], "")]


@fixture(literal("id INTEGER, t VARCHAR", [(r[0], r[2]) for r in _WRAPPED]))
def wrapped_lines(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _WRAPPED], "id int, l array<string>").select("id", layout.join_wrapped(F.col("l")).alias("t"))


_PARTS = [(1, 1, 10.0, 10.0, "a", "body a", 3, None), (1, 1, 50.0, 10.0, "b", "body b", None, None), (1, 3, 10.0, 10.0, "f", "FROM PAGE 1 more a", None, 1), (1, 4, 10.0, 10.0, "g", "from page 2 lost", None, 2)]


@fixture(literal("title VARCHAR, body VARCHAR", [("a", "body a\n\nmore a"), ("b", "body b"), ("g", "from page 2 lost")]))
def pdf_continuations(spark, sf_dir):
    """A fragment without an article that refers to it stays as it is."""
    p = spark.createDataFrame(_PARTS, "day int, page int, y0 double, x0 double, title string, body string, see_page int, from_page int")
    return layout.merge_continuations(p, "day").select("title", "body")


@fixture(literal("id INTEGER, body VARCHAR", [(1, "found one"), (2, "own"), (3, "")]))
def pdf_attach(spark, sf_dir):
    items = spark.createDataFrame([(1, 1, "Minister Meets & Greets", ""), (1, 2, "Minister meets and greets", "own"), (1, 3, "Quite another", "")], "day int, id int, title string, body string")
    found = spark.createDataFrame([(1, 7, "MINISTER MEETS AND GREETS", "found one"), (1, 8, "Weather", "w")], "day int, id int, title string, body string")
    return layout.attach_bodies(items, found, "day").select("id", "body")


@fixture(literal("id INTEGER, title VARCHAR", [(2, "A, B!")]))
def pdf_longest(spark, sf_dir):
    rows = spark.createDataFrame([(1, "a b", "x"), (2, "A, B!", "longer"), (3, "a-b", "longer"), (4, "။", "zzzzzzzzz")], "id int, title string, body string")
    return layout.longest_by_title(rows, "title", "body", "id").select("id", "title")


@fixture("SELECT 'gnlm-pdf:2026-05-09:' || substr(sha1('2026-05-09|T|3|10.0|20.2'), 1, 16) AS key")
def pdf_keys(spark, sf_dir):
    d = spark.createDataFrame([("2026-05-09", "T", 3, 10.0, 20.24)], "d string, t string, p int, x double, y double")
    return d.select(layout.pdf_key(F.col("d").cast("date"), F.col("t"), F.col("p"), F.col("x"), F.col("y")).alias("key"))


# --- limits and settings ---


@fixture(literal("client VARCHAR, id INTEGER, start DOUBLE", [("a", 1, 0.0), ("a", 2, 2.0), ("a", 3, 60.01), ("a", 4, 62.01), ("b", 1, 5.0), ("b", 2, 65.5)]))
def stream_rate(spark, sf_dir):
    """Two requests a minute, two seconds apart; the second client's jitter is half a second at its second request."""
    r = spark.createDataFrame([("a", 1, 0.0, 0.0), ("a", 2, 0.5, 0.0), ("a", 3, 1.0, 0.0), ("a", 4, 61.0, 0.0), ("b", 1, 5.0, 0.0), ("b", 2, 65.0, 0.5)], "client string, id int, ready double, jitter double")
    return rate.limited(r, "client", "ready", 2, 2.0, "jitter").select("client", "id", F.round("start", 4).alias("start"))


@fixture(literal("attempt INTEGER, wait DOUBLE", [(0, 60.5), (1, 120.5), (4, 960.5), (5, 1200.0)]))
def backoff_waits(spark, sf_dir):
    return rate.backoff(spark.createDataFrame([(i, 0.5) for i in (0, 1, 4, 5)], "attempt int, j double"), jitter="j").select("attempt", "wait")


@fixture(literal("name VARCHAR, value VARCHAR", [("n", "5"), ("low", "1"), ("bad", "7"), ("gone", "7"), ("f", "0.5"), ("yes", "True"), ("no", "False"), ("empty", "True"), ("day", "2026-05-09")]))
def settings(spark, sf_dir):
    v = {"n": " 5 ", "low": "-3", "bad": "x", "f": "0.5", "yes": "On", "no": "nah", "empty": "", "day": "2026-05-09"}
    got = [("n", config.number(v, "n", 7)), ("low", config.number(v, "low", 7, 1, 9)), ("bad", config.number(v, "bad", 7, 1, 9)), ("gone", config.number(v, "gone", 7)), ("f", config.number(v, "f", 1.0, kind=float)),
           ("yes", config.flag(v, "yes")), ("no", config.flag(v, "no", True)), ("empty", config.flag(v, "empty", True)), ("day", config.local_today(v["day"]))]
    return spark.createDataFrame([(n, str(x)) for n, x in got], "name string, value string")


# --- texts, dates and predicates ---

_BODIES = [(1, "Photo: x\n  a   b \n\nDVB\n#a #b #c\nCredit: y\nPDF\n— —\nmore", "a b\n\nmore"), (2, "Leave a comment here\nဓာတ်ပုံ: x\n##t", ""), (3, None, ""), (4, "Photograph stays", "Photograph stays")]


@fixture(literal("id INTEGER, body VARCHAR", [(r[0], r[2]) for r in _BODIES]))
def compact_bodies(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _BODIES], "id int, b string").select("id", text.compact_body(F.col("b")).alias("body"))


@fixture(literal("id INTEGER, behind VARCHAR, inside VARCHAR", [(1, "abc", "abc"), (2, "x" * 39 + "\n\n[…本文が長いためここまでを翻訳]", "x" * 23 + "…（本文が長いためここまでを翻訳）"), (3, "", "")]))
def cut_texts(spark, sf_dir):
    rows = spark.createDataFrame([(1, "abc"), (2, "x" * 39 + " " + "y" * 20), (3, None)], "id int, t string")
    return rows.select("id", text.cut_full(F.col("t"), 40).alias("behind"), text.cut_full(F.col("t"), 40, within=True).alias("inside"))


_HELD = [(1, "Data for Myanmar https://A.b/C D", "Data~for~Myanmar https://A.b/C D"), (2, "the New York Times said", "the New~York~Times said"), (3, "A\r\nB", "A\nB"), (4, None, "")]


@fixture(literal("id INTEGER, t VARCHAR", [(i, t.replace("~", "\u00a0")) for i, _, t in _HELD]))
def names_held_together(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _HELD], "id int, t string").select("id", text.held_together(F.col("t")).alias("t"))


_KEYS = [(1, "ＡＢＣ　Kyat・「x」", "abcチャット・x"), (2, "ミンアウン・フライン", "ミンアウンフライン"), (3, "a\tb​c", "ab​c"), (4, None, ""), (5, "ﬁ①", "fi1"), (6, "é", "é")]


@fixture(literal("id INTEGER, k VARCHAR", [(r[0], r[2]) for r in _KEYS]))
def folded_keys(spark, sf_dir):
    """Keys with NFKC and the replacements."""
    return spark.createDataFrame([r[:2] for r in _KEYS], "id int, t string").select("id", text.normalize_key(F.col("t")).alias("k"))


_MARKUP = [(1, "a\nb", "a<br>b", "ab"), (2, "x&nbsp;y z", "x&nbsp;y z", "x y z"), (3, None, "", None)]


@fixture(literal("id INTEGER, br VARCHAR, visible VARCHAR", [(r[0], *r[2:]) for r in _MARKUP]))
def markup_texts(spark, sf_dir):
    t = F.col("t")
    return spark.createDataFrame([r[:2] for r in _MARKUP], "id int, t string").select("id", text.as_html_lines(t).alias("br"), text.without_category_c(t).alias("visible"))


@fixture(literal("id INTEGER, t VARCHAR", [(1, "Ooredoo Myanmar\u00a0社"), (2, "a b"), (3, "�x")]))
def boundary_blanks(spark, sf_dir):
    rows = spark.createDataFrame([(1, "Ooredoo Myanmar 社".encode()), (2, b"a b"), (3, b"\xffx")], "id int, b binary")
    return rows.select("id", text.latin_before_cjk(text.payload_text(F.col("b"))).alias("t"))


_AMOUNTS = [(1, "ကျပ် ၅၀", "ကျပ် ၅၀"), (2, "၅,၀၀၀ သိန်း ကျပ် ကျော် နှင့် ကျပ် ၁", "၅,၀၀၀ သိန်း ကျပ် ကျော်"), (3, "ကျပ် များ", ""), (4, None, "")]


@fixture(literal("id INTEGER, hit VARCHAR", [(r[0], r[2]) for r in _AMOUNTS]))
def kyat_hits(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _AMOUNTS], "id int, t string").select("id", amounts.kyat_amount(F.col("t")).alias("hit"))


_QUEUE = [(1, "u", "nothing", ""), (2, "u", "keyword", ""), (3, "v", "keyword", ""), (4, "w", "plain", "bypass")]


@fixture(literal("id INTEGER", [(3,), (4,)]))
def enqueued(spark, sf_dir):
    """An address is taken once and then judged: its second article is not seen, though it has the keyword."""
    q = spark.createDataFrame(_QUEUE, "id int, url string, title string, source string")
    return dedupe.first_wins(q, F.col("url"), ["id"]).filter((F.col("source") == "bypass") | F.contains("title", F.lit("keyword"))).select("id")


@fixture(literal("k VARCHAR, bundle BOOLEAN, model BOOLEAN", [("a", True, True), ("A", False, True), (" a ", False, True), ("", False, False)]))
def adopted_flags(spark, sf_dir):
    k = F.col("k")
    return spark.createDataFrame([("a",), ("A",), (" a ",), ("",)], "k string").select("k", (k == "a").alias("bundle"), (F.lower(F.trim("k")) == "a").alias("model"))


@fixture(literal("id INTEGER, official BOOLEAN", [(1, True), (2, True), (3, False), (4, False)]))
def official_sources(spark, sf_dir):
    s = spark.createDataFrame([(1, " GNLM "), (2, "Ｎｅｗｓ  Eleven"), (3, "DVB"), (4, None)], "id int, s string")
    return s.select("id", terminology.official(F.col("s")).alias("official"))


@query("SELECT url FROM (SELECT DISTINCT regexp_replace(url, '[?#].*$', '') AS url FROM pages) ORDER BY url")
def url_union(spark, sf_dir):
    """Addresses of two overlapping lists, each once, in order."""
    p = table(spark, sf_dir, "pages").select(F.regexp_replace("url", r"[?#].*$", "").alias("url"))
    return p.union(p).distinct().orderBy("url")


@query("SELECT source_table, count(*) AS n FROM (SELECT 'archive' AS source_table FROM benchmark UNION ALL SELECT 'local' FROM labels WHERE quality = 1) GROUP BY 1")
def context_union(spark, sf_dir):
    """Archive and locally adopted rows together, for contexts only."""
    a = table(spark, sf_dir, "benchmark").select(F.lit("archive").alias("source_table"), F.col("item_id").alias("id"))
    b = table(spark, sf_dir, "labels").filter("quality = 1").select(F.lit("local").alias("source_table"), F.col("doc_id").alias("id"))
    return a.unionByName(b).groupBy("source_table").agg(F.count(F.lit(1)).alias("n"))


@fixture(literal("id INTEGER, labels VARCHAR", [(1, "2,209|2209|5"), (2, "")]))
def longest_first(spark, sf_dir):
    """Literals in the order in which they are replaced: longest first, then by text."""
    rows = spark.createDataFrame([(1, ["5", "2209", "2,209"]), (2, [])], "id int, l array<string>")
    order = F.array_sort("l", lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    return rows.select("id", F.array_join(order, "|").alias("labels"))


_DATES = [
    (1, "2026/5/9", "20260509"), (2, "2026年5月9日", "20260509"), (3, "2026-02-30", ""), (4, "20260509xyz", "20260509"), (5, "abc", ""), (6, "", ""), (7, None, ""), (8, "2026.13.1", ""), (9, "99999999", ""),
]


@fixture(literal("id INTEGER, k VARCHAR", [(r[0], r[2]) for r in _DATES]))
def hostile_date_keys(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _DATES], "id int, t string").select("id", dates.date_key(F.coalesce("t", F.lit(""))).alias("k"))


_FEED = [(1, "Sat, 09 May 2026 20:00:00 +0000", "2026-05-10"), (2, "09 May 2026 10:00:00 GMT", "2026-05-09"), (3, "Sat, 09 May 2026 01:00:00 +0630", "2026-05-09"), (4, "yesterday", None), (5, None, None)]


@fixture(literal("id INTEGER, day DATE", [(r[0], r[2]) for r in _FEED]))
def hostile_feed_dates(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _FEED], "id int, t string").select("id", dates.feed_date(F.col("t")).alias("day"))


@fixture(literal("id INTEGER, day DATE", [(1, "2026-05-01"), (2, "2026-05-02"), (3, "2026-05-09")]))
def backfilled_dates(spark, sf_dir):
    """An article's own date, else its page's, else the digest's."""
    rows = spark.createDataFrame([(1, "2026-05-01", "2026-05-02"), (2, None, "2026-05-02T10:00:00+06:30"), (3, "", None)], "id int, d string, meta string")
    own = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", dates.iso_local_date(F.col(c)))
    return rows.select("id", F.coalesce(own("d"), own("meta"), F.lit("2026-05-09").cast("date")).alias("day"))


_LENIENT = [(1, '```json\n{"k": 1}\n```', 1), (2, 'Here: {"k": 2} done', 2), (3, '{"k": "3"}', None), (4, "{bad", None), (5, None, None), (6, '{"k": 4}', 4), (7, "[1]", None)]


@fixture(literal("id INTEGER, k BIGINT", [(r[0], r[2]) for r in _LENIENT]))
def hostile_json(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _LENIENT], "id int, t string").select("id", json_text.lenient(F.col("t"), "k long")["k"].alias("k"))


_CACHES = [("new", '[{"item_id": "1", "url": "https://x/a/", "body": "one"}, {"item_id": "1", "url": "https://x/a", "body": "two"}, {"item_id": "", "url": "https://x/b", "body": " "}]'), ("old", '{"https://x/c": {"title": "t", "body": "three"}}'), ("bad", "{nothing"), ("text", "x")]


@fixture(literal("file VARCHAR, pos INTEGER, url VARCHAR, body VARCHAR", [("new", 0, "https://x/a/", "one"), ("new", 1, "https://x/a", "two"), ("new", 2, "https://x/b", " "), ("old", 0, "https://x/c", "three")]))
def cache_forms(spark, sf_dir):
    return feeds.cache_entries(spark.createDataFrame(_CACHES, "file string, body string")).select("file", "pos", "url", "body")


@fixture(literal("id VARCHAR, body VARCHAR, cached BOOLEAN", [("1", "one", True), ("9", "two", True), ("3", "fetched", False), ("4", "", False)]))
def cached_bodies(spark, sf_dir):
    """The first entry of an id, the last of an address, else what is fetched; blank bodies are never taken."""
    cache = feeds.cache_entries(spark.createDataFrame(_CACHES[:1], "file string, body string"))
    wanted = spark.createDataFrame([("1", "https://x/none"), ("9", "https://x/a#f"), ("3", "https://x/b"), ("4", "https://x/d")], "id string, url string")
    fetched = spark.createDataFrame([("https://x/b", "fetched"), ("https://x/d", " ")], "url string, body string")
    return feeds.read_through(wanted, cache, fetched).select("id", "body", "cached")


_SECTIONED = [(1, '<ul class="td-category"><li class="entry-category"><a href="/m">Movies</a></li></ul>', "Movies", False), (2, '<ul class="td-category"><a href="/category/whim/x">W</a></ul><div class="entry-category"><a href="/en/category/Whim">w</a></div>', "W", True),
              (3, '<script type="application/ld+json">{"@type": "Article", "articleSection": ["News", "Doh  Athan"]}</script>', "", True), (4, None, "", False)]


@fixture(literal("id INTEGER, category VARCHAR, excluded BOOLEAN", [(r[0], *r[2:]) for r in _SECTIONED]))
def page_sections(spark, sf_dir):
    h = F.col("html")
    return spark.createDataFrame([r[:2] for r in _SECTIONED], "id int, html string").select("id", sites.category(h).alias("category"), sites.in_section(h, ("doh athan", "whim"), ("doh-athan", "whim")).alias("excluded"))


@fixture(literal("id INTEGER, t VARCHAR", [(1, "text"), (2, "a  b"), (3, None)]))
def noise_phrases(spark, sf_dir):
    rows = spark.createDataFrame([(1, " text BBC  Burmese"), (2, "a bbc burmese b"), (3, None)], "id int, t string")
    return rows.select("id", terminology.without_phrases(F.col("t"), [r"BBC\s*Burmese"]).alias("t"))


@query("SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'")
def entries_of_day(spark, sf_dir):
    return scans.on_day(table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("d")), "d", "2024-01-05").select("event_id")


@fixture(literal("id INTEGER, rules VARCHAR", [(1, "title:\n- Bago => Bago City\nbody:\n- က => か\n- Bago => バゴー"), (2, "")]))
def prompt_rules(spark, sf_dir):
    """Terms of a glossary that an article has, as rules for its title and body."""
    g = spark.createDataFrame([("က", "", "か", ""), ("", "Bago", "バゴー", "Bago City")], "mm string, en string, body_ja string, title_ja string")
    a = spark.createDataFrame([(1, "in bago", "က and BAGO"), (2, "x", None)], "id int, title string, body string")
    return prompts.rules(a, g, "id").select("id", "rules")


_NFKC = [(1, "ﬁ①Ａ", "fi1A"), (2, "é", "é"), (3, "㌔", "キロ"), (4, "　", " "), (5, None, None), (6, "😀", "😀")]


@fixture(literal("id INTEGER, t VARCHAR", [(r[0], r[2]) for r in _NFKC]))
def nfkc_forms(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _NFKC], "id int, t string").select("id", text.nfkc("t").alias("t"))


@fixture(literal("id INTEGER, kind VARCHAR", [(1, "kept"), (2, "cut")]))
def stored_results(spark, sf_dir):
    """A result stored in a cell is cut where the cell ends, even inside its JSON."""
    rows = spark.createDataFrame([(1, '{"gemini_score": 1}'), (2, '{"gemini_score": 2, "reasons": ["' + "x" * 100 + '"]}')], "id int, j string")
    stored = F.substring(F.to_json(responses.second_score(F.col("j"))), 1, 600)
    whole = F.to_json(responses.second_score(F.col("j")))
    return rows.select("id", F.when(F.length(stored) < F.length(whole), "cut").otherwise("kept").alias("kind"))
