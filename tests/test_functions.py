"""Golden values of the scalar functions and sequential operators."""

import pytest
from pyspark.sql import functions as F

from newsweft.functions import dates, numbers, text, urls
from newsweft.operators import cutting, dedupe, joins, similarity, windows


def values(spark, rows, expr, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.select(expr(F.col("v")).alias("x"), "i").orderBy("i").select("x").collect()]


@pytest.mark.parametrize("n, want", [(21060000000, "210億6000万円"), (987654321, "9億8765万4321円"), (0, "0円")])
def test_yen(spark, n, want):
    assert values(spark, [n], numbers.format_yen, "long") == [want]


def test_kyat(spark):
    assert values(spark, [12345, 9999, 0, 1234567890000], numbers.format_kyat, "long") == ["1万チャット", "9999チャット", "", "1兆2345億6789万チャット"]
    assert values(spark, ["1兆2345億6789万チャット", "万1億チャット", "", None], numbers.parse_kyat) == [1234567890000, None, None, None]


def test_rounding_and_scores(spark):
    assert values(spark, ["0.5", "1.5", "2.5"], numbers.safe_int) == [0, 2, 2]
    assert values(spark, ["", "x", "101", "-3", "49.5", None], numbers.clamp_score) == [0, 0, 100, 0, 50, 0]


def test_dates(spark):
    assert [str(x) if x else None for x in values(spark, [45000.0, 9999.0, 80001.0, None], dates.serial_date, "double")] == ["2023-03-15", None, None, None]
    assert values(spark, ["2026年5月9日", "2026-02-30", "20260509xyz", "abc", ""], dates.date_key) == ["20260509", "", "20260509", "", ""]
    assert [str(x) for x in values(spark, ["Tue, 05 Mar 2024 20:00:00 GMT", "Tue, 05 Mar 2024 20:00:00 +0630"], dates.feed_date)] == ["2024-03-06", "2024-03-05"]


def test_text(spark):
    assert values(spark, ["a #tag b#c"], text.drop_hashtags) == ["a  b#c"]
    assert values(spark, ["　 a  b ", None], lambda c: text.squeeze(text.text(c))) == ["a b", ""]
    assert values(spark, ["x【M】y【M】z", "none"], lambda c: text.replace_after_first(c, "【M】", "Full", "F")) == ["xFullyFz", "none"]
    assert values(spark, ["ab", "abc", "", None], text.grams) == [[], ["abc"], [], []]
    assert values(spark, ["x" * 30, "short"], lambda c: text.clip_cell(c, 20, "..")) == ["x" * 18 + "..", "short"]


def test_urls(spark):
    assert values(spark, ["http://x/a//", "https://h:8/p/?q#f", ""], urls.canonical) == ["http://x/a", "https://h:8/p", ""]
    assert values(spark, ["https://x.org/2024/hello-big-world.html?x"], urls.slug_title) == ["Hello Big World"]
    df = spark.createDataFrame([("https://a.b/c/d", "/x"), ("https://a.b/c/d", "e"), ("https://a.b/c/d", "//z/y")], "b string, l string")
    assert [r[0] for r in df.select(urls.absolute(F.col("b"), F.col("l"))).collect()] == ["https://a.b/x", "https://a.b/c/e", "https://z/y"]


def test_dedupe_blank_keys(spark):
    df = spark.createDataFrame([(1, ""), (2, ""), (3, "a"), (4, "a"), (5, None)], "i int, k string")
    ids = lambda keep: sorted(r.i for r in dedupe.first_wins(df, F.col("k"), ["i"], keep).collect())
    assert ids(True) == [1, 3]
    assert ids(False) == [3]
    assert dedupe.first_wins(df.limit(0), F.col("k"), ["i"]).count() == 0


def test_chunks(spark):
    df = spark.createDataFrame([("a", i, 10) for i in range(7)] + [("b", 0, 500), ("b", 1, 1)], "g string, i int, n int")
    got = {(r.g, r.i): r.chunk for r in cutting.greedy_chunks(df, ["g"], ["i"], "n", 3, 100).collect()}
    assert [got["a", i] for i in range(7)] == [0, 0, 0, 1, 1, 1, 2]
    assert (got["b", 0], got["b", 1]) == (0, 1)


def test_rolling_edges(spark):
    df = spark.sql("SELECT 1 AS u, timestamp'2024-01-01 00:00:00' AS ts, 1L AS v UNION ALL SELECT 1, timestamp'2024-01-01 00:01:00', 2L")
    last = lambda closed: [r.n for r in windows.rolling(df, ["u"], "ts", 60, "v", closed).orderBy("ts").collect()][-1]
    assert (last(True), last(False)) == (2, 1)


def test_components(spark):
    edges = spark.createDataFrame([(2, 3), (3, 4), (4, 5), (9, 9), (20, 21)], "a long, b long")
    got = {r.node: (r.component, r.label) for r in similarity.duplicate_labels(similarity.components(edges, "a", "b")).collect()}
    assert got == {2: (2, "重複001"), 3: (2, "重複001"), 4: (2, "重複001"), 5: (2, "重複001"), 20: (20, "重複002"), 21: (20, "重複002")}


def test_keep_or_all(spark):
    df = spark.createDataFrame([(1, False), (2, True), (3, False)], "id int, ex boolean")
    run = lambda ids: sorted(r.id for r in joins.keep_or_all(df, spark.createDataFrame([(i,) for i in ids], "id int"), "id", F.col("ex")).collect())
    assert run([3]) == [2, 3]
    assert run([]) == [1, 2, 3]


def test_amounts(spark):
    from newsweft.functions import amounts

    assert values(spark, ["計100億チャット（約1円）です", "10億ドル（約390億円）", None], lambda c: amounts.drop_foreign_yen(amounts.fix_yen(c))) == ["計100億チャット（約3億7000万円）です", "10億ドル", None]
    assert values(spark, ["ကျပ် ၁၂ဒသမ၅ သန်း"], amounts.normalize_amount_text) == ["ကျပ် 12.5 သန်း"]
    got = values(spark, ["ကျပ် 12.5 သန်း", "12 သန်း people", None], amounts.amount_facts)
    assert [[(f.raw, f.ja) for f in x] for x in got] == [[("12.5 သန်း", "1250万チャット（約46万2500円）")], [], []]


def test_html_and_json(spark):
    from newsweft.functions import html, json_text

    page = "<title>T | S</title><nav><a href='/m'>m</a></nav><article><h1>Head</h1><p>One<p>Two<div class=ad><p>Buy</p></div><p>Two</p><p>Three</article>"
    assert html.parse(page, frozenset({"ad"})) == {"title": "Head", "description": None, "published": None, "paragraphs": ["One", "Two", "Three"], "links": ["/m"]}
    assert html.parse(None, frozenset())["paragraphs"] == []
    assert values(spark, ['```json\n{"k": 1}\n```', 'so {"k": 2} ok', "none", None], lambda c: json_text.lenient(c, "k int")["k"]) == [1, 2, None, None]


def test_layout(spark):
    from newsweft.operators import layout

    pairs = spark.createDataFrame([("d", 1, 10, 0.9), ("d", 1, 11, 0.8), ("d", 2, 10, 0.95), ("d", 2, 11, 0.77), ("d", 3, 12, 0.5)], "g string, l int, r int, s double")
    assert sorted((r.l, r.r) for r in layout.greedy_match(pairs, "g", "l", "r", "s").collect()) == [(1, 10), (2, 11)]
    assert values(spark, [["a-", "b", "c"]], layout.join_wrapped, "array<string>") == ["ab c"]
