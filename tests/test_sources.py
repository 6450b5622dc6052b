"""Sources, sinks and streams end to end on temporary folders."""

from pyspark.sql import functions as F

from newsweft.sources import feeds, sinks
from newsweft.streaming import incremental


def test_payload_choice(spark):
    rows = [("u", 1, 1, 200, "Just a moment..."), ("u", 1, 2, 503, "x"), ("u", 2, 1, 200, "good"), ("u", 3, 1, 200, "late"), ("v", 1, 1, 200, " "), (None, 1, 1, 200, "n")]
    f = spark.createDataFrame(rows, "url string, stage_rank int, attempt int, status int, body string")
    got = {r.url: (r.body, r.stage_rank) for r in feeds.usable_payloads(f, ["url"]).collect()}
    assert got == {"u": ("good", 2), None: ("n", 1)}


def test_rss(spark):
    feed = "<rss><item><title>A &amp; B</title><link>http://x</link><pubDate>Tue, 05 Mar 2024 20:00:00 GMT</pubDate></item><item><title>C</title></item></rss>"
    rows = feeds.rss_items(spark.createDataFrame([("s", feed), ("t", "broken"), ("n", None)], "source string, body string")).orderBy("pos").collect()
    assert [(r.source, r.title, r.link) for r in rows] == [("s", "A & B", "http://x"), ("s", "C", "")]


def test_csv_mark(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame([("ü", 1)], "name string, n int").coalesce(1), str(tmp_path / "c"))
    part = next((tmp_path / "c").glob("part-*"))
    assert part.read_bytes().startswith("﻿name,n".encode())


def test_day_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, day string")
    sinks.overwrite_days(df, str(tmp_path / "d"), "day")
    sinks.overwrite_days(df.filter("day = 'b'").withColumn("i", F.lit(9)), str(tmp_path / "d"), "day")
    assert sorted((r.i, r.day) for r in spark.read.parquet(str(tmp_path / "d")).collect()) == [(1, "a"), (9, "b")]


def test_append_is_idempotent(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    like = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    like.coalesce(1).write.parquet(src)
    for c in ("c1", "c2"):
        incremental.append_new(incremental.file_stream(spark, src, "*.parquet", like), "k", out, str(tmp_path / c))
    assert spark.read.parquet(out).count() == 2


def test_combined_pdf(spark):
    import io
    import re

    from newsweft.sources import pdf

    long = "long text " * 900
    d = spark.createDataFrame([(2, "二", "DVB", "2026-05-09", long, "https://x/(b)"), (1, "題 Title", None, None, "本文\nline", None), (3, None, None, None, None, None)], "n int, title string, source string, date string, body string, url string")
    out = io.BytesIO()
    n = pdf.combined(d, "n", out)
    data = out.getvalue()
    assert n == len(re.findall(rb"/Type /Page /", data)) > 4 and data.startswith(b"%PDF") and data.endswith(b"%%EOF\n")
    shown = [bytes.fromhex(x.decode()).decode("utf-16-be") for x in re.findall(rb"<([0-9a-f]+)> Tj", data)]
    assert shown[:3] == ["題 Title", "本文", "line"] and " ".join(shown[5:-1]).split() == long.split() and b"(https://x/%28b%29)" in data
    start = int(re.search(rb"startxref\n(\d+)", data)[1])
    for k, at in enumerate(re.findall(rb"(\d{10}) 00000 n", data[start:]), 1):
        assert data[int(at) :].startswith(b"%d 0 obj" % k)
    assert pdf.render([], io.BytesIO()) == 1
    assert all(sum(pdf.advance(c) for c in x) * 10 <= 100 for x in pdf.wrapped("word 漢字漢字漢字漢字漢字漢字 unbreakablewordthatislong x", 10, 100))
