"""Streams with state: restarts, failed batches, late rows, and the cache's rules by a plain loop."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from newsweft.streaming import once, stateful

ENTRIES = "address string, id string, position long, title string, body string"


def cache_by_hand(rows):
    """Rows in order of seq; keys are (address, id)."""
    entries = {}
    for seq, item, url, title, body in sorted(rows, key=lambda r: r[0]):
        item = (item or "").strip()
        address = (url or "").strip().rstrip("/") or (item and "id:" + item)
        if not address:
            continue
        own = [k for k in entries if k[0] == address]
        key = (address, item) if item or not own else min(own, key=lambda k: entries[k][0])
        e = entries.setdefault(key, [seq, None, None])
        e[1], e[2] = title or e[1], body or e[2]
    return {(a, i, *e) for (a, i), e in entries.items()}


def test_body_cache_in_order(spark, tmp_path):
    r = random.Random(2)
    rows = [(k, r.choice([None, "", " ", "a", "b", "c"]), r.choice(["http://x/1", "http://x/1/", " http://x/2", None, ""]), r.choice([None, "", f"t{k}"]), r.choice([None, "", f"b{k}"])) for k in range(60)]
    schema = "seq long, item string, url string, title string, body string"
    for part in range(3):
        spark.createDataFrame(rows[part * 20 : part * 20 + 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        once.run(stateful.body_cache(stream, "item", "url", "seq", ["title", "body"]), lambda df, i: once.write_batch(df, i, str(tmp_path / "out")), str(tmp_path / "cp"), "update")
    got = stateful.latest_entries(once.committed(spark, str(tmp_path / "out"), spark.createDataFrame([], ENTRIES)))
    assert {tuple(x) for x in got.collect()} == cache_by_hand(rows)


def test_quota_orders_late_events_and_frees_state(spark, tmp_path):
    """Events of several days in any order within the delay: the same as counting them in order."""
    r = random.Random(4)
    day0 = datetime.datetime(2024, 3, 1, 12)
    events = [(i, r.choice("uv"), day0 + datetime.timedelta(seconds=r.randint(0, 3 * 86_400))) for i in range(60)]
    events += [(100 + i, "u", day0 + datetime.timedelta(seconds=i)) for i in range(6)]  # a busy minute
    order = sorted(events, key=lambda e: e[2] + datetime.timedelta(seconds=r.randint(0, 7000)))
    schema = "event long, who string, ts timestamp"
    parts = [order[:20], order[20:45], order[45:], [(-1, None, day0 + datetime.timedelta(days=20))]]
    for p in parts:
        spark.createDataFrame(p, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        once.run(stateful.quota(stream, "who", "event", "ts", "2 hours", 3, 4), lambda df, i: once.write_batch(df, i, str(tmp_path / "out")), str(tmp_path / "cp"))
    like = spark.createDataFrame([], "event long, day long, ordinal long, over boolean, notify boolean, per_minute long, busy boolean, warn boolean")
    got = {x.event: tuple(x)[1:8] for x in once.committed(spark, str(tmp_path / "out"), like).collect()}
    want = {}
    for who in "uv":
        own = sorted((t, e) for e, w, t in events if w == who)
        days, busy = {}, False
        for k, (t, e) in enumerate(own):
            d = (t + datetime.timedelta(minutes=390)).date()
            days[d] = days.get(d, 0) + 1
            minute = sum(1 for s, _ in own[: k + 1] if s >= t - datetime.timedelta(seconds=60))
            was, busy = busy, minute > 4
            want[e] = ((d - datetime.date(1970, 1, 1)).days, days[d], days[d] > 3, days[d] == 4, minute, busy, busy and not was)
    assert got == want and any(w[6] for w in want.values())


def test_failed_batch_is_seen_once(spark, tmp_path, monkeypatch):
    """A batch that is written but not noted is invisible, and its second run replaces it."""
    df = spark.createDataFrame([(i % 7, datetime.datetime(2024, 1, 1, i % 20)) for i in range(30)], "k long, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    go = lambda: once.append_once(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "k", "ts", "30 days", str(tmp_path / "out"), str(tmp_path / "cp"))
    seen = lambda: sorted(r.k for r in once.committed(spark, str(tmp_path / "out"), df).collect())

    def broken(*_):
        raise OSError("the driver is lost here")

    with monkeypatch.context() as m:
        m.setattr(once, "_note", broken)
        with pytest.raises(Exception, match="lost here"):
            go()
    assert seen() == [] and spark.read.parquet(str(tmp_path / "out")).count() == 7
    go()
    assert seen() == list(range(7))
    df.filter("k < 3").write.mode("append").parquet(str(tmp_path / "in"))
    spark.createDataFrame([(9, datetime.datetime(2024, 1, 2))], df.schema).write.mode("append").parquet(str(tmp_path / "in"))
    go()
    assert seen() == [*range(7), 9]


def test_late_rows_are_kept(spark, tmp_path):
    t = lambda h: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)
    batches = [[(1, t(10)), (2, t(1))], [(3, t(9)), (4, t(2)), (5, t(30)), (6, None)], [(7, t(27)), (8, t(29))]]
    schema = "k long, ts timestamp"
    out = str(tmp_path / "late")
    like = spark.createDataFrame([], schema)
    assert once.committed(spark, out, like).count() == 0
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        once.late_rows(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "ts", "2 hours", out, str(tmp_path / "cp"))
    assert sorted(r.k for r in once.committed(spark, out, like).filter(F.col("batch").isNotNull()).collect()) == [4, 7]
