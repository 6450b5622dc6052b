"""Streams with state over the record tables, each run several times from its checkpoint; they equal their batch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_folder
from ..streaming import once, stateful
from .records import cache_upsert, quota_edges_daily
from .registry import ORACLE_SQL, query, table


@query(ORACLE_SQL[cache_upsert.__name__])
def stream_body_cache(spark, sf_dir):
    """Turns arrive in three parts and in no order; the stream is started anew for each."""
    c = table(spark, sf_dir, "conversations")
    body = F.when(F.col("turn") % 3 != 2, F.col("text")).otherwise("")
    rows = c.select(F.concat("role", F.lit("|"), F.col("conv_id").cast("string")).alias("url"), F.lit("").alias("item"), F.col("turn").cast("long").alias("turn"), body.alias("body"))
    source, target, offsets = (shared_folder(spark, n) for n in ("turns", "entries", "offsets"))
    like = spark.createDataFrame([], "address string, id string, position long, body string")
    for part in range(3):
        rows.filter(F.pmod(F.xxhash64("url", "turn"), F.lit(3)) == part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        once.run(stateful.body_cache(stream, "item", "url", "turn", ["body"]), lambda df, i: once.write_batch(df, i, target), offsets, "update")
    entries = stateful.latest_entries(once.committed(spark, target, like))
    named = F.split("address", "\\|")
    return entries.select(named[0].alias("role"), named[1].cast(c.schema["conv_id"].dataType).alias("conv_id"), "body", F.col("position").cast(c.schema["turn"].dataType).alias("position"))


@query(f"SELECT q.*, m.per_minute FROM ({ORACLE_SQL[quota_edges_daily.__name__]}) q JOIN (SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW) AS per_minute FROM events) m USING (event_id)")
def stream_quota(spark, sf_dir):
    """Events arrive up to a day late, in three parts; one far ahead ends the stream, as time only moves with events."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    first, last = e.agg(F.min("ts"), F.max("ts")).first()
    # A row's part is that of its time and up to a day.
    seen = F.unix_seconds("ts") + F.pmod(F.xxhash64("event_id"), F.lit(86_400))
    start = F.unix_seconds(F.lit(first))
    part = F.expr("least(2, greatest(0, CAST(3 * p AS INT)))")
    rows = e.withColumn("p", (seen - start) / (F.unix_seconds(F.lit(last)) - start + 1)).withColumn("part", part).drop("p")
    end = e.limit(0).unionByName(spark.createDataFrame([(None, None, last)], e.schema).withColumn("ts", F.col("ts") + F.expr("INTERVAL 10 DAYS")).withColumn("event_id", F.lit(-1).cast(e.schema["event_id"].dataType)))
    source, target, offsets = (shared_folder(spark, n) for n in ("events", "quota", "offsets"))
    like = spark.createDataFrame([], "event long, at long, day long, ordinal long, over boolean, notify boolean, per_minute long, busy boolean, warn boolean")
    for k in range(4):
        (rows.filter(F.col("part") == k).drop("part") if k < 3 else end).write.mode("append").parquet(source)
        stream = spark.readStream.schema(e.schema).parquet(source)
        once.run(stateful.quota(stream, "user_id", "event_id", "ts", "2 days", 2, 60), lambda df, i: once.write_batch(df, i, target), offsets)
    out = once.committed(spark, target, like).filter("event >= 0")
    return out.select(F.col("event").alias("event_id"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("day").cast("int")).alias("day"), "ordinal", "over", "notify", "per_minute")


@query("SELECT event_type, count(*) AS n, 0::BIGINT AS late FROM events GROUP BY event_type")
def stream_append_once(spark, sf_dir):
    """Every event is delivered twice, in two parts, and stored once; rows behind the watermark go to a table of their own."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    source, target, side, offsets, more = (shared_folder(spark, n) for n in ("events", "stored", "late", "offsets", "offsets-late"))
    span = "3650 days"
    for _ in range(2):
        e.write.mode("append").parquet(source)
        stream = spark.readStream.schema(e.schema).parquet(source)
        once.append_once(stream, "event_id", "ts", span, target, offsets)
        once.late_rows(stream, "ts", span, side, more)
    late = once.committed(spark, side, e).groupBy("event_type").agg(F.count(F.lit(1)).alias("late"))
    n = once.committed(spark, target, e).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return n.join(late, "event_type", "left").select("event_type", "n", F.coalesce("late", F.lit(0).cast("long")).alias("late"))
