"""Structured Streaming: idempotent appends and windowed counts; both run as micro-batches that end when input does."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, folder: str, glob: str, like: DataFrame) -> DataFrame:
    return spark.readStream.schema(like.schema).option("pathGlobFilter", glob).parquet(folder)


def append_new(stream: DataFrame, key: str, target: str, checkpoint: str) -> None:
    """Append rows whose key the target doesn't hold; a batch that is run again adds nothing. Rows without a key are not stored.

    Of the target only files within the batch's range of keys are read.
    """

    def batch(df: DataFrame, _: int) -> None:
        spark, new = df.sparkSession, df.filter(F.col(key).isNotNull()).dropDuplicates([key])
        low, high = new.agg(F.min(key), F.max(key)).first()
        if low is None:
            return
        try:
            known = spark.read.schema(df.schema).parquet(target).filter(F.col(key).between(low, high)).select(key)
        except Exception as e:  # nothing is there before the first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
            known = None
        (new if known is None else new.join(known, key, "left_anti")).write.mode("append").parquet(target)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(stream: DataFrame, ts: str, by: list[str], width: str, late: str, target: str, checkpoint: str) -> None:
    """Counts of tumbling windows; rows later than ``late`` are dropped; the target holds every window's latest count."""
    counts = stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    flat = counts.select(F.col("w.start").alias("start"), *by, "n")

    def batch(df: DataFrame, i: int) -> None:
        df.withColumn("batch", F.lit(i)).write.mode("append").parquet(target)

    flat.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest(updates: DataFrame, by: list[str]) -> DataFrame:
    return updates.groupBy(*by).agg(F.max_by("n", "batch").alias("n"))
