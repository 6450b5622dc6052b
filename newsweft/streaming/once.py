"""Sinks that a failed or repeated micro-batch can't disturb, and rows that come too late.

A batch is written to a folder of its own, which a second try overwrites, and
then noted in a ledger beside the target. Readers take the batches of the ledger,
so what a failed batch left behind is never seen, and no batch reads the target.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LEDGER = "batch long, high timestamp"


def _note(spark: SparkSession, target: str, batch: int, high: object = None) -> None:
    spark.createDataFrame([(batch, high)], _LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{target}.ledger/b={batch}")


def write_batch(df: DataFrame, batch: int, target: str, high: object = None) -> None:
    df.write.mode("overwrite").parquet(f"{target}/batch={batch}")
    _note(df.sparkSession, target, batch, high)


def committed(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """Rows of all batches that are noted, with ``batch``; none before the first."""
    try:
        noted = spark.read.schema(_LEDGER).parquet(f"{target}.ledger").select("batch")
        rows = spark.read.schema(T.StructType([*like.schema.fields, T.StructField("batch", T.LongType())])).parquet(target)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return like.limit(0).withColumn("batch", F.lit(None).cast("long"))
    return rows.join(noted, "batch", "left_semi").select(*like.columns, "batch")


def run(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Work off what is there, from where the checkpoint stands."""
    stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_once(stream: DataFrame, key: str, ts: str, late: str, target: str, checkpoint: str) -> None:
    """Append each key once, of repeats within ``late`` of each other the first; a batch that runs again replaces itself.

    The keys that were seen are state that the watermark clears; rows without a
    key are one key, rows behind the watermark are left out (``late_rows`` keeps them).
    """
    fresh = stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
    run(fresh, lambda df, i: write_batch(df, i, target), checkpoint)


def late_rows(stream: DataFrame, ts: str, late: str, target: str, checkpoint: str) -> None:
    """Keep the rows that are older than the latest time of all batches before theirs less ``late``, as a watermark of that delay sees them.

    The ledger carries the latest time, so a batch reads the one entry before its own.
    """

    def batch(df: DataFrame, i: int) -> None:
        spark = df.sparkSession
        before = spark.read.schema(_LEDGER).parquet(f"{target}.ledger/b={i - 1}").first()["high"] if i else None
        behind = F.coalesce(F.col(ts) < F.lit(before) - F.expr(f"INTERVAL {late}"), F.lit(False)) if before is not None else F.lit(False)
        high = df.agg(F.max(ts)).first()[0]
        write_batch(df.filter(behind), i, target, max((x for x in (before, high) if x is not None), default=None))

    run(stream, batch, checkpoint)
