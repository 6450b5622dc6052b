"""Window and sequential operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .joins import small

SALTS = 16
#: Length of a time range in lengths of the window that looks back.
RANGES = 24


def time_ranges(df: DataFrame, at: str, reach: int, width: int) -> DataFrame:
    """``_range`` of ``width`` microseconds, and ``_halo``: rows that reach into the next range are there again, marked.

    With the range beside the group, a window that looks back ``reach`` microseconds
    finds all it needs, however many rows one group has.
    """
    width = max(width, reach)
    own = F.floor(F.col(at) / width).cast("long")
    near = F.pmod(F.col(at), F.lit(width)) >= width - reach
    copies = F.when(near, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_halo", F.explode(copies)).withColumn("_range", own + F.col("_halo"))


def rolling(df: DataFrame, by: list[str], ts: str, seconds: int, value: str, closed: bool = True, ranges: int = RANGES) -> DataFrame:
    """``n`` and ``total`` of the last ``seconds``: [t-s, t] if closed, (t-s, t] if not; microsecond times.

    A group is spread over time ranges of ``ranges`` times ``seconds``. Rows
    without a time are counted among themselves.
    """
    reach = seconds * 1_000_000
    dealt = time_ranges(df.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp"))), "_at", reach, reach * ranges)
    w = Window.partitionBy(*by, "_range").orderBy("_at").rangeBetween(-reach + (0 if closed else 1), 0)
    counted = dealt.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("total", F.sum(value).over(w))
    return counted.filter("_halo = 0").drop("_at", "_range", "_halo")


def rising_edges(df: DataFrame, by: list[str], order: list[str], over: Column) -> DataFrame:
    """``ordinal`` within the group, ``over``, and ``notify`` where it became true."""
    w = Window.partitionBy(*by).orderBy(*order)
    df = df.withColumn("ordinal", F.row_number().over(w).cast("long")).withColumn("over", over)
    return df.withColumn("notify", F.col("over") & ~F.coalesce(F.lag("over").over(w), F.lit(False)))


def take_while_not(df: DataFrame, by: list[str], order: list[str], stop: Column, keep_stop: bool = False) -> DataFrame:
    """Rows before the first stopper of each group, with it if asked."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if keep_stop else 0)
    return df.withColumn("_s", F.coalesce(F.max(stop.cast("int")).over(w), F.lit(0))).filter("_s = 0").drop("_s")


def islands(df: DataFrame, by: list[str], order: list[str], same: Column, name: str = "island") -> DataFrame:
    """Number runs of neighbours: ``same`` says whether a row goes on from the one before (``lag`` over the same order)."""
    w = Window.partitionBy(*by).orderBy(*order)
    new = (~F.coalesce(same, F.lit(False))).cast("int")
    return df.withColumn("_n", new).withColumn(name, F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_n")


def within_budget(df: DataFrame, by: list[str], order: list, size: Column, budget: int, most: int) -> DataFrame:
    """The first row, and further ones as long as their sizes add up to the budget; at most ``most``.

    A hot group is first cut to its best ``most`` in each of SALTS parts, which are all it needs.
    """
    part = Window.partitionBy(*by, "_salt").orderBy(*order)
    df = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))).withColumn("_first", F.row_number().over(part)).filter(F.col("_first") <= most).drop("_salt", "_first")
    w = Window.partitionBy(*by).orderBy(*order)
    run = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("rn", F.row_number().over(w).cast("long")).withColumn("_run", run)
    return df.filter((F.col("rn") <= most) & ((F.col("rn") == 1) | (F.col("_run") <= budget))).drop("_run")


def numbered(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``rn``: the number of each row in its group's order, without any group being one task.

    Rows are dealt by ranges of group and order and written down, so that ranges
    stay as they are; a range numbers its own rows behind those of the ranges
    before it, of which only counts are gathered, a row a group and range.
    """
    ranged = df.repartitionByRange(*by, *order).withColumn("_p", F.spark_partition_id())
    ranged = written(ranged, "numbered")
    counts = ranged.groupBy(*by, "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*by, *([] if by else [F.lit(0)])).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    nth = F.row_number().over(Window.partitionBy(*by, "_p").orderBy(*order))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, "_p"]]
    on = same[0]
    for x in same[1:]:
        on = on & x
    rows = ranged.withColumn("_nth", nth).alias("a").join(before.alias("b"), on)
    return rows.select(*[F.col(f"a.{c}").alias(c) for c in df.columns], (F.col("a._nth") + F.col("b._before")).cast("long").alias("rn"))


def fixed_batches(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """``rn`` and ``batch``."""
    return numbered(df, by, order).withColumn("batch", F.floor((F.col("rn") - 1) / n).cast("long"))


def manual_rank(df: DataFrame, by: list[str], key: str, order: str, adopted: Column) -> DataFrame:
    """Rank of each adopted key by its first row in the group."""
    first = df.filter(adopted).groupBy(*by, key).agg(F.min(order).alias("_first"))
    return numbered(first, by, ["_first"]).withColumn("manual_rank", F.col("rn").cast("int")).drop("_first", "rn")


def sample_weights(df: DataFrame, group: str, label: str, rank: str) -> DataFrame:
    """1 for negatives; 1 + 2 (n - rank + 1) / n for positives, n the group's positives, rank within 1..n."""
    counts = df.groupBy(F.col(group).alias("_g")).agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_n"))
    n = F.col("_n")
    r = F.greatest(F.lit(1), F.least(F.coalesce(F.col(rank), n), n))
    return df.join(small(counts), F.col(group).eqNullSafe(F.col("_g"))).withColumn("weight", F.when(F.col(label) == 1, 1.0 + 2.0 * (F.col("_n") - r + 1) / F.col("_n")).otherwise(1.0)).drop("_n", "_g")
