"""Duplicate components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder, written
from .windows import numbered


def components(edges: DataFrame, a: str, b: str, checkpoint: bool = True, most_rounds: int = 50) -> DataFrame:
    """``node, component`` with the smallest reachable node, by pointer jumping on minimum labels.

    Every round halves the distance to the minimum at best; state is cut off
    from its lineage in the session's checkpoint folder.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    if checkpoint and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or shared_folder(spark, "components"))
    both = both.checkpoint() if checkpoint else both
    label = both.select(F.col("u").alias("node")).distinct().withColumn("component", F.col("node"))
    for _ in range(most_rounds):
        near = both.join(label, F.col("v") == F.col("node")).groupBy("u").agg(F.min("component").alias("m"))
        new = label.join(near, F.col("node") == F.col("u")).select("node", F.least("component", "m").alias("c"), (F.col("m") < F.col("component")).alias("moved"))
        jump = new.alias("n").join(new.select(F.col("node").alias("p"), F.col("c").alias("pc")), F.col("c") == F.col("p"), "left")
        new = jump.select("node", F.least("c", F.coalesce("pc", "c")).alias("component"), "moved")
        new = new.checkpoint() if checkpoint else new.cache()
        label = new.select("node", "component")
        if new.filter("moved").isEmpty():
            return label
    raise RuntimeError("components did not settle")


def duplicate_labels(comp: DataFrame, prefix: str = "重複", offset: int = 0) -> DataFrame:
    """Components of two and more, numbered by their smallest member: ``node, component, label``."""
    sized = comp.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    num = numbered(sized.select("component"), [], ["component"]).select("component", F.format_string(f"{prefix}%03d", F.col("rn") + offset).alias("label"))
    return comp.join(num, "component").select("node", "component", "label")


def extend(stored: DataFrame, edges: DataFrame, a: str, b: str, prefix: str = "重複") -> DataFrame:
    """Stored components (``node, component, label``) with new links: ``node, component, label``.

    Links are drawn between whole stored components, so the work is that of the new
    links. Of labels that come together the smallest stays, others are given up; a
    component keeps its label when it grows. New ones are numbered behind the largest
    label there was, by their smallest member. Without stored rows this is
    ``duplicate_labels(components(edges))``.
    """
    home = stored.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    for end in ("u", "v"):
        links = links.join(home, F.col(end) == F.col("_n"), "left").withColumn(f"_{end}", F.coalesce("_c", end)).drop("_n", "_c")
    links = written(links.distinct(), "links")
    joined = components(links.filter("_u <> _v"), "_u", "_v").select(F.col("node").alias("_old"), F.col("component").alias("_new"))
    fresh = links.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(stored, "node", "left_anti")
    nodes = stored.select("node", F.col("component").alias("_old"), "label").unionByName(fresh.select("node", F.col("node").alias("_old"), F.lit(None).cast("string").alias("label")))
    nodes = written(nodes.join(joined, "_old", "left").select("node", F.coalesce("_new", "_old").alias("component"), "label"), "components")
    number = F.regexp_extract("label", r"(\d+)$", 1).cast("long")
    groups = nodes.groupBy("component").agg(F.min(number).alias("k"), F.count(F.lit(1)).alias("n")).filter("n > 1 OR k IS NOT NULL")
    last = stored.agg(F.max(number)).first()[0] or 0
    new = numbered(groups.filter("k IS NULL").select("component"), [], ["component"]).select("component", (F.col("rn") + last).alias("k"))
    named = groups.filter("k IS NOT NULL").select("component", "k").unionByName(new).select("component", F.format_string(f"{prefix}%03d", "k").alias("label"))
    return nodes.drop("label").join(named, "component").select("node", "component", "label")
