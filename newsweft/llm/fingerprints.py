"""Threshold-scaled fingerprints: every shingle hash below a fixed fraction of the range.

DataFrame functions only. All sketches keep the same part of the hash range,
whatever the text's length, so the sketch of a union is the union of sketches,
and resemblance and containment are estimated between texts of very unequal
length. A text's sketch also has one hash of its whole word sequence, by which
texts too short to keep any shingle are still told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
#: One hash in so many is kept.
SCALE = 4
_TOP = (1 << 63) - 1


def word_hashes(text: Column) -> Column:
    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != ""), lambda x: F.xxhash64(x))


def _shingles(w: Column) -> Column:
    """63-bit hashes of ``SHINGLE`` neighbours of hashed words; fewer words make one shingle."""
    neighbours = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])
    n = F.size(w)
    run = F.transform(F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0))), lambda i: neighbours(i).bitwiseAND(F.lit(_TOP)))
    return F.when(n > 0, run).otherwise(F.array().cast("array<bigint>"))


def with_sketch(df: DataFrame, text_col: str, out: str, scale: int = SCALE) -> DataFrame:
    """``df`` and, as ``out``, the ``struct<whole long, kept array<long>>`` of a text column; null counts as empty."""
    words = f"_{out}_words"
    df = df.withColumn(words, word_hashes(F.col(text_col)))
    kept = F.array_sort(F.array_distinct(F.filter(_shingles(F.col(words)), lambda x: x < F.lit(_TOP // scale))))
    return df.withColumn(out, F.struct(F.xxhash64(F.col(words)).alias("whole"), kept.alias("kept"))).drop(words)


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together; sketches of one scale merge in any order."""
    return F.struct(F.lit(None).cast("bigint").alias("whole"), F.array_sort(F.array_union(a["kept"], b["kept"])).alias("kept"))


def as_text(s: Column) -> Column:
    """A sketch as hexadecimal numbers: the whole's hash, then the hashes kept."""
    return F.concat_ws(" ", F.lower(F.hex(s["whole"])), F.concat_ws(" ", F.transform(s["kept"], lambda x: F.lower(F.hex(x)))))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard estimate of two sketches, 0 to 1; equal word sequences are 1, and two that keep no hash else 0."""
    both, either = F.size(F.array_intersect(a["kept"], b["kept"])), F.size(a["kept"]) + F.size(b["kept"])
    ratio = F.coalesce(F.try_divide(both.cast("double"), (either - both).cast("double")), F.lit(0.0))
    return F.when(a["whole"] == b["whole"], F.lit(1.0)).otherwise(ratio)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; 1 for equal word sequences, 0 if a keeps no hash else."""
    ratio = F.coalesce(F.try_divide(F.size(F.array_intersect(a["kept"], b["kept"])).cast("double"), F.size(a["kept"]).cast("double")), F.lit(0.0))
    return F.when(a["whole"] == b["whole"], F.lit(1.0)).otherwise(ratio)


#: Bytes of text in a range of ids, and percentiles of ids at most; between two percentiles ranges are cut evenly.
RANGE_BYTES = 16 << 20
EDGES = 512
#: First rows of so many ranges are broadcast, 16 bytes each; of more they are joined by shuffle.
BROADCAST_RANGES = 100_000


def _slots(rows: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """``rows`` (id, text, tie) with ``slot``, a number that rises as ids fall, and how many slots have one ``slot div width``.

    Ids are cut at approximate percentiles, then evenly. An id that fills whole
    percentiles is cut by a hash of its texts, and so are rows without an id,
    which come last.
    """
    n = min(parts, EDGES)
    fine = -(-parts // n)
    marks = (rows.agg(F.percentile_approx("id", [i / n for i in range(n + 1)], 20 * n + 100)).first()[0] or [0, 0]) if parts > 1 else [0, 0]
    edges = sorted(set(marks))
    hot = {c: marks.count(c) for c in edges if marks.count(c) > 1} if parts > 1 else {}
    width = 2 * (n + 2) * fine + 2
    longs = F.array(*[F.lit(int(e)).cast("long") for e in edges])
    k = F.greatest(F.size(F.filter(longs, lambda e: e <= F.col("id"))), F.lit(1))
    low, high = F.get(longs, k - 1), F.coalesce(F.get(longs, k), F.col("id") + 1)
    even = F.floor((F.col("id") - low) / F.greatest(high - low, F.lit(1)) * fine).cast("long")
    share = lambda m: F.floor(F.shiftrightunsigned(F.col("tie"), 33) / (1 << 31) * m).cast("long")  # noqa: E731  0..m-1, rising with tie_order
    sub = fine - F.least(F.greatest(even, F.lit(0)), F.lit(fine - 1))
    for c, m in hot.items():  # at most EDGES; their rows come last in their percentile, which is the one they start
        sub = F.when(F.col("id") == c, fine + 1 + share(m * fine)).otherwise(sub)
    slot = (len(edges) - k).cast("long") * width + sub
    return rows.withColumn("slot", F.when(F.col("id").isNull(), F.lit((len(edges) + 1) * width) + share(fine)).otherwise(slot)), width


def with_next(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """``id, text, own, next_text, next``: beside each document and its sketch the one after it in descending id; after the last, the first.

    Rows are dealt by ranges of ids, where a window's lead finds the next one.
    Each range also gets the first row of the range after it, the only rows that
    move twice. Rows of one id follow each other by a hash of their texts; rows
    without an id come last.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows, width = _slots(rows.withColumn("tie", F.xxhash64("text")), parts)
    rows = rows.withColumn("turn", F.shiftrightunsigned("tie", 1))  # orders ties as their ranges do
    firsts = rows.groupBy("slot").agg(F.max(F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("id"), F.bitwise_not("turn").alias("turn"))).alias("f"))
    firsts = firsts.select("slot", F.col("f.id").alias("id"), F.bitwise_not("f.turn").alias("turn"), F.expr(f"slot div {width}").alias("part"))
    # The slot before each: within a percentile, and for the first of one, the last of the percentile before.
    firsts = firsts.withColumn("before", F.lag("slot").over(Window.partitionBy("part").orderBy("slot")))
    ends = firsts.groupBy("part").agg(F.max("slot").alias("last"))  # a row a percentile, at most EDGES + 2
    in_order = Window.orderBy("part")
    ends = ends.select("part", F.coalesce(F.lag("last").over(in_order), F.max("last").over(Window.orderBy(F.lit(1)))).alias("last"))
    firsts = firsts.join(F.broadcast(ends), "part").select("slot", "turn", F.coalesce("before", "last").alias("to"), F.col("id").alias("first_id"))
    if parts <= BROADCAST_RANGES:
        firsts = F.broadcast(firsts)
    moved = rows.join(firsts, ["slot", "turn"]).filter(F.coalesce("id", F.lit(-(1 << 63))) == F.col("first_id"))
    both = rows.withColumn("end", F.lit(0)).unionByName(moved.select("id", "text", "tie", "turn", F.col("to").alias("slot"), F.lit(1).alias("end")))
    # Dealt first, so that sketches are made once a row and don't move.
    dealt = with_sketch(both.repartition("slot"), "text", "own")
    order = Window.partitionBy("slot").orderBy("end", F.col("id").desc_nulls_last(), "turn")
    return dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("next", F.lead("own").over(order)).filter("end = 0").select("id", "text", "own", "next_text", "next")


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has the last third of its code points replaced by as many of
    the next document's first ones. Returns ``id_col, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next`` and
    ``contained_edited, contained_next``, a row for each row; other columns,
    whatever their names, are not read. Ids are integers. Null text counts as
    empty, which is like another wordless one (1.0) and unlike any other (0.0).
    Equal texts have equal fingerprints; rows of one id follow each other by a
    hash of their texts, and repeated rows follow each other. Texts of any length
    are read whole. A single row is its own next; an empty table gives an empty one.
    """
    if parts is None:
        total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
        parts = max(1, int(total) // RANGE_BYTES + 1)
    df = with_next(docs, id_col, text_col, parts)
    cut = F.floor(F.length("text") / 3).cast("int")
    df = df.select("id", F.length("text").cast("long").alias("n_chars"), "own", "next",
                   F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - cut), F.substring(F.col("next_text"), F.lit(1), cut)).alias("edited"))
    df = df.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    df = with_sketch(df, "edited", "changed").drop("edited")
    own, changed, after = F.col("own"), F.col("changed"), F.col("next")
    return df.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", as_text(own).alias("fingerprint"), as_text(changed).alias("edited_fingerprint"),
                     likeness(own, changed).alias("near_edited"), likeness(own, after).alias("near_next"),
                     containment(own, changed).alias("contained_edited"), containment(own, after).alias("contained_next"))
