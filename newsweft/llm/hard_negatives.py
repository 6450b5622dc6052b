"""Hard negatives by a block matrix multiply in two dimensions, in the manner of SUMMA.

Rows and anchors are cut into blocks and their dimensions into chunks. A tile
of scores stays where it is: the panels of all chunks of a row block and of a
strip of anchor blocks are shuffled to one task, which adds up their products
chunk by chunk and reduces each whole tile at once to the best few rows of every
window. So no scores are shuffled, and no matrix of scores is ever kept.

This is done twice. For positives, blocks hold rows of few labels, so that only
tiles of rows with one label are made. Then anchors carry the score window of
each of their positives and meet all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .scratch import free, persist
from .units import trim

#: Rows and anchors in a block, chunks of dimensions, and anchor blocks that a task multiplies one row block with.
ROWS, ANCHORS, CHUNKS, STRIP = 2048, 512, 2, 16
#: Components are floor(SCALE * x).
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score in hundredths of its positive's: LOW of 100 at least, HIGH at most.
LOW, HIGH = 50, 95
_TOP = 1 << 63

_PANEL = "row_block long, strip long, chunk int, kind int, anchor_block long, meta binary, data binary"


def prepared(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, anchors: Column, scale: int) -> DataFrame:
    """``id, label, x array<long>, tie, is_anchor`` of distinct rows that take part."""
    x = F.col(vector_col)
    fine = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    # floor() of a double saturates, so numbers that don't fit stay visible to the check of bounds.
    rows = vectors.filter(F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("x"), anchors.alias("is_anchor"))
    return rows.distinct().withColumn("tie", F.xxhash64("id", "label", "x"))


def _blocks(rows: DataFrame, block: list[str], extra: list[str], dim: int, chunks: int, kind: str) -> DataFrame:
    """A row for each chunk of each block: the block's key, ``chunk, meta, data``; ``meta`` has ids, labels, ties and ``extra`` columns."""
    width = -(-max(dim, 1) // chunks)
    schema = ", ".join([f"{b} long" for b in block]) + ", chunk int, meta binary, data binary"

    def make(t: pa.Table) -> pa.Table:
        n = t.num_rows
        t = t.combine_chunks()
        x = t.column("x").chunk(0)
        matrix, sizes = np.zeros((n, width * chunks), kind), np.diff(x.offsets.to_numpy())
        at = np.repeat(np.arange(n), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        matrix[at] = x.flatten().to_numpy(zero_copy_only=False)
        meta = b"".join([np.int64(n).tobytes(), *(t.column(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "label", "tie"))])
        if extra:  # lists of one length for all rows
            meta += np.column_stack([np.array(t.column(c).to_pylist(), np.int64) for c in extra]).tobytes()
        keys = [pa.array([t.column(b)[0].as_py()] * chunks, pa.int64()) for b in block]
        data = [np.ascontiguousarray(matrix[:, c * width : (c + 1) * width]).tobytes() for c in range(chunks)]
        return pa.Table.from_arrays([*keys, pa.array(range(chunks), pa.int32()), pa.array([meta] * chunks, pa.binary()), pa.array(data, pa.binary())], names=[*block, "chunk", "meta", "data"])

    return rows.select(*block, "id", "label", "tie", "x", *extra).groupBy(*block).applyInArrow(make, schema)


def _read_meta(meta: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels, ties, and the extra numbers of each row."""
    n = int(np.frombuffer(meta, np.int64, 1)[0])
    a = np.frombuffer(meta, np.int64, offset=8)
    return a[:n], a[n : 2 * n], a[2 * n : 3 * n], a[3 * n :].reshape(n, -1)


def _meet(panels: DataFrame, tasks: int, kind: str, wide: bool, best: Callable[[np.ndarray, bytes, bytes], list[np.ndarray]], names: list[str]) -> DataFrame:
    """Each row block times the anchor blocks of its strip, and every tile reduced by ``best`` to columns of longs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> Iterator[pa.RecordBatch]:
            out = best(total.astype(np.int64), anchor_meta, tile_rows)
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

        rows, row_meta, anchor_meta, tile_rows, has, tile, total = {}, b"", b"", b"", None, None, None
        for b in batches:
            for r in b.to_pylist():
                height = int(np.frombuffer(r["meta"], np.int64, 1)[0])
                m = np.frombuffer(r["data"], kind).reshape(height, -1)
                key = r["row_block"], r["strip"]
                if r["kind"] == 0:
                    rows, row_meta = (rows if has == key else {}) | {r["chunk"]: m}, r["meta"]
                    has = key
                    continue
                if has != key:  # a strip without a row block: no rows in it
                    continue
                cast = np.int64 if wide else np.float64  # exact in doubles too, as no sum reaches 2**53
                part = m.astype(cast) @ rows[r["chunk"]].astype(cast).T
                if tile == (*key, r["anchor_block"]):
                    total += part
                    continue
                if tile is not None:
                    yield from done()
                tile, total, anchor_meta, tile_rows = (*key, r["anchor_block"]), part, r["meta"], row_meta
        if tile is not None:
            yield from done()
        trim()

    dealt = panels.repartition(tasks, "row_block", "strip").sortWithinPartitions("row_block", "strip", "kind", "anchor_block", "chunk")
    return dealt.mapInArrow(work, ", ".join(f"{n} long" for n in names))


def first_of_each(owner: np.ndarray, score: np.ndarray, row_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each owner by falling score, then rising id."""
    order = np.lexsort((row_id, -score, owner))
    o = owner[order]
    start = np.flatnonzero(np.diff(o, prepend=-1)) if len(o) else np.zeros(0, np.int64)
    nth = np.arange(len(o)) - np.repeat(start, np.diff(np.append(start, len(o))))
    return order[nth < k]


def _positives_of(k: int) -> Callable[[np.ndarray, bytes, bytes], list[np.ndarray]]:
    def best(tile: np.ndarray, anchors: bytes, rows: bytes) -> list[np.ndarray]:
        (aid, alabel, atie, _), (rid, rlabel, _, _) = _read_meta(anchors), _read_meta(rows)
        a, r = np.nonzero((alabel[:, None] == rlabel) & (aid[:, None] != rid))
        at = first_of_each(a, tile[a, r], rid[r], k)
        a, r = a[at], r[at]
        return [aid[a], atie[a], rid[r], tile[a, r]]

    return best


def bounds(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest s with low * score <= 100 * s <= high * score, without passing 64 bits."""
    q, r = np.divmod(score, 100)
    return low * q - (-low * r) // 100, high * q + (high * r) // 100


def _negatives_of(k: int, positives: int, low: int, high: int) -> Callable[[np.ndarray, bytes, bytes], list[np.ndarray]]:
    def best(tile: np.ndarray, anchors: bytes, rows: bytes) -> list[np.ndarray]:
        (aid, alabel, atie, extra), (rid, rlabel, _, _) = _read_meta(anchors), _read_meta(rows)
        nth, pid, ps = (extra[:, i * positives : (i + 1) * positives] for i in range(3))
        least, most = bounds(ps, low, high)
        real = nth > 0
        # A window with least > most is empty; absent positives have none.
        from_, to = np.where(real, least, _TOP - 1).min(1), np.where(real, most, -_TOP).max(1)
        a, r = np.nonzero((alabel[:, None] != rlabel) & (tile >= from_[:, None]) & (tile <= to[:, None]))
        s = tile[a, r]
        out = []
        for p in range(positives):
            inside = np.flatnonzero(real[a, p] & (s >= least[a, p]) & (s <= most[a, p]))
            at = inside[first_of_each(a[inside], s[inside], rid[r[inside]], k)]
            out.append([aid[a[at]], atie[a[at]], nth[a[at], p], pid[a[at], p], ps[a[at], p], rid[r[at]], s[at]])
        return [np.concatenate(c) for c in zip(*out)]

    return best


def _tasks(spark, work: float) -> int:
    return int(min(20_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), work)))


def mine(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", anchors: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE, rows_in_block: int = ROWS, anchors_in_block: int = ANCHORS, chunks: int = CHUNKS, strip: int = STRIP) -> DataFrame:
    """Hard negatives for each anchor and each of its nearest rows of the same label.

    Scores are inner products of floor(scale * x); higher ones come first, ties
    by smaller id. An anchor's positives are its first ``positives`` other rows of
    its label, and a positive's negatives the first ``negatives`` rows of other
    labels whose score lies between ``low`` and ``high`` hundredths of the
    positive's. Returns ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``; other columns, whatever their names, are not
    read (``anchors`` may use any).

    Rows with a null id, label, vector or component, or one that isn't finite,
    take no part. Rows that are equal in id, label and vector count once; rows of
    one id are never each other's positives, and each is an anchor of its own.
    Shorter vectors count as filled up with zeros, an empty one as zeros. Windows
    of negative scores are empty. An empty table, or one without anchors,
    positives or negatives, gives an empty one. Components so large that a score
    may pass 64 bits raise OverflowError. Vectors may be of any length.
    """
    spark = ship(vectors.sparkSession)
    anchors = F.col(id_col) % 50 == 0 if anchors is None else anchors
    rows = persist(prepared(vectors, id_col, label_col, vector_col, F.coalesce(anchors, F.lit(False)), scale), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("a"), F.max(F.size("x")).alias("dim"), F.max(F.array_max(F.transform("x", lambda v: F.abs(v.cast("double"))))).alias("most")).first()
    n, n_anchors, dim, most = size["n"], size["a"], size["dim"] or 0, size["most"] or 0.0
    if most * most * max(dim, 1) >= float(_TOP):
        raise OverflowError(f"an inner product of {dim} components up to {most:g} may pass 64 bits")
    wide = most * most * max(dim, 1) >= float(1 << 53)
    kind = "int16" if most < 1 << 15 else "int32" if most < 1 << 31 else "int64"
    groups, anchor_blocks, row_blocks = n // rows_in_block + 1, n_anchors // anchors_in_block + 1, n // rows_in_block + 1

    # Positives: a group holds few labels, and a label that fills many blocks has a group for itself.
    rows = rows.withColumn("grp", F.pmod(F.xxhash64("label"), F.lit(groups)))
    sizes = rows.groupBy("grp").agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("a"))
    sizes = sizes.filter("a > 0").select("grp", F.expr(f"n div {rows_in_block} + 1").alias("row_parts"), F.expr(f"a div {anchors_in_block} + 1").alias("anchor_parts"))
    grouped = rows.join(sizes, "grp")
    part = lambda of: F.pmod(F.col("tie"), F.col(of))
    strips = F.expr(f"(anchor_parts - 1) div {strip}")
    one = _blocks(grouped.withColumns({"part": part("row_parts"), "strips": strips}), ["grp", "part", "strips"], [], dim, chunks, kind)
    wall = F.lit(1 << 31)
    panel = [c.split()[0] for c in _PANEL.split(", ")]
    row_panels = one.select((F.col("grp") * wall + F.col("part")).alias("row_block"), F.explode(F.sequence(F.lit(0).cast("long"), "strips")).alias("strip"), "chunk", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("anchor_block"), "meta", "data")
    two = _blocks(grouped.filter("is_anchor").withColumn("part", part("anchor_parts")), ["grp", "part", "row_parts"], [], dim, chunks, kind)
    two = two.withColumn("row_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_parts") - 1)))
    anchor_panels = two.select((F.col("grp") * wall + F.col("row_part")).alias("row_block"), F.expr(f"part div {strip}").alias("strip"), "chunk", F.lit(1).alias("kind"), (F.col("grp") * wall + F.col("part")).alias("anchor_block"), "meta", "data")
    near = _meet(row_panels.select(panel).unionByName(anchor_panels.select(panel)), _tasks(spark, row_blocks), kind, wide, _positives_of(positives), ["id", "tie", "positive_id", "score"])
    best = Window.partitionBy("id", "tie").orderBy(F.desc("score"), "positive_id")
    near = near.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= positives)
    # At most ``positives`` of each anchor, filled up with zeros.
    three = near.groupBy("id", "tie").agg(F.sort_array(F.collect_list(F.struct(F.col("nth").cast("long").alias("nth"), "positive_id", "score"))).alias("p"))
    filled = lambda c: F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(F.get(F.col(f"p.{c}"), i), F.lit(0).cast("long")))
    windows = persist(three.select("id", "tie", *(filled(c).alias(c) for c in ("nth", "positive_id", "score"))), "windows")

    # Negatives: all rows, and anchors with the windows of their positives.
    own = rows.filter("is_anchor").join(windows, ["id", "tie"]).withColumn("block", F.pmod("tie", F.lit(anchor_blocks)))
    two = _blocks(own, ["block"], ["nth", "positive_id", "score"], dim, chunks, kind)
    one = _blocks(rows.withColumn("block", F.pmod("tie", F.lit(row_blocks))), ["block"], [], dim, chunks, kind)
    row_panels = one.select(F.col("block").alias("row_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit((anchor_blocks - 1) // strip).cast("long"))).alias("strip"), "chunk", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("anchor_block"), "meta", "data")
    anchor_panels = two.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))).alias("row_block"), F.expr(f"block div {strip}").alias("strip"), "chunk", F.lit(1).alias("kind"), F.col("block").alias("anchor_block"), "meta", "data")
    names = ["id", "tie", "nth", "positive_id", "positive_score", "negative_id", "negative_score"]
    hard = _meet(row_panels.select(panel).unionByName(anchor_panels.select(panel)), _tasks(spark, row_blocks * -(-anchor_blocks // strip)), kind, wide, _negatives_of(negatives, positives, low, high), names)
    best = Window.partitionBy("id", "tie", "nth").orderBy(F.desc("negative_score"), "negative_id")
    hard = persist(hard.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives), "negatives")
    free(rows, windows)
    return hard.select(F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
