"""Best-two-fit packing of token sequences.

Which pieces share a sequence depends on lengths alone, so the packing is
planned on the histogram of lengths, at most ``size`` numbers whatever the
corpus: a bin is filled greedily with the largest pieces that fit; then its
smallest piece is replaced by two unpacked ones that fill its gap and its place
more tightly. A plan line is a pattern and how often it is used. Pieces find
their place by their rank among those of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from . import bpe
from .scratch import persist
from .units import trim

SIZE = 1024
END_ID = 2


def plan(counts: np.ndarray, size: int = SIZE) -> list[tuple[list[int], int]]:
    """Patterns (lengths in a bin, largest first, and the number of such bins) that use up ``counts[length]``.

    Each line uses up a length or as good as does, so there are O(size) lines.
    """
    left, lines = counts.astype(np.int64).copy(), []
    left[0] = 0
    while left.any():
        used: dict[int, int] = {}
        bin_, gap = [], size

        def take(n: int) -> None:
            bin_.append(n)
            used[n] = used.get(n, 0) + 1

        def free(n: int) -> int:
            return int(left[n]) - used.get(n, 0)

        while gap:
            fits = np.flatnonzero(left[: gap + 1])[::-1]
            best = next((int(n) for n in fits if free(int(n)) > 0), 0)
            if not best:
                break
            take(best)
            gap -= best
        while gap and len(bin_) > 1:  # the smallest gives way to two that fit tighter
            small = min(bin_)
            most, pair = small, None
            for a in np.flatnonzero(left[: small + gap]):
                a = int(a)
                if free(a) <= 0:
                    continue
                fits = np.flatnonzero(left[a : small + gap - a + 1]) + a
                b = next((int(x) for x in fits[::-1] if free(int(x)) > (x == a)), 0)
                if b and a + b > most:
                    most, pair = a + b, (a, b)
            if not pair:
                break
            bin_.remove(small)
            used[small] -= 1
            gap += small - most
            for n in pair:
                take(n)
        used = {n: k for n, k in used.items() if k}
        times = min(int(left[n]) // k for n, k in used.items())
        for n, k in used.items():
            left[n] -= k * times
        lines.append((sorted(bin_, reverse=True), times))
    return lines


def places(lines: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """For each length, runs of ranks: (length, first rank, first sequence, pieces of it in a bin, offset of the first), sorted."""
    rank: dict[int, int] = {}
    rows, base = [], 0
    for lengths, times in lines:
        at = 0
        for n in dict.fromkeys(lengths):
            k = lengths.count(n)
            rows.append((n, rank.get(n, 0), base, k, at))
            rank[n] = rank.get(n, 0) + k * times
            at += k * n
        base += times
    rows.sort()
    names = ("length", "rank", "sequence", "pieces", "offset")
    return {c: np.array([r[i] for r in rows], np.int64) for i, c in enumerate(names)}


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str, size: int, end_id: int, with_ids: bool) -> DataFrame:
    """Pieces of all documents with ``task`` and ``nth``, their number among the task's pieces of their length."""
    fields = [docs.schema[id_col], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("task", T.IntegerType()), T.StructField("nth", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, task = np.zeros(size + 1, np.int64), TaskContext.get().partitionId()
        for part, got in bpe.encode_batches(batches, path, 1):
            row, piece, start, length, crc, nth, out = [], [], [], [], [], [], []
            for i, ids in enumerate(got):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = len(ids) % size or size
                edges = [0, *range(first, len(ids) + 1, size)]
                for p, (a, b) in enumerate(zip(edges, edges[1:])):
                    row.append(i)
                    piece.append(p)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
                    nth.append(int(seen[b - a]))
                    seen[b - a] += 1
                    if with_ids:
                        out.append(ids[a:b].astype(np.int32))
            cols = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()), pa.array([task] * len(row), pa.int32()), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(out, pa.list_(pa.int32()))] if with_ids else []), names=schema.names)
        trim()

    return docs.select(id_col, text_col).mapInArrow(work, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, size: int = SIZE,
         end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Encode texts, end each with ``end_id``, cut the longer ones and pack the pieces into sequences of ``size``.

    Returns a row for each piece: ``id_col, piece, start, length, ids_crc32,
    sequence_id, offset`` and, with ``with_ids``, ``ids``. The first piece of a
    document may be short, the others are whole. Null text is empty, so its piece
    is the end id alone; repeated rows and rows of one id are packed one by one,
    and pieces of equal length take places in the order of their tasks and rows.
    Other columns, whatever their names, are not read; an empty table gives an
    empty one.
    """
    spark = ship(docs.sparkSession)
    cut = persist(pieces(docs, id_col, text_col, path or bpe.default_tokenizer(), size, end_id, with_ids), "pieces")
    by_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(size + 1, np.int64)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        counts[r["length"]] = r["n"]
    where = places(plan(counts, size))
    before = by_task.select("length", "task", (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    ranked = cut.join(before, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    runs = spark.sparkContext.broadcast(where)  # O(size) rows
    names = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = T.StructType([T.StructField("sequence_id", T.LongType()) if c == "sequence_id" else T.StructField("offset", T.LongType()) if c == "offset" else cut.schema[c] for c in names])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = runs.value
        key = t["length"] * (1 << 48) + t["rank"]
        for b in batches:
            length, rank = (b.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            run = np.searchsorted(key, length * (1 << 48) + rank, "right") - 1
            k = rank - t["rank"][run]
            new = {"sequence_id": pa.array(t["sequence"][run] + k // t["pieces"][run], pa.int64()),
                   "offset": pa.array(t["offset"][run] + k % t["pieces"][run] * length, pa.int64())}
            yield pa.RecordBatch.from_arrays([new.get(c) if c in new else b.column(c) for c in names], names=names)

    return ranked.mapInArrow(place, schema)
