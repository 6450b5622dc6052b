"""Units: a few megabytes of whole documents in one row, and answers to questions units ask.

Staging documents as units makes every later pass work on the same groups of
rows whatever tasks read them, so a unit can send one compact question per
shard (sorted hashes) and recognise the answer by the order of its own hashes.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .scratch import persist_bucketed

UNIT_BYTES = 4 << 20
#: Hashes a shard task holds at once, roughly.
SHARD_HASHES = 1 << 20


def trim() -> None:
    """Give memory that a worker no longer uses back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts."""
    return int(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)


def shards_for(n_hashes: float) -> int:
    return max(1, int(n_hashes / SHARD_HASHES) + 1)


def squeeze(a: np.ndarray) -> bytes:
    """Numbers as planes of bytes, which compress well where the high bytes are alike."""
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())


def unsqueeze(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def squeeze_sorted(a: np.ndarray) -> bytes:
    """Ascending unsigned numbers by their gaps."""
    return squeeze(np.diff(a, prepend=a.dtype.type(0)))


def unsqueeze_sorted(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unsqueeze(data, kind), dtype=kind)


def stage(docs: DataFrame, text_col: str, unit_bytes: int = UNIT_BYTES, total_bytes: int | None = None) -> DataFrame:
    """``unit_id long, rows array<struct<all columns>>``, written once, bucketed by unit_id.

    No shuffle: each task cuts its own rows into units. Null texts count as
    empty; a longer text than ``unit_bytes`` is a unit of its own.
    """
    schema = T.StructType([
        T.StructField("unit_id", T.LongType()),
        T.StructField("rows", T.ArrayType(docs.schema)),
    ])
    ship(docs.sparkSession)
    names = docs.columns
    at = names.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        base, made = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            if not b.num_rows:
                continue
            size = pc.fill_null(pc.binary_length(b.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            group = (np.cumsum(size) - size) // unit_bytes
            first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            offsets = pa.array(np.append(first, b.num_rows).astype(np.int32))
            rows = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(b.columns, fields=list(b.schema)))
            ids = pa.array(base + made + np.arange(len(first)), pa.int64())
            made += len(first)
            for i in range(len(first)):  # a unit a batch, so that no batch grows large
                yield pa.RecordBatch.from_arrays([ids.slice(i, 1), rows.slice(i, 1)], names=["unit_id", "rows"])
        trim()

    total = text_bytes(docs, text_col) if total_bytes is None else total_bytes
    # With fewer buckets than shuffle partitions Spark would move the bucketed side too.
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return persist_bucketed(docs.mapInArrow(cut, schema), "units", "unit_id", max(least, min(100_000, total // (4 * unit_bytes) + 1)))


def each_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.StructArray, dict]]:
    """(unit_id, its rows, other columns) of batches of units."""
    for b in batches:
        ids, rows = b.column("unit_id").to_pylist(), b.column("rows")
        rest = [n for n in b.schema.names if n not in ("unit_id", "rows")]
        for i, u in enumerate(ids):
            yield u, rows[i].values, {n: b.column(n)[i].as_py() for n in rest}
        del b, rows
        trim()


def texts_of(rows: pa.StructArray, text_col: str) -> list[bytes | None]:
    return rows.field(text_col).cast(pa.binary()).to_pylist()


def shard_of(sorted_hashes: np.ndarray, shards: int) -> np.ndarray:
    """Positions at which the hashes of each shard start; shards are equal ranges of hashes."""
    edges = (np.arange(shards, dtype=np.float64) * (2.0**64 / shards)).astype(np.uint64)
    return np.append(np.searchsorted(sorted_hashes, edges), len(sorted_hashes))


def questions(unit: int, hashes: np.ndarray, shards: int, more: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    """Rows (shard, unit_id, blob) for sorted ``hashes`` with values beside them."""
    cut = shard_of(hashes, shards)
    for s in np.flatnonzero(np.diff(cut)):
        part = slice(cut[s], cut[s + 1])
        yield int(s), unit, b"".join([hashes[part].tobytes(), *(m[part].tobytes() for m in more)])


QUESTION = "shard int, unit_id long, blob binary"


def question_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    a, b, c = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], names=["shard", "unit_id", "blob"])


def in_batches(rows: Iterator[tuple[int, int, bytes]], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[2])
        if size >= most or len(held) >= 5000:
            yield question_batch(held)
            held, size = [], 0
    if held:
        yield question_batch(held)


def ask(asked: DataFrame, shards: int, answer: Callable[[list[int], list[bytes]], list[bytes | None]], summary: bool = False, notes: bool = False) -> DataFrame:
    """``shard, unit_id, blob``: the blobs of a shard, of all units, answered together by one task.

    ``answer`` gets unit ids and blobs; blobs answered by None stay unanswered.
    With ``summary`` it adds one more blob, about the shard, for unit -1. With
    ``notes``, blobs of shards from ``shards`` on are units' notes to themselves
    and come back as they are.

    A shard is a range of hashes and each unit sends a hash once, so a shard's
    rows are bounded by the units times its width, hot words included.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[tuple[int, int, bytes]]:
            got = blobs if notes and shard >= shards else answer(units, blobs)
            for u, out in zip([*units, -1] if summary else units, got):
                if out is not None:
                    yield shard, u, out

        shard, units, blobs = None, [], []
        for b in batches:
            for s, u, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if s != shard and blobs:
                    yield from in_batches(flush())
                    units, blobs = [], []
                shard = s
                units.append(u)
                blobs.append(x)
        if blobs:
            yield from in_batches(flush())
        trim()

    return asked.repartition(min(shards, 20_000), "shard").sortWithinPartitions("shard", "unit_id").mapInArrow(work, QUESTION)


def answered(units: DataFrame, answers: DataFrame) -> DataFrame:
    """Units with ``answers array<struct<shard, blob>>``; only the answers move, units are bucketed.

    A unit's answers are bounded as the unit is.
    """
    own = answers.filter("unit_id >= 0").groupBy("unit_id").agg(F.collect_list(F.struct("shard", "blob")).alias("answers"))
    return units.join(own, "unit_id", "left").select("unit_id", "rows", "answers")


def answer_map(answers: list[dict] | None) -> dict[int, bytes]:
    return {a["shard"]: a["blob"] for a in answers or ()}


