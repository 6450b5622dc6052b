"""Token-ID files: ids bit-packed at fixed width in blocks, with offsets for random access.

A shard file holds, little-endian: the magic, six u64 (bits an id, ids a
block, documents, ids, blocks, documents without an id, which come first), the
ids before each document and in all (u64), the document ids (i64), the byte at which each block starts (u64), then
the blocks. An id takes the bits that the largest id of the vocabulary needs;
bit k of id i of a block is bit i * bits + k of its bytes.
"""

from __future__ import annotations

import struct
import uuid
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
from .scratch import new_path, persist
from .units import text_bytes, trim

MAGIC = b"NWTOKEN2"
BLOCK = 4096
SHARD_BYTES = 24 << 20
END_ID = 0


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    return np.packbits(((ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1).astype(np.uint8), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    raw = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return raw.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


def write_shard(out, doc_ids: np.ndarray, ids: list[np.ndarray], bits: int, block: int = BLOCK, nameless: int = 0) -> int:
    """Write one shard to a binary file; returns its number of ids."""
    before = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype("<u8")
    n = int(before[-1])
    flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    blocks = [pack(flat[a : a + block], bits) for a in range(0, n, block)]
    out.write(MAGIC + struct.pack("<6Q", bits, block, len(ids), n, len(blocks), nameless))
    out.write(before.tobytes() + doc_ids.astype("<i8").tobytes())
    out.write(np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")[: len(blocks)].tobytes())
    for b in blocks:
        out.write(b)
    return n


class ShardReader:
    """Random access to a shard file."""

    def __init__(self, file):
        self.file = file
        if file.read(8) != MAGIC:
            raise ValueError("not a token shard")
        self.bits, self.block, self.n_docs, self.n_ids, n_blocks, self.nameless = struct.unpack("<6Q", file.read(48))
        self.before = np.frombuffer(file.read(8 * (self.n_docs + 1)), "<u8").astype(np.int64)
        self.doc_ids = np.frombuffer(file.read(8 * self.n_docs), "<i8")
        self.offsets = np.frombuffer(file.read(8 * n_blocks), "<u8").astype(np.int64)
        self.base = 56 + 8 * (2 * self.n_docs + 1 + n_blocks)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids at places first..last-1, reading only the blocks that hold them."""
        if first >= last:
            return np.empty(0, np.uint32)
        a, b = first // self.block, (last - 1) // self.block
        n = min(self.n_ids, (b + 1) * self.block) - a * self.block
        size = (b - a) * int(self.offsets[1] if len(self.offsets) > 1 else 0) + (self._bytes(min(self.n_ids, (b + 1) * self.block) - b * self.block))
        self.file.seek(self.base + int(self.offsets[a]))
        data = self.file.read(size)
        if (self.block * self.bits) % 8:
            per = self._bytes(self.block)
            parts = [unpack(data[i * per : (i + 1) * per], self.bits, min(self.block, n - i * self.block)) for i in range(b - a + 1)]
            got = np.concatenate(parts)
        else:
            got = unpack(data, self.bits, n)
        return got[first - a * self.block : last - a * self.block]

    def _bytes(self, n: int) -> int:
        return (n * self.bits + 7) // 8

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.before[i]), int(self.before[i + 1]))


def open_path(path: str, mode: str):
    """A file of any store that pyarrow knows; plain paths are local."""
    from pyarrow import fs

    store, where = fs.FileSystem.from_uri(path)
    if mode == "r":
        return store.open_input_file(where)
    store.create_dir(where.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(where, compression=None)


MANIFEST = "shard int, path string, docs long, ids long"


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode all texts and write them in ascending id order; returns the manifest.

    Null text is empty, so only the end id is written; null ids come first; rows
    of equal ids are ordered by a hash of their text. Texts of any length are
    encoded whole; other columns, whatever their names, are not read; an empty
    table writes no file. A retried task writes another file and only the manifest's files count.
    """
    ship(docs.sparkSession)
    path = path or bpe.default_tokenizer()
    shards = max(1, min(1_000_000, text_bytes(docs, text_col) // shard_bytes + 1))
    keyed = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("x"), F.xxhash64(text_col).alias("h"))
    dealt = keyed.repartitionByRange(shards, "k", "h").sortWithinPartitions("k", "h")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, nameless = [], [], 0
        bits = bits_for(bpe.encoder(path).tok.get_vocab_size(with_added_tokens=True))
        end = np.array([end_id], np.uint32)
        small = np.uint16 if bits <= 16 else np.uint32
        for part, got in bpe.encode_batches(batches, path, 1):
            nameless += part.column(0).null_count
            keys.append(part.column(0).fill_null(0).to_numpy(zero_copy_only=False))
            flat = np.concatenate([y for x in got for y in (x, end)]).astype(small)
            ids += np.split(flat, np.cumsum([len(x) + 1 for x in got])[:-1])
        if not ids:
            return
        shard = TaskContext.get().partitionId()
        to = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex[:8]}.tok"
        with open_path(to, "w") as out:
            n = write_shard(out, np.concatenate(keys), ids, bits, nameless=nameless)
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([to]), pa.array([len(ids)], pa.int64()), pa.array([n], pa.int64())], names=["shard", "path", "docs", "ids"])
        keys = ids = None
        trim()

    return persist(dealt.mapInArrow(work, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, with ``with_ids``, ``ids array<int>``, from the files."""
    ship(manifest.sparkSession)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)
    # One row a shard: the running total is over the manifest, not over documents.
    placed = manifest.withColumn("start", F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n = max(1, manifest.count())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for to, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                with open_path(to, "r") as f:
                    r = ShardReader(f)
                    at, step = 0, 4 << 20
                    while at < r.n_docs:
                        end = max(at + 1, int(np.searchsorted(r.before, r.before[at] + step, "right")) - 1)
                        end = min(end, r.n_docs)
                        first = int(r.before[at])
                        flat = r.ids(first, int(r.before[end]))
                        cuts = r.before[at : end + 1] - first
                        raw, keys = memoryview(flat.tobytes()), r.doc_ids[at:end]
                        none = np.arange(at, end) < r.nameless
                        out = [pa.array(keys, pa.int64(), mask=none), pa.array(start + r.before[at:end], pa.int64()), pa.array(np.diff(cuts), pa.int64()),
                               pa.array([zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(cuts, cuts[1:])], pa.int64())]
                        if with_ids:
                            out.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32())))
                        yield pa.RecordBatch.from_arrays(out, names=schema.names)
                        at = end
        trim()

    return placed.select("path", "start", "shard").repartition(n, "shard").mapInArrow(work, schema)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the files to the shared folder and read them back, digests only."""
    return read_tokens(write_tokens(docs, new_path(docs.sparkSession, "tokens"), path=path), with_ids=False)
