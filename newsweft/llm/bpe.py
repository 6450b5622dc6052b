"""Byte-level BPE encoding and decoding, exactly as the tokenizers library does it.

Text is cut where a character that isn't white space is followed by a space or
a newline: the pre-tokenizer always cuts there, whatever stands around, so the
chunks are encoded apart and remembered. Long unsplit text is encoded as a
tree: halves in parallel, then growing windows around each join are re-encoded
until both sides agree.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship

#: Characters of a leaf of the tree; longer unsplit text is halved.
LEAF = 1 << 14
#: Characters above which a document's leaves are rows of their own.
LONG_TEXT = 1 << 16
#: Chunks remembered by a worker at most.
REMEMBERED = 350_000
#: Bytes encoded at once.
BATCH = 1 << 22


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_characters() -> list[str]:
    """The character by which byte-level vocabularies write each byte: itself if printable, else one from U+0100 on."""
    out, spare = [], 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class Encoder:
    """Encodes texts by remembered chunks. A chunk's key is the chunk without its first blank; before it stands
    \x01 if it starts with a newline instead, \x02 if it is the first of a text."""

    def __init__(self, path: str, leaf: int = LEAF):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.leaf = leaf
        self.byte_char = byte_characters()
        self.char_map = {b: c for b, c in enumerate(self.byte_char)}
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self._bytes: list[bytes] | None = None
        self.blank = self.byte_char[0x20]
        self.newline = self.tok.token_to_id(self.byte_char[0x0A])
        self.signs = {c: i for c in ".,!?;:" if (i := self.tok.token_to_id(c)) is not None}
        self.known: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        """Keep what was used since the last time as a second generation; all else goes."""
        self.old = (self.known, np.cumsum([0, *self.size]), self.flat, self.open) if self.known else None
        self.known, self.flat, self.size, self.open = {}, array("I"), array("H"), set()

    def _learn(self, keys: list[str]) -> np.ndarray:
        """Numbers of keys; new ones are encoded, most of them a run of letters with perhaps a sign behind."""
        known, tokenize, signs, size, flat = self.known, self.model.tokenize, self.signs, self.size, self.flat
        old, first, was, open_ = self.old or ({}, None, None, set())
        out = list(map(known.get, keys))
        at = len(size)
        for i, n in enumerate(out):
            if n is not None:
                continue
            key = keys[i]
            o = old.get(key)
            if o is not None:
                ids, unsafe = was[first[o] : first[o + 1]], o in open_
            else:
                mark = key[:1]
                plain = mark not in "\x01\x02" if mark else True
                body = key if plain else key[1:]
                tail = signs.get(body[-1:])
                head = body if tail is None else body[:-1]
                unsafe = False
                if head.isalpha() and len(head) < 200 and (head.isascii() or max(head) < "\u0250") and (plain or mark == "\x02" or self.newline is not None):
                    word = head if head.isascii() else head.encode().decode("latin-1").translate(self.char_map)
                    ids = [t.id for t in tokenize(self.blank + word if plain else word)]
                    if mark == "\x01":
                        ids.insert(0, self.newline)
                    if tail is not None:
                        ids.append(tail)
                else:
                    chunk = " " + body if plain else "\n" + body if mark == "\x01" else body
                    ids, unsafe = self.tree(chunk), chunk[-1:].isspace()
            if len(ids) > 65_000:  # too long to remember; its text is encoded whole
                ids, unsafe = [], True
            if unsafe:
                self.open.add(at)
            known[key] = out[i] = at
            size.append(len(ids))
            flat.extend(ids)
            at += 1
        return np.array(out, np.int64)

    def library(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of an Arrow string array; null counts as empty."""
        import pyarrow.compute as pc

        out: list[np.ndarray] = []
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(ends, done + BATCH)))
            out += self._batch(texts.slice(at, end - at))
            at, done = end, ends[end - 1]
        return out

    def _batch(self, texts: pa.Array) -> list[np.ndarray]:
        import pyarrow.compute as pc

        if len(self.known) > REMEMBERED:
            self._forget()
        texts = pc.fill_null(texts, "")
        odd = pc.or_(pc.match_substring(texts, "\x01"), pc.match_substring(texts, "\x02"))
        whole = set(np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist())
        marked = pc.binary_join_element_wise(pa.scalar("\x02"), pc.replace_substring(texts, "\n", " \x01"), "")
        parts = pc.split_pattern(marked, " ")
        words = parts.flatten().dictionary_encode()
        idx = self._learn(words.dictionary.to_pylist())[words.indices.to_numpy()]
        size, flat = np.array(self.size, np.int64), np.array(self.flat, np.uint32)
        first = np.cumsum(size) - size
        ends = np.cumsum(pc.list_value_length(parts).to_numpy().astype(np.int64))
        n = size[idx]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(first[idx] - total[:-1], n) + np.arange(total[-1])]
        cut = total[np.concatenate([[0], ends])]
        if self.open:
            unsafe = np.zeros(len(size), bool)
            unsafe[list(self.open)] = True
            whole |= set(np.searchsorted(ends, np.flatnonzero(unsafe[idx]), "right").tolist())
        out = [ids[a:b] for a, b in zip(cut, cut[1:])]
        for i in whole:
            out[i] = np.array(self.tree(texts[i].as_py()), np.uint32)
        return out

    # -- the tree ---------------------------------------------------------

    def token_bytes(self) -> list[bytes]:
        if self._bytes is None:
            back = {c: b for b, c in enumerate(self.byte_char)}
            n = self.tok.get_vocab_size(with_added_tokens=True)
            added = {i: t.content.encode() for i, t in self.tok.get_added_tokens_decoder().items()}
            words = [self.tok.id_to_token(i) or "" for i in range(n)]
            self._bytes = [added[i] if i in added else bytes(back[c] for c in w) for i, w in enumerate(words)]
        return self._bytes

    def leaves(self, text: str) -> list[str]:
        """Pieces of at most ``leaf`` characters, by halving."""
        if len(text) <= self.leaf:
            return [text]
        half = len(text) // 2
        return self.leaves(text[:half]) + self.leaves(text[half:])

    def tree(self, text: str) -> list[int]:
        return self.join_all([self.library(p) for p in self.leaves(text)])

    def join_all(self, parts: list[list[int]]) -> list[int]:
        """Joined in pairs, level by level."""
        parts = [p for p in parts if len(p)]
        while len(parts) > 1:
            pairs = [self.join(a, b) for a, b in zip(parts[::2], parts[1::2])]
            parts = pairs + parts[len(pairs) * 2 :]
        return parts[0] if parts else []

    def join(self, left: list[int], right: list[int]) -> list[int]:
        table, w = self.token_bytes(), 8
        left, right = list(left), list(right)
        while True:
            a, b = max(0, len(left) - w), min(len(right), w)
            while a > 0 and not self._whole(table[left[a]]):
                a -= 1
            while b < len(right) and not self._whole(table[right[b]]):
                b += 1
            text = b"".join(table[i] for i in left[a:] + right[:b]).decode()
            new = self.library(text)
            keep_l, keep_r = (len(left) - a) // 2, b // 2
            if a == 0 and b == len(right):
                return new
            fits_l = a == 0 or (new[:keep_l] == left[a : a + keep_l] and self._seam(table, left[a - 1], left[a], left[max(0, a - 4) : a + 4]))
            fits_r = b == len(right) or (new[len(new) - keep_r :] == right[b - keep_r : b] and self._seam(table, right[b - 1], right[b], right[max(0, b - 4) : b + 4]))
            if fits_l and fits_r:
                return left[:a] + new + right[b:]
            w *= 2

    @staticmethod
    def _whole(b: bytes) -> bool:
        """Whether a token starts at a character's first byte."""
        return not b or (b[0] & 0xC0) != 0x80

    def _seam(self, table: list[bytes], x: int, y: int, around: list[int]) -> bool:
        """Whether two neighbours stay two tokens in any text: no apostrophe or special token is near, and they re-encode as themselves."""
        near = b"".join(table[i] for i in around)
        if b"'" in near or any(s.encode()[:1] in near for s in self.special):
            return False
        try:
            return self.library((table[x] + table[y]).decode()) == [x, y]
        except UnicodeDecodeError:
            return False

    def decode(self, ids: np.ndarray) -> str:
        table = self.token_bytes()
        raw = b"".join(map(table.__getitem__, ids.tolist()))
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self.tok.decode(ids.tolist(), skip_special_tokens=False)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """A worker's encoder of a vocabulary file."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, text_at: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Small slices of the batches and the ids of their texts."""
    enc = encoder(path)
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            part = b.slice(at, 1000)
            yield part, enc.encode(part.column(text_at))


def _plain(docs: DataFrame, id_col: str, text_col: str, path: str, work, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids in encode_batches(batches, path, 1):
            yield work(part.column(0), ids)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                  long_text: int = LONG_TEXT, outputs: bool = True) -> DataFrame:
    """Encode every text and decode the ids again.

    Returns ``id_col``, ``n_tokens``, ``ids_sha256`` (of decimal ids joined by
    commas), ``decoded_sha256`` and, with ``outputs``, ``ids array<int>`` and
    ``decoded``. One row for each row, repeated ones too; null text counts as
    empty, a null id is kept as it is. Other columns, whatever their names, are
    not read; repeated rows get equal rows; an empty table gives an empty one.

    Documents of more than ``long_text`` characters are cut into leaves that are
    rows of their own, encoded by any task, and joined again document by document.
    """
    ship(docs.sparkSession)
    path = path or default_tokenizer()
    fields = [docs.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if outputs:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    schema = T.StructType(fields)

    def work(key: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
        enc = encoder(path)
        names = _number_names(enc.tok.get_vocab_size(with_added_tokens=True))
        texts = [enc.decode(x) for x in ids]
        sha = [hashlib.sha256(",".join(map(names.__getitem__, x.tolist())).encode()).hexdigest() for x in ids]
        out = [key, pa.array(map(len, ids), pa.int64()), pa.array(sha), pa.array(hashlib.sha256(t.encode()).hexdigest() for t in texts)]
        if outputs:
            out += [pa.array(ids, pa.list_(pa.int32())), pa.array(texts)]
        return pa.RecordBatch.from_arrays(out, names=schema.names)

    size = F.coalesce(F.length(text_col), F.lit(0))
    short = _plain(docs.filter(size <= long_text), id_col, text_col, path, work, schema)
    leaf = LEAF
    # Repeated rows are encoded once and counted, so a row's leaves find each other by id and text.
    whole = docs.filter(size > long_text).groupBy(F.col(id_col).alias("k"), F.col(text_col).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    n_leaves = F.ceil(F.length("x") / leaf)
    leaves = whole.select("k", F.sha2(F.col("x").cast("binary"), 256).alias("h"), "n", F.posexplode(
        F.transform(F.sequence(F.lit(0), n_leaves - 1), lambda i: F.substring(F.col("x"), (i * leaf + 1).cast("int"), F.lit(leaf)))).alias("at", "x"))

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids in encode_batches(batches, path, 4):
            yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(ids, pa.list_(pa.int32()))], names=["k", "h", "n", "at", "ids"])

    leaf_schema = T.StructType([T.StructField("k", docs.schema[id_col].dataType), T.StructField("h", T.StringType()), T.StructField("n", T.LongType()),
                                T.StructField("at", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    done = leaves.repartition(F.col("h"), F.col("at")).mapInArrow(encode_leaves, leaf_schema)
    trees = done.groupBy("k", "h", "n").agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            for i in range(b.num_rows):
                ids = np.array(enc.join_all([p["ids"] for p in b.column(2)[i].as_py()]), np.uint32)
                again = b.column(1)[i].as_py()
                row = work(b.column(0).slice(i, 1), [ids])
                for _ in range(again):
                    yield row

    long = trees.select(F.col("k").alias(id_col), "n", "parts").mapInArrow(join, schema)
    return short.unionByName(long)


_names: dict[int, list[str]] = {}


def _number_names(n: int) -> list[str]:
    if n not in _names:
        _names[n] = [str(i) for i in range(n)]
    return _names[n]
