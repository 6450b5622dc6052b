"""Quality rules: compression bands beside counts of words, symbols, lines and repeats.

zstandard ratios (bytes before over bytes after) of the whole document and of
fixed chunks must lie in a band that depends on length: above it text repeats
itself, below it text doesn't compress, as encoded or random data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .units import trim
from .words import Words, mix, spread, window_starts, windows

REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"
LEVEL = 3


@dataclass(frozen=True)
class Band:
    """Texts of fewer bytes than ``below``: the least and largest ratio of the whole."""

    below: float
    least: float
    most: float


#: Short text compresses badly and long text well, so the band rises with length.
BANDS = (
    Band(100, 0.45, 1.45), Band(200, 0.75, 2.15), Band(400, 1.0, 2.2), Band(800, 1.15, 2.2), Band(1600, 1.3, 2.3),
    Band(3200, 1.4, 2.4), Band(6400, 1.5, 2.5), Band(25_600, 1.6, 2.75), Band(float("inf"), 1.6, 3.2),
)
#: Chunk sizes and the band of a chunk: a text is cut by the largest size that it holds twice.
CHUNKS = ((2048, 1.75, 2.3), (1024, 1.55, 2.15), (512, 1.3, 2.0), (256, 1.15, 1.85))
#: One chunk rejects if it lies outside its band by this much more; two neighbours, or such a share of chunks, if they lie outside at all.
FAR, CHUNK_SHARE = 0.03, 0.15

_CHAR = np.ones(256, bool)  # first byte of a code point that belongs to a word
_CHAR[[0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)]] = False
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_BLANK = bytes([0x20, *range(0x09, 0x0E)])

FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, chunks_out double, chunk_far boolean, base_failed boolean, kept boolean"


def repeated_words(w: Words, k: int = REPEAT_WINDOW) -> np.ndarray:
    """For each text the words that a window of ``k`` words found twice or more in it covers."""
    at = window_starts(w.bounds, k)
    text = np.searchsorted(w.bounds, at, "right") - 1
    if not len(at):
        return np.zeros(len(w.counts), np.int64)
    h = windows(w.hashes, k)[at]
    key = mix(h ^ mix(text.astype(np.uint64)))  # equal only for equal windows of one text
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    change = np.zeros(len(w.starts) + 1, np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + k, -1)
    covered = np.cumsum(change)[:-1] > 0
    return np.bincount(spread(w.bounds), covered, len(w.counts)).astype(np.int64)


def dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(_BLANK)]
    return len(lines) - len(set(lines))


def ratios(text: bytes, compress) -> tuple[float, float, bool]:
    """Ratio of the whole, the share of chunks outside their band, and whether one lies far outside or two neighbours do.

    The last chunk ends with the text, so every byte is in one.
    """
    if not text:
        return 0.0, 0.0, False
    whole = len(text) / len(compress(text))
    for size, least, most in CHUNKS:
        if len(text) >= 2 * size:
            starts = [*range(0, len(text) - size, size), len(text) - size]
            each = [size / len(compress(text[i : i + size])) for i in starts]
            out = [not least <= r <= most for r in each]
            far = any(not least * (1 - FAR) <= r <= most * (1 + FAR) for r in each) or any(x and y for x, y in zip(out, out[1:]))
            return whole, sum(out) / len(out), far
    return whole, 0.0, False


def in_band(size: int, ratio: float, chunks_out: float, chunk_far: bool) -> bool:
    band = next(b for b in BANDS if size < b.below)
    return band.least <= ratio <= band.most and chunks_out < CHUNK_SHARE and not chunk_far


def assess(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and the counts and verdicts of ``FIELDS``.

    Input columns named like one of those give way to it. Null or wordless text
    has zero counts and fails the base rule; each row is judged alone, so repeated
    rows get equal verdicts and an empty table gives an empty one. Texts of any
    length are compressed whole; a ratio equal to a limit of its band is kept.
    """
    ship(docs.sparkSession)
    extra = T.StructType.fromDDL(FIELDS)
    carried = [f for f in docs.schema if f.name not in extra.names]
    schema = T.StructType(carried + list(extra))
    keep = [f.name for f in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                texts = [t or b"" for t in b.column(text_col).cast(pa.binary()).to_pylist()]
                w = Words(texts)
                buf = np.frombuffer(w.data, np.uint8)
                first = w.text_starts[:-1]
                chars = np.add.reduceat(_CHAR[buf], first, dtype=np.int64)
                symbols = np.add.reduceat(_SYMBOL[buf], first, dtype=np.int64)
                repeats = repeated_words(w)
                both = [ratios(t, compress) for t in texts]
                failed = (w.counts < 10) | (100 * repeats > 20 * w.counts)
                kept = [not f and in_band(len(t), *r) for f, t, r in zip(failed, texts, both)]
                out = [pa.array(w.counts, pa.int64()), pa.array(chars), pa.array(symbols), pa.array([dup_lines(t) for t in texts], pa.int64()), pa.array(repeats),
                       pa.array([r[0] for r in both], pa.float64()), pa.array([r[1] for r in both], pa.float64()), pa.array([r[2] for r in both], pa.bool_()), pa.array(failed), pa.array(kept, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *out], names=schema.names)
        trim()

    return docs.select(*docs.columns).mapInArrow(run, schema)


def keep(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps, with all columns as they are, whatever their names.

    Null, empty and wordless texts go, as they fail the base rule; texts of any
    length are judged whole, repeated rows alike, without ties. An empty table gives
    an empty one.
    """
    safe = {c: f"carried_{i}" if c in T.StructType.fromDDL(FIELDS).names else c for i, c in enumerate(docs.columns)}
    held = assess(docs.select(*[F.col(c).alias(n) for c, n in safe.items()]), safe[text_col]).filter("kept")
    return held.select(*[F.col(n).alias(c) for c, n in safe.items()])
