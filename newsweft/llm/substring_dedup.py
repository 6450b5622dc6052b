"""Substring dedup with a count-min prefilter.

Pass 1 sketches how often windows occur. Each unit of documents has a sketch of
its own windows, sparse, as the cells that it hits; the sketches are merged by
ranges of cells, and a range answers to each unit which of its cells were hit
twice or more by all. The count is never too small, so a window with a cell hit
once is certainly unique. Pass 2 groups exactly, by 96 bits of hash, only the
windows estimated to be repeated, and pass 3 removes words.

The sketch has ``cells_per_window`` cells a window at every size of the input,
lies in ranges of 2**20 cells and is never gathered, so what passes the filter
is the same share of unique windows whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import units as un
from .scratch import free, persist, sweep
from .words import Words, mix, window_starts, windows

WINDOW = 13
#: Bytes of text a word takes at least, on average, in the estimate of windows.
BYTES_A_WORD = 6
#: Rows of the sketch, and cells of a row for each window.
DEPTH = 2
CELLS_A_WINDOW = 2.0
#: Cells of a range, which one task merges.
RANGE = 1 << 20
_OTHER_BASE = 0xD1342543DE82EF95
_ROWS = [np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _hashes(texts: list[bytes | None], window: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, the word at which each window starts, its 64-bit hash and 32 more bits."""
    w = Words(texts)
    at = window_starts(w.bounds, window)
    if not len(at):
        return w, at, np.empty(0, np.uint64), np.empty(0, np.uint32)
    first = mix(windows(w.hashes, window)[at])
    second = mix(windows(mix(w.hashes ^ _ROWS[3]), window, _OTHER_BASE)[at]).astype(np.uint32)
    return w, at, first, second


def _cells(h: np.ndarray, row: int, ranges: int) -> np.ndarray:
    """Cell of each hash in a row of ``ranges`` ranges: the number of the range, then 20 bits of the place in it."""
    x = mix(h ^ _ROWS[row])
    return (((x >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)) << np.uint64(20)) | (x & np.uint64(RANGE - 1))


def sketch_of(h: np.ndarray, ranges: int, depth: int = DEPTH) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The sparse sketch of some windows: for each range that they hit its number, the places hit, and which of them twice."""
    for row in range(depth):
        cells = _cells(h, row, ranges)
        cells.sort()
        new = np.concatenate([[True], cells[1:] != cells[:-1]])
        only = cells[new]
        twice = np.diff(np.append(np.flatnonzero(new), len(cells))) > 1
        cut = np.searchsorted(only, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(20))
        for s in np.flatnonzero(np.diff(cut)):
            part = slice(cut[s], cut[s + 1])
            yield row * ranges + int(s), (only[part] & np.uint64(RANGE - 1)).astype(np.uint32), twice[part]


def merge(_: list[int], blobs: list[bytes]) -> list[bytes]:
    """Merge a range's sparse sketches; for each a bit a place: whether all of them together hit it twice or more."""
    hits, places = np.zeros(RANGE, np.uint8), []
    for b in blobs:
        n = int.from_bytes(b[:4], "little")
        at = un.unsqueeze_sorted(b[4 + (n + 7) // 8 :], np.uint32)
        twice = np.unpackbits(np.frombuffer(b, np.uint8, (n + 7) // 8, 4), count=n)
        hits[at] = np.minimum(hits[at] + 1 + twice, 2)
        places.append(at)
    return [np.packbits(hits[at] >= 2).tobytes() for at in places]


def suspects(h: np.ndarray, ranges: int, answers: dict[int, bytes], depth: int = DEPTH) -> np.ndarray:
    """Whether every row of the merged sketch says that a window occurs twice or more."""
    sus = np.ones(len(h), bool)
    for row in range(depth):
        cells = _cells(h, row, ranges)
        order = np.argsort(cells)
        cells = cells[order]
        new = np.ones(len(cells), bool)
        new[1:] = cells[1:] != cells[:-1]
        only = cells[new]
        cut = np.searchsorted(only, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(20))
        seen = np.zeros(len(only), bool)
        for s in np.flatnonzero(np.diff(cut)):
            seen[cut[s] : cut[s + 1]] = np.unpackbits(np.frombuffer(answers[row * ranges + int(s)], np.uint8), count=cut[s + 1] - cut[s])
        sus[order] &= seen[np.cumsum(new) - 1]
    return sus


def _ordered_texts(rows: pa.StructArray, text_col: str, id_col: str) -> list[bytes | None]:
    """Texts; those without an id take no part and count as empty."""
    ids = rows.field(id_col).is_valid().to_pylist()
    return [t if ok else None for t, ok in zip(un.texts_of(rows, text_col), ids)]


def _groups(h: np.ndarray, g: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (h, g, doc), where a new (h, g) starts in it, and the group of each place in it."""
    order = np.lexsort((doc, g, h))
    h, g = h[order], g[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    return order, new, np.cumsum(new) - 1


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                     window: int = WINDOW, cells_per_window: float = CELLS_A_WINDOW) -> DataFrame:
    """Remove passages that start, word for word, in a document with a smaller id.

    Returns ``id_col`` (an integer), ``text_col`` (kept words joined by a space),
    ``n_words``, ``n_removed`` and the ``carry`` columns; an input column named
    like an output column gives way to it. A row for each row: null text has no
    words and gives an empty text; rows with a null id are neither sources nor
    cut; rows that share an id never cut each other, and repeated rows are cut
    alike. Texts are cut whole, whatever their length; one longer than a unit is
    a unit of its own. An empty table gives an empty one.
    """
    carry = tuple(c for c in carry if c not in (id_col, text_col, "n_words", "n_removed"))
    used = docs.select(id_col, text_col, *carry)
    total = un.text_bytes(used, text_col)
    estimate = max(1, total // BYTES_A_WORD)
    ranges = max(1, int(estimate * cells_per_window) // RANGE + (cells_per_window >= 1))
    units = un.stage(used, text_col, total_bytes=total)
    shards = un.shards_for(estimate / 2)
    spark = docs.sparkSession

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of():
            for unit, rows, _ in un.each_unit(batches):
                h = _hashes(_ordered_texts(rows, text_col, id_col), window)[2]
                if len(h):
                    for s, at, twice in sketch_of(h, ranges):
                        yield s, unit, len(at).to_bytes(4, "little") + np.packbits(twice).tobytes() + un.squeeze_sorted(at)

        yield from un.in_batches(rows_of())

    merged = persist(un.ask(units.mapInArrow(sketch, un.QUESTION), DEPTH * ranges, merge), "sketch-answers")
    sweep(spark)

    def local(rows: pa.StructArray, filtered):
        """The unit's suspect windows by hash: words, starts, documents, group of each, and for each group hash, bits, smallest id; last, which windows are suspect."""
        ids = pc.fill_null(rows.field(id_col).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
        w, at, h, g = _hashes(_ordered_texts(rows, text_col, id_col), window)
        sus = filtered(h)
        at, h, g = at[sus], h[sus], g[sus]
        row = np.searchsorted(w.bounds, at, "right") - 1
        doc = ids[row]
        order, new, group = _groups(h, g, doc)
        first = order[new]
        return w, at[order], row[order], doc[order], group, h[first], g[first], doc[first], sus

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of():
            for unit, rows, more in un.each_unit(batches):
                got = un.answer_map(more["answers"])
                *_, h, g, low, sus = local(rows, lambda h: suspects(h, ranges, got))  # noqa: B023
                yield from un.questions(unit, h, shards, [g, low])
                if len(h):  # what passed the filter comes back with the answers, so that it is worked out once
                    yield shards + unit % shards, unit, un.squeeze(np.packbits(sus))

        yield from un.in_batches(rows_of())

    def answer(_: list[int], blobs: list[bytes]) -> list[bytes | None]:
        """For each blob a bit for each hash: whether another unit has it in a document of a smaller id."""
        sizes = [len(b) // 20 for b in blobs]
        h = np.concatenate([np.frombuffer(b, np.uint64, n) for b, n in zip(blobs, sizes)])
        g = np.concatenate([np.frombuffer(b, np.uint32, n, 8 * n) for b, n in zip(blobs, sizes)])
        low = np.concatenate([np.frombuffer(b, np.int64, n, 12 * n) for b, n in zip(blobs, sizes)])
        order, new, group = _groups(h, g, low)
        smaller = np.empty(len(h), bool)
        smaller[order] = low[order][new][group] < low[order]
        cuts = np.cumsum([0, *sizes])
        return [np.packbits(part).tobytes() if (part := smaller[a:b]).any() else None for a, b in zip(cuts, cuts[1:])]

    exact = persist(un.ask(un.answered(units, merged).mapInArrow(emit, un.QUESTION), shards, answer, notes=True), "substring-answers")
    free(merged)
    sweep(spark)
    schema = T.StructType([docs.schema[id_col], T.StructField(text_col, T.StringType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), *(docs.schema[c] for c in carry)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, more in un.each_unit(batches):
            answers = un.answer_map(more["answers"])
            marks = next((un.unsqueeze(b, np.uint8) for s, b in answers.items() if s >= shards), np.empty(0, np.uint8))
            w, at, row, doc, group, h, _, low, _ = local(rows, lambda h: np.unpackbits(marks, count=len(h)).astype(bool) if len(marks) else np.zeros(len(h), bool))  # noqa: B023
            smaller, edges = np.zeros(len(h), bool), un.shard_of(h, shards)
            for s, bits in answers.items():
                if s < shards:
                    a, z = edges[s], edges[s + 1]
                    smaller[a:z] = np.unpackbits(np.frombuffer(bits, np.uint8), count=z - a)
            hit = at[smaller[group] | (low[group] < doc)] if len(at) else at
            change = np.zeros(len(w.starts) + 1, np.int64)
            np.add.at(change, hit, 1)
            np.add.at(change, np.minimum(hit + window, len(w.starts)), -1)
            gone = np.cumsum(change)[:-1] > 0
            valid = rows.field(id_col).is_valid().to_numpy(zero_copy_only=False)
            texts = un.texts_of(rows, text_col)
            out, n_words, n_gone = [], [], []
            for i in range(len(rows)):
                words = (texts[i] or b"").split()
                removed = int(gone[w.bounds[i] : w.bounds[i + 1]].sum()) if valid[i] else 0
                n_words.append(len(words))
                n_gone.append(removed)
                if removed:
                    words = [words[j] for j in np.flatnonzero(~gone[w.bounds[i] : w.bounds[i + 1]])]
                out.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [rows.field(id_col), pa.array(out, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), *(rows.field(c) for c in carry)],
                names=schema.names)

    return un.answered(units, exact).mapInArrow(cut, schema)


def digest(result: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return result.select(id_col, "n_words", "n_removed", F.sha2(F.col(text_col).cast("binary"), 256).alias("kept_sha256"))
