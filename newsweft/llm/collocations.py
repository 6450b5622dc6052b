"""Collocations by pivot partitioning: every phrase is counted where its rarest word is.

Words that occur ``least`` times in a language get a number and a frequency; all
others break the text, as no frequent phrase holds them. Words are ordered by
frequency (then number), and a phrase's pivot is its rarest word, at its leftmost
place. For each place of a text, the fragment in which its word is the pivot is
rewritten: up to three neighbours before it that are more frequent, up to three
behind it that are no rarer, and nothing beyond the first rarer one. Fragments
go to their pivot's bucket, equal ones of a unit once with their number; there
the phrases that hold the pivot are counted, from short to long. Any occurrence
of a phrase lies in exactly one fragment of its pivot, so no count is split,
except for very frequent pivots, which are dealt by unit and summed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from . import units as un
from .scratch import free, persist, persist_bucketed
from .words import Words, mix

#: Occurrences that make a phrase a candidate; words of the longest phrase; rows returned a language.
LEAST, LONGEST, TOP = 30, 4, 2000
#: A candidate goes if a longer one that holds it has so many hundredths of its count.
COVERED = 80
NO_LANG = "und"
#: Phrases end at these, besides the end of a text.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_TO_SPACE = bytes.maketrans(BREAKS, b" " * len(BREAKS))
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(BREAKS)] = True

UNIT_BYTES = 6 << 20
#: Bytes of text whose fragments make a bucket, roughly, and fragments that are mined together.
BUCKET_BYTES, FRAGMENTS = 8 << 20, 3 << 19
#: A pivot is dealt to one bucket for each so many occurrences.
SPLIT = 1 << 20
#: Buckets that units address; with more of them, fragments are forwarded once (two hops).
FAN_OUT = 4096
#: Frequent words of all languages up to which their table is broadcast (some 100 bytes each); beyond, joins shuffle.
BROADCAST_WORDS = 300_000

_STAGED = "unit_id long, lang string, n long, tokens binary, words array<string>, counts array<long>"
_SENT = "bucket long, blob binary"
_GRAMS = "ids array<long>, a long"


class Pieces:
    """Lower-cased words of texts, as numbers of the distinct ones, and where pieces start."""

    def __init__(self, texts: list[bytes | None]):
        texts = [t or b"" for t in texts]
        w = Words([t.translate(_TO_SPACE) for t in texts], lower=True)
        _, first, self.token = np.unique(w.hashes, return_index=True, return_inverse=True)
        breaks = np.cumsum(_IS_BREAK[np.frombuffer(b" ".join(texts) + b" ", np.uint8)], dtype=np.int32)
        place, text = breaks[w.starts], w.text_of_word()
        self.starts = np.ones(len(place), bool)
        self.starts[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
        self.counts = np.bincount(self.token, minlength=len(first))
        self.words = _strings(w, first)


def _strings(w: Words, at: np.ndarray) -> pa.Array:
    """Words at these places, lower-cased."""
    start, size = w.starts[at], (w.ends - w.starts)[at]
    ends = np.cumsum(size)
    data = np.frombuffer(w.data.lower(), np.uint8)[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def stage(docs: DataFrame, text_col: str, lang_col: str, unit_bytes: int = UNIT_BYTES, total: int = 0) -> DataFrame:
    """A few megabytes of texts of one language a row: numbered words with piece starts, and the distinct words with their counts."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            langs: dict[str, list[int]] = {}
            for i, lang in enumerate(b.column("lang").to_pylist()):
                langs.setdefault(lang, []).append(i)
            for lang, rows in langs.items():
                sizes = np.array([len(texts[i] or b"") for i in rows], np.int64)
                group = (np.cumsum(sizes) - sizes) // unit_bytes
                for g in np.unique(group):
                    p = Pieces([texts[rows[k]] for k in np.flatnonzero(group == g)])
                    if not len(p.token):
                        continue
                    tokens = un.squeeze((p.token.astype(np.uint32) << np.uint32(1)) | p.starts.astype(np.uint32))
                    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([base + made], pa.int64()), pa.array([lang]), pa.array([len(p.token)], pa.int64()), pa.array([tokens], pa.binary()), one(p.words), one(pa.array(p.counts, pa.int64()))],
                        names=["unit_id", "lang", "n", "tokens", "words", "counts"])
                    made += 1
                    del p
            un.trim()

    rows = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"))
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return persist_bucketed(rows.mapInArrow(cut, _STAGED), "pieces", "unit_id", max(least, min(100_000, total // (4 * unit_bytes) + 1)))


def frequent_words(staged: DataFrame, least: int) -> DataFrame:
    """``id, lang, word, f`` of words that a language has ``least`` times; ids count from 1 without gaps."""
    each = staged.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    counts = each.groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f")).filter(F.col("f") >= least)
    found = persist(counts.withColumn("raw", F.monotonically_increasing_id()), "words")
    part = F.shiftrightunsigned("raw", 33)
    # A row a partition of the count, at most; the running sum is over these.
    sizes = sorted((r["p"], r["c"]) for r in found.groupBy(part.alias("p")).agg(F.count("*").alias("c")).collect())
    starts, total = {}, 1
    for p, c in sizes:
        starts[p], total = total, total + c
    spark = staged.sparkSession
    first = spark.createDataFrame(list(starts.items()), "p long, first long")
    return found.withColumn("p", part).join(F.broadcast(first), "p").select((F.col("first") + F.col("raw").bitwiseAND((1 << 33) - 1)).alias("id"), "lang", "word", "f")


def fragments(token: np.ndarray, starts: np.ndarray, ids: np.ndarray, f: np.ndarray, reach: int = LONGEST - 1) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fragments and how often each occurs.

    ``ids`` and ``f`` are by token, 0 for words that aren't frequent. Columns of a
    fragment: the pivot, its neighbours before it from the nearest on, then those
    behind it; 0 where it ends.
    """
    order = np.empty(len(ids), np.int64)
    order[np.lexsort((ids, -f))] = np.arange(len(ids))  # low for frequent words
    rank = np.where(ids > 0, order, len(ids))[token]
    gid = ids[token]
    piece = np.cumsum(starts)
    n = len(token)
    cols = np.zeros((1 + 2 * reach, n), ids.dtype)
    cols[0] = gid
    for side, sign in ((0, -1), (1, 1)):
        open_ = gid > 0
        for k in range(1, reach + 1):
            here, there = (slice(k, None), slice(0, max(0, n - k))) if sign < 0 else (slice(0, max(0, n - k)), slice(k, None))
            more = np.zeros(n, bool)
            lower = rank[there] < rank[here] if sign < 0 else rank[there] <= rank[here]
            more[here] = open_[here] & lower & (piece[there] == piece[here])
            open_ = more
            cols[1 + side * reach + k - 1, here] = np.where(more[here], gid[there], 0)
    held = cols[:, (cols[1] > 0) | (cols[1 + reach] > 0)].T
    if not len(held):
        return held, np.zeros(0, np.int64)
    key = np.zeros(len(held), np.uint64)
    for c in held.T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64))
    _, at, same, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    if np.array_equal(held[at][same], held):
        return held[at], counts
    return held, np.ones(len(held), np.int64)  # two fragments of one key: all are sent as they are


def _dense(cols: list[np.ndarray]) -> np.ndarray:
    """One number a row, equal for equal rows and only for these."""
    out, top = cols[0], int(cols[0].max(initial=0)) + 1
    for c in cols[1:]:
        size = int(c.max(initial=0)) + 1
        if top * size >= 1 << 62:
            distinct, out = np.unique(out, return_inverse=True)
            top = len(distinct)
        out, top = out * size + c, top * size
    return out


def mine(rows: np.ndarray, counts: np.ndarray, whole: np.ndarray, least: int, reach: int = LONGEST - 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases as rows of ids, counts) of the phrases that hold their fragment's pivot, shape by shape.

    Pivots that are ``whole`` here yield phrases of ``least`` occurrences only;
    phrases of these are grown from such shorter ones. Others yield all.
    """
    ok = {(0, 0): np.ones(len(rows), bool)}
    for size in range(2, reach + 2):
        for i in range(size):
            j = size - 1 - i
            last = rows[:, i] if i else rows[:, 0]
            live = (last > 0) & ((rows[:, reach + j] > 0) if j else True)
            for shorter in ((i - 1, j), (i, j - 1)):
                if shorter in ok:
                    live &= ok[shorter]
            at = np.flatnonzero(live)
            ok[i, j] = np.zeros(len(rows), bool)
            if not len(at):
                continue
            cols = [*range(i, 0, -1), 0, *range(reach + 1, reach + 1 + j)]
            _, one, same = np.unique(_dense([rows[at, c].astype(np.int64) for c in cols]), return_index=True, return_inverse=True)
            a = _sums(same, counts[at], len(one))
            good = (a >= least) | ~whole[at[one]]
            ok[i, j][at] = good[same]
            yield rows[np.ix_(at[one[good]], cols)], a[good]


def _sums(same: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    if counts.sum() < 1 << 53:
        return np.bincount(same, counts, n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, same, counts)
    return out


def _send(bucket: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A blob for each bucket: its fragments and their counts."""
    order = np.lexsort((rows[:, 0], bucket))
    bucket, table = bucket[order], np.column_stack([rows, counts.astype(rows.dtype)])[order]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)) if len(bucket) else []
    held, size = ([], []), 0
    for s, e in zip(cut[:-1], cut[1:]):
        held[0].append(int(bucket[s]))
        held[1].append(un.squeeze(np.ascontiguousarray(table[s:e].T).reshape(-1)))
        size += len(held[1][-1])
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.int64()), pa.array(held[1], pa.binary())], names=["bucket", "blob"])
            held, size = ([], []), 0
    if held[0]:
        yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.int64()), pa.array(held[1], pa.binary())], names=["bucket", "blob"])


def _received(batches: Iterator[pa.RecordBatch], kind: type, most: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(bucket, table of fragments and counts, whether that is all of it), a bucket at a time, ``most`` rows or so at once."""
    width = 2 * LONGEST
    held, size, bucket, cut = [], 0, None, False
    for b in batches:
        for k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if held and (k != bucket or size >= most):
                more = k == bucket
                yield bucket, np.concatenate(held), not (cut or more)
                held, size, cut = [], 0, more
            elif k != bucket:
                cut = False
            bucket = k
            held.append(np.ascontiguousarray(un.unsqueeze(blob, kind).reshape(width, -1).T))
            size += len(held[-1])
    if held:
        yield bucket, np.concatenate(held), not cut


def _bucket_of(pivot: np.ndarray, salt: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(pivot.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def phrases(staged: DataFrame, words: DataFrame, total: int, least: int = LEAST, buckets: int | None = None, fan_out: int = FAN_OUT, split: int = SPLIT, most: int = FRAGMENTS, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """``ids array<long>, a long``: phrases of 2 to 4 words that occur ``least`` times."""
    n_words = words.count()
    kind = np.uint32 if n_words < 1 << 31 and total < 1 << 40 else np.uint64
    buckets = buckets or max(1, total // BUCKET_BYTES + 1)
    known = F.broadcast(words) if n_words <= broadcast_words else words
    asked = staged.select("unit_id", "lang", F.posexplode("words").alias("at", "word"))
    found = asked.join(known, ["lang", "word"]).groupBy("unit_id").agg(F.collect_list(F.struct("at", "id", "f")).alias("known"))
    units = staged.select("unit_id", "tokens").join(found, "unit_id")

    hops = [buckets]
    if buckets > fan_out:
        hops.insert(0, fan_out)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                unit, packed = b.column("unit_id")[r].as_py(), un.unsqueeze(b.column("tokens")[r].as_py(), np.uint32)
                known = b.column("known")[r].values
                at, gid, freq = (known.field(c).to_numpy(zero_copy_only=False) for c in ("at", "id", "f"))
                token = (packed >> np.uint32(1)).astype(np.int64)
                ids, f = np.zeros(int(token.max()) + 1, kind), np.zeros(int(token.max()) + 1, np.int64)
                ids[at], f[at] = gid, freq
                rows, counts = fragments(token, (packed & np.uint32(1)).astype(bool), ids, f)
                order = np.argsort(gid)
                times = f[at[order]][np.searchsorted(gid[order], rows[:, 0].astype(np.int64))]
                bucket = _bucket_of(rows[:, 0], unit % (1 + times // split), buckets)
                yield from _send(bucket % hops[0], rows, counts)
            un.trim()

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Salts are dealt anew, by fragment, so a split pivot stays split."""
        for _, table, _ in _received(batches, kind, most):
            salt = _salt(table, split_of.value)
            yield from _send(_bucket_of(table[:, 0], salt, buckets), table[:, :-1], table[:, -1])
            un.trim()

    spark = staged.sparkSession
    # Words that are split: each has ``split`` occurrences or more, so there are no more than the corpus has tokens / split.
    hot = {r["id"]: 1 + r["f"] // split for r in words.filter(F.col("f") >= split).select("id", "f").toLocalIterator()}
    split_of = spark.sparkContext.broadcast((np.array(sorted(hot), np.int64), np.array([hot[k] for k in sorted(hot)], np.int64)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table, all_here in _received(batches, kind, most):
            rows, counts = table[:, :-1], table[:, -1].astype(np.int64)
            whole = (_parts(rows[:, 0], split_of.value) == 1) & all_here
            for grams, a in mine(rows, counts, whole, least):
                for s in range(0, len(a), 1 << 18):
                    g = grams[s : s + (1 << 18)].astype(np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(g) + 1) * grams.shape[1], pa.int32()), pa.array(g.reshape(-1), pa.int64()))
                    yield pa.RecordBatch.from_arrays([lists, pa.array(a[s : s + (1 << 18)], pa.int64())], names=["ids", "a"])
            un.trim()

    def dealt(sent: DataFrame, n: int) -> DataFrame:
        return sent.repartition(min(n, 20_000), "bucket").sortWithinPartitions("bucket")

    sent = dealt(units.mapInArrow(route, _SENT), hops[0])
    if len(hops) > 1:
        sent = dealt(sent.mapInArrow(forward, _SENT), buckets)
    return sent.mapInArrow(count, _GRAMS).groupBy("ids").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)


def _parts(pivot: np.ndarray, split_of: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Buckets that each pivot is dealt to."""
    ids, n = split_of
    if not len(ids):
        return np.ones(len(pivot), np.int64)
    at = np.minimum(np.searchsorted(ids, pivot.astype(np.int64)), len(ids) - 1)
    return np.where(ids[at] == pivot.astype(np.int64), n[at], 1)


def _salt(table: np.ndarray, split_of: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    key = np.zeros(len(table), np.uint64)
    for c in table[:, :-1].T:
        key = mix(key + c.astype(np.uint64))
    return (key % _parts(table[:, 0], split_of).astype(np.uint64)).astype(np.int64)


def _exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int | None = TOP, covered: int = COVERED, **how) -> DataFrame:
    """Each language's phrases of 2 to 4 words that stick together, best first.

    Returns ``lang, rank, phrase, a, l, r, n, score``: the phrase's count, the
    counts of the two parts of its worst cut, the language's words, and
    floor(2000000 a / (l + r)); at most ``top`` rows a language (None: all). Other
    columns, whatever their names, are not read. Null texts count as empty, a null
    language is ``und``; texts of any length are read whole. Repeated rows count
    each time. Ties of score go by count, then by the phrase's bytes; ties of cuts
    to the first one. An empty table, or one without candidates, gives an empty
    one. Counts and scores are exact: words are compared by 64-bit hashes inside a
    few megabytes of text only, and by themselves elsewhere.
    """
    total = un.text_bytes(docs, text_col)
    staged = stage(docs, text_col, lang_col, total=total)
    words = persist(frequent_words(staged, least), "numbered")
    totals = persist(staged.groupBy("lang").agg(F.sum("n").alias("n")), "totals")  # a row a language
    grams = persist(phrases(staged, words, total, least, **how), "phrases")
    free(staged)

    limit = how.get("broadcast_words", BROADCAST_WORDS)
    known = F.broadcast(words) if words.count() <= limit else words
    each = grams.select("ids", "a", F.posexplode("ids").alias("at", "id")).join(known, "id")
    spelt = each.groupBy("ids").agg(F.first("a").alias("a"), F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word", "f"))).alias("w"))
    spelt = persist(spelt.select("ids", "a", "lang", F.col("w.word").alias("words"), F.col("w.f").alias("f")), "spelt")
    n = F.size("ids")
    sub = lambda at, k: F.slice("ids", at, k)

    # Counts of parts of two words and more: the first or last 2 or 3 words. Shorter phrases ask for themselves, as nulls would meet in one task.
    counted = spelt
    for name, at, k, size in (("first2", F.lit(1), 2, 3), ("last2", n - 1, 2, 3), ("first3", F.lit(1), 3, 4), ("last3", n - 2, 3, 4)):
        part = spelt.select(F.col("ids").alias("part"), F.col("a").alias(name)).filter(F.size("part") == k)
        counted = counted.withColumn("part", F.when(n >= size, F.slice("ids", at, F.lit(k))).otherwise(F.col("ids"))).join(part, "part", "left").drop("part")
    f = lambda i: F.get("f", i)

    def cut(k: int, size: int) -> Column:
        one = lambda words_, where: f(F.lit(0) if where == "first" else n - 1) if words_ == 1 else F.col(f"{where}{words_}")
        left, right = one(k, "first"), one(size - k, "last")
        score = (_exact("a") * F.lit(2_000_000).cast("decimal(7,0)"))
        return F.struct(F.call_function("div", score, _exact(left) + _exact(right)).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    cuts = F.when(n == 2, F.array(cut(1, 2))).when(n == 3, F.array(cut(1, 3), cut(2, 3))).otherwise(F.array(*[cut(k, 4) for k in (1, 2, 3)]))
    counted = counted.withColumn("cut", F.array_min(cuts))

    # Shorter phrases inside longer ones, with the largest count of those.
    inside = F.when(n == 3, F.array(sub(1, 2), sub(2, 2))).when(n == 4, F.array(sub(1, 2), sub(2, 2), sub(3, 2), sub(1, 3), sub(2, 3)))
    longer = spelt.filter(n > 2).select(F.explode(inside).alias("ids"), F.col("a").alias("most")).groupBy("ids").agg(F.max("most").alias("most"))
    kept = counted.join(longer, "ids", "left").filter(F.col("most").isNull() | (_exact("most") * F.lit(100).cast("decimal(3,0)") < _exact("a") * F.lit(covered).cast("decimal(3,0)")))
    rows = kept.join(totals, "lang").select("lang", F.array_join("words", " ").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
