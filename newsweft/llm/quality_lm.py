"""Quality classifier: perplexity under interpolated modified Kneser-Ney models.

The models are of bytes, order 5, across words: what stands before a blank is
context of what follows. There is one for each language, fitted on trusted
documents (labels: quality 1, not toxic). Fitting may take a bounded sample of
them: the ``fit_rows`` with the smallest hash of their id. Counts, continuation
counts, discounts and back-off weights are DataFrame aggregations; the
resulting table is sharded by hash of the n-gram. Each unit of documents asks
the shards for its distinct n-grams, so every document's perplexity comes from
joins with count shards whatever the model's size.

A document is judged by its log-perplexity, less a leave for short texts, and by
its worst word, as an average hides single words. Either is rejected above its
language's limit: the QUANTILE of trusted documents that the model was not
fitted on (one fold in HELD_FOLDS).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from . import units as un
from .scratch import free, persist, sweep
from .words import mix

ORDER = 5
#: Labelled rows to fit on at most.
FIT_ROWS = 20_000
#: One trusted document in so many is held out of fitting and sets the limits.
HELD_FOLDS = 5
#: The share of held-out trusted documents that lies below the limits.
QUANTILE = 0.99
#: In a language with fewer held-out documents, the limits lie LEAVE above the quantile of the fitted ones.
LEAST_HELD = 20
LEAVE = 0.25
#: Short texts vary more: this over the root of their bytes is taken off.
SHORT = 1.5
ALPHABET = 257
UNIT_BYTES = 8 << 20
#: Bytes of texts that are worked on at once.
SLICE = 2 << 20
_U = np.uint64
_SIZE, _LANG = 40, 48  # bits below the length and the language of a key
_BYTES = (1 << _SIZE) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def packed(a: np.ndarray) -> np.ndarray:
    """Weights in (0, 1] as 16 bits on a scale of logarithms, to 1 part in 4096; 0 for none."""
    with np.errstate(divide="ignore"):
        return np.where(a > 0, np.clip(np.rint(-np.log(a) * 4096), 0, 65534) + 1, 0).astype(np.uint16)


def unpacked(a: np.ndarray) -> np.ndarray:
    return np.where(a > 0, np.exp((1.0 - a) / 4096), 0.0)


def slices(texts: list[bytes | None], most: int = SLICE) -> Iterator[slice]:
    """Runs of texts of at most ``most`` bytes, or of one text."""
    at = size = 0
    for i, t in enumerate(texts):
        n = len(t or b"")
        if i > at and size + n > most:
            yield slice(at, i)
            at, size = i, 0
        size += n
    if at < len(texts):
        yield slice(at, len(texts))


def distinct(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, in no order, and which of them each is."""
    d = pa.array(a).dictionary_encode()
    return d.dictionary.to_numpy(), d.indices.to_numpy()


class Grams:
    """Windows of up to ORDER bytes that end at each byte of a text's words or at the blank behind a word.

    Words are parted by one blank whatever white space the text has, and one
    stands before the first. ``keys`` are the distinct (language, length, bytes),
    ``window`` that of each byte predicted, ``first`` the place of each word,
    ``steps`` its bytes with the blank, ``text`` its text; ``counts`` words and
    ``bytes_of`` bytes of each text.
    """

    def __init__(self, texts: list[bytes | None], langs: np.ndarray):
        texts = [t or b"" for t in texts]
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        space = _SPACE[raw]
        start = np.flatnonzero(~space & np.append(True, space[:-1]))
        end = np.flatnonzero(space & np.append(False, ~space[:-1]))
        keep = ~space
        keep[end] = True  # one byte behind each word, taken as a blank
        byte = np.where(space, np.uint8(0x20), raw)[keep]
        self.steps = end - start + 1
        total = np.concatenate([[0], np.cumsum(self.steps)])
        self.first = total[:-1]
        text_at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        bounds = np.searchsorted(start, text_at)
        self.counts, self.bytes_of = np.diff(bounds), np.diff(total[bounds])
        self.text = np.repeat(np.arange(len(texts)), self.counts)
        # Before each text stand zeros and a blank, so windows at its start have zeros where nothing stands.
        text = np.repeat(np.arange(len(texts), dtype=np.int32), self.bytes_of)
        at = np.arange(len(byte)) + (ORDER - 1) * (text + 1)
        stream = np.zeros(len(byte) + (ORDER - 1) * len(texts), np.uint64)
        stream[at] = byte
        first = total[bounds][:-1]
        some = self.bytes_of > 0
        stream[(first + (ORDER - 1) * np.arange(1, len(texts) + 1) - 1)[some]] = 0x20
        gram = stream.copy()
        for k in range(1, ORDER):
            gram[k:] |= stream[: len(stream) - k] << _U(8 * k)
        # A window that reaches back into the text before is cut at its own text's start.
        key = gram[at] | (langs.astype(np.uint64) << _U(_LANG))[text] | _U(ORDER << _SIZE)
        for j in range(ORDER - 2):  # a text's first bytes have shorter windows: of two bytes and more
            short = first[self.bytes_of > j] + j
            key[short] = (key[short] & ~_U(((1 << _LANG) - 1) ^ ((1 << 8 * (j + 2)) - 1))) | _U((j + 2) << _SIZE)
        self.keys, self.window = distinct(key)


def orders(keys: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """For each order of some windows: key of the n-gram, key of its context, whether the window is that long."""
    lang, size, gram = keys & ~_U((1 << _LANG) - 1), (keys >> _U(_SIZE)) & _U(7), keys & _U(_BYTES)
    cut = [gram & _U((1 << 8 * k) - 1) for k in range(1, ORDER + 1)]
    full = [lang | _U(k << _SIZE) | cut[k - 1] for k in range(1, ORDER + 1)]
    context = [lang | _U((k - 1) << _SIZE) | (cut[k - 1] >> _U(8)) for k in range(1, ORDER + 1)]
    return full, context, [size >= _U(k) for k in range(1, ORDER + 1)]


def trusted_ids(labels: DataFrame, id_col: str) -> DataFrame:
    """``id_col, held`` of trusted documents; those held out of fitting set the limits."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select(id_col).distinct()
    return good.withColumn("held", F.pmod(F.xxhash64(id_col, F.lit(11)), F.lit(HELD_FOLDS)) == 0)


def _lang(lang_col: str) -> Column:
    return F.coalesce(F.col(lang_col).cast("string"), F.lit(""))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, fit_rows: int) -> tuple[DataFrame, list[str]]:
    """``key, add double, back double`` of every n-gram and context, and the languages by number.

    p(x | h) = add(hx) + back(h) p(x | shorter h); the empty context backs off to 1 / ALPHABET.
    """
    ship(docs.sparkSession)
    trusted = trusted_ids(labels, id_col).filter("NOT held").select(id_col).orderBy(F.xxhash64(id_col), id_col).limit(fit_rows)
    text = docs.select(id_col, _lang(lang_col).alias("lang"), F.col(text_col).alias("text"))
    chosen = text.join(F.broadcast(trusted), id_col, "left_semi").select("lang", "text")  # at most fit_rows ids

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, numbers = np.unique(np.array(b.column(0).to_pylist(), object).astype(str), return_inverse=True)
            texts = b.column(1).cast(pa.binary()).to_pylist()
            for part in slices(texts):
                g = Grams(texts[part], numbers[part])
                n = np.bincount(g.window, minlength=len(g.keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names[(g.keys >> _U(_LANG)).astype(np.int64)]), pa.array((g.keys & _U((1 << _LANG) - 1)).astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
        un.trim()

    raw = persist(chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    langs = [r["lang"] for r in raw.select("lang").distinct().orderBy("lang").collect()]  # at most fit_rows
    number = F.create_map(*[F.lit(x) for i, l in enumerate(langs) for x in (l, i)]) if langs else F.create_map().cast("map<string,int>")
    raw = raw.select(number[F.col("lang")].alias("lang"), F.shiftright("gram", _SIZE).alias("size"), F.col("gram").bitwiseAND(_BYTES).alias("g"), "n")
    adds, backs, above, written = [], [], None, [raw]
    for k in range(ORDER, 0, -1):
        own = raw.filter(F.col("size") == k).select("lang", "g", "n")
        if above is not None:  # below the top: how many bytes stand before it
            cont = above.groupBy("lang", F.col("g").bitwiseAND((1 << (8 * k)) - 1).alias("g")).agg(F.count(F.lit(1)).alias("n"))
            own = own.unionByName(cont).groupBy("lang", "g").agg(F.sum("n").alias("n"))
        own = persist(own, f"grams{k}")
        written.append(own)
        n = lambda i: F.sum(F.when(F.col("n") == i, 1.0).otherwise(0.0))
        d = own.groupBy("lang").agg(*[n(i).alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5))
        cut = lambda i: F.greatest(F.lit(0.05), F.least(F.lit(i - 0.05), i - (i + 1) * y * F.coalesce(F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")), F.lit(0.5))))
        d = d.select("lang", cut(1).alias("d1"), cut(2).alias("d2"), cut(3).alias("d3"))
        rows = own.join(F.broadcast(d), "lang")  # a row a language, at most fit_rows
        less = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        context = Window.partitionBy("lang", "h")
        rows = rows.withColumn("h", F.shiftright("g", 8)).withColumn("less", F.least(less, F.col("n").cast("double")))
        rows = rows.withColumn("s", F.sum("n").over(context))
        key = lambda size, g: F.shiftleft(F.col("lang").cast("long"), _LANG) + F.lit(size << _SIZE) + g
        adds.append(rows.select(key(k, F.col("g")).alias("key"), ((F.col("n") - F.col("less")) / F.col("s")).alias("add"), F.lit(None).cast("double").alias("back")))
        backs.append(rows.groupBy("lang", "h").agg((F.sum("less") / F.first("s")).alias("back")).select(key(k - 1, F.col("h")).alias("key"), F.lit(None).cast("double").alias("add"), "back"))
        above = own
    both = adds[0]
    for x in [*adds[1:], *backs]:
        both = both.unionByName(x)
    model = both.groupBy("key").agg(F.coalesce(F.max("add"), F.lit(0.0)).alias("add"), F.coalesce(F.max("back"), F.lit(1.0)).alias("back"))
    model = persist(model, "kn-model")
    free(*written)
    return model, langs


def perplexities(docs: DataFrame, model: DataFrame, langs: list[str], id_col: str, text_col: str, lang_col: str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``keep`` columns and ``unit_id long, nth int, n_words long, n_bytes long, log_ppl double, worst_word double``, and the units of documents.

    Nats a byte, of all and of the worst word; null without words or without a
    model of the language.
    """
    total = un.text_bytes(docs, text_col)
    units = un.stage(docs, text_col, UNIT_BYTES, total)
    shards = un.shards_for(total / 30)
    number = {l: i for i, l in enumerate(langs)}

    def parts(rows: pa.StructArray) -> Iterator[tuple[slice, np.ndarray, Grams]]:
        lang = np.array([number.get(x if x is not None else "", -1) for x in rows.field(lang_col).cast(pa.string()).to_pylist()], np.int64)
        texts = [t if i >= 0 else None for t, i in zip(un.texts_of(rows, text_col), lang)]
        for part in slices(texts):
            yield part, lang[part], Grams(texts[part], np.maximum(lang[part], 0))

    def asked(grams: Iterator[Grams]) -> tuple[np.ndarray, np.ndarray]:
        """Keys of a unit by shard, then ascending, and where each shard starts."""
        found = [g.keys for g in grams]
        full, context, _ = orders(distinct(np.concatenate(found))[0]) if found else ([np.empty(0, np.uint64)], [], [])
        return by_shard(np.sort(distinct(np.concatenate([*full, *context]))[0]))

    def by_shard(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shard = ((mix(keys) >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        return keys[order], np.searchsorted(shard[order], np.arange(shards + 1))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of():
            for unit, rows, _ in un.each_unit(batches):
                keys, cut = asked(g for *_, g in parts(rows))
                for s in np.flatnonzero(np.diff(cut)):
                    yield int(s), unit, un.squeeze_sorted(keys[cut[s] : cut[s + 1]])

        yield from un.in_batches(rows_of())

    def emit_model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(0).to_numpy().view(np.uint64)
            order = np.argsort(own)
            keys, cut = by_shard(own[order])
            back = order[np.argsort(((mix(own[order]) >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64), kind="stable")]
            add, leave = (b.column(i).to_numpy()[back].astype(np.float32) for i in (1, 2))
            yield from un.in_batches((int(s), -1, b"".join(x[cut[s] : cut[s + 1]].tobytes() for x in (keys, add, leave))) for s in np.flatnonzero(np.diff(cut)))

    def answer(ids: list[int], blobs: list[bytes]) -> list[bytes | None]:
        """The shard's n-grams, which come as unit -1, joined with each unit's."""
        own = [b for u, b in zip(ids, blobs) if u == -1]
        sizes = [len(b) // 16 for b in own]
        h = np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(b, np.uint64, n) for b, n in zip(own, sizes))])
        add = np.concatenate([np.zeros(1, np.float32), *(np.frombuffer(b, np.float32, n, 8 * n) for b, n in zip(own, sizes))])
        back = np.concatenate([np.ones(1, np.float32), *(np.frombuffer(b, np.float32, n, 12 * n) for b, n in zip(own, sizes))])
        order = np.argsort(h)
        h = h[order]
        out: list[bytes | None] = []
        for u, b in zip(ids, blobs):
            if u == -1 or not len(h):
                out.append(None)
                continue
            q = un.unsqueeze_sorted(b, np.uint64)
            at = np.minimum(np.searchsorted(h, q), len(h) - 1)
            row = np.where(h[at] == q, order[at] + 1, 0)
            inner = (q >> _U(_SIZE)) & _U(7) < _U(ORDER)  # the longest n-grams are no contexts
            out.append(un.squeeze(np.concatenate([packed(add[row]), packed(back[row[inner]])])))
        return out

    questions = units.mapInArrow(emit, un.QUESTION).unionAll(model.mapInArrow(emit_model, un.QUESTION))
    answers = un.ask(questions, shards, answer)
    own = [("unit_id", T.LongType()), ("nth", T.IntegerType()), ("n_words", T.LongType()), ("n_bytes", T.LongType()), ("log_ppl", T.DoubleType()), ("worst_word", T.DoubleType())]
    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(*x) for x in own)])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, rows, more in un.each_unit(batches):
            held = list(parts(rows))
            keys, cut = asked(g for *_, g in held)
            add, back = np.zeros(len(keys), np.float32), np.ones(len(keys), np.float32)
            for s, blob in un.answer_map(more["answers"]).items():
                n, got = cut[s + 1] - cut[s], unpacked(un.unsqueeze(blob, np.uint16))
                inner = cut[s] + np.flatnonzero((keys[cut[s] : cut[s + 1]] >> _U(_SIZE)) & _U(7) < _U(ORDER))
                add[cut[s] : cut[s + 1]], back[inner] = got[:n], got[n:]
            order = np.argsort(keys)
            keys, add, back = keys[order], add[order], back[order]
            for part, lang, g in held:
                k = len(lang)
                full, context, known = orders(g.keys)
                p = np.full(len(g.keys), 1.0 / ALPHABET)
                for f, c, long in zip(full, context, known):
                    p = np.where(long, add[np.searchsorted(keys, f)] + back[np.searchsorted(keys, c)] * p, p)
                word = np.add.reduceat(-np.log(p)[g.window], g.first) if len(g.first) else np.empty(0)
                text = g.text
                sums, worst = np.bincount(text, word, k), np.zeros(k)
                np.maximum.at(worst, text, word / g.steps)
                ok = (g.bytes_of > 0) & (lang >= 0)
                ppl = np.divide(sums, g.bytes_of, out=np.zeros(k), where=ok)
                yield pa.RecordBatch.from_arrays([*(rows.field(c).slice(part.start, k) for c in keep), pa.array(np.full(k, unit)), pa.array(np.arange(part.start, part.start + k), pa.int32()),
                                                  pa.array(g.counts, pa.int64()), pa.array(g.bytes_of.astype(np.int64)), pa.array(ppl, mask=~ok), pa.array(worst, mask=~ok)], names=schema.names)

    return persist(un.answered(units, answers).mapInArrow(judge, schema), "perplexities"), units


def _judged(scored: DataFrame, labels: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    """``scored`` with ``score, limit, word_limit, kept``."""
    score = F.col("log_ppl") - SHORT / F.sqrt(F.greatest(F.col("n_bytes"), F.lit(1)))
    scored = scored.withColumn("score", score)
    marked = scored.select(id_col, _lang(lang_col).alias("l"), "score", "worst_word").join(trusted_ids(labels, id_col), id_col)
    high = lambda c, held: F.percentile_approx(F.when(F.col("held") == held, F.col(c)), QUANTILE, 10_000)
    pick = lambda c: F.when(F.count_if(F.col("held") & F.col(c).isNotNull()) >= LEAST_HELD, high(c, True)).otherwise(F.greatest(high(c, True), high(c, False) + LEAVE))
    limits = marked.groupBy("l").agg(pick("score").alias("limit"), pick("worst_word").alias("word_limit"))
    out = scored.join(F.broadcast(limits), _lang(lang_col) == F.col("l"), "left").drop("l")  # a row a language of the labelled rows
    return out.withColumn("kept", F.coalesce((F.col("score") <= F.col("limit")) & (F.col("worst_word") <= F.col("word_limit")), F.lit(True)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Returns ``id_col, lang_col, n_words, n_bytes, log_ppl, worst_word, score, limit, word_limit, kept``, a row for each row.

    A null language is a language of its own, the empty one. Null or wordless
    text, and texts in a language without trusted documents, have no perplexity
    and are kept, as nothing speaks against them. Repeated rows are judged alike;
    a score equal to a limit is kept. Texts of any length are scored whole. Other
    columns, whatever their names, are not read. Empty documents give an empty
    table, and with empty labels all documents are kept.
    """
    model, langs = fit(docs, labels, id_col, text_col, lang_col, fit_rows)
    sweep(docs.sparkSession)  # what fitting has shuffled
    scored, units = perplexities(docs.select(id_col, text_col, lang_col), model, langs, id_col, text_col, lang_col, (id_col, lang_col))
    free(model)
    return _judged(scored.drop("unit_id", "nth"), labels, id_col, lang_col)


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all columns; texts are read where they were staged, only row numbers move."""
    model, langs = fit(docs, labels, id_col, text_col, lang_col, fit_rows)
    sweep(docs.sparkSession)  # what fitting has shuffled
    scored, units = perplexities(docs, model, langs, id_col, text_col, lang_col, (id_col, lang_col))
    free(model)
    picks = _judged(scored, labels, id_col, lang_col).filter("kept").groupBy("unit_id").agg(F.collect_list("nth").alias("picks"))

    names = docs.columns

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, more in un.each_unit(batches):
            yield pa.RecordBatch.from_arrays(rows.take(pa.array(sorted(more["picks"]), pa.int64())).flatten(), names=names)

    return units.join(picks, "unit_id").select("unit_id", "rows", "picks").mapInArrow(take, docs.schema)
