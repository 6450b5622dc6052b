"""Language-model scoring by a weighted backoff automaton.

The model is a trigram model with Dirichlet smoothing over add-half unigrams,
p(w|b) = (c(bw) + mu2 p(w)) / (c(b) + mu2) and, for the word pairs ab that
training has at least ``least`` times,
p(w|ab) = (c(abw) + mu3 p(w|b)) / (c(ab) + mu3).

As an automaton: the root is a state, and so is every known word and every such
pair, as a history. A state has an arc for each word that training has behind
it, and a failure arc to the state of its shorter history, which is taken, with
its weight, when a word has no arc; the root has an arc for every word. One pass
from left to right carries the state and adds up the weights of the arcs taken.

The whole corpus is counted: each unit of documents sends its distinct words
and pairs, then its distinct triples behind frequent pairs, with their counts in
training documents to shards by hash, and gets the corpus's counts back. These
are the arcs that its own texts can take, so each unit builds and walks its part
of the automaton.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import units as un
from .scratch import persist, sweep
from .words import Words, mix

#: Weight of the shorter history's model, in words, in pairs' and in triples' models.
MU2, MU3 = 300.0, 20.0
#: Pairs that training has less often are no states.
LEAST = 2
FOLDS, HELD_OUT = 5, 1
UNIT_BYTES = 6 << 20
#: Tokens that are walked one after another; runs are walked side by side.
RUN = 256
_END, _START = np.uint64(0x51ED270B7F3C9A11), np.uint64(0xC2B2AE3D27D4EB4F)
_B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_ONE = np.uint64(1)


def held_out(doc_id: int | None, folds: int = FOLDS, remainder: int = HELD_OUT) -> bool:
    """By crc32 of the id as text; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == remainder


class Tokens:
    """Tokens of a unit: lower-cased words, and an end after each text. Keys of words are odd, of pairs even."""

    def __init__(self, texts: list[bytes | None]):
        w = Words(texts, lower=True)
        n = len(w.counts)
        self.bounds = w.bounds + np.arange(n + 1)
        end = np.zeros(self.bounds[-1], bool)
        end[self.bounds[1:] - 1] = True
        self.token = token = np.empty(len(end), np.uint64)
        token[end], token[~end] = _END, w.hashes
        self.text = np.repeat(np.arange(n), np.diff(self.bounds))
        self.first = self.bounds[:-1]  # of each text
        before = self._behind(token, _START)
        self.word_keys, self.word = np.unique(mix(token) | _ONE, return_inverse=True)
        self.pair_keys, at, self.pair = np.unique(mix(before * _B + token) & ~_ONE, return_index=True, return_inverse=True)
        self.end = int(np.searchsorted(self.word_keys, mix(np.array([_END], np.uint64)) | _ONE)[0]) if n else 0
        # The words of each pair; a text's start stands for its end, as there are as many of either.
        self.pair_words = self._behind(self.word, self.end)[at], self.word[at]

    def _behind(self, a: np.ndarray, start) -> np.ndarray:
        """What stands before each token."""
        out = np.empty_like(a)
        out[1:] = a[:-1]
        out[self.first] = start
        return out

    def triples(self, states: np.ndarray) -> None:
        """Find the distinct triples whose first two words are a pair of ``states``."""
        history = self._behind(self.pair, -1)  # the pair before each token; none before a text's first
        at = np.flatnonzero((history >= 0) & states[history])
        keys = mix(self.pair_keys[history[at]] * _C + self.token[at])
        self.triple_keys, one, inverse = np.unique(keys, return_index=True, return_inverse=True)
        self.triple, self.triple_at = inverse, at
        self.triple_pair, self.triple_word = history[at[one]], self.word[at[one]]


class Automaton:
    """States and arcs that a unit's texts can take, from corpus counts of its words, pairs and triples."""

    def __init__(self, t: Tokens, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray, n: int, v: int, mu2: float, mu3: float, least: int):
        a, b = t.pair_words
        p1 = (words + 0.5) / (n + 0.5 * (v + 1))
        p2 = (pairs + mu2 * p1[b]) / (words[a] + mu2)
        # States: the root, then known words, then frequent pairs.
        known, frequent = np.flatnonzero(words > 0), np.flatnonzero(pairs >= least)
        self.word_state = np.zeros(len(words), np.int64)
        self.word_state[known] = 1 + np.arange(len(known))
        pair_state = np.zeros(len(pairs), np.int64)
        pair_state[frequent] = 1 + len(known) + np.arange(len(frequent))
        self.fail = np.concatenate([[0], np.zeros(len(known), np.int64), self.word_state[b[frequent]]])
        self.fail_weight = np.log10(np.concatenate([[1.0], mu2 / (words[known] + mu2), mu3 / (pairs[frequent] + mu3)]))
        self.start = self.word_state[t.end] if len(words) else 0
        # The root's arcs lead to words; pairs' and triples' arcs to the longest state that ends there.
        self.root_weight, self.width = np.log10(p1), len(words)
        behind = np.where(pair_state > 0, pair_state, self.word_state[b])
        two = np.flatnonzero(pairs > 0)
        three = np.flatnonzero(triples > 0)
        history, w = t.triple_pair[three], t.triple_word[three]
        inner = self._find(b[history], w, a, b)  # the triple's last two words are a pair of the unit
        weight = np.concatenate([np.log10(p2[two]), np.log10((triples[three] + mu3 * p2[inner]) / (pairs[history] + mu3))])
        keys = np.concatenate([self.word_state[a[two]] * self.width + b[two], pair_state[history] * self.width + w])
        order = np.argsort(keys)
        self.arcs, self.weight, self.to = keys[order], weight[order], np.concatenate([behind[two], behind[inner]])[order]

    def _find(self, x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.width + b
        order = np.argsort(key)
        return order[np.searchsorted(key[order], x * self.width + y)] if len(x) else np.empty(0, np.int64)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read a word in each of many states: the new states, and the weights of the arcs and failure arcs taken."""
        weight, to = np.zeros(len(state)), np.zeros(len(state), np.int64)
        open_ = np.arange(len(state))
        while len(open_):
            s, w = state[open_], word[open_]
            key = s * self.width + w
            at = np.minimum(np.searchsorted(self.arcs, key), max(0, len(self.arcs) - 1))
            hit = (s > 0) & (self.arcs[at] == key) if len(self.arcs) else np.zeros(len(s), bool)
            root = s == 0
            got = open_[hit]
            weight[got] += self.weight[at[hit]]
            to[got] = self.to[at[hit]]
            got = open_[root]
            weight[got] += self.root_weight[w[root]]
            to[got] = self.word_state[w[root]]
            miss = ~hit & ~root
            open_, s = open_[miss], s[miss]
            weight[open_] += self.fail_weight[s]
            state = state.copy() if len(open_) else state
            state[open_] = self.fail[s]
        return to, weight

    def walk(self, t: Tokens, run: int = RUN) -> np.ndarray:
        """Weight added at each token.

        Texts are cut into runs that are walked side by side. A run inside a
        text starts at the root two words early, without weights: the state
        depends on no more than two words, so it is the one that is carried.
        """
        sizes = np.diff(t.bounds)
        runs = (sizes + run - 1) // run
        text = np.repeat(np.arange(len(sizes)), runs)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
        first = t.first[text] + nth * run
        n = np.minimum(run, t.bounds[1:][text] - first)
        lead = np.minimum(2, nth * run)
        order = np.argsort(-(n + lead), kind="stable")
        first, n, lead, inside = (first - lead)[order], (n + lead)[order], lead[order], nth[order] > 0
        state = np.where(inside, 0, self.start)
        out = np.zeros(len(t.word))
        for k in range(int(n.max(initial=0))):
            live = int(np.searchsorted(-n, -k))  # runs longer than k come first
            at = first[:live] + k
            state[:live], weight = self.step(state[:live], t.word[at])
            counts = k >= lead[:live]
            out[at[counts]] = weight[counts]
        return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mu2: float = MU2, mu3: float = MU3, least: int = LEAST) -> DataFrame:
    """Train on all documents of the other folds and score every document.

    Returns ``id_col, held_out, n_tokens, n_known, train_tokens, base_score,
    score``, a row for each row; other columns, whatever their names, are not
    read. Null text is the end token alone; a null id counts as the empty text;
    repeated rows count and score each time. Texts of any length are scored
    whole. An empty table gives an empty one, and without training documents all
    words are unknown. There are no ties to break: a score is a function of the
    text and the counts.
    """
    used = docs.select(id_col, text_col)
    total = un.text_bytes(used, text_col)
    units = un.stage(used, text_col, UNIT_BYTES, total)
    shards, more_shards = un.shards_for(total / 8), un.shards_for(total / 10)

    def train_of(rows: pa.StructArray) -> np.ndarray:
        return np.array([not held_out(i) for i in rows.field(id_col).to_pylist()], bool)

    def ask_for(unit: int, keys: np.ndarray, counts: np.ndarray, n_shards: int) -> Iterator[tuple[int, int, bytes]]:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(np.uint32)
        cut = un.shard_of(keys, n_shards)
        for s in np.flatnonzero(np.diff(cut)):
            own = un.squeeze_sorted(keys[cut[s] : cut[s + 1]])
            yield int(s), unit, struct.pack("<I", len(own)) + own + un.squeeze(counts[cut[s] : cut[s + 1]])

    def sums(_: list[int], blobs: list[bytes]) -> list[bytes | None]:
        """Sums of each key over all units, and behind the last answer the shard's known words and training tokens."""
        ends = [4 + struct.unpack_from("<I", b)[0] for b in blobs]
        each = [un.unsqueeze_sorted(b[4:e], np.uint64) for b, e in zip(blobs, ends)]
        sizes, keys = [len(k) for k in each], np.concatenate(each)
        counts = np.concatenate([un.unsqueeze(b[e:], np.uint32) for b, e in zip(blobs, ends)])
        del each
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        group = np.empty(len(keys), np.int64)
        group[order] = np.cumsum(new) - 1
        total = np.bincount(group, counts).astype(np.uint64)
        words = total[(keys[new] & _ONE) == 1]
        cuts = np.cumsum([0, *sizes])
        return [*(un.squeeze(total[group[a:b]]) for a, b in zip(cuts, cuts[1:])), struct.pack(">QQ", int((words > 0).sum()), int(words.sum()))]

    def counted(keys: np.ndarray, got: dict[int, bytes], n_shards: int, sign: bool = False) -> np.ndarray:
        order = np.argsort(keys)
        cut, out = un.shard_of(keys[order], n_shards), np.zeros(len(keys))
        for s, blob in got.items():
            if (s < 0) == sign:
                s = -1 - s if sign else s
                out[order[cut[s] : cut[s + 1]]] = un.unsqueeze(blob, np.uint64)
        return out

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of():
            for unit, rows, _ in un.each_unit(batches):
                t = Tokens(un.texts_of(rows, text_col))
                use = train_of(rows)[t.text]
                n = np.concatenate([np.bincount(t.word[use], minlength=len(t.word_keys)), np.bincount(t.pair[use], minlength=len(t.pair_keys))])
                yield from ask_for(unit, np.concatenate([t.word_keys, t.pair_keys]), n, shards)

        yield from un.in_batches(rows_of())

    def tokens(rows: pa.StructArray, got: dict[int, bytes]) -> tuple[Tokens, np.ndarray, np.ndarray]:
        t = Tokens(un.texts_of(rows, text_col))
        c = counted(np.concatenate([t.word_keys, t.pair_keys]), got, shards)
        words, pairs = c[: len(t.word_keys)], c[len(t.word_keys) :]
        t.triples(pairs >= least)
        return t, words, pairs

    def emit_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of():
            for unit, rows, more in un.each_unit(batches):
                t, _, _ = tokens(rows, un.answer_map(more["answers"]))
                use = train_of(rows)[t.text[t.triple_at]]
                yield from ask_for(unit, t.triple_keys, np.bincount(t.triple[use], minlength=len(t.triple_keys)), more_shards)

        yield from un.in_batches(rows_of())

    answers = persist(un.ask(units.mapInArrow(emit, un.QUESTION), shards, sums, summary=True), "lm-answers")
    number = lambda a: F.conv(F.substring(F.hex("blob"), a, 16), 16, 10).cast("decimal(20,0)")
    totals = answers.filter("unit_id = -1").agg(F.sum(number(1)).alias("v"), F.sum(number(17)).alias("n")).first()
    v, n = int(totals["v"] or 0), int(totals["n"] or 0)
    sweep(docs.sparkSession)
    triples = persist(un.ask(un.answered(units, answers).mapInArrow(emit_triples, un.QUESTION), more_shards, lambda ids, blobs: sums(ids, blobs)[:-1]), "lm-triples")
    sweep(docs.sparkSession)
    both = answers.unionByName(triples.withColumn("shard", -1 - F.col("shard")))
    schema = T.StructType([docs.schema[id_col], T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                           T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, more in un.each_unit(batches):
            got = un.answer_map(more["answers"])
            t, words, pairs = tokens(rows, got)
            a = Automaton(t, words, pairs, counted(t.triple_keys, got, more_shards, True), n, v, mu2, mu3, least)
            k = len(rows)
            of = lambda x: np.bincount(t.text, x, k)
            out = [rows.field(id_col), pa.array(~train_of(rows)), pa.array(np.diff(t.bounds), pa.int64()), pa.array(of(words[t.word] > 0).astype(np.int64)),
                   pa.array(np.full(k, n), pa.int64()), pa.array(of(a.root_weight[t.word])), pa.array(of(a.walk(t)))]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return un.answered(units, both).mapInArrow(walk, schema)
