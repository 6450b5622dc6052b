"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its own embedding beside the sum of embeddings of its character
n-grams (with a mark at both ends), both from hashed tables, so that forms never
seen in training still show what they are made of. Words of a window are read by
a gated recurrent unit from either side; attention weighs the states, and the
pooled state gives the window's logit. A text's score is that of its most toxic
window, over overlapping windows that cover the whole text.

Labels belong to texts, but one window is enough to make a text toxic: each
epoch trains on the windows of a text that the model of the epoch before holds
for the most toxic, and on further windows of clean texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .units import trim
from .words import Words

FOLDS, HELD_OUT = 5, 0
#: Labelled rows of each class that are fitted at most, and bytes of the longest text that is.
FIT_ROWS, FIT_BYTES = 2000, 16_000
#: Words in a window, and from one window to the next.
WINDOW, STEP = 32, 24
#: Characters of a word's n-grams; bytes of a word whose n-grams count, from its start and from its end.
GRAMS, EDGE = (3, 4, 5), 24
#: Rows of either embedding table, their width, and states of either direction.
TABLE, WIDTH, STATES = 1 << 15, 12, 12
EPOCHS, BATCH, RATE, SEED = 6, 384, 0.015, 17
#: Windows that are scored at once, and bytes of text.
AT_ONCE, PART_BYTES = 2048, 4 << 20
#: Words end at ASCII characters that are neither letters nor digits.
_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 0x20 for c in range(256))
_G = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: int | None, folds: int = FOLDS, remainder: int = HELD_OUT) -> bool:
    """By crc32 of the id as text; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == remainder


def _slots(h: np.ndarray) -> np.ndarray:
    return ((h * _G) >> np.uint64(64 - TABLE.bit_length() + 1)).astype(np.int64)


class Inputs:
    """Distinct words of texts: the embedding row of each, and those of its n-grams; and where windows lie."""

    def __init__(self, texts: list[bytes | None], window: int = WINDOW, step: int = STEP):
        w = Words([(t or b"").translate(_PLAIN) for t in texts], lower=True)
        distinct, first, self.token = np.unique(w.hashes, return_index=True, return_inverse=True)
        self.row = _slots(distinct)
        self.gram, self.gram_ends = _grams(w, first)
        counts = w.counts
        # A window every ``step`` words, the last one ends with the text; a text without words has one empty window.
        n = np.maximum(1, -(-np.maximum(counts - window, 0) // step) + 1)
        self.text = np.repeat(np.arange(len(counts)), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.minimum(nth * step, np.maximum(counts - window, 0)[self.text])
        self.start = w.bounds[:-1][self.text] + at
        self.size = np.minimum(window, counts[self.text])
        self.window = window

    def words_of(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words of windows, a row each, and which places hold a word."""
        at = self.start[windows][:, None] + np.arange(self.window)
        live = np.arange(self.window) < self.size[windows][:, None]
        if not len(self.token):
            return np.zeros(at.shape, np.int64), live
        return np.where(live, self.token[np.minimum(at, len(self.token) - 1)], 0), live


def _grams(w: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the n-grams of words, one after another, and where each word's end.

    Of a word longer than twice ``EDGE`` bytes, the bytes at its edges count.
    """
    buf = np.frombuffer(w.data.lower(), np.uint8)
    start, size = w.starts[at], (w.ends - w.starts)[at]
    long = size > 2 * EDGE
    # Each word is laid out with a mark at both ends; a long one as its two edges with a mark between them.
    held = np.where(long, 2 * EDGE + 3, size + 2)
    ends = np.cumsum(held)
    word = np.repeat(np.arange(len(at)), held)
    k = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - held, held)
    tail = long[word] & (k > EDGE + 1)
    source = np.where(tail, start[word] + size[word] - (held[word] - 1 - k), start[word] + k - 1)
    mark = (k == 0) | (k == held[word] - 1) | (long[word] & (k == EDGE + 1))
    chars = np.where(mark, 1, buf[np.clip(source, 0, max(0, len(buf) - 1))]).astype(np.uint64) if len(k) else np.zeros(0, np.uint64)
    rows, owners = [], []
    for n in GRAMS:
        m = max(0, len(chars) - n + 1)
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + chars[j : j + m]
        inside = word[:m] == word[n - 1 : n - 1 + m] if m else np.zeros(0, bool)
        rows.append(_slots(h[inside] ^ (h[inside] >> np.uint64(29))))
        owners.append(word[:m][inside])
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.cumsum(np.bincount(owners, minlength=len(at)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _sum_rows(owner: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each owner."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(owner):
        order = np.argsort(owner, kind="stable")
        o = owner[order]
        start = np.flatnonzero(np.diff(o, prepend=-1))
        out[o[start]] = np.add.reduceat(rows[order], start, axis=0)
    return out


@dataclass
class Network:
    """Embeddings of words and n-grams; for either direction weights of update, reset and candidate; attention; output."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, seed: int = SEED, width: int = WIDTH, states: int = STATES) -> Network:
        g = np.random.default_rng(seed)
        one = lambda *s: (g.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        p = {"words": np.zeros((TABLE, width), np.float32), "grams": np.zeros((TABLE, width), np.float32)}
        for d in "fb":  # reading forwards and backwards
            p |= {f"w{d}": one(2 * width, 3 * states), f"u{d}": one(states, 3 * states), f"b{d}": np.zeros(3 * states, np.float32)}
        p |= {"wa": one(2 * states, states), "ba": np.zeros(states, np.float32), "va": one(states), "wo": one(2 * states), "bo": np.zeros(1, np.float32)}
        return cls(p)

    def word_inputs(self, x: Inputs) -> np.ndarray:
        """A row for each distinct word."""
        sums = np.zeros((len(x.row) + 1, self.p["grams"].shape[1]), np.float32)
        sizes = np.diff(x.gram_ends, prepend=0)
        full = np.flatnonzero(sizes)
        if len(full):
            for s in range(0, len(full), 1 << 15):  # words at a time, as each n-gram is gathered
                part = full[s : s + (1 << 15)]
                lo, hi = x.gram_ends[part[0]] - sizes[part[0]], x.gram_ends[part[-1]]
                sums[part] = np.add.reduceat(self.p["grams"][x.gram[lo:hi]], x.gram_ends[part] - sizes[part] - lo, axis=0)
        return np.concatenate([self.p["words"][x.row], sums[:-1]], axis=1)

    def _run(self, d: str, inputs: np.ndarray, token: np.ndarray, live: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States (place, window, state); places without a word carry the state on."""
        n, t = token.shape
        h_size = self.p["u" + d].shape[0]
        u = self.p["u" + d]
        u_gates, u_cand = np.ascontiguousarray(u[:, : 2 * h_size]), np.ascontiguousarray(u[:, 2 * h_size :])
        h = np.zeros((n, h_size), np.float32)
        out, saved = np.empty((t, n, h_size), np.float32), []
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            x = inputs[token[:, k]]
            gates = h @ u_gates
            gates += x[:, : 2 * h_size]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[:, :h_size], gates[:, h_size:]
            rh = r * h
            c = np.tanh(rh @ u_cand + x[:, 2 * h_size :])
            new = h + z * (c - h)
            if not live[:, k].all():
                new = np.where(live[:, k, None], new, h)
            if keep:
                saved.append((k, h, z, r, c))
            h = out[k] = new
        return out, saved

    def forward(self, token: np.ndarray, live: np.ndarray, words: np.ndarray, keep: bool = False, projected: dict | None = None) -> tuple[np.ndarray, dict]:
        """Logits of windows. ``words`` are the inputs of distinct words, ``projected`` their products with the input weights."""
        p, c = self.p, {}
        projected = projected or self.projected(words)
        runs = {d: self._run(d, projected[d], token, live, keep) for d in "fb"}
        h = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)  # place, window, both states
        a = np.tanh(h @ p["wa"] + p["ba"])
        e = np.where(live.T, a @ p["va"], -1e9)
        e = np.exp(e - e.max(0)) * live.T
        alpha = e / np.maximum(e.sum(0), 1e-9)
        pooled = (alpha[:, :, None] * h).sum(0)
        if keep:
            c = {"h": h, "a": a, "alpha": alpha, "pooled": pooled, "saved": {d: runs[d][1] for d in "fb"}}
        return pooled @ p["wo"] + p["bo"][0], c

    def projected(self, words: np.ndarray) -> dict[str, np.ndarray]:
        return {d: words @ self.p["w" + d] + self.p["b" + d] for d in "fb"}

    def gradients(self, token: np.ndarray, live: np.ndarray, words: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of windows and its gradients; ``words`` stands for the embeddings of distinct words."""
        p = self.p
        logit, c = self.forward(token, live, words, keep=True)
        prob = _sigmoid(logit)
        n = len(y)
        loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
        g = {"words": np.zeros_like(words)}
        dl = ((prob - y) / n).astype(np.float32)
        g["bo"], g["wo"] = np.array([dl.sum()], np.float32), c["pooled"].T @ dl
        d_pooled = dl[:, None] * p["wo"]
        h, a, alpha = c["h"], c["a"], c["alpha"]
        dh = alpha[:, :, None] * d_pooled
        d_alpha = (h * d_pooled).sum(2)
        de = alpha * (d_alpha - (alpha * d_alpha).sum(0))
        g["va"] = np.einsum("tns,tn->s", a, de)
        da = de[:, :, None] * p["va"] * (1 - a * a)
        flat = da.reshape(-1, da.shape[2])
        g["wa"], g["ba"] = h.reshape(-1, h.shape[2]).T @ flat, flat.sum(0)
        dh += da @ p["wa"].T
        size = p["uf"].shape[0]
        for d, part in (("f", slice(0, size)), ("b", slice(size, None))):
            u = p["u" + d]
            gu, places, steps = np.zeros_like(u), [], []
            back = np.zeros((n, size), np.float32)
            for k, before, z, r, cand in reversed(c["saved"][d]):
                total = back + dh[k, :, part]
                on = live[:, k, None]
                new = np.where(on, total, 0)
                dc = new * z * (1 - cand * cand)
                dz = new * (cand - before) * z * (1 - z)
                d_rh = dc @ u[:, 2 * size :].T
                dr = d_rh * before * r * (1 - r)
                gates = np.concatenate([dz, dr], axis=1)
                back = np.where(on, new * (1 - z) + d_rh * r + gates @ u[:, : 2 * size].T, total)
                gu[:, : 2 * size] += before.T @ gates
                gu[:, 2 * size :] += (r * before).T @ dc
                places.append(token[:, k])
                steps.append(np.concatenate([gates, dc], axis=1))
            gx = _sum_rows(np.concatenate(places), np.concatenate(steps), len(words))
            g["u" + d], g["b" + d], g["w" + d] = gu, gx.sum(0), words.T @ gx
            g["words"] += gx @ p["w" + d].T
        return loss, g

    def score_windows(self, x: Inputs, windows: np.ndarray | None = None) -> np.ndarray:
        """Logit of each window."""
        windows = np.arange(len(x.start)) if windows is None else windows
        if len(x.row):
            projected = self.projected(self.word_inputs(x))
        else:
            projected = {d: np.zeros((1, self.p["b" + d].shape[0]), np.float32) for d in "fb"}
        out = np.empty(len(windows), np.float32)
        for s in range(0, len(windows), AT_ONCE):
            token, live = x.words_of(windows[s : s + AT_ONCE])
            out[s : s + AT_ONCE] = self.forward(token, live, None, projected=projected)[0]
        return out

    def score(self, texts: list[bytes | None], window: int = WINDOW, step: int = STEP) -> np.ndarray:
        """Probability for each text: that of its most toxic window. A text's score doesn't depend on those beside it."""
        out = np.empty(len(texts))
        sizes = np.array([len(t or b"") for t in texts], np.int64)
        group = (np.cumsum(sizes) - sizes) // PART_BYTES
        for k in np.unique(group):
            own = np.flatnonzero(group == k)
            x = Inputs([texts[i] for i in own], window, step)
            logit = self.score_windows(x)
            first = np.searchsorted(x.text, np.arange(len(own)))
            out[own] = np.maximum.reduceat(logit, first)
        return _sigmoid(out)


def train(texts: list[bytes | None], labels: np.ndarray, seed: int = SEED, epochs: int = EPOCHS, window: int = WINDOW, step: int = STEP) -> Network:
    """Fit a network; without rows of both classes, one that gives every text the rate of its rows (0 without any)."""
    labels = np.asarray(labels, np.float32)
    net = Network.new(seed)
    if len(labels) == 0 or labels.min() == labels.max():
        net.p["bo"][0] = 8.0 if len(labels) and labels[0] else -8.0
        net.p["wo"][:] = 0
        return net
    x = Inputs(texts, window, step)
    g = np.random.default_rng(seed)
    first = np.searchsorted(x.text, np.arange(len(texts)))
    toxic = np.flatnonzero(labels > 0)
    clean = np.flatnonzero(labels == 0)
    n_windows = np.diff(np.append(first, len(x.text)))
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    turn = 0
    for epoch in range(epochs):
        if epoch == 0:  # no model yet: all windows of short toxic texts, some of longer ones
            some = np.concatenate([first[i] + g.permutation(n_windows[i])[:8] for i in toxic])
            hard = np.zeros(0, np.int64)
        else:
            logit = net.score_windows(x)
            best = first + np.array([int(np.argmax(logit[f : f + n])) for f, n in zip(first, n_windows)])
            some, hard = best[toxic], best[clean]
        rest = np.concatenate([(first + g.integers(0, n_windows))[clean] for _ in range(2)])
        chosen = np.unique(np.concatenate([some, hard, rest]))
        y = labels[x.text[chosen]]
        weight = max(1, int(round((y == 0).sum() / max(1, (y == 1).sum()) / 2)))
        chosen = np.concatenate([chosen, *[chosen[y == 1]] * (weight - 1)])
        rate = RATE * min(1.0, 2 * (epochs - epoch) / epochs)
        order = g.permutation(chosen)
        for s in range(0, len(order), BATCH):
            turn += 1
            _step(net, state, x, order[s : s + BATCH], labels, rate, turn, g)
    return net


def _step(net: Network, state: dict, x: Inputs, windows: np.ndarray, labels: np.ndarray, rate: float, turn: int, g: np.random.Generator) -> None:
    """One step of Adam; embeddings that the batch doesn't touch stay as they are."""
    token, live = x.words_of(windows)
    used, token = np.unique(token, return_inverse=True)
    token = token.reshape(live.shape)
    ends = np.concatenate([[0], x.gram_ends])
    sizes = ends[used + 1] - ends[used]
    at = np.repeat(ends[used] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    owner = np.repeat(np.arange(len(used)), sizes)
    sums = _sum_rows(owner, net.p["grams"][x.gram[at]], len(used))
    width = net.p["words"].shape[1]
    shown = (g.random(len(used)) < 0.7).astype(np.float32)[:, None]  # some words show their characters alone
    own = net.p["words"][x.row[used]] * shown
    _, grad = net.gradients(token, live, np.concatenate([own, sums], axis=1), labels[x.text[windows]])
    back = grad.pop("words")
    rows, same = np.unique(x.row[used], return_inverse=True)
    word_grad = _sum_rows(same, back[:, :width] * shown, len(rows))
    gram_rows, same = np.unique(x.gram[at], return_inverse=True)
    gram_grad = _sum_rows(same, back[owner, width:], len(gram_rows))
    norm = np.sqrt(sum(float((v * v).sum()) for v in grad.values()))
    for k, v in [*grad.items(), ("words", word_grad), ("grams", gram_grad)]:
        where = rows if k == "words" else gram_rows if k == "grams" else slice(None)
        m, s = state[k]
        v = v / max(1.0, norm)
        m[where] = 0.9 * m[where] + 0.1 * v
        s[where] = 0.999 * s[where] + 0.001 * v * v
        up = m[where] / (1 - 0.9**turn)
        net.p[k][where] -= rate * up / (np.sqrt(s[where] / (1 - 0.999**turn)) + 1e-6)


def fit_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int = FIT_ROWS, most_bytes: int = FIT_BYTES) -> tuple[list[bytes], np.ndarray]:
    """At most ``rows`` labelled rows of either class outside the held-out fold, first by a hash of their id."""
    fold = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter((fold != HELD_OUT) & F.col("y").isin(0, 1) & F.col("id").isNotNull()).groupBy("id").agg(F.max("y").alias("y"))
    first = Window.partitionBy("y").orderBy(F.xxhash64("id"), "id")
    marks = marks.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= rows).drop("nth")
    # 2 * rows ids, so they are broadcast and no text moves that isn't fitted; repeated rows count once.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.octet_length("text") <= most_bytes)
    found = texts.join(F.broadcast(marks), "id").groupBy("id", "y").agg(F.min("text").alias("text")).orderBy("y", F.xxhash64("id"), "id").collect()
    return [r["text"].encode() for r in found], np.array([r["y"] for r in found], np.float32)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES, seed: int = SEED, epochs: int = EPOCHS) -> DataFrame:
    """Score every whole text: ``id_col, held_out, score, predicted``, a row for each row.

    The network is fitted on at most ``fit_rows`` labelled rows of either class,
    none in the held-out fold and none longer than ``fit_bytes``; fitting them is
    the same work at every size. Every window of every text is scored. Other
    columns, whatever their names, are not read, and ids only tell the folds. Null
    texts count as empty and score as a window without words; a null id counts as
    the empty text in the fold. Repeated rows score alike; of labels that
    contradict each other, toxic counts. Without labelled rows of both classes
    every text gets the class there is (clean without any). An empty table gives an
    empty one.
    """
    spark = ship(docs.sparkSession)
    net = train(*fit_sample(docs, labels, id_col, text_col, label_col, fit_rows, fit_bytes), seed=seed, epochs=epochs)
    model = spark.sparkContext.broadcast(net.p)  # fixed size: two tables of TABLE rows and some small matrices
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(model.value)
        for b in batches:
            score = net.score(b.column("text").cast(pa.binary()).to_pylist())
            out = pa.array([held_out(i) for i in b.column("id").to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("id"), out, pa.array(score, pa.float64())], names=["id", "held_out", "score"])
            trim()

    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(work, schema)
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
