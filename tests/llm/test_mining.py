"""Collocations, toxicity and hard negatives against brute force, on small tables with nulls, ties, repeats and clashing names."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from newsweft.llm import collocations, hard_negatives, queries, toxicity

SCHEMA = "doc_id long, text string, lang string, unit_id string, ids int, a string, n string, words int, bucket int"


@pytest.mark.parametrize("name", ["op11_collocations", "op13_hard_negatives"])
def test_sql_twins(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    cur = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())
    assert sorted(map(tuple, df.select(*cols).collect())) == want and want


# Collocations


def texts():
    r = random.Random(5)
    vocab = ["the", "of", "Ä", "new", "york", "city", "a", "x", "z", "the"]
    out = [" ".join(r.choice(vocab) + r.choice(["", "", "", ",", ".", "\n", "!\t"]) for _ in range(r.randint(0, 60))) for _ in range(60)]
    out += ["NEW york city hall"] * 40 + ["the the the the the"] * 12 + ["", None, " \t\n.,", "a\x0bb\x0cc", "word " * 300, "é" * 4000, "a,b;c:d"]
    return [(i, t, ["en", "de", None][i % 3], "u", 1, "a", "n", 2, 3) for i, t in enumerate(out)] + [(None, "new york", "und", "u", 1, "a", "n", 2, 3)]


def phrases_by_hand(rows, least, covered, top):
    f = collections.defaultdict(collections.Counter)
    n = collections.Counter()
    for _, t, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cand.items():
            longer = [b for q, b in cand.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= covered * a for b in longer):
                continue
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("how", [{}, {"split": 40, "buckets": 7, "fan_out": 2, "most": 30, "broadcast_words": 0}, {"buckets": 5, "split": 100}])
def test_collocations(spark, how):
    rows = texts()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = collocations.collocations(docs, least=6, top=25, **how)
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(rows, 6, 80, 25)


def test_collocations_without_candidates(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(empty).collect() == []
    few = spark.createDataFrame(texts()[:3], SCHEMA)
    assert collocations.collocations(few, least=1000).collect() == []


def test_fragments_hold_each_occurrence_once():
    r = np.random.default_rng(2)
    token, starts = r.integers(0, 6, 400), r.random(400) < 0.1
    starts[0] = True
    ids = np.array([0, 5, 2, 9, 4, 7], np.uint32)
    f = np.bincount(token, minlength=6) * (ids > 0)
    rows, counts = collocations.fragments(token, starts, ids, f)
    got = collections.Counter()
    for grams, a in collocations.mine(rows, counts, np.ones(len(rows), bool), 1):
        for g, c in zip(grams.tolist(), a.tolist()):
            assert tuple(g) not in got
            got[tuple(g)] = c
    want = collections.Counter()
    piece = np.cumsum(starts)
    for k in (2, 3, 4):
        for i in range(400 - k + 1):
            g = ids[token[i : i + k]]
            if piece[i] == piece[i + k - 1] and g.all():
                want[tuple(g.tolist())] += 1
    assert got == want


# Hard negatives


def negatives_by_hand(rows, positives=5, negatives=3):
    fine = {(i, l, tuple(int(np.floor(256 * float(x))) for x in v)) for i, l, v in rows if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, v in fine:
        if i % 50:
            continue
        near = sorted((-dot(v, w), j) for j, m, w in fine if m == label and j != i)[:positives]
        for s, j in near:
            s = -s
            hard = sorted((-dot(v, w), k) for k, m, w in fine if m != label and 50 * s <= 100 * dot(v, w) <= 95 * s)[:negatives]
            out += [(i, j, r + 1, k, s, -t) for r, (t, k) in enumerate(hard)]
    return sorted(out)


VECTORS = "vec_id long, label int, embedding array<float>, id int, x string, tie int, grp int, block string"


def vectors():
    r = np.random.default_rng(4)
    rows = [(int(i), int(r.integers(0, 4)) if i % 3 else 0, [float(np.float32(x)) for x in r.standard_normal(7).round(1)]) for i in range(301)]
    rows += rows[50:52] + rows[100:101] * 40  # repeated rows, one of them hot
    rows += [(50, 2, rows[50][2]), (150, 1, [0.5] * 7), (None, 1, [1.0] * 7), (400, None, [1.0] * 7), (450, 1, None), (500, 1, [1.0, None]), (550, 1, [float("nan")] * 7), (600, 2, [float("inf")] + [1.0] * 6), (650, 3, []), (700, 3, [1.0, -1.0])]
    return rows


@pytest.mark.parametrize("how", [{}, {"rows_in_block": 16, "anchors_in_block": 2, "chunks": 3, "strip": 2}, {"rows_in_block": 40, "anchors_in_block": 3, "chunks": 9, "strip": 1}])
def test_hard_negatives(spark, how):
    df = spark.createDataFrame([(*v, 1, "x", 2, 3, "b") for v in vectors()], VECTORS).repartition(3)
    got = hard_negatives.mine(df, **how)
    assert sorted(map(tuple, got.collect())) == negatives_by_hand(vectors())


def test_hard_negatives_large_numbers(spark):
    """Scores beyond 2**53 are exact; those that may pass 64 bits are refused."""
    rows = [(i, i % 2, [1e6 + i, 2e6 - 3 * i, 5e6]) for i in range(101)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = sorted(map(tuple, hard_negatives.mine(df, low=0, high=100, rows_in_block=30).select("anchor_id", "positive_id", "positive_score").distinct().collect()))
    ints = {i: [int(256 * x) for x in v] for i, _, v in rows}
    want = []
    for a in (0, 50, 100):
        dots = sorted((-sum(x * y for x, y in zip(ints[a], ints[b])), b) for b in ints if b % 2 == a % 2 and b != a)[:5]
        want += [(a, b, -s) for s, b in dots]
    assert want[0][2] > 1 << 53 and set(got) <= set(want) and got
    with pytest.raises(OverflowError):
        hard_negatives.mine(spark.createDataFrame([(0, 1, [1e8] * 3)], df.schema))


def test_hard_negatives_without_rows(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(empty).collect() == []
    one = spark.createDataFrame([(50, 1, [1.0], 1, "x", 2, 3, "b")], VECTORS)
    assert hard_negatives.mine(one).collect() == []
    assert hard_negatives.mine(one, anchors=F.lit(False)).collect() == []


def test_score_bounds():
    s = np.array([-250, -1, 0, 1, 3, 99, 100, 101, 1 << 60, (1 << 63) - 1])
    least, most = hard_negatives.bounds(s, 50, 95)
    assert least.tolist() == [-((-50 * int(x)) // 100) for x in s] and most.tolist() == [95 * int(x) // 100 for x in s]


# Toxicity


def test_network_gradients():
    r = np.random.default_rng(0)
    net = toxicity.Network.new(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = toxicity.Inputs([b"alpha beta gamma delta epsilon", b"one two", b"", b"beta beta x"], 6, 3)
    token, live = x.words_of(np.arange(len(x.start)))
    words, y = r.standard_normal((len(x.row), 2 * toxicity.WIDTH)), np.array([1.0, 0, 1, 0])[x.text]
    _, grad = net.gradients(token, live, words, y)

    def loss():
        logit = net.forward(token, live, words)[0]
        return float(np.mean(np.logaddexp(0, logit) - y * logit))

    for name, g in grad.items():
        a = words if name == "words" else net.p[name]
        for _ in range(3):
            i = tuple(r.integers(0, n) for n in a.shape)
            old = a[i]
            a[i] = old + 1e-3
            up = loss()
            a[i] = old - 1e-3
            down = loss()
            a[i] = old
            assert abs((up - down) / 2e-3 - g[i]) < 1e-5 + 1e-3 * abs(g[i]), name


def test_windows_cover_whole_texts():
    texts = [b"w%d " % k * n for k, n in enumerate((0, 1, 31, 32, 33, 56, 57, 500))]
    x = toxicity.Inputs(texts)
    counts = [0, 1, 31, 32, 33, 56, 57, 500]
    for i, n in enumerate(counts):
        own = np.flatnonzero(x.text == i)
        assert len(own) >= 1
        base = sum(counts[:i])
        covered = {int(x.start[k]) - base + j for k in own for j in range(int(x.size[k]))}
        assert covered == set(range(n))
        assert n <= toxicity.WINDOW or (np.diff(x.start[own]) < toxicity.WINDOW).all()


def test_long_words_and_grams():
    a, b = toxicity.Inputs([b"x" * 100_000 + b" end"]), toxicity.Inputs([b"ab"])
    assert np.diff(a.gram_ends, prepend=0).max() <= 3 * (2 * toxicity.EDGE + 3)
    assert np.diff(b.gram_ends, prepend=0).tolist() == [3]  # of _ab_: two of 3 characters, one of 4


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.classify(docs, labels).cache()


def test_toxicity_on_held_out(scored):
    docs, labels, got = scored
    rows = got.join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert len(toxic) >= 5 and sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)
    assert got.count() == docs.count() and got.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_toxicity_reads_text_alone(spark, scored):
    """One insult at any place of a long text counts; ids, languages and neighbours don't."""
    docs, labels, got = scored
    insult = docs.join(labels.filter("toxic = 1"), "doc_id").filter("lang = 'en' AND length(text) < 3000 AND text LIKE '%idiot%'").first()["text"]
    clean = max((r["text"] for r in docs.join(labels.filter("toxic = 0 AND quality = 1"), "doc_id").join(got.filter("score < 0.05"), "doc_id").filter("lang = 'en'").collect()), key=len)
    half = clean[: len(clean) // 2]
    rows = [(1, clean, "en"), (2, half + " idiot " + clean[len(half) :], "xx"), (3, None, None), (4, "", "en"), (None, insult, "en"), (1, clean, "de"), (6, " \n", "en"), (7, "é" * 50_000, "en")]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, score string, held_out int")
    net = toxicity.train(*toxicity.fit_sample(docs, labels, "doc_id", "text", "toxic"))
    alone = [float(net.score([None if t is None else t.encode()])[0]) for _, t, _ in rows]
    together = net.score([None if t is None else t.encode() for _, t, _ in rows])
    assert np.allclose(alone, together, atol=1e-5)
    assert alone[0] < 0.5 <= alone[1] and alone[2] == alone[3] == alone[6] < 0.5 <= alone[4]
    out = toxicity.classify(df, labels, epochs=1)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == len(rows)
    assert {r.doc_id: r.held_out for r in out.collect()} == {i: toxicity.held_out(i) for i, _, _ in rows}


def test_toxicity_without_labels(spark, scored):
    docs, labels, _ = scored
    got = toxicity.classify(docs.limit(5), labels.filter("toxic = 0"))
    assert {r.predicted for r in got.collect()} == {0}
    assert toxicity.classify(docs.limit(0), labels, epochs=1).count() == 0
    assert {r.predicted for r in toxicity.classify(docs.limit(5), labels.limit(0)).collect()} == {0}


def test_no_scores_are_shuffled(spark):
    """Each panel is sent with its strip, and what a task gives are the first few rows of each anchor, not tiles."""
    df = spark.range(400).select(F.col("id").alias("vec_id"), (F.col("id") % 3).cast("int").alias("label"), F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.sin(F.col("id") * i).cast("float")).alias("embedding"))
    seen, meet = [], hard_negatives._meet

    def watched(panels, *a):
        seen.append(meet(panels, *a))
        return seen[-1]

    hard_negatives._meet = watched
    try:
        hard_negatives.mine(df, rows_in_block=50, anchors_in_block=2, chunks=3)
    finally:
        hard_negatives._meet = meet
    assert len(seen) == 2 and all(set(dict(d.dtypes).values()) == {"bigint"} for d in seen)
