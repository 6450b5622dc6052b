"""What the comparison of articles moves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsweft.operators import context


def test_blocks_travel_as_texts(spark):
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(1000))
    df = spark.createDataFrame([(i, f"title {i}", text) for i in range(3)], "id long, title string, body string")
    side = context.sides(df, F.lit(1), F.col("id"), F.col("title"), F.col("body"), F.lit("u"), F.lit(""))
    size = side.select(sum((F.octet_length(c) for c in side.columns if c not in ("grp", "id")), F.lit(0)).alias("n")).agg(F.max("n")).first()[0]
    assert size <= 1.2 * len(text)
    got = context.pairs(side, None, "grp")
    assert sorted((r.id, r.other) for r in got.collect()) == [(a, b) for a in range(3) for b in range(3) if a != b]


def test_copies_do_not_grow_with_a_group(spark, monkeypatch):
    """A group of many blocks travels in few spans, and the best partners are those of all pairs."""
    monkeypatch.setattr(context, "BLOCK", 5)
    words = [f"w{i * 7919 % 101}" for i in range(300)]
    df = spark.createDataFrame([(i, f"title {i % 40}", " ".join(words[i * 3 % 200 : i * 3 % 200 + 20 + i % 9])) for i in range(90)], "id long, title string, body string")
    side = context.sides(df, F.lit(1), F.col("id"), F.col("title"), F.col("body"), F.lit(""), F.lit(""))
    assert context._blocks(side, "grp", "i", True).agg(F.max("i")).first()[0] < context.SPANS
    score = F.round(F.col("points") + F.when(F.col("sim") >= context.LEAST, F.col("sim") * context.FACTOR).otherwise(0.0), 6)
    best = {}
    for r in context.pairs(side, None, "grp").select("id", "other", score.alias("s")).collect():
        best.setdefault(r.id, []).append((-r.s, r.other))
    got = {}
    for r in context.pairs(side, None, "grp", most=6).select("id", "other", score.alias("s")).collect():
        got.setdefault(r.id, []).append((-r.s, r.other))
    assert {i: sorted(x)[:6] for i, x in got.items()} == {i: sorted(x)[:6] for i, x in best.items()}


def test_a_text_travels_once(spark, monkeypatch):
    """A group is one span though it has many blocks, and of larger groups a text is copied once a span."""
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(50))
    df = spark.createDataFrame([(i, f"title {i}", text) for i in range(600)], "id long, title string, body string")
    side = context.sides(df, F.lit(1), F.col("id"), F.col("title"), F.col("body"), F.lit(""), F.lit(""))
    assert context._tasks(side, None, "grp").count() == 600
    monkeypatch.setattr(context, "SPAN_ROWS", 200)
    assert context._tasks(side, None, "grp").count() == 600 * 3


@pytest.mark.parametrize("words", [1, 16])
def test_counts_are_those_of_sets(monkeypatch, words):
    """Shared grams by bits, in few and many blocks, with blank and long texts and characters of any alphabet."""
    monkeypatch.setattr(context, "WORDS", words)
    monkeypatch.setattr(context, "ADDED", 40)
    r = np.random.default_rng(4)
    for letters in ("abcé\U00010428", "".join(map(chr, range(0x4E00, 0x4E00 + 5000)))):
        texts = ["", "a", letters] + ["".join(r.choice(list(letters[:9]), r.integers(0, 400))) for _ in range(150)]
        sets = [{t[k : k + n] for n in (3, 4, 5) for k in range(len(t) - n + 1)} for t in texts]
        for a, b in ((np.arange(len(texts)), None), (np.arange(90), np.arange(90, len(texts)))):
            seen = []
            for i, j, shared, size_i, size_j, within in context._tiles(texts, a, b):
                assert size_i.tolist() == [len(sets[k]) for k in i] and size_j.tolist() == [len(sets[k]) for k in j]
                assert shared.tolist() == [[len(sets[x] & sets[y]) for y in j] for x in i]
                seen += [(min(x, y), max(x, y)) for x in i.tolist() for y in j.tolist() if not within or x < y]
            assert len(seen) == len(set(seen)) == (len(texts) * (len(texts) - 1) // 2 if b is None else len(a) * len(b))


def test_more_grams_than_a_task_holds(monkeypatch):
    r = np.random.default_rng(5)
    texts = ["".join(r.choice(list("abcdefgh"), 60)) for _ in range(20)]
    count = lambda: {(min(x, y), max(x, y)): int(s[k, m]) for i, j, s, *_ in context._tiles(texts, np.arange(20), None) for k, x in enumerate(i.tolist()) for m, y in enumerate(j.tolist()) if x != y}
    whole = count()
    monkeypatch.setattr(context, "GRAMS", 500)
    assert count() == whole and len(whole) == 190


def test_similar(spark, monkeypatch):
    """Pairs once, smaller ids first, as ``pairs`` gives them, and halves of the last digit go up."""
    words = [f"w{i * 7919 % 101}" for i in range(300)]
    rows = [(i, "", " ".join(words[i * 3 % 200 : i * 3 % 200 + 20 + i % 9])) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, title string, body string")
    side = context.sides(df, F.lit(1), F.col("id"), F.col("title"), F.col("body"), F.lit(""), F.lit(""))
    want = context.pairs(side, None, "grp").filter((F.col("id") < F.col("other")) & (F.col("sim") >= context.LEAST)).select("id", "other", F.round("sim", 6).alias("sim"))
    for span in (context.SPAN_ROWS, 20):
        monkeypatch.setattr(context, "SPAN_ROWS", span)
        assert sorted(map(tuple, context.similar(side, "grp").collect())) == sorted(map(tuple, want.collect()))
    a = "".join(map(chr, range(0x100, 0x100 + 131)))
    # 3 * 131 - 9 = 384 grams, of which 3 * 27 - 9 = 72 are shared: 0.1875, and 0.1953125 with 28 characters.
    for n, sim in ((27, 0.1875), (28, 0.195313)):
        b = a[:n] + "".join(map(chr, range(0x1000, 0x1000 + 300)))
        df = spark.createDataFrame([(7, a), (3, b)], "id long, key string").withColumn("grp", F.lit(1))
        assert [tuple(x) for x in context.similar(df, "grp").collect()] == [(3, 7, sim)]
