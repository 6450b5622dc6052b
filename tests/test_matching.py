"""Many terms at once against a plain loop, by the automaton and by the join on grams."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsweft.functions.automaton import Automaton
from newsweft.operators import joins

ROWS = [(1, "Ab aba", "x"), (2, "AB éÉ ab ab", "y"), (3, None, "z"), (4, "", "z"), (5, "x" * 3000 + "needle" + "y" * 900, "z"), (5, "Ab aba", "x"), (6, "မြန်မာ မြန်မာဘာ", "z"), (7, "yangon, YANGONS", "q")]
TERMS = [(1, "ab", "", "甲"), (2, "aba", "", "乙"), (3, "", "AB", "丙"), (4, "", "Éé", "丁"), (5, None, None, "x"), (6, "", "", "x"), (7, "needle", "Yyy", "戊"), (8, "မြန်မာ", "", "己"), (9, "", "Yangon", "庚"), (1, "ab", "", "甲"), (10, "b", "", "辛"), (11, "甲", "", "壬")]


def by_hand():
    out = []
    for i, t, k in ROWS:
        for n, mm, en, ja in TERMS:
            if (mm and mm in (t or "")) or (en and en.lower() in (t or "").lower()):
                out.append((i, k, n, mm, en))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(ROWS, "id int, text string, _t string"), spark.createDataFrame(TERMS, "nth int, mm string, en string, body_ja string")


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_glossary_matches(tables, limit):
    texts, glossary = tables
    got = joins.glossary_matches(texts.withColumnRenamed("_t", "kind"), glossary, "text", limit=limit).select("id", "kind", "nth", "mm", "en")
    assert sorted(map(tuple, got.collect()), key=str) == by_hand()


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_region_matches(tables, limit):
    texts, glossary = tables
    got = joins.region_matches(texts.select("id", "text").distinct(), glossary.filter("nth IN (3, 4, 8, 9)"), "text", limit=limit)
    assert sorted((r.id, r.nth) for r in got.collect()) == [(1, 3), (2, 3), (2, 4), (5, 3), (6, 8), (7, 9)]


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_with_glossary(spark, limit):
    rows = [(1, "ab aba Yangon Yangons", "AB aba yangon"), (2, "ab", "nothing"), (3, None, "ab"), (4, "ab", None)]
    df = spark.createDataFrame(rows, "id int, out string, src string")
    glossary = spark.createDataFrame([(2, "ab", "", "甲"), (1, "aba", "", "乙"), (3, "", "Yangon", "庚"), (4, "甲", "", "壬"), (5, "zz", "", "")], "nth int, mm string, en string, body_ja string")
    got = joins.with_glossary(df, glossary, "out", "src", "nth", limit=limit)
    assert got.columns == df.columns
    assert {r.id: r.out for r in got.collect()} == {1: "甲 乙 庚 Yangons", 2: "ab", 3: "", 4: "ab"}


def test_empty_sides(spark, tables):
    texts, glossary = tables
    for limit in (2_000_000, 0):
        assert joins.glossary_matches(texts, glossary.limit(0), "text", limit=limit).count() == 0
        assert joins.glossary_matches(texts.limit(0), glossary, "text", limit=limit).count() == 0


def test_automaton():
    r = random.Random(1)
    for _ in range(20):
        needles = list({"".join(r.choice("abcé") for _ in range(r.randint(1, 6))) for _ in range(r.randint(1, 40))})
        texts = ["".join(r.choice("abcdé") for _ in range(r.choice([0, 3, 50, 3000]))) for _ in range(10)] + [None]
        t, n = Automaton(needles).find(texts)
        assert list(zip(t.tolist(), n.tolist())) == [(i, j) for i, x in enumerate(texts) for j, w in enumerate(needles) if w in (x or "")]
    t, n = Automaton([]).find(["a"])
    assert len(t) == len(n) == 0
    t, _ = Automaton(["a" * 700]).find(["b" * 513 + "a" * 700, "a" * 699])  # across runs
    assert t.tolist() == [0]


def test_fifty_thousand_terms():
    needles = [f"{i * 2654435761 % (1 << 32):08x}" for i in range(50_000)]
    a = Automaton(needles)
    text = "-".join(needles[i] for i in range(0, 50_000, 1000))
    t, n = a.find([text, "nothing here"])
    assert set(np.unique(t).tolist()) == {0} and {needles[k] for k in n.tolist()} == set(needles[::1000])


def test_speed_of_windows():
    """A core reads a million characters for 20,000 terms in about a tenth of a second; a walk by single characters took over half of one."""
    r = random.Random(2)
    words = list({"".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(9, 20))) for _ in range(40_000)})
    a, texts = Automaton(words[:20_000]), [" ".join(r.choice(words) for _ in range(700)) for _ in range(100)]
    a.find(texts[:1])
    took = []
    for _ in range(3):
        began = time.process_time()
        a.find(texts)
        took.append(time.process_time() - began)
    assert min(took) < 0.35 * sum(map(len, texts)) / 1e6


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_what_stands_around_a_name(spark, limit):
    """The look at a few characters says what the pattern says of the whole text."""
    texts = ["Yangon", "xYangon, yangon", "YANGONS", "é\u0301yangon", "\u0301yangon-", "yangon\u0301 x", "_yangon", "(yangon)", "\U00010400yangon", "noſe nose1", "noſe", "ရန်ကုန် ကရန်ကုန်", "ရန်ကုန်x", "aa aaa", "aaaa"]
    names = [(1, "", "Yangon"), (2, "", "nose"), (3, "ရန်ကုန်", "yangon"), (4, "", "aa")]
    t = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    g = spark.createDataFrame(names, "nth int, mm string, en string")
    mm = F.concat(F.lit(r"(?<![\x{1000}-\x{109F}])\Q"), "mm", F.lit(r"\E(?![\x{1000}-\x{109F}])"))
    en = F.concat(F.lit(r"(?iu)\b\Q"), "en", F.lit(r"\E\b"))
    occurs = F.contains(F.lower("text"), F.lower("en")) | ((F.col("mm") != "") & F.contains("text", F.col("mm")))
    want = t.crossJoin(g).filter(occurs & (((F.col("mm") != "") & F.rlike("text", mm)) | F.rlike("text", en)))
    got = joins.region_matches(t, g, "text", limit=limit)
    assert sorted((r.id, r.nth) for r in got.collect()) == sorted((r.id, r.nth) for r in want.collect())


def test_texts_are_sent_once(spark):
    """Where no needle is looked for literally, a text goes to Python in lower case alone, unless it has a character that is folded."""
    named = joins._needles(spark.createDataFrame([("", "nose")], "mm string, en string"), "mm", "en")
    t = spark.createDataFrame([(1, "A NOSE"), (2, "a no\u017fe")], "id int, text string")
    plan = t.select("id", joins._windows(named, F.col("text"), True).alias("w"))._jdf.queryExecution().optimizedPlan().toString()
    assert "found(CASE WHEN" in plan.replace("RLIKE", "rlike")
    assert [r.w for r in t.select("id", joins._windows(named, F.col("text"), False).alias("w")).orderBy("id").collect()][0][0].needle == "nose"
