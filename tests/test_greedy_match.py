"""One-to-one matching in rounds against the plain loop."""

import random

import pytest

from newsweft.operators import layout


def by_hand(pairs, least):
    out = []
    for g in {p[0] for p in pairs}:
        used = set()
        for left in sorted({p[1] for p in pairs if p[0] == g}):
            free = [(-s, r) for h, x, r, s in pairs if (h, x) == (g, left) and s >= least and r not in used]
            if free:
                s, r = min(free)
                used.add(r)
                out.append((g, left, r, -s))
    return sorted(out)


@pytest.mark.parametrize("alone", [0, 40, 200_000])
def test_rounds_equal_the_loop(spark, alone):
    r = random.Random(alone)
    pairs = list({(g, x, y): (g, x, y, round(r.random(), 1)) for g in (1, 2) for x in range(30) for y in r.sample(range(40), 6)}.values())
    pairs += [(3, x, y, 0.9 - y / 100) for x in range(9) for y in range(5)]  # all want the same, in the same order
    pairs += [(4, 1, 1, 0.1)] + pairs[:5]  # below the least score; repeats
    df = spark.createDataFrame(pairs, "day int, item int, article int, score double").repartition(3)
    got = layout.greedy_match(df, "day", "item", "article", "score", 0.2, alone)
    assert sorted(map(tuple, got.collect())) == by_hand(set(pairs), 0.2)


def test_nothing_to_match(spark):
    df = spark.createDataFrame([], "day int, item int, article int, score double")
    assert layout.greedy_match(df, "day", "item", "article", "score", alone=0).collect() == []
