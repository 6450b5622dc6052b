"""Windows over hot groups, and components that keep their labels."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from newsweft.operators import similarity, windows


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("ranges", [1, 3])
def test_rolling_of_a_hot_user(spark, closed, ranges):
    r = random.Random(1)
    t0 = datetime.datetime(2023, 12, 31, 23, 59)
    rows = [(i, "hot" if i % 10 else "u", t0 + datetime.timedelta(seconds=r.choice([r.randint(0, 4000), r.randint(0, 400) * 60])), r.randint(1, 9)) for i in range(600)]
    rows += [(900, "old", datetime.datetime(1969, 12, 31, 23, 59, 30), 1), (901, "old", datetime.datetime(1970, 1, 1, 0, 0, 30), 2), (902, "u", None, 5)]
    df = spark.createDataFrame(rows, "id int, user string, ts timestamp, v int").repartition(3)
    got = {x.id: (x.n, x.total) for x in windows.rolling(df, ["user"], "ts", 60, "v", closed, ranges).collect()}
    for i, u, t, _ in rows[:-1]:
        own = [v for _, w, s, v in rows if w == u and s and (0 <= (t - s).total_seconds() <= 60 if closed else 0 <= (t - s).total_seconds() < 60)]
        assert got[i] == (len(own), sum(own)), i
    assert got[902] == (1, 5)


def test_no_range_holds_the_hot_user(spark):
    """Of 90 % of the rows, no more than a range and the halo before it are together."""
    df = spark.range(100_000).select((F.col("id") * 1_000_000).alias("at"), F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("user"))
    most = windows.time_ranges(df, "at", 60_000_000, 24 * 60_000_000).groupBy("user", "_range").count().agg(F.max("count")).first()[0]
    assert most <= 25 * 60


def test_labels_stay(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 60), 100 + r.randint(0, 60)) for _ in range(70)] + [(5, 5), (None, 3), (7, 107), (7, 107)]
    df = lambda e: spark.createDataFrame(e, "u long, v long")
    none = spark.createDataFrame([], "node long, component long, label string")
    whole = {x.node: x.component for x in similarity.components(df(edges), "u", "v").collect()}
    first = similarity.extend(none, df(edges[:30]), "u", "v").collect()
    one = similarity.duplicate_labels(similarity.components(df(edges[:30]), "u", "v"))
    assert sorted(map(tuple, first)) == sorted(map(tuple, one.collect()))
    second = similarity.extend(spark.createDataFrame(first, none.schema), df(edges[30:]), "u", "v").collect()
    sizes = {}
    for c in whole.values():
        sizes[c] = sizes.get(c, 0) + 1
    assert {x.node: x.component for x in second} == {n: c for n, c in whole.items() if sizes[c] > 1}
    old, label = {x.node: x.label for x in first}, {x.component: x.label for x in second}
    taken = max(old.values())
    for c, k in label.items():
        before = [old[n] for n, m in whole.items() if m == c and n in old]
        assert k == min(before) if before else k > taken
    assert len(set(label.values())) == len(label)
    again = similarity.extend(spark.createDataFrame(second, none.schema), df([]), "u", "v").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, second))
