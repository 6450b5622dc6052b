"""Greedy cutting over ranges against the plain loop."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsweft.operators import cutting

SCHEMA = "sheet string, row long, bytes long, chunks string, entry int, n int"


def by_hand(sizes, most_rows, most_bytes):
    out, rows, used, chunk = [], 0, 0, 0
    for n in sizes:
        if rows and (rows + 1 > most_rows or used + n > most_bytes):
            rows, used, chunk = 0, 0, chunk + 1
        rows, used = rows + 1, used + n
        out.append(chunk)
    return out


@pytest.mark.parametrize("most_rows, most_bytes, width", [(5, 60, 8), (1, 100, 4), (3, 0, 3), (7, 10**9, 16), (4, 35, 1 << 14)])
def test_greedy_chunks(spark, most_rows, most_bytes, width):
    r = random.Random(most_rows)
    sheets = {"a": 333, "b": 1, None: 40, "c": 64}
    rows = [(s, i, r.choice([0, 0, 1, 9, 30, 200, None]), "x", 1, 2) for s, n in sheets.items() for i in range(n)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = cutting.greedy_chunks(df, ["sheet"], ["row"], "bytes", most_rows, most_bytes, width)
    assert got.columns == [*df.columns, "chunk"] and got.count() == len(rows)
    for s in sheets:
        own = sorted((x for x in rows if x[0] == s), key=lambda x: x[1])
        here = got.filter(F.col("sheet").eqNullSafe(F.lit(s))).orderBy("row").collect()
        assert [x.chunk for x in here] == by_hand([x[2] or 0 for x in own], most_rows, most_bytes)


def test_one_sequence_over_many_tasks(spark):
    """A single sequence is cut by as many groups as it has ranges, none larger than a range and its halo."""
    df = spark.range(20_000).select(F.col("id").alias("row"), (F.col("id") * 7919 % 97).alias("bytes"))
    got = cutting.greedy_chunks(df, [], ["row"], "bytes", 25, 900, 512)
    assert [x.chunk for x in got.orderBy("row").collect()] == by_hand([i * 7919 % 97 for i in range(20_000)], 25, 900)
    assert got.select((F.col("row") / 512).cast("int").alias("r"), F.spark_partition_id().alias("p")).distinct().count() >= 40


def test_empty_and_jumps(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cutting.greedy_chunks(empty, ["sheet"], ["row"], "bytes", 5, 5).collect() == []
    nxt = cutting.successors(np.array([4, 4, 4, 9, 1, 1]), 3, 8)
    assert nxt.tolist() == [2, 3, 3, 4, 6, 6]
    to, n = cutting.jumps(nxt, 4)
    assert to.tolist() == [4, 4, 4, 4] and n.tolist() == [3, 2, 2, 1]
