"""Greedy cutting of long sequences, many ranges of a sequence at a time.

Where a chunk that starts at a row ends depends on that row alone, and it ends
within the next ``most_rows`` rows. So each row has a successor, found by binary
search on prefix sums, and chunks are the orbit of the first row. A sequence is
cut into ranges of rows; each range works out, for the few rows at which a chunk
from the range before can start, where the orbit leaves it and after how many
chunks. These jumps are composed by doubling, which gives the first chunk of
every range, and then each range cuts its own rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .windows import numbered

#: Rows in a range.
WIDTH = 1 << 14


def successors(sizes: np.ndarray, most_rows: int, most_bytes: int) -> np.ndarray:
    """For each row, the row at which the next chunk starts if a chunk starts there."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(len(sizes))
    return np.minimum(np.maximum(np.searchsorted(sums, sums[:-1] + most_bytes, "right") - 1, at + 1), at + most_rows)


def jumps(nxt: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the first ``rows`` rows, the first row of its orbit behind them, and the chunks on the way."""
    to, n = nxt[:rows].copy(), np.ones(rows, np.int64)
    while len(inside := np.flatnonzero(to < rows)):
        n[inside], to[inside] = n[inside] + n[to[inside]], to[to[inside]]
    return to, n


def greedy_chunks(df: DataFrame, by: list[str], order: list[str], size: str, most_rows: int, most_bytes: int, width: int = WIDTH) -> DataFrame:
    """``chunk``: rows in order; a new one starts where rows or bytes would exceed the limits.

    A row that is larger than ``most_bytes`` is a chunk of its own. A null size
    counts as 0; rows that tie in ``order`` follow each other in any order. Groups
    of any size are spread over ranges of ``width`` rows.
    """
    width = max(width, most_rows)
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    d = df.withColumn("_g", key).withColumn("_s", F.coalesce(F.col(size).cast("long"), F.lit(0)))
    rows = written(numbered(d, ["_g"], order).withColumn("_r", F.expr(f"(rn - 1) div {width}")), "sequence")
    own = rows.select("_g", "_r", "rn", "_s")
    halo = own.filter((F.col("_r") > 0) & ((F.col("rn") - 1) % width < most_rows)).withColumn("_r", F.col("_r") - 1)

    def leave(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn")
        rn, first = pdf["rn"].to_numpy(), int(pdf["_r"].iloc[0]) * width
        n_own = int((rn <= first + width).sum())
        to, n = jumps(successors(pdf["_s"].to_numpy(), most_rows, most_bytes), n_own)
        to = rn[0] + to
        held = (np.arange(n_own) < most_rows) & (to > first + width)  # others end with the sequence
        return pd.DataFrame({"_g": pdf["_g"].iloc[0], "entry": rn[:n_own][held], "exit": to[held], "n": n[held]})

    step = written(own.unionByName(halo).groupBy("_g", "_r").applyInPandas(leave, "_g string, entry long, exit long, n long"), "jumps")
    ranges = own.agg(F.max("_r")).first()[0]
    starts = own.filter("rn = 1").select("_g", F.lit(1).cast("long").alias("entry"), F.lit(0).cast("long").alias("chunks"))
    # After k rounds the first 2 ** k ranges know where their first chunk starts.
    for k in range(int(ranges or 0).bit_length()):
        further = starts.join(step, ["_g", "entry"]).select("_g", F.col("exit").alias("entry"), (F.col("chunks") + F.col("n")).alias("chunks"))
        starts = written(starts.unionByName(further), "starts")
        second = step.select("_g", F.col("entry").alias("exit"), F.col("exit").alias("last"), F.col("n").alias("more"))
        step = written(step.join(second, ["_g", "exit"]).select("_g", "entry", F.col("last").alias("exit"), (F.col("n") + F.col("more")).alias("n")), "jumps")
    found = starts.select("_g", F.expr(f"(entry - 1) div {width}").alias("_r"), F.col("entry").alias("_entry"), F.col("chunks").alias("_chunks"))
    cols = df.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", chunk long"

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn")
        nxt, new = successors(pdf["_s"].to_numpy(), most_rows, most_bytes), np.zeros(len(pdf), np.int64)
        k = int(pdf["_entry"].iloc[0] - pdf["rn"].iloc[0])
        while k < len(pdf):
            new[k], k = 1, nxt[k]
        return pdf[cols].assign(chunk=int(pdf["_chunks"].iloc[0]) - 1 + np.cumsum(new))

    return rows.join(found, ["_g", "_r"]).groupBy("_g", "_r").applyInPandas(cut, schema)
