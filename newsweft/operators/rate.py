"""A client-side limiter, replayed over a table of requests: requests a minute, least interval, jitter."""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, SLACK = 60.0, 0.01


def limited(requests: DataFrame, by: str, ready: str, per_minute: int, interval: float = 0.0, jitter: str | None = None) -> DataFrame:
    """``requests`` with ``start``: when each may start, in seconds, if the client works one after another.

    A request is ready at ``ready`` and not before the last one has started. The
    window is half-open: a start 60 seconds ago no longer counts. ``jitter`` is a
    column of waits, as chance has no place in a replay. State is one client's
    last starts, so each client is one group, as it was one process.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema) + ", start double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ready, kind="stable")
        seen: deque[float] = deque()
        now, last, out = 0.0, None, []
        for row in pdf.to_dict("records"):
            now = max(now, float(row[ready]))
            if last is not None and now - last < interval:
                now = last + interval
            while seen and now - seen[0] >= WINDOW:
                seen.popleft()
            if len(seen) >= max(1, per_minute):
                now += max(0.0, WINDOW - (now - seen[0]) + SLACK)
            now += float(row[jitter]) if jitter else 0.0
            last = now
            seen.append(now)
            out.append(now)
        return pdf.assign(start=out)

    return requests.groupBy(by).applyInPandas(run, fields)


def backoff(attempts: DataFrame, base: float = 60.0, most: float = 1200.0, jitter: str | None = None) -> DataFrame:
    """``wait`` before each retry: doubled from ``base``, with a jitter column, and capped."""
    plain = base * F.pow(F.lit(2.0), F.col("attempt"))
    return attempts.withColumn("wait", F.least(F.lit(most), plain + (F.col(jitter) if jitter else F.lit(0.0))))
