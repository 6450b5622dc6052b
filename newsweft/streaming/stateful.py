"""Stateful operators of streams: the body cache, and quotas with timers. State is kept by key in the state store, sized by what a key needs."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ship

_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ready(spark: SparkSession) -> SparkSession:
    """Stateful processors need a state store with column families, and travel by value: the process in which Spark plans them doesn't get shipped files."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    return ship(spark)


class _Cache(StatefulProcessor):
    """Entries of one address: by item id, each with the first place it came at and the latest value of each column."""

    def __init__(self, values: list[str]):
        self.values = values

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getMapState("entries", "id string", "position long, " + ", ".join(f"`{v}` string, `{v}_at` long" for v in self.values))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {k[0]: list(v) for k, v in self.entries.iterator()}
        changed = set()
        for r in sorted((r for pdf in rows for r in pdf[["seq", "id", *self.values]].itertuples(index=False, name=None)), key=lambda r: r[0]):
            seq, own = int(r[0]), (r[1] or "").strip()
            if not own and held:  # without an id, the address's first entry
                own = min(held, key=lambda k: held[k][0])
            entry = held.setdefault(own, [seq] + [None, None] * len(self.values))
            entry[0] = min(entry[0], seq)
            for i, v in enumerate(r[2:]):
                if v and (entry[2 + 2 * i] is None or seq >= entry[2 + 2 * i]):
                    entry[1 + 2 * i : 3 + 2 * i] = [v, seq]
            changed.add(own)
        for own in changed:
            self.entries.updateValue((own,), tuple(held[own]))
        yield pd.DataFrame([(key[0], own, held[own][0], *held[own][1::2]) for own in sorted(changed)], columns=["address", "id", "position", *self.values])

    def close(self) -> None:
        pass


def body_cache(stream: DataFrame, id_col: str, url_col: str, seq: str, values: list[str]) -> DataFrame:
    """``address, id, position`` and ``values`` of every entry that a batch changes, in update mode.

    A row with an id belongs to that id's entry of its address, one without to the
    address's first entry; a new one is added otherwise. An empty or null value
    never overwrites, of others the one of the highest ``seq`` stays, in whatever
    order rows arrive. An address is stripped of blanks and slashes at its end;
    rows with neither address nor id are left out. An id keeps its address.
    """
    blank = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    url = F.nullif(F.regexp_replace(F.trim(F.coalesce(F.col(url_col), F.lit(""))), "/+$", ""), F.lit(""))
    address = F.coalesce(url, F.concat(F.lit("id:"), blank(id_col)))
    rows = stream.select(address.alias("address"), F.col(seq).cast("long").alias("seq"), F.col(id_col).cast("string").alias("id"), *[F.col(v).cast("string").alias(v) for v in values]).filter("address IS NOT NULL AND seq IS NOT NULL")
    ready(stream.sparkSession)
    schema = "address string, id string, position long, " + ", ".join(f"`{v}` string" for v in values)
    return rows.groupBy("address").transformWithStateInPandas(_Cache(list(values)), schema, "Update", "None")


def latest_entries(updates: DataFrame) -> DataFrame:
    """The last update of each entry (``batch`` numbers the updates)."""
    rest = [c for c in updates.columns if c not in ("address", "id", "batch")]
    return updates.groupBy("address", "id").agg(F.max_by(F.struct(*rest), "batch").alias("x")).select("address", "id", *[f"x.{c}" for c in rest])


MINUTE, DAY = 60_000_000, 86_400_000_000


class _Quota(StatefulProcessor):
    """Events of a user wait until the watermark has passed them, then count in order; a timer ends the local day."""

    def __init__(self, daily: int, per_minute: int, offset: int):
        self.daily, self.per_minute, self.offset = daily, per_minute, offset

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "event long, at long")
        self.recent = handle.getListState("recent", "at long")
        self.today = handle.getValueState("today", "day long, n long, busy boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(e), int(t)) for pdf in rows for e, t in zip(pdf["event"], pdf["at"])]
        self.waiting.appendList(new)
        # One timer a batch: when it rings, everything of the batch is behind the watermark.
        self.handle.registerTimer(-(-max(t for _, t in new) // 1000))
        yield pd.DataFrame(columns=["event", "at", "day", "ordinal", "over", "notify", "per_minute", "busy", "warn"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted((w[1], w[0]) for w in self.waiting.get()) if self.waiting.exists() else []
        due, later = [w for w in waiting if w[0] <= passed], [w for w in waiting if w[0] > passed]
        day, n, busy = self.today.get() if self.today.exists() else (None, 0, False)
        recent = [r[0] for r in self.recent.get()] if self.recent.exists() else []
        out = []
        for at, event in due:
            d = (at + self.offset) // DAY
            if d != day:
                day, n = d, 0
            n += 1
            recent = [t for t in recent if t >= at - MINUTE] + [at]
            was, busy = busy, len(recent) > self.per_minute
            out.append((event, at, day, n, n > self.daily, n == self.daily + 1, len(recent), busy, busy and not was))
        self.waiting.clear()
        if later:
            self.waiting.put([(e, t) for t, e in later])
        if day is not None and not later and (day + 1) * DAY - self.offset + MINUTE <= passed:  # the day is over: nothing of it can come
            self.today.clear()
            self.recent.clear()
        elif day is not None:
            self.today.update((day, n, busy))
            self.recent.clear()
            if recent:
                self.recent.put([(t,) for t in recent])
            self.handle.registerTimer(-(-((day + 1) * DAY - self.offset + MINUTE) // 1000))
        yield pd.DataFrame(out, columns=["event", "at", "day", "ordinal", "over", "notify", "per_minute", "busy", "warn"])

    def close(self) -> None:
        pass


def quota(stream: DataFrame, user: str, event: str, ts: str, late: str, daily: int, per_minute: int, offset_minutes: int = 390) -> DataFrame:
    """Counts of each user's local day and of the 60 seconds up to each event, and where either passes its limit.

    ``user, event, at, day, ordinal, over, notify, per_minute, busy, warn``: an event
    comes out when the watermark, ``late`` behind the latest one, has passed it, in
    order of time and then ``event``, however rows arrived before. A user's state
    is the events that wait, those of the last minute and a count, and goes with the day.
    Rows behind the watermark are left out (``once.late_rows`` keeps them).
    """
    ready(stream.sparkSession)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = stream.withWatermark(ts, late).select(F.col(user).alias("user"), F.col(event).cast("long").alias("event"), at.alias("at"), ts).filter(F.col(event).isNotNull() & F.col(ts).isNotNull())
    schema = "event long, at long, day long, ordinal long, over boolean, notify boolean, per_minute long, busy boolean, warn boolean"
    return rows.groupBy("user").transformWithStateInPandas(_Quota(daily, per_minute, offset_minutes * MINUTE), schema, "Append", "EventTime")
