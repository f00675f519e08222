"""Streams with state of their own: bounded by a delay, with corrections for what comes later."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

HOUR = 3_600_000
#: The state store that streams with state of their own need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUT = "hour long, n long, cents long, kind string"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Run streams with the state store they need, and give the session its own setting back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class HourTotals(StatefulProcessor):
    """Count and sum per hour of one key. Open hours are state; an hour is closed, emitted and forgotten once the key's newest
    time is ``delay`` beyond its end. Rows of a closed hour are emitted at once as a correction. A key without rows for ``idle``
    milliseconds has its open hours emitted by a timer."""

    def __init__(self, delay: int, idle: int | None = None):
        self.delay, self.idle = delay, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "hour long", "n long, cents long")
        self.marks = handle.getValueState("marks", "newest long, closed long, timer long")

    def _closing(self, key: tuple, upto: int | None) -> list[tuple]:
        """Emit and forget the open hours that end by ``upto`` (all of them for None)."""
        ended = [(h[0], tuple(v)) for h, v in self.open.iterator() if upto is None or h[0] + HOUR <= upto]
        for hour, _ in ended:
            self.open.removeKey((hour,))
        return [(*key, hour, n, cents, "closed") for hour, (n, cents) in sorted(ended)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest, closed, timer = self.marks.get() if self.marks.exists() else (-(1 << 62), -(1 << 62), None)
        out = []
        for pdf in rows:
            newest = max(newest, int(pdf["at"].max()))
            counted = pdf[pdf["cents"].notna()]
            hours = counted.groupby(counted["at"] // HOUR * HOUR)["cents"].agg(["count", "sum"])
            for hour, count, cents in zip(hours.index.tolist(), hours["count"].tolist(), hours["sum"].tolist()):
                if hour + HOUR <= closed:
                    out.append((*key, hour, count, int(cents), "late"))
                    continue
                n, held = self.open.getValue((hour,)) if self.open.containsKey((hour,)) else (0, 0)
                self.open.updateValue((hour,), (n + count, held + int(cents)))
        closed = max(closed, newest - self.delay)
        out += self._closing(key, closed)
        if self.idle is not None:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = timerValues.getCurrentProcessingTimeInMs() + self.idle
            self.handle.registerTimer(timer)
        self.marks.update((newest, closed, timer))
        yield pd.DataFrame(out, columns=["key", "hour", "n", "cents", "kind"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        newest, closed, _ = self.marks.get()
        out = self._closing(key, None)
        # what comes now for these hours is a correction
        self.marks.update((newest, max([closed, *[row[1] + HOUR for row in out]]), None))
        yield pd.DataFrame(out, columns=["key", "hour", "n", "cents", "kind"])

    def close(self) -> None:
        pass


def hour_totals(events: DataFrame, ts: str, key: str, cents: Column, delay: int, idle: int | None = None) -> DataFrame:
    """Hourly count and sum per key of a stream whose state is the hours of the last ``delay`` milliseconds.

    Rows: key, hour (milliseconds), n, cents, kind (``closed`` or ``late``). Every event is in exactly one of them, so the sums of
    all rows of an hour are the hour's totals whatever the order of arrival. ``cents`` is a whole number; a row with null cents
    moves the key's time on and counts nothing.
    """
    rows = events.select(F.col(key).cast("string").alias("key"), F.unix_millis(ts).alias("at"), cents.cast("long").alias("cents"))
    mode = "None" if idle is None else "ProcessingTime"
    return rows.groupBy("key").transformWithStateInPandas(HourTotals(delay, idle), f"key string, {_OUT}", "Append", mode)


def summed_hours(rows: DataFrame) -> DataFrame:
    """Totals per key and hour from the stored rows of :func:`hour_totals`, with the number of late events."""
    return rows.groupBy("key", F.timestamp_millis("hour").cast("timestamp_ntz").alias("hour")).agg(
        F.sum("n").alias("n"), (F.sum("cents") / 100).alias("total"), F.sum(F.when(F.col("kind") == "late", F.col("n")).otherwise(0)).alias("late")
    )


def joined_stretches(stretches: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """(first, last, steps) put together where less than ``gap`` lies between one's last and the next one's first."""
    out: list[tuple[int, int, int]] = []
    for first, last, steps in sorted(stretches):
        if out and first - out[-1][1] < gap:
            out[-1] = out[-1][0], max(out[-1][1], last), out[-1][2] + steps
        else:
            out.append((first, last, steps))
    return out


class GapSessions(StatefulProcessor):
    """Sessions of one key, ended by a gap. Only sessions that a row within ``delay`` of the newest one could still reach are
    state; the others are emitted. A later row makes a stretch of its own, emitted at once.

    What a key holds is one value, read once and written once a batch: with many keys of few rows these calls are the work.
    """

    def __init__(self, gap: int, delay: int):
        self.gap, self.delay = gap, delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "newest long, firsts array<long>, lasts array<long>, steps array<long>")

    def ended(self, rows: Iterable[tuple[int, bool]]) -> list[tuple[int, int, int]]:
        """Take the times of a key's rows, with whether they count, into its state; the stretches that leave it."""
        newest, *held = self.held.get() or (-(1 << 62), [], [], [])
        found = list(zip(*held))
        for at, counts in rows:
            newest = max(newest, at)
            if counts:
                found.append((at, at, 1))
        joined = joined_stretches(found, self.gap)
        over = [s[1] + self.gap <= newest - self.delay for s in joined]
        kept = [s for s, o in zip(joined, over) if not o]
        self.held.update((newest, *([s[i] for s in kept] for i in range(3))))
        return [s for s, o in zip(joined, over) if o]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times = [pair for pdf in rows for pair in zip(pdf["at"].tolist(), pdf["counts"].tolist())]
        yield pd.DataFrame([(*key, *s) for s in self.ended(times)], columns=["key", "first", "last", "steps"])

    def close(self) -> None:
        pass


class GapSessionRows(GapSessions):
    """The same from rows to rows: a frame for each key takes longer to build than few rows to join."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for first, last, steps in self.ended((row.at, row.counts) for row in rows):
            yield Row(key=key[0], first=first, last=last, steps=steps)


def session_stretches(events: DataFrame, ts: str, key: str, gap: int, delay: int, counts: Column | None = None) -> DataFrame:
    """Stretches of sessions ``(key, first, last, steps)`` in milliseconds; :func:`whole_sessions` puts them together.

    Rows for which ``counts`` is false only move the key's time on.
    """
    flag = F.lit(True) if counts is None else counts
    rows = events.select(F.col(key).cast("string").alias("key"), F.unix_millis(ts).alias("at"), flag.alias("counts"))
    schema = "key string, first long, last long, steps long"
    return rows.groupBy("key").transformWithState(GapSessionRows(gap, delay), schema, "Append", "None")


def whole_sessions(stretches: DataFrame, gap: int) -> DataFrame:
    """Sessions ``(key, first, last, steps)`` from stored stretches: those of late rows are joined to what they belong to."""
    order = Window.partitionBy("key").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("first") - reached < gap, 0).otherwise(1)
    numbered = stretches.withColumn("_fresh", fresh).withColumn("_no", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("key", "_no").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("steps").alias("steps")).drop("_no")
