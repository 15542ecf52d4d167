"""Streaming twins that put late rows in order: a row waits until the watermark has passed it.

Files may come in any order within the delay; what comes out is what the batch twin finds in all rows that the watermark has passed.
State ends by timers on the event time. Rows of 1970-01-01 00:00 and before are dropped, as Spark's watermark begins there. Sessions need the RocksDB state store, which ``state_store`` sets for as long as a stream runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_NEVER = -(1 << 62)


@contextmanager
def state_store(spark: SparkSession):
    """Streams that start inside keep their state in RocksDB; the session's own setting comes back after."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class _Ordered(StatefulProcessor):
    """Holds rows ``t, id`` back until the watermark has passed them, then hands them on in order with what is remembered (one number).

    Spark drops rows at or before the watermark of the last batch and fires timers after a batch's rows, so nothing that
    comes later belongs before the rows handed on.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t long, id long")
        self.memory = handle.getValueState("memory", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        least = None
        for part in rows:
            if len(part):
                self.waiting.appendList(list(zip(part["t"].tolist(), part["id"].tolist(), strict=True)))
                least = int(part["t"].min()) if least is None else min(least, int(part["t"].min()))
        if least is not None:
            self._wake(least)
        return iter([])

    def _wake(self, t: int) -> None:
        self.handle.registerTimer(-(-t // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = np.array(sorted(self.waiting.get()) if self.waiting.exists() else [], np.int64).reshape(-1, 2)
        ready = rows[: np.searchsorted(rows[:, 0], passed, side="right")]
        rest = rows[len(ready) :]
        memory = self.memory.get()[0] if self.memory.exists() else _NEVER
        made, memory, until = self.go_on(key[0], ready, memory)
        if len(ready):
            if len(rest):
                self.waiting.put([tuple(map(int, r)) for r in rest])
            else:
                self.waiting.clear()
        if until is None or until <= passed:
            self.memory.clear()
        else:
            self.memory.update((int(memory),))
            self._wake(until)
        if len(rest):
            self._wake(int(rest[0, 0]))
        if len(made):
            yield made

    def go_on(self, key, rows: np.ndarray, memory: int) -> tuple[pd.DataFrame, int, int | None]:
        """What comes of these rows, what to remember and until when (none: nothing)."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class _Triggers(_Ordered):
    def __init__(self, lockout: int):
        self.lockout = lockout

    def go_on(self, key, rows, memory):
        t, hit, i = rows[:, 0], [], int(np.searchsorted(rows[:, 0], memory))
        while i < len(t):  # from one trigger to the next
            hit.append(i)
            memory = int(t[i]) + self.lockout
            i = max(i + 1, int(np.searchsorted(t, memory)))
        return pd.DataFrame({"key": key, "t": t[hit], "id": rows[hit, 1]}), memory, None if memory == _NEVER else memory


class _Pairs(_Ordered):
    def __init__(self, longest: int):
        self.longest = longest

    def go_on(self, key, rows, memory):
        # an on of the rows before, if one is open, comes first; id is 1 for an on
        t, on = rows[:, 0], rows[:, 1] == 1
        if memory != _NEVER:
            t, on = np.append(memory, t), np.append(True, on)
        shut = np.flatnonzero(on[:-1] & ~on[1:] & (t[1:] - t[:-1] <= self.longest))
        made = pd.DataFrame({"key": key, "start": t[shut], "stop": t[shut + 1]})
        if not len(t) or not on[-1]:
            return made, _NEVER, None
        return made, int(t[-1]), int(t[-1]) + self.longest + 1


def _rows(stream: DataFrame, key: str, t: str, id_: Column, delay: str) -> DataFrame:
    """``t`` in microseconds is the event time; rows without a key or a time are left out."""
    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(t).cast("long").alias("t"), id_.cast("long").alias("id")).where("key is not null and t is not null")
    return rows.withColumn("ts", F.timestamp_micros("t")).withWatermark("ts", delay).groupBy("key")


def triggers(stream: DataFrame, key: str, t: str, id_: str, value: str, threshold: float, lockout: int, delay: str) -> DataFrame:
    """Events that reach the threshold, none within ``lockout`` (microseconds) of the last that counted, in the order of ``t`` and ``id``.

    Rows may be late by ``delay``; later ones are dropped. An event comes out once the watermark has passed it, as ``key, t, id``.
    A lockout of zero or less lets every event count. A key whose lockout is over and that has no waiting rows has no state.
    """
    over = stream.where(F.col(value) >= threshold)
    return _rows(over, key, t, F.col(id_), delay).transformWithStateInPandas(_Triggers(max(0, lockout)), "key string, t long, id long", "Append", "EventTime")


def on_off_pairs(stream: DataFrame, key: str, t: str, on: Column, longest: int, delay: str) -> DataFrame:
    """Intervals from the last on before an off to that off, of at most ``longest`` microseconds, as ``key, start, stop``.

    Rows may be late by ``delay``; later ones are dropped. Of an on and an off at one time the off comes first. A row whose ``on`` is null is
    an off. An on that stays open for more than ``longest`` is forgotten, which ends its key's state.
    """
    made = _rows(stream, key, t, F.coalesce(on, F.lit(False)).cast("int"), delay)
    return made.transformWithStateInPandas(_Pairs(longest), "key string, start long, stop long", "Append", "EventTime")
