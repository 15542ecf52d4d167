"""Streaming twins of batch operators; each must give its batch twin's rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def valid_stretches(stream: DataFrame, key: str, ts: str, gap: str, delay: str) -> DataFrame:
    """Stretches of events of a key without a distance of ``gap`` or more, closed by the watermark."""
    windows = stream.withWatermark(ts, delay).groupBy(F.col(key), F.session_window(ts, gap)).agg(F.count("*").alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    return windows.select(key, "first", "last", "n")


def tumbling_counts(stream: DataFrame, key: str, ts: str, width: str, delay: str) -> DataFrame:
    """Events of a key in windows of ``width``; rows later than the watermark are dropped."""
    windows = stream.withWatermark(ts, delay).groupBy(F.col(key), F.window(ts, width)).agg(F.count("*").alias("n"))
    return windows.select(key, F.col("window.start").alias("start"), "n")


def speed_gate(stream: DataFrame, speed: str, limit: float) -> DataFrame:
    """Rows at or below a speed; stateless."""
    return stream.where(F.col(speed) <= limit)


def _locked(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    (until,) = state.get if state.exists else (-(1 << 62),)
    frames = [b for b in batches if len(b)]
    rows = pd.concat(frames).sort_values(["t", "id"]) if frames else pd.DataFrame({"t": [], "id": [], "lockout": []})
    out = []
    for t, id_, lockout in zip(rows["t"], rows["id"], rows["lockout"], strict=True):
        if t >= until:
            out.append((key[0], int(t), int(id_)))
            until = int(t) + int(lockout)
    state.update((int(until),))
    yield pd.DataFrame(out, columns=["key", "t", "id"])


def triggers(stream: DataFrame, key: str, t: str, id_: str, value: str, threshold: float, lockout: int) -> DataFrame:
    """Events that reach the threshold, none within ``lockout`` of the last that counted; times must not run back between batches."""
    over = stream.where(F.col(value) >= threshold).select(F.col(key).cast("string").alias("key"), F.col(t).cast("long").alias("t"), F.col(id_).cast("long").alias("id"), F.lit(lockout).cast("long").alias("lockout"))
    return over.groupBy("key").applyInPandasWithState(_locked, "key string, t long, id long", "until long", "append", GroupStateTimeout.NoTimeout)


def _paired(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    (opened,) = state.get if state.exists else (None,)
    frames = [b for b in batches if len(b)]
    rows = pd.concat(frames).sort_values("t") if frames else pd.DataFrame({"t": [], "on": []})
    out = []
    for t, on in zip(rows["t"], rows["on"], strict=True):
        if on:
            opened = int(t)
        elif opened is not None:
            out.append((key[0], opened, int(t)))
            opened = None
    state.update((opened,))
    yield pd.DataFrame(out, columns=["key", "start", "stop"])


def on_off_pairs(stream: DataFrame, key: str, t: str, on) -> DataFrame:
    """Intervals from the last on before an off to that off; the state holds the open on of each key."""
    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(t).cast("long").alias("t"), on.alias("on"))
    return rows.groupBy("key").applyInPandasWithState(_paired, "key string, start long, stop long", "opened long", "append", GroupStateTimeout.NoTimeout)
