"""Events in time series: threshold crossings and peaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import blockwise, numbered
from ..functions.islands import mask_runs
from ..functions.rangejoin import points_in
from .intervals import DAY, merge_touching
from .signal import gaussian, resample, zscore


def threshold_events(df: DataFrame, key: list[str], idx: str, t: str, value: str, low: float, high: float, least: int = 1, block: int | None = None) -> DataFrame:
    """Stretches of at least ``least`` samples at or above ``low`` that reach ``high``; with ``block`` as in ``peaks``."""
    runs = mask_runs(df, key, idx, F.col(value) >= low, block)
    found = runs.groupBy(*key, "run").agg(F.min(t).alias("start"), F.max(t).alias("stop"), F.count("*").alias("samples"), F.max(value).alias("peak"))
    return found.where((F.col("peak") >= high) & (F.col("samples") >= least)).drop("run")


def peaks(df: DataFrame, key: list[str], idx: str, value: str, threshold: float, reach: int, block: int | None = None) -> DataFrame:
    """Samples at or above ``threshold`` that none within ``reach`` exceeds; with ``block``, for samples numbered without gaps, a series is worked on in blocks."""

    def marked(d: DataFrame, own: list[str]) -> DataFrame:
        return d.withColumn("_m", F.max(value).over(Window.partitionBy(*own).orderBy(idx).rowsBetween(-reach, reach)))

    rows = blockwise(df, key, idx, reach, marked, block) if block else marked(df, key)
    return rows.where((F.col(value) >= threshold) & (F.col(value) == F.col("_m"))).drop("_m")


def consensus_trace(envelopes: DataFrame, key: list[str], channel: str, idx: str, value: str, sigma: float, block: int | None = None) -> DataFrame:
    """Root of the smoothed sum of squares over the channels; samples where a channel is missing are left out. With ``block`` a series is numbered anew and worked on in blocks."""
    n = envelopes.select(*key, channel).distinct().groupBy(*key).agg(F.count("*").alias("_n"))
    power = envelopes.where(F.col(value).isNotNull()).groupBy(*key, idx).agg(F.sum(F.col(value) * F.col(value)).alias("_p"), F.count("*").alias("_k")).join(n, key).where("_k = _n")
    if block:
        power = numbered(power, key, [idx], "_row")
    return gaussian(power, key, "_row" if block else idx, "_p", sigma, name="_s", block=block).select(*key, idx, F.sqrt("_s").alias("trace"))


def above_mean(df: DataFrame, key: list[str], idx: str, t: str, z: str, threshold: float, least: int = 0, block: int | None = None) -> DataFrame:
    """Stretches at or above zero that hold one at or above ``threshold`` of at least ``least`` from first to last time.

    Returns ``start, stop, samples, peak``. With ``block`` a series is numbered anew and worked on in blocks.
    """
    if block:
        df, idx = numbered(df, key, [idx], "_row"), "_row"
    runs = mask_runs(df, key, idx, F.col(z) >= 0, block).withColumnRenamed("run", "_m")
    high = mask_runs(runs, [*key, "_m"], idx, F.col(z) >= threshold, block).groupBy(*key, "_m", "run").agg((F.max(t) - F.min(t)).alias("_long"))
    found = runs.join(high.where(F.col("_long") >= least).select(*key, "_m").distinct(), [*key, "_m"], "left_semi")
    return found.groupBy(*key, "_m").agg(F.min(t).alias("start"), F.max(t).alias("stop"), F.count("*").alias("samples"), F.max(z).alias("peak")).drop("_m")


def at_rest(events: DataFrame, position: DataFrame, key: list[str], t: str, speed: str, most: float) -> DataFrame:
    """Events at whose first and last time the speed is ``most`` at most; times without a speed drop the event."""
    slow = position.where(F.col(speed) <= most).select(*key, F.col(t).alias("_t")).distinct()
    for end in ("start", "stop"):
        events = events.join(slow.withColumnRenamed("_t", end), [*key, end], "left_semi")
    return events


def apart(events: DataFrame, key: list[str], gap: int) -> DataFrame:
    """Drops events that start less than ``gap`` after the end of the last one that stays; the first of a key stays.

    Which stay depends on the one before, so the events of a key (not its samples) are one group.
    """
    if gap <= 0:
        return events
    names = events.columns

    def keep(pdf):
        pdf, end, kept = pdf.sort_values("start"), None, []
        for start, stop in zip(pdf["start"], pdf["stop"], strict=True):
            kept.append(end is None or start >= end + gap)
            end = stop if kept[-1] else end
        return pdf[kept][names]

    return events.groupBy(*key).applyInPandas(keep, events.schema)


def ripple_inputs(lfp: DataFrame, position: DataFrame, intervals: DataFrame, key: list[str], t: str, speed: str) -> tuple[DataFrame, DataFrame]:
    """Band-passed samples and speeds within the intervals, the speed interpolated to the samples' times."""
    inside = points_in(lfp, intervals, key, t, DAY, how="left_semi")
    near = points_in(position, intervals, key, t, DAY, how="left_semi")
    return inside, resample(near, inside.select(*key, t).distinct(), key, t, speed)


def consensus_events(envelopes: DataFrame, position: DataFrame, key: list[str], channel: str, idx: str, t: str, value: str, speed: str, sigma: float, threshold: float = 2.0, least: int = 0, most_speed: float = 4.0, gap: int = 0, block: int | None = None) -> DataFrame:
    """Ripples of the consensus trace: z-scored, extended to the mean, at rest, apart from each other."""
    clock = envelopes.select(*key, idx, t).distinct()
    trace = zscore(consensus_trace(envelopes, key, channel, idx, value, sigma, block).join(clock, [*key, idx]), key, "trace")
    return apart(at_rest(above_mean(trace, key, idx, t, "z", threshold, least, block), position, key, t, speed, most_speed), key, gap)


def channel_events(envelopes: DataFrame, position: DataFrame, key: list[str], channel: str, idx: str, t: str, value: str, speed: str, sigma: float, threshold: float = 3.0, least: int = 0, most_speed: float = 4.0, gap: int = 0, block: int | None = None) -> DataFrame:
    """Ripples of any channel: each one's smoothed envelope z-scored and extended to its mean; overlapping ones of several channels are one."""
    own = [*key, channel]
    rows = numbered(envelopes, own, [idx], "_at") if block else envelopes
    z = zscore(gaussian(rows, own, "_at" if block else idx, value, sigma, block=block), own, "smooth")
    return apart(at_rest(merge_touching(above_mean(z, own, idx, t, "z", threshold, least, block), key), position, key, t, speed, most_speed), key, gap)


def high_synchrony(rate: DataFrame, key: list[str], idx: str, t: str, value: str, threshold: float = 2.0, least: int = 0, sigma: float | None = None, position: DataFrame | None = None, speed: str = "speed", most_speed: float = 4.0, gap: int = 0, block: int | None = None) -> DataFrame:
    """Stretches where the smoothed and z-scored population rate is above its mean and stays at ``threshold`` for ``least``, at rest if there is a ``position``."""
    if block:
        rate, idx = numbered(rate, key, [idx], "_at"), "_at"
    smooth = gaussian(rate, key, idx, value, sigma, block=block) if sigma else rate.withColumn("smooth", F.col(value))
    found = above_mean(zscore(smooth, key, "smooth"), key, idx, t, "z", threshold, least, block)
    if position is not None:
        found = at_rest(found, position, key, t, speed, most_speed)
    return apart(found, key, gap)
