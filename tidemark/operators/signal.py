"""Rates, gaps, filters and artifacts of time series in long form.

A series has key columns, a running ``idx`` and a time in microseconds; windows
are partitioned by the key. Filters with many taps work on blocks of samples
with a halo, so that one long series is many tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import blocks
from ..functions.blocks import BLOCK, block_width, blockwise, gap_islands, nearest_known, running_sum
from ..functions.columns import no_nan
from ..functions.ranks import medians
from .intervals import add_removal_window, consolidate, from_indices, subtract


def _w(key: list[str], order: str, a: int | None = None, b: int | None = None):
    w = Window.partitionBy(*key).orderBy(order)
    return w if a is None else w.rowsBetween(a, b)


def sampling_rate(df: DataFrame, key: list[str], t: str, multiplier: float = 1.75, width: int | None = None) -> DataFrame:
    """The rate in samples a second of each key, from the usual distance of its times.

    Differences are smoothed by a box of ten (rows -5 to 4, what is missing counts
    as zero), their logarithms binned in 100 bins from -5 to that of three times their
    mean; the left edge of the first fullest bin is the usual distance, and the
    mean of the differences below ``multiplier`` times it gives the rate. Keys with
    fewer than ten differences have none. A series is worked on in stretches of ``width``.
    """
    rows = df.where(F.col(t).isNotNull()).select(*key, F.col(t).alias("_t"))
    width = width or block_width(rows, "_t")
    d = nearest_known(rows, key, "_t", F.col("_t"), "_p", "_q", own=False, block=width).withColumn("_d", (F.col("_t") - F.col("_p")) / 1e6).where("_d is not null")
    # of equal times the first has the distance from the time before, the others none
    d = blocks.numbered(d.select(*key, "_t", "_d", (-F.col("_d")).alias("_later")), key, ["_t", "_later"], "_i", 1, width).select(*key, "_d", "_i")
    d = blockwise(d, key, "_i", 5, lambda x, k: x.withColumn("_s", F.sum("_d").over(_w(k, "_i", -5, 4)) / 10))
    ends = d.groupBy(*key).agg(F.log10(3 * F.avg("_s")).alias("_top"), F.count("*").alias("_n")).where("_n >= 10")
    step = (F.col("_top") + 5) / 100
    binned = d.where("_s > 0").join(ends, key).withColumn("_b", F.least(F.lit(99), F.floor((F.log10("_s") + 5) / step).cast("int"))).where((F.log10("_s") >= -5) & (F.log10("_s") <= F.col("_top")))
    full = binned.groupBy(*key, "_b", "_top").agg(F.count("*").alias("_k"))
    mode = full.groupBy(*key).agg(F.max_by(F.struct("_b", "_top"), F.struct(F.col("_k"), -F.col("_b"))).alias("_m"))
    usual = mode.select(*key, F.pow(F.lit(10.0), F.lit(-5) + F.col("_m._b") * (F.col("_m._top") + 5) / 100).alias("_usual"))
    near = d.join(usual, key).where(F.col("_d") < multiplier * F.col("_usual"))
    return near.groupBy(*key).agg(F.round(1 / F.avg("_d")).alias("rate"))


def valid_intervals(df: DataFrame, key: list[str], t: str, gap: Column | int, least: int = 0, slack: int = 0, width: int | None = None) -> DataFrame:
    """Stretches without a distance above ``gap``, widened by ``slack``, longer than ``least``; where the whole is shorter than that, longer than half the whole."""
    found = gap_islands(df, key, t, gap if isinstance(gap, Column) else F.lit(gap), width)
    found = found.select(*key, (F.col("start") - slack).alias("start"), (F.col("stop") + slack).alias("stop"))
    whole = df.groupBy(*key).agg((F.max(t) - F.min(t)).alias("_whole"))
    longer = F.when(F.col("_whole") < least, F.col("_whole") / 2).otherwise(F.lit(float(least)))
    return found.join(whole, key).where((F.col("stop") - F.col("start")) > longer).select(*key, "start", "stop")


def fir_small(df: DataFrame, key: list[str], order: str, value: str, taps: list[float], name: str = "filtered", block: int | None = None) -> DataFrame:
    """Zero-phase FIR filter by a weighted sum of neighbours; beyond the ends samples count as zero.

    With ``block``, for an order that numbers the rows without gaps, a series is worked on in blocks.
    """
    if block:
        return blockwise(df, key, order, len(taps), lambda d, k: fir_small(d, k, order, value, taps, name), block)
    delay = (len(taps) - 1) // 2
    w = _w(key, order)
    total = None
    for k, h in enumerate(taps):
        shift = k - delay
        x = F.lag(value, shift).over(w) if shift >= 0 else F.lead(value, -shift).over(w)
        part = F.coalesce(x, F.lit(0.0)) * F.lit(float(h))
        total = part if total is None else total + part
    return df.withColumn(name, total)


def fir_blocks(df: DataFrame, key: list[str], idx: str, value: str, taps: list[float], block: int = 65536, every: int = 1) -> DataFrame:
    """Zero-phase FIR filter for many taps, on blocks with a halo of a filter's length; keeps each ``every``-th sample.

    Returns ``key, idx, filtered``. Samples that are not there count as zero.
    """
    taps_ = np.asarray(taps, dtype=float)
    delay, reach = (len(taps_) - 1) // 2, len(taps_)
    block = max(block, reach)  # a halo reaches into the next block only
    here = F.floor(F.col(idx) / block)
    edges = F.array_distinct(F.array(here, F.floor((F.col(idx) - reach) / block), F.floor((F.col(idx) + reach) / block)))
    dealt = df.select(*key, F.col(idx).alias("_i"), F.col(value).cast("double").alias("_x"), F.explode(edges).alias("_block"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first = int(pdf["_block"].iloc[0]) * block
        x = np.zeros(block + 2 * reach)
        x[pdf["_i"].to_numpy() - first + reach] = pdf["_x"].fillna(0).to_numpy()
        size = 1 << int(len(x) + len(taps_)).bit_length()
        y = np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(taps_, size), size)[delay : delay + len(x)]
        own = pdf[(pdf["_i"] >= first) & (pdf["_i"] < first + block) & (pdf["_i"] % every == 0)]
        out = own[[*key, "_i"]].copy()
        out["filtered"] = y[own["_i"].to_numpy() - first + reach]
        return out

    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema}
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in key] + ["_i long", "filtered double"])
    return dealt.groupBy(*key, "_block").applyInPandas(run, schema).withColumnRenamed("_i", idx)


def decimate(df: DataFrame, key: list[str], order: str, every: int, numbered: bool = False) -> DataFrame:
    """Every ``every``-th row of a key, from the first; if the order numbers the rows from 0 without gaps, by that number alone."""
    if numbered:
        return df.where(F.col(order) % every == 0)
    return blocks.numbered(df, key, [order], "_n").where(F.col("_n") % every == 0).drop("_n")


def re_reference(df: DataFrame, at: list[str], channel: str, value: str, references: DataFrame) -> DataFrame:
    """Subtracts each channel's reference channel at the same place; ``references(channel, reference)`` with null for none."""
    base = df.select(*at, F.col(channel).alias("reference"), F.col(value).alias("_ref"))
    return df.join(references, channel).join(base, [*at, "reference"], "left").withColumn(value, F.col(value) - F.coalesce("_ref", F.lit(0.0))).drop("_ref")


def common_reference(df: DataFrame, at: list[str], value: str) -> DataFrame:
    """Subtracts the median over the channels at each place."""
    return df.withColumn(value, F.col(value) - F.percentile(value, 0.5).over(Window.partitionBy(*at)))


def gaussian(df: DataFrame, key: list[str], order: str, value: str, sigma: float, truncate: float = 4.0, name: str = "smooth", block: int | None = None) -> DataFrame:
    """Gaussian smoothing with ``sigma`` in rows; the weights are those of the rows that are there.

    With ``block``, for an order that numbers the rows without gaps, a series is worked on in blocks.
    """
    reach = int(truncate * sigma + 0.5)
    if block:
        return blockwise(df, key, order, reach, lambda d, k: gaussian(d, k, order, value, sigma, truncate, name), block)
    weights = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)]
    w = _w(key, order)
    top, low = None, None
    for k, h in zip(range(-reach, reach + 1), weights, strict=True):
        x = F.lag(value, -k).over(w) if k <= 0 else F.lead(value, k).over(w)
        part, there = F.coalesce(x, F.lit(0.0)) * h, F.when(x.isNotNull(), h).otherwise(0.0)
        top, low = (part, there) if top is None else (top + part, low + there)
    return df.withColumn(name, top / low)


def moving_mean(df: DataFrame, key: list[str], order: str, value: str, width: int, name: str = "mean", block: int | None = None) -> DataFrame:
    """Mean of this and the ``width - 1`` rows before it; NaN and null are left out. With ``block`` as in ``gaussian``."""
    if block:
        return blockwise(df, key, order, width, lambda d, k: moving_mean(d, k, order, value, width, name), block)
    return df.withColumn(name, F.avg(no_nan(F.col(value))).over(_w(key, order, 1 - width, 0)))


def interpolate(df: DataFrame, key: list[str], x: str, value: str, name: str = "filled", ends: bool = False, idx: str | None = None, block: int = BLOCK, last: str | None = None) -> DataFrame:
    """Fills NaN and null linearly along ``x``; beyond the ends only if ``ends``, with the nearest value.

    If ``idx`` has the order of ``x``, a series is worked on in blocks of it. ``last`` adds the last value up to each row.
    """
    v = no_nan(F.col(value).cast("double"))
    known = F.when(v.isNotNull(), F.struct(F.col(x).alias("x"), v.alias("v")))
    if idx:
        rows = nearest_known(df, key, idx, known, "_a", "_b", block=block)
    else:
        rows = blocks.around(df.withColumn("_known", known), key, [x], "_known", "_a", "_b").drop("_known")
    share = (F.col(x) - F.col("_a.x")) / (F.col("_b.x") - F.col("_a.x"))
    line = F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * share
    edge = F.coalesce("_a.v", "_b.v") if ends else F.lit(None).cast("double")
    if last:
        rows = rows.withColumn(last, F.col("_a.v"))
    return rows.withColumn(name, F.when(v.isNotNull(), v).when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), line).otherwise(edge)).drop("_a", "_b")


def resample(df: DataFrame, grid: DataFrame, key: list[str], t: str, value: str, by: str = "time", width: int | None = None) -> DataFrame:
    """Values at the times of ``grid``, linear between neighbours by time or by row; after the last value it stays, before the first there is none. A series is worked on in stretches of ``width``."""
    both = df.select(*key, t, F.col(value).cast("double").alias("_v"), F.lit(False).alias("_g")).unionByName(grid.select(*key, t, F.lit(None).cast("double").alias("_v"), F.lit(True).alias("_g")))
    rows = both.groupBy(*key, t).agg(F.max("_v").alias("_v"), F.max("_g").alias("_g"))
    width, x = width or block_width(both, t), t
    if by == "row":
        rows, x = blocks.numbered(rows, key, [t], "_r", 1, width), "_r"
    filled = interpolate(rows, key, x, "_v", "_f", idx=x, block=BLOCK if by == "row" else width, last="_last")
    return filled.where("_g").select(*key, t, F.coalesce("_f", "_last").alias(value))


def time_grid(iv: DataFrame, key: list[str], step: int) -> DataFrame:
    """Evenly spread times over the hull of a list: so many steps as fit, rounded up, and both ends."""
    ends = iv.groupBy(*key).agg(F.min("start").alias("_a"), F.max("stop").alias("_b"))
    n = F.greatest(F.lit(1), F.ceil((F.col("_b") - F.col("_a")) / step))
    rows = ends.select(*key, "_a", "_b", n.alias("_n"), F.explode(F.sequence(F.lit(0).cast("long"), n)).alias("i"))
    return rows.select(*key, "i", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("i") / F.col("_n")).alias("t"))


def align_to_clock(df: DataFrame, clock: DataFrame, key: list[str], t: str, value: str, width: int | None = None) -> DataFrame:
    """Puts each value at the last clock time not after it; the latest wins, clock times without a value have none. A series is worked on in stretches of ``width``."""
    both = df.select(*key, F.col(t).alias("_t"), F.col(value).alias("_v"), F.lit(1).alias("_k")).unionByName(clock.select(*key, F.col(t).alias("_t"), F.lit(None).cast("double").alias("_v"), F.lit(0).alias("_k")))
    tick = F.when(F.col("_k") == 0, F.col("_t"))
    placed = nearest_known(both, key, "_t", tick, t, "_q", block=width or block_width(both, "_t"), then=("_k",))
    placed = placed.where(f"_k = 1 and {t} is not null").groupBy(*key, t).agg(F.max_by("_v", "_t").alias(value))
    return clock.select(*key, t).distinct().join(placed, [*key, t], "left")


def unwrap(df: DataFrame, key: list[str], order: str, angle: str, name: str = "unwrapped", block: int | None = None) -> DataFrame:
    """Adds turns so that neighbours differ by half a turn at most; NaN and null are skipped. With ``block``, for an order without gaps, by blocks."""
    a = no_nan(F.col(angle))
    turns = F.coalesce(F.round((a - F.col("_p")) / (2 * math.pi)), F.lit(0.0))
    if block:
        rows = nearest_known(df, key, order, a, "_p", "_q", own=False, block=block).drop("_q")
        rows = running_sum(rows, key, order, turns, "_j", block)
    else:
        rows = df.withColumn("_p", F.last(a, ignorenulls=True).over(_w(key, order, Window.unboundedPreceding, -1))).withColumn("_t", turns)
        rows = rows.withColumn("_j", F.sum("_t").over(_w(key, order, Window.unboundedPreceding, 0))).drop("_t")
    return rows.withColumn(name, F.col(angle) - 2 * math.pi * F.col("_j")).drop("_p", "_j")


def zscore(df: DataFrame, key: list[str], value: str, name: str = "z") -> DataFrame:
    """Distance from the key's mean in population standard deviations; the statistics are joined, not windowed."""
    stats = df.groupBy(*key).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    return df.join(stats, key).withColumn(name, (F.col(value) - F.col("_m")) / F.col("_s")).drop("_m", "_s")


def mad_outliers(df: DataFrame, key: list[str], value: str, threshold: float, name: str = "outlier") -> DataFrame:
    """Whether a value is further from the median than ``threshold`` scaled median deviations (1 where that is zero)."""
    rows = df.join(medians(df, key, value, "_med"), key).withColumn("_dev", F.abs(F.col(value) - F.col("_med")))
    mad = medians(rows, key, "_dev", "_mad").withColumn("_mad", F.col("_mad") * 1.4826)
    scale = F.when(F.col("_mad") > 0, F.col("_mad")).otherwise(1.0)
    return rows.join(mad, key).withColumn(name, F.col("_dev") / scale > threshold).drop("_med", "_dev", "_mad")


def difference_artifacts(df: DataFrame, key: list[str], channel: str, idx: str, value: str, first: float, second: float, share: float = 1.0, box: int = 15, reach: int = 3, block: int | None = None) -> DataFrame:
    """Sample numbers (without gaps) where enough channels jump: the sum of successive differences over ``box`` samples is above ``first``, and so is the local range above ``second``."""
    half = box // 2

    def measured(d: DataFrame, own: list[str]) -> DataFrame:
        d = d.withColumn("_d", F.coalesce(F.col(value) - F.lag(value).over(_w(own, idx)), F.lit(0.0)))
        d = d.withColumn("_s", F.abs(F.sum("_d").over(_w(own, idx, -half, half))))
        near = _w(own, idx, -reach, reach - 1)
        return d.withColumn("_r", F.max(value).over(near) - F.min(value).over(near))

    own = [*key, channel]
    rows = blockwise(df, own, idx, half + reach + 1, measured, block) if block else measured(df, own)
    n = rows.groupBy(*key, idx).agg(F.count("*").alias("_n"), F.count(F.when((F.col("_s") > first) & (F.col("_r") > second), 1)).alias("_k"))
    return n.where(F.col("_k") >= F.ceil(F.col("_n") * share)).where(F.col(idx) > reach).select(*key, idx)


def amplitude_artifacts(df: DataFrame, samples: DataFrame, sort_interval: DataFrame, key: list[str], channel: str, idx: str, t: str, value: str, threshold: float | None, window: int, share: float = 1.0, z: float | None = None, least: int = 1_000_000) -> DataFrame:
    """The sort interval without the widened stretches where ``share`` of the channels is beyond ``threshold``, or beyond ``z`` deviations of the channels' mean at that sample.

    Pieces of ``least`` or less go. A key without such stretches keeps the whole of its samples.
    """
    at = Window.partitionBy(*key, idx)
    beyond = F.abs(F.col(value)) > threshold if threshold is not None else F.lit(False)
    if z is not None:
        beyond = beyond | (F.abs(F.col(value) - F.avg(value).over(at)) > z * F.stddev_pop(value).over(at))
    flagged = df.select(*key, channel, idx, F.coalesce(beyond, F.lit(False)).alias("_hit"))
    hit = flagged.groupBy(*key, idx).agg(F.count("*").alias("_n"), F.count(F.when(F.col("_hit"), 1)).alias("_k")).where(F.col("_k") >= F.ceil(F.col("_n") * share))
    ranges = from_indices(hit, key, idx)
    left = consolidate(subtract(sort_interval, add_removal_window(ranges, samples, key, idx, t, window), key, least), key)
    whole = samples.groupBy(*key).agg(F.min(t).alias("start"), F.max(t).alias("stop"))
    clean = whole.join(hit.select(*key).distinct(), key, "left_anti")
    return left.join(clean.select(*key), key, "left_anti").unionByName(clean.select(*key, "start", "stop"))


def zero_out(df: DataFrame, inside: DataFrame, key: list[str], idx: str, value: str) -> DataFrame:
    """Sets samples of the listed places to zero."""
    mark = inside.select(*key, idx).distinct().withColumn("_z", F.lit(True))
    return df.join(mark, [*key, idx], "left").withColumn(value, F.when(F.col("_z"), F.lit(0.0)).otherwise(F.col(value))).drop("_z")


def growth_slope(df: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
    """Median and upper-quartile slope over all pairs of points of a key (the caller bounds the points, such as daily totals)."""
    a = df.select(*key, F.col(x).alias("_x"), F.col(y).alias("_y"))
    b = df.select(*key, F.col(x).alias("_x2"), F.col(y).alias("_y2"))
    pairs = a.join(b, key).where("_x < _x2").withColumn("_s", (F.col("_y2") - F.col("_y")) / (F.col("_x2") - F.col("_x")))
    return pairs.groupBy(*key).agg(F.percentile("_s", 0.5).alias("median_slope"), F.percentile("_s", 0.75).alias("upper_slope"))


def hilbert(df: DataFrame, key: list[str], idx: str, value: str) -> DataFrame:
    """The analytic signal of each channel, as ``re, im``; a channel is one group, so it must fit in a task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(idx)
        n = len(pdf)
        gain = np.zeros(n)
        gain[0] = 1
        gain[1 : (n + 1) // 2] = 2
        if n % 2 == 0:
            gain[n // 2] = 1
        z = np.fft.ifft(np.fft.fft(pdf[value].to_numpy()) * gain)
        return pdf[[*key, idx]].assign(re=z.real, im=z.imag)

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.select(*key, idx, value).groupBy(*key).applyInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in [*key, idx]) + ", re double, im double")


def hilbert_taps(reach: int) -> list[float]:
    """Taps of a Hilbert filter with a raised-cosine window."""
    return [0.0 if k % 2 == 0 else 2 / (math.pi * k) * (0.54 + 0.46 * math.cos(math.pi * k / (reach + 1))) for k in range(-reach, reach + 1)]


def band_taps(low: float, high: float, rate: float, reach: int) -> list[float]:
    """Taps of a windowed-sinc band pass between two frequencies."""
    sinc = lambda f, k: 2 * f / rate if k == 0 else math.sin(2 * math.pi * f / rate * k) / (math.pi * k)
    return [(sinc(high, k) - sinc(low, k)) * (0.54 + 0.46 * math.cos(math.pi * k / (reach + 1))) for k in range(-reach, reach + 1)]


def analytic(df: DataFrame, key: list[str], idx: str, value: str, reach: int = 32, block: int = 65536) -> DataFrame:
    """The analytic signal as ``re, im`` by a Hilbert filter on blocks, so that one long channel is many tasks.

    Between the filter's band edges (a hundredth and forty-nine hundredths of the rate at
    the reach of 32) it agrees with the transform of the whole channel.
    """
    im = fir_blocks(df, key, idx, value, hilbert_taps(reach), block).withColumnRenamed("filtered", "im")
    return df.select(*key, idx, F.col(value).cast("double").alias("re")).join(im, [*key, idx])


def phase_and_power(df: DataFrame) -> DataFrame:
    """Phase in [0, 2 pi] and squared modulus of ``re, im``."""
    return df.withColumn("phase", F.atan2("im", "re") + math.pi).withColumn("power", F.col("re") * F.col("re") + F.col("im") * F.col("im"))
