"""Interval algebra.

Interval tables hold the key columns and ``start, stop`` as BIGINT; every
operator works within a key and returns such a table unless it says otherwise.
Ends belong to an interval. Rows with a null start or stop are not intervals
and are dropped by ``normalise``, which the set operations apply first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import block_width, blockwise, gap_islands, running_sum
from ..functions.islands import mask_runs, merge_runs, number_islands
from ..functions.rangejoin import overlaps, points_by_length, points_in
from ..functions.store import materialise

DAY = 86_400_000_000


def violations(iv: DataFrame) -> DataFrame:
    """Rows that are no interval: a missing end, or a stop before the start."""
    return iv.where(F.col("start").isNull() | F.col("stop").isNull() | (F.col("start") > F.col("stop")))


def normalise(iv: DataFrame, key: list[str]) -> DataFrame:
    """Valid intervals, each once."""
    return iv.where("start <= stop").select(*key, "start", "stop").distinct()


def from_indices(df: DataFrame, key: list[str], idx: str, width: int | None = None) -> DataFrame:
    """Maximal runs of consecutive integers, as first and last."""
    return gap_islands(df.select(*key, F.col(idx).alias("_i")), key, "_i", F.lit(1), width)


def by_length(iv: DataFrame, least: float = 0, most: float = 1e16) -> DataFrame:
    """Intervals longer than ``least`` and shorter than ``most``, both strictly."""
    length = F.col("stop") - F.col("start")
    return iv.where((length > least) & (length < most))


def contains(points: DataFrame, iv: DataFrame, key: list[str], t: str, width: int = DAY) -> DataFrame:
    """Points in intervals, once for each interval that holds them, with its bounds."""
    return points_in(points, iv, key, t, width)


def excludes(points: DataFrame, iv: DataFrame, key: list[str], t: str, width: int = DAY) -> DataFrame:
    """Distinct points in no interval."""
    return points_in(points, iv, key, t, width, how="left_anti").select(*key, t).distinct()


def consolidate(iv: DataFrame, key: list[str]) -> DataFrame:
    """Merges intervals that overlap by more than a point; touching ones stay apart."""
    return merge_runs(normalise(iv, key), key, lambda start, far: start >= far)


def merge_touching(iv: DataFrame, key: list[str]) -> DataFrame:
    """Merges intervals that overlap or touch."""
    return merge_runs(normalise(iv, key), key, lambda start, far: start > far)


def union(a: DataFrame, b: DataFrame, key: list[str], least: float = -1, most: float = 1e16) -> DataFrame:
    """All that either list covers; touching intervals merge, then the lengths are applied."""
    both = a.select(*key, "start", "stop").unionByName(b.select(*key, "start", "stop"))
    return by_length(merge_touching(both, key), least, most)


def intersect(a: DataFrame, b: DataFrame, key: list[str], least: float = 0, width: int = 30 * DAY) -> DataFrame:
    """What both lists cover, in pieces longer than ``least``."""
    met = overlaps(consolidate(a, key), consolidate(b, key), key, width)
    pieces = met.select(*key, F.greatest("start", "start2").alias("start"), F.least("stop", "stop2").alias("stop"))
    return by_length(pieces.where("stop > start"), least)


def subtract(a: DataFrame, b: DataFrame, key: list[str], least: float = 0, width: int = 30 * DAY) -> DataFrame:
    """What ``a`` covers and ``b`` does not, in pieces longer than ``least``."""
    a = consolidate(a, key)
    holes = merge_touching(b, key)
    hull = a.groupBy(*key).agg(F.min("start").alias("lo"), F.max("stop").alias("hi"))
    order = Window.partitionBy(*key).orderBy("start")
    free = holes.withColumn("_next", F.lead("start").over(order)).withColumn("_first", F.row_number().over(order) == 1).join(hull, key)
    gaps = free.select(*key, F.inline(F.array(F.struct(F.when(F.col("_first"), F.col("lo")).alias("start"), F.col("start").alias("stop")), F.struct(F.col("stop").alias("start"), F.coalesce("_next", "hi").alias("stop")))))
    gaps = gaps.where("start is not null").join(hull, key).select(*key, F.greatest("start", "lo").alias("start"), F.least("stop", "hi").alias("stop")).where("start < stop")
    met = overlaps(a, gaps, key, width).select(*key, F.greatest("start", "start2").alias("start"), F.least("stop", "stop2").alias("stop"))
    untouched = a.join(holes.select(*key).distinct(), key, "left_anti")
    return by_length(met.unionByName(untouched), least)


def censor(iv: DataFrame, points: DataFrame, key: list[str], t: str) -> DataFrame:
    """Clips intervals to the first and last point of their key; what is left without length goes."""
    ends = points.groupBy(*key).agg(F.min(t).alias("lo"), F.max(t).alias("hi"))
    return iv.join(ends, key).select(*key, F.greatest("start", "lo").alias("start"), F.least("stop", "hi").alias("stop")).where("stop > start")


def union_adjacent_index(iv: DataFrame, key: list[str]) -> DataFrame:
    """Merges exact neighbours [a, b], [b + 1, c] only."""
    w = Window.partitionBy(*key).orderBy("start", "stop")
    marked = normalise(iv, key).withColumn("_p", F.lag("stop").over(w))
    marked = number_islands(marked, key, F.col("_p").isNull() | (F.col("start") != F.col("_p") + 1), ["start", "stop"], "_g")
    return marked.groupBy(*key, "_g").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_g")


def to_times(ranges: DataFrame, samples: DataFrame, key: list[str], idx: str, t: str) -> DataFrame:
    """Index intervals as times; an end without sample drops the interval."""
    at = lambda name: samples.select(*key, F.col(idx).alias(name), F.col(t).alias(f"{name}_t"))
    return ranges.join(at("start"), [*key, "start"]).join(at("stop"), [*key, "stop"]).select(*key, F.col("start_t").alias("start"), F.col("stop_t").alias("stop"))


def add_removal_window(ranges: DataFrame, samples: DataFrame, key: list[str], idx: str, t: str, window: int) -> DataFrame:
    """Index intervals as times, widened by half of ``window`` either way, not beyond the last sample, consolidated."""
    last = samples.groupBy(*key).agg(F.max(t).alias("_hi"))
    wide = to_times(ranges, samples, key, idx, t).join(last, key)
    half = window // 2
    return consolidate(wide.select(*key, (F.col("start") - half).alias("start"), F.least(F.col("stop") + half, F.col("_hi")).alias("stop")), key)


def to_indices(bounds: DataFrame, samples: DataFrame, key: list[str], t: str, side: str = "left", width: int | None = None) -> DataFrame:
    """For each row ``key, x`` of ``bounds`` how many samples are before it (``left``) or not after it (``right``), as ``position``; counted in stretches of ``width``."""
    first = 0 if side == "left" else 2
    both = bounds.select(*key, F.col("x").alias("_x"), F.lit(first).alias("_k")).unionByName(samples.select(*key, F.col(t).alias("_x"), F.lit(1).alias("_k")))
    placed = running_sum(both, key, "_x", F.when(F.col("_k") == 1, 1).otherwise(0), "position", width or block_width(both, "_x"), ("_k",))
    return placed.where(F.col("_k") != 1).select(*key, F.col("_x").alias("x"), "position")


def sample_ranges(iv: DataFrame, samples: DataFrame, key: list[str], t: str) -> DataFrame:
    """Intervals as first and last sample number, merged when the next starts right after the last."""
    first = to_indices(iv.select(*key, F.col("start").alias("x")).distinct(), samples, key, t, "left").select(*key, F.col("x").alias("start"), F.col("position").alias("_i"))
    last = to_indices(iv.select(*key, F.col("stop").alias("x")).distinct(), samples, key, t, "right").select(*key, F.col("x").alias("stop"), (F.col("position") - 1).alias("_j"))
    ranges = iv.join(first, [*key, "start"]).join(last, [*key, "stop"]).select(*key, F.col("_i").alias("start"), F.col("_j").alias("stop")).where("start <= stop")
    return merge_runs(ranges.distinct(), key, lambda start, far: start > far + 1)


def runs_of(df: DataFrame, key: list[str], t: str, flag: Column, idx: str | None = None, block: int | None = None) -> DataFrame:
    """Stretches of rows where ``flag`` holds, as first and last time; in blocks if ``idx`` numbers the rows without gaps."""
    return mask_runs(df, key, idx or t, flag, block if idx else None).groupBy(*key, "run").agg(F.min(t).alias("start"), F.max(t).alias("stop")).drop("run")


def dilate(df: DataFrame, key: list[str], order: str, flag: str, reach: int, block: int | None = None) -> DataFrame:
    """Extends true stretches of ``flag`` by ``reach`` rows either way; with ``block``, for an order without gaps, by blocks."""
    if block:
        return blockwise(df, key, order, reach, lambda d, k: dilate(d, k, order, flag, reach), block)
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(-reach, reach)
    return df.withColumn(flag, F.max(F.col(flag).cast("int")).over(w) == 1)


def interval_labels(df: DataFrame, key: list[str], order: str, missing: Column, block: int | None = None) -> DataFrame:
    """Adds ``label``, the number of the stretch of rows that are not missing, -1 for missing rows; with ``block``, for an order without gaps, by blocks."""

    def begun(d: DataFrame, own: list[str]) -> DataFrame:
        return d.withColumn("_new", F.col("_there") & ~F.coalesce(F.lag("_there").over(Window.partitionBy(*own).orderBy(order)), F.lit(False)))

    rows = df.withColumn("_there", ~missing)
    if block:
        rows = running_sum(blockwise(rows, key, order, 1, begun, block), key, order, F.coalesce(F.col("_new").cast("int"), F.lit(0)), "_n", block)
    else:
        rows = number_islands(begun(rows, key), key, F.col("_new"), [order], "_n")
    return rows.withColumn("label", F.when(F.col("_there"), F.col("_n") - 1).otherwise(-1)).drop("_there", "_new", "_n")


def label_by_interval(points: DataFrame, iv: DataFrame, key: list[str], t: str, width: int = DAY) -> DataFrame:
    """Points in intervals with ``label``, the number of the interval among those that hold points."""
    met = points_in(points, iv, key, t, width)
    return met.withColumn("label", F.dense_rank().over(Window.partitionBy(*key).orderBy("start", "stop")) - 1)


def hull(iv: DataFrame, key: list[str]) -> DataFrame:
    """From the first start to the last stop."""
    return iv.groupBy(*key).agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


def intersect_all(lists: list[DataFrame], key: list[str]) -> DataFrame:
    """What all lists cover."""
    return reduce(lambda a, b: intersect(a, b, key), lists)


def containing_match(outer: DataFrame, inner: DataFrame, key: list[str], slack: int) -> DataFrame:
    """For each outer interval the only inner one within its bounds widened by ``slack``; null where there is none or several."""
    bounds = [*key, "outer_start", "outer_stop"]
    o = materialise(outer.select(*key, F.col("start").alias("outer_start"), F.col("stop").alias("outer_stop")).distinct(), "outer")
    wide = o.withColumn("start", F.col("outer_start") - slack).withColumn("stop", F.col("outer_stop") + slack)
    met = points_by_length(inner.select(*key, F.col("start").alias("_s"), F.col("stop").alias("_e")).distinct(), wide, key, "_s")
    in_it = F.col("_s").isNotNull() & (F.col("_e") <= F.col("stop"))
    found = met.groupBy(*bounds).agg(F.count(F.when(in_it, 1)).alias("matches"), F.min(F.when(in_it, F.col("_s"))).alias("_s"), F.min(F.when(in_it, F.col("_e"))).alias("_e"))
    one = F.col("matches") == 1
    return found.select(*bounds, "matches", F.when(one, F.col("_s")).alias("start"), F.when(one, F.col("_e")).alias("stop"))


def overlap_share(points: DataFrame, iv: DataFrame, key: list[str], t: str, least: float = 0.9, width: int = DAY) -> DataFrame:
    """For each key the share of its points in intervals, and whether it reaches ``least``."""
    inside = points_in(points, iv, key, t, width, how="left_semi").groupBy(*key).agg(F.count("*").alias("inside"))
    total = points.groupBy(*key).agg(F.count("*").alias("n"))
    share = F.coalesce("inside", F.lit(0)) / F.col("n")
    return total.join(inside, key, "left").select(*key, "n", F.coalesce("inside", F.lit(0)).alias("inside"), (share >= least).alias("accepted"))


def epoch_name(names: DataFrame, key: list[str], epoch: str, name: str) -> DataFrame:
    """The only name that is the epoch's number, bare or padded to two or three digits; keys with none or several go."""
    e = F.col(epoch).cast("string")
    hit = (F.col(name) == e) | (F.col(name) == F.lpad(e, 2, "0")) | (F.col(name) == F.lpad(e, 3, "0"))
    return names.where(hit).groupBy(*key, epoch).agg(F.countDistinct(name).alias("_n"), F.min(name).alias("interval_name")).where("_n = 1").drop("_n")


def on_off_pairs(df: DataFrame, key: list[str], t: str, on: Column, off: Column) -> DataFrame:
    """Intervals from each on to the next event if that is an off; an on that stays open ends at the key's last time."""
    w = Window.partitionBy(*key).orderBy(t)
    last = F.max(t).over(Window.partitionBy(*key))
    rows = df.withColumn("_last", last).withColumn("_s", F.when(on, 1).when(off, 0)).where("_s is not null")
    rows = rows.withColumn("_next_s", F.lead("_s").over(w)).withColumn("_next_t", F.lead(t).over(w))
    closed = F.when(F.col("_next_s") == 0, F.col("_next_t")).when(F.col("_next_s").isNull(), F.col("_last"))
    return rows.where("_s = 1").select(*key, F.col(t).alias("start"), closed.alias("stop")).where("stop is not null")


def slice_series(series: DataFrame, iv: DataFrame, key: list[str], t: str, width: int = DAY) -> DataFrame:
    """Rows in [start, stop) of any interval, once for each."""
    return points_in(series, iv, key, t, width, closed=False)


def orphan_lists(lists: DataFrame, name: list[str], *children: DataFrame) -> DataFrame:
    """Interval lists that no child table names."""
    return reduce(lambda left, child: left.join(child.select(*name).distinct(), name, "left_anti"), children, lists)
