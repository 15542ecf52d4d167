"""Sessions: loading tables in order, importing series, electrodes and groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import Catalogue, bridge
from .signal import sampling_rate, valid_intervals


def load_in_order(catalogue: Catalogue) -> tuple[dict[str, DataFrame], DataFrame]:
    """The rows of each table whose parents were loaded too, parents first, and all others with the first parent they lack.

    Rejected rows are ``table_name, key, missing``; loading goes on without them, so their own children are rejected as well.
    """
    loaded: dict[str, DataFrame] = {}
    rejects = []
    for name in catalogue.order():
        spec, rows = catalogue.specs[name], catalogue.read(name)
        for parent, on in spec.parents.items():
            there = loaded[parent].select(*(F.col(v).alias(k) for k, v in on.items())).distinct()
            lost = rows.join(there, list(on), "left_anti")
            rejects.append(lost.select(F.lit(name).alias("table_name"), F.concat_ws("|", *(F.col(k).cast("string") for k in spec.key)).alias("key"), F.lit(parent).alias("missing")))
            rows = rows.join(there, list(on), "left_semi")
        loaded[name] = rows
    return loaded, reduce(DataFrame.union, rejects)


def import_series(df: DataFrame, rates: DataFrame, key: list[str], t: str, multiplier: float = 1.5, gap: float = 1.75) -> tuple[DataFrame, DataFrame]:
    """The rate of each series (given in ``rates(key, rate)``, else estimated) and its valid times.

    With a given rate the valid times are one interval from 0 to the number of samples at that rate;
    else the stretches without a distance of more than ``gap`` samples.
    """
    given = rates.where("rate is not null").select(*key, F.col("rate").cast("double").alias("rate"))
    rest = df.join(given.select(*key), key, "left_anti")
    estimated = sampling_rate(rest, key, t, multiplier)
    n = df.groupBy(*key).agg(F.count(t).alias("_n"))
    whole = given.join(n, key).select(*key, F.lit(0).cast("double").alias("start"), (F.col("_n") * 1e6 / F.col("rate")).alias("stop"))
    timed = rest.select(*key, t).join(estimated, key)
    stretches = valid_intervals(timed, key, t, gap * 1e6 / F.col("rate"))
    both = whole.unionByName(stretches.select(*key, F.col("start").cast("double").alias("start"), F.col("stop").cast("double").alias("stop")))
    return given.withColumn("estimated", F.lit(False)).unionByName(estimated.withColumn("estimated", F.lit(True))), both


def with_regular_time(df: DataFrame, idx: str, start: int, step: int) -> DataFrame:
    """Adds ``t`` of a series of one rate."""
    return df.withColumn("t", F.lit(start) + F.col(idx) * F.lit(step))


def position_sources(df: DataFrame, epochs: DataFrame, series: str, t: str, gap: int) -> DataFrame:
    """The valid times of each position series, named by the number of its epoch."""
    named = epochs.select(series, F.format_string("pos %d valid times", F.col("epoch")).alias("interval_name"))
    return valid_intervals(df.where(F.col(series).isNotNull()), [series], t, gap).join(named, series)


def join_on_time(frames: dict[str, DataFrame], t: str) -> DataFrame:
    """Rows of several series at times that all of them have; their columns are numbered by the series' names."""
    return reduce(lambda a, b: a.join(b, t), (df.select(t, *(F.col(c).alias(f"{c}_{name}" if c != name else name) for c in df.columns if c != t)) for name, df in frames.items()))


def import_bounds(df: DataFrame, key: list[str], t: str, shared: DataFrame | None = None) -> DataFrame:
    """The interval of each source: that of ``shared(key, start, stop)`` if it is there, else from its first to its last time; with the number of its rows."""
    own = df.groupBy(*key).agg(F.min(t).alias("_a"), F.max(t).alias("_b"), F.count("*").alias("n"))
    if shared is None:
        return own.select(*key, F.col("_a").alias("start"), F.col("_b").alias("stop"), "n")
    return own.join(shared.select(*key, "start", "stop"), key, "left").select(*key, F.coalesce("start", "_a").alias("start"), F.coalesce("stop", "_b").alias("stop"), "n")


def task_epochs(tasks: DataFrame, key: str, epochs: str, cameras: str, intervals: DataFrame, known: DataFrame) -> DataFrame:
    """A row for each epoch of a task that has an interval (``key, epoch, interval_name``), with the known ones of its cameras, joined by commas; none is null."""
    rows = tasks.select(key, F.explode(epochs).alias("epoch"), cameras).join(intervals, [key, "epoch"])
    seen = tasks.select(key, F.explode(cameras).alias("camera")).join(known.select("camera").distinct(), "camera")
    listed = seen.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("camera")), ",").alias("cameras"))
    return rows.drop(cameras).join(listed, key, "left")


def export_rows(catalogue: Catalogue, restricted: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The whole rows of the tables of a restricted graph."""
    return {n: bridge(catalogue.read(n), df, {k: k for k in catalogue.specs[n].key}) for n, df in restricted.items()}


def split_parts(df: DataFrame, key: list[str], master: list[str], parts: dict[str, tuple[Column, list[str]]]) -> dict[str, DataFrame]:
    """A wide table as its master and, for each part, the rows whose flag holds with the part's columns."""
    out = {"master": df.select(*key, *master)}
    for name, (flag, columns) in parts.items():
        out[name] = df.where(flag).select(*key, *columns)
    return out


def select_electrodes(known: DataFrame, wanted: DataFrame, electrode: str, reference: str) -> DataFrame:
    """The wanted electrodes with their references, by electrode, each once; a missing reference counts as -1 (none).

    An electrode, or a reference other than -1, that is not known fails the job.
    """
    ids = known.select(F.col(electrode).alias("_id")).distinct()
    rows = wanted.select(electrode, F.coalesce(reference, F.lit(-1)).alias(reference)).distinct()
    rows = rows.join(ids.withColumn("_e", F.lit(True)), F.col(electrode) == F.col("_id"), "left").drop("_id")
    rows = rows.join(ids.withColumn("_r", F.lit(True)), F.col(reference) == F.col("_id"), "left").drop("_id")
    good = F.col("_e") & (F.col("_r") | (F.col(reference) == -1))
    return rows.where(F.when(good, F.lit(True)).otherwise(F.raise_error(F.lit("an unknown electrode or reference")).cast("boolean"))).select(electrode, reference)


def electrode_index(region: DataFrame, key: list[str], ids: str, wanted: DataFrame, electrode: str) -> DataFrame:
    """The place of each wanted electrode in its region's array ``ids``, from 0, the first of equals; null if it is not there."""
    places = region.select(*key, F.posexplode(ids).alias("position", electrode)).groupBy(*key, electrode).agg(F.min("position").alias("position"))
    return wanted.join(places, [*key, electrode], "left")


def position_group(members: list[DataFrame], order: str, start: int | None = None, stop: int | None = None) -> DataFrame:
    """The rows of all members in the closed range of ``order``."""
    rows = reduce(lambda a, b: a.unionByName(b), members)
    if start is not None:
        rows = rows.where(F.col(order) >= start)
    return rows if stop is None else rows.where(F.col(order) <= stop)


def epochs_slices(intervals: list[DataFrame], series: DataFrame, key: list[str], t: str, width: int) -> DataFrame:
    """The rows of a series within what all interval lists cover, with ``epoch``, the number of the piece in its key."""
    from .intervals import intersect_all, label_by_interval

    return label_by_interval(series, intersect_all(intervals, key), key, t, width).withColumnRenamed("label", "epoch").drop("start", "stop")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows of a small table numbered from 0 in the given order; one task."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1)
