"""Runs of rows, by window functions within a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import blockwise, running_sum


def before(key: list[str], *order: str | Column):
    return Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def up_to(key: list[str], *order: str | Column):
    return Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def number_islands(df: DataFrame, key: list[str], starts: Column, order: list[str], name: str = "island") -> DataFrame:
    """Adds the running number of islands; ``starts`` tells whether a row starts one."""
    return df.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(up_to(key, *order)))


def merge_runs(iv: DataFrame, key: list[str], starts) -> DataFrame:
    """Merges intervals into islands; ``starts(start, furthest stop before)`` tells where one starts."""
    marked = iv.withColumn("_far", F.max("stop").over(before(key, "start", "stop")))
    marked = number_islands(marked, key, F.col("_far").isNull() | starts(F.col("start"), F.col("_far")), ["start", "stop"], "_island")
    return marked.groupBy(*key, "_island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_island")


def mask_runs(df: DataFrame, key: list[str], order: str, flag: Column, block: int | None = None) -> DataFrame:
    """Rows where ``flag`` holds, with ``run``, the number of the stretch they are in; with ``block``, for an order without gaps, by blocks."""

    def begun(d: DataFrame, own: list[str]) -> DataFrame:
        w = Window.partitionBy(*own).orderBy(order)
        return d.withColumn("_begin", F.col("_flag") & ~F.coalesce(F.lag("_flag").over(w), F.lit(False)))

    flagged = df.withColumn("_flag", F.coalesce(flag, F.lit(False)))
    if block:
        rows = running_sum(blockwise(flagged, key, order, 1, begun, block), key, order, F.col("_begin").cast("int"), "run", block)
    else:
        rows = number_islands(begun(flagged, key), key, F.col("_begin"), [order], "run")
    return rows.where("_flag").drop("_flag", "_begin")
