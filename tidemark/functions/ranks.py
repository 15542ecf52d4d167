"""Exact order statistics of every key at once, without a key's values in one place.

A rank is looked for in a histogram between the least and the greatest value; the bin that holds it is
cut into bins again, until few rows or one value are left. Each pass adds up counts, so what any task holds is
bounded by the number of bins, however many rows and values a key has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .columns import no_nan
from .store import materialise

BINS = 1024
#: A bin with no more rows than this is looked through value by value.
FEW = 100_000


def _bin(v: str, bins: int):
    """The bin of ``v`` between ``lo`` and ``hi``: never falling with ``v``, the first for the one and the last for the other."""
    half = lambda c: F.col(c) / 2  # noqa: E731  differences of halves are finite
    share = (half(v) - half("lo")) / (half("hi") - half("lo"))
    endless = F.abs("lo").eqNullSafe(F.lit(float("inf"))) | F.abs("hi").eqNullSafe(F.lit(float("inf")))
    by_sign = F.when(F.col(v) == float("-inf"), 0).when(F.col(v) == float("inf"), bins - 1).otherwise(1)
    return F.when(endless, by_sign).otherwise(F.least(F.lit(bins - 1), F.floor(share * bins))).cast("int")


def _within(values: DataFrame, state: DataFrame, key: list[str]) -> DataFrame:
    """The values that are still in question, for each rank that is looked for."""
    return values.join(state.where("lo < hi"), key).where(F.col("_v").between(F.col("lo"), F.col("hi")))


def medians(df: DataFrame, key: list[str], value: str, name: str, bins: int = BINS, few: int = FEW) -> DataFrame:
    """The median of ``value`` for each key, as ``key, name``: the mean of the two middle values where their number is even.

    Null and NaN are left out; a key without other values has none. Keys are not null. The passes over the
    table are as many as it takes to narrow every bin to ``few`` rows or one value: one for keys with no more rows than
    that, a second for up to about ``few * bins`` evenly spread ones.
    """
    keys = [f"_k{i}" for i in range(len(key))]
    values = df.select(*(F.col(k).alias(a) for k, a in zip(key, keys, strict=True)), no_nan(F.col(value).cast("double")).alias("_v")).where("_v is not null")
    ends = values.groupBy(*keys).agg(F.count("*").alias("inside"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    both = F.array_distinct(F.array(F.floor((F.col("inside") - 1) / 2), F.floor(F.col("inside") / 2)))
    state = materialise(ends.withColumn("rank", F.explode(both)).withColumn("place", F.col("rank")), "ranks")  # place: the rank among the rows inside
    while not state.where(f"lo < hi and inside > {few}").isEmpty():
        counted = _within(values, state, keys).groupBy(*keys, "rank", "place", _bin("_v", bins).alias("bin")).agg(F.count("*").alias("n"), F.min("_v").alias("a"), F.max("_v").alias("b"))
        up_to = Window.partitionBy(*keys, "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        counted = counted.withColumn("upto", F.sum("n").over(up_to)).where((F.col("upto") - F.col("n") <= F.col("place")) & (F.col("place") < F.col("upto")))
        narrowed = counted.select(*keys, F.col("n").alias("inside"), F.col("a").alias("lo"), F.col("b").alias("hi"), "rank", (F.col("place") - F.col("upto") + F.col("n")).alias("place"))
        state = materialise(narrowed.unionByName(state.where("lo = hi")), "ranks")
    each = _within(values, state, keys).groupBy(*keys, "rank", "place", "_v").agg(F.count("*").alias("n"))
    up_to = Window.partitionBy(*keys, "rank").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("upto", F.sum("n").over(up_to)).where((F.col("upto") - F.col("n") <= F.col("place")) & (F.col("place") < F.col("upto")))
    found = each.select(*keys, F.col("_v").alias("v")).unionByName(state.where("lo = hi").select(*keys, F.col("lo").alias("v")))
    # one value, or the two in the middle
    return found.groupBy(*keys).agg((F.min("v") * 0.5 + F.max("v") * 0.5).alias(name)).toDF(*key, name)
