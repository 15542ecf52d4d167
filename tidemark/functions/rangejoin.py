"""Range joins by time buckets, so that Spark joins on equal keys.

An interval is copied to every bucket of ``width`` that it touches; a point has
one bucket, so a match is found once. Two intervals may share several buckets;
only the one where the later of them starts counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bucket(c: Column, width: int) -> Column:
    return F.floor(c / F.lit(width))


#: Buckets that an interval lists at a time.
_RUN = 4096


def spread(iv: DataFrame, width: int, start: str = "start", stop: str = "stop") -> DataFrame:
    """One row for each bucket that an interval touches; a long interval is spread in runs, so no array grows with it."""
    first, last, run = _bucket(F.col(start), width), _bucket(F.col(stop), width), F.lit(_RUN)
    runs = iv.withColumn("_r", F.explode(F.sequence(F.floor(first / run), F.floor(last / run))))
    return runs.withColumn("_b", F.explode(F.sequence(F.greatest(first, F.col("_r") * run), F.least(last, F.col("_r") * run + run - 1)))).drop("_r")


def points_in(points: DataFrame, iv: DataFrame, key: list[str], t: str, width: int, how: str = "inner", closed: bool = True) -> DataFrame:
    """Joins points with the intervals of their key that hold them; the end is in if ``closed``."""
    left = points.withColumn("_b", _bucket(F.col(t), width))
    right = spread(iv, width)
    for k in key:
        right = right.withColumnRenamed(k, f"_{k}")
    on = F.lit(True)
    for k in [*key]:
        on = on & (left[k] == right[f"_{k}"])
    end = (F.col(t) <= F.col("stop")) if closed else (F.col(t) < F.col("stop"))
    joined = left.join(right.withColumnRenamed("_b", "_b2"), on & (F.col("_b") == F.col("_b2")) & (F.col(t) >= F.col("start")) & end, how)
    return joined.drop("_b", "_b2", *[f"_{k}" for k in key])


def points_by_length(points: DataFrame, iv: DataFrame, key: list[str], t: str) -> DataFrame:
    """Every interval with the points of its key that it holds, ends included, or once without: a left join of intervals.

    Intervals are told apart by length, to a power of four; those of a level have buckets as wide as its longest, so
    each is in two at most, however long it is. A point goes to its bucket on each level that occurs.
    """
    length = F.greatest(F.col("stop") - F.col("start"), F.lit(1))
    level = F.ceil(F.ceil(F.log2(length.cast("double")) + 1e-9) / 2).cast("int")  # rounded up, so that no interval is longer than its buckets
    held = iv.withColumn("_l", level)
    levels = sorted(r._l for r in held.where("_l is not null").select("_l").distinct().collect())  # at most 32
    at = lambda x, l: F.floor(x / F.pow(F.lit(4.0), l))  # noqa: E731, E741
    right = held.withColumn("_b", F.explode_outer(F.array_distinct(F.array(at(F.col("start"), F.col("_l")), at(F.col("stop"), F.col("_l"))))))
    left = points.withColumn("_l2", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("_b2", at(F.col(t), F.col("_l2")))
    left = left.withColumnsRenamed({k: f"_{k}" for k in key})
    on = (F.col("_l") == F.col("_l2")) & (F.col("_b") == F.col("_b2")) & F.col(t).between(F.col("start"), F.col("stop"))
    for k in key:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return right.join(left, on, "left").drop("_l", "_b", "_l2", "_b2", *[f"_{k}" for k in key])


def overlaps(a: DataFrame, b: DataFrame, key: list[str], width: int) -> DataFrame:
    """Pairs of intervals that share more than a point, as ``key, start, stop, start2, stop2``."""
    left = spread(a.select(*key, "start", "stop"), width)
    right = spread(b.select(*key, F.col("start").alias("start2"), F.col("stop").alias("stop2")), width, "start2", "stop2")
    met = left.join(right, [*key, "_b"]).where((F.col("start") < F.col("stop2")) & (F.col("start2") < F.col("stop")))
    return met.where(F.col("_b") == _bucket(F.greatest("start", "start2"), width)).drop("_b")
