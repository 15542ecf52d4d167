"""Connected groups, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.store import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """For each node of ``edges(a, b)`` the smallest node it is connected with.

    Returns ``node, root`` for every node but the roots. Edges
    may repeat and loop; null ends are ignored. Each round rewrites the edge
    table in the shared folder, so lineage does not grow, and moves every edge
    towards a star around the component's smallest node; the rounds end when
    the edges stay the same (a number of rounds that grows with the logarithm
    of the longest chain).
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        found = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.shiftright(F.xxhash64("b", "a"), 20))).first()
        if found == mark or not found[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = found
        large = _large_star(now).where("a <> b").distinct()
        small = _small_star(large).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        now = materialise(small, "edges")
    raise RuntimeError("the components did not settle")


def merge_groups(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """For each member of ``pairs`` the smallest member it is linked with, as ``member, root``; a pair with a null end is none."""
    both = pairs.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    members = both.select(F.col("a").alias("member")).union(both.select("b")).distinct()
    roots = components(both).withColumnRenamed("node", "member")
    return members.join(roots, "member", "left").select("member", F.coalesce("root", "member").alias("root"))


def apply_merges(trains: DataFrame, unit: str, groups: DataFrame) -> DataFrame:
    """Trains with merged units renamed: groups get new ids after the largest, in the order of their smallest member."""
    last = trains.agg(F.max(unit).alias("_last"))
    sized = groups.groupBy("root").agg(F.count("*").alias("_n")).where("_n > 1")
    new = sized.select("root", F.row_number().over(Window.orderBy("root")).alias("_k")).crossJoin(last)  # one row
    ids = groups.join(new, "root").select(F.col("member").alias(unit), (F.col("_last") + F.col("_k")).alias("_new"))
    return trains.join(ids, unit, "left").withColumn(unit, F.coalesce("_new", unit)).drop("_new")
