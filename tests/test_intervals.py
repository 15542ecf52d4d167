"""Literal cases of the interval algebra, and random lists against membership on a fine grid."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import intervals as I

K = ["k"]


@pytest.fixture(scope="module")
def iv(spark):
    return lambda *pairs: spark.createDataFrame([(1, a, b) for a, b in pairs], "k int, start long, stop long")


def rows(df):
    return sorted((r.start, r.stop) for r in df.collect())


def test_rules_of_ends(spark, iv):
    """Cases made from the docstrings: ends belong to an interval, touching is not overlapping, pieces without length go."""
    assert I.violations(iv((70, 20), (20, 70), (33, 33))).count() == 1
    assert rows(I.normalise(iv((33, 33), (33, 33), (20, 70), (70, 20)), K)) == [(20, 70), (33, 33)]
    chain = iv((100, 140), (140, 180), (170, 260), (400, 401))
    assert rows(I.consolidate(chain, K)) == [(100, 140), (140, 260), (400, 401)]
    assert rows(I.merge_touching(chain, K)) == [(100, 260), (400, 401)]
    assert rows(I.consolidate(iv((100, 900), (200, 200), (850, 1000)), K)) == [(100, 1000)]
    met = I.intersect(iv((0, 600), (700, 900)), iv((600, 700), (550, 580), (890, 2000)), K)
    assert rows(met) == [(550, 580), (890, 900)]
    assert rows(I.intersect(iv((0, 600), (700, 900)), iv((550, 580), (890, 2000)), K, 10)) == [(550, 580)]
    assert rows(I.intersect(iv((0, 100)), iv((101, 140)), K)) == []
    held = iv((1000, 5000), (9000, 9500))
    assert rows(I.subtract(held, iv((2000, 2001), (4900, 9100)), K)) == [(1000, 2000), (2001, 4900), (9100, 9500)]
    assert rows(I.subtract(held, iv((5000, 9000)), K)) == [(1000, 5000), (9000, 9500)]
    assert rows(I.subtract(held, iv((0, 1990), (2000, 9499)), K, 5)) == [(1990, 2000)]
    assert rows(I.subtract(held, iv((0, 20000)), K)) == []
    lengths = iv((7, 7), (7, 20), (7, 10**12))
    assert rows(I.by_length(lengths, -1, 13)) == [(7, 7)] and rows(I.by_length(lengths, 0, 14)) == [(7, 20)] and rows(I.by_length(lengths, 13)) == [(7, 10**12)]
    assert rows(I.union(iv((40, 60)), iv((60, 61), (10, 39)), K)) == [(10, 39), (40, 61)]
    assert rows(I.union(iv((40, 60)), iv((60, 61), (10, 39)), K, 25)) == [(10, 39)]
    assert rows(I.union_adjacent_index(iv((11, 14), (15, 15), (16, 30), (32, 40), (40, 41)), K)) == [(11, 30), (32, 40), (40, 41)]
    points = spark.createDataFrame([(1, t) for t in (99, 100, 120, 140, 141)], "k int, t long")
    assert sorted(r.t for r in I.contains(points, iv((100, 120), (120, 140)), K, "t", 7).collect()) == [100, 120, 120, 140]
    assert sorted(r.t for r in I.excludes(points, iv((100, 120), (120, 140)), K, "t", 7).collect()) == [99, 141]
    idx = spark.createDataFrame([(1, i) for i in (-2, -1, 0, 5, 5, 7, 8)] + [(1, None)], "k int, i long")
    assert rows(I.from_indices(idx, K, "i")) == [(-2, 0), (5, 5), (7, 8)]
    assert rows(I.censor(iv((0, 50), (60, 90), (95, 99)), spark.createDataFrame([(1, 30), (1, 70)], "k int, t long"), K, "t")) == [(30, 50), (60, 70)]


def test_random_lists_against_a_grid(spark):
    rng = random.Random(4)
    lists = {name: [(k, a, a + rng.choice([0, 1, 3, 7, 20])) for k in range(25) for a in (rng.randrange(60) for _ in range(rng.randrange(6)))] for name in "ab"}
    frames = {n: spark.createDataFrame(x, "k int, start long, stop long") for n, x in lists.items()}

    def cells(triples):
        """Unit cells covered, by key."""
        return {(k, c) for k, a, b in triples for c in range(a, b)}

    a, b = cells(lists["a"]), cells(lists["b"])
    got = lambda df: cells((r.k, r.start, r.stop) for r in df.collect())
    assert got(I.union(frames["a"], frames["b"], K)) == a | b
    assert got(I.intersect(frames["a"], frames["b"], K, 0, 5)) == a & b
    assert got(I.subtract(frames["a"], frames["b"], K, 0, 5)) == a - b
    for df in (I.consolidate(frames["a"], K), I.merge_touching(frames["a"], K), I.subtract(frames["a"], frames["b"], K)):
        lag = df.alias("x").join(df.alias("y"), "k").where("x.start < y.start and y.start < x.stop")
        assert lag.count() == 0


def test_labels_and_pairs(spark):
    mask = spark.createDataFrame([(1, i, not (10 <= i <= 20 or 40 <= i <= 60)) for i in range(100)], "k int, i long, missing boolean")
    labels = {r.i: r.label for r in I.interval_labels(mask, K, "i", F.col("missing")).collect()}
    assert [labels[i] for i in (9, 10, 20, 21, 40, 60, 61)] == [-1, 0, 0, -1, 1, 1, -1]
    ev = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 4, 0), (1, 6, 1)], "k int, t long, s int")
    assert rows(I.on_off_pairs(ev, K, "t", F.col("s") == 1, F.col("s") == 0)) == [(1, 4), (6, 6)]
    empty = mask.where("false")
    assert I.interval_labels(empty, K, "i", F.col("missing")).count() == 0
