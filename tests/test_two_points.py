"""The two-point position with each key's own rate."""

import pytest

from tidemark.operators import position as P

SCHEMA = "k string, t long, x1 double, y1 double, x2 double, y2 double"
ARGS = (["k"], "t", ("x1", "y1"), ("x2", "y2"))


def test_rates_gaps_and_upsampling(spark):
    slow = [("slow", k * 500_000, 10.0 * k, 0.0, 10.0 * k, 4.0) for k in range(8)]
    fast = [("fast", k * 100_000, 2.0 * k, 1.0, 2.0 * k, 1.0) for k in range(20)]
    fast[5] = ("fast", 500_000, 10.0, 1.0, 90.0, 1.0)  # apart, so filled from its neighbours
    rows = spark.createDataFrame([*slow, *fast, ("one", 7, 1.0, 1.0, 1.0, 3.0), (None, 7, 1.0, 1.0, 1.0, 3.0), ("one", None, 1.0, 1.0, 1.0, 3.0)], SCHEMA)
    made = {(r.k, r.t): r for r in P.two_point_position(rows, *ARGS, 1.0, 50.0, 1000.0, 0.3).collect()}
    assert len(made) == 29
    # a mean of three rows at ten a second, of one at two a second
    assert made["fast", 500_000].x == pytest.approx(8.0) and made["fast", 100_000].x == pytest.approx(1.0)
    assert made["slow", 1_500_000].x == pytest.approx(30.0) and made["slow", 1_500_000].y == pytest.approx(2.0)
    assert made["fast", 1_000_000].speed == pytest.approx(20.0) and made["slow", 1_500_000].speed == pytest.approx(20.0)
    assert made["one", 7].speed == 0
    more = {(r.k, r.t): r for r in P.two_point_position(rows.where("k = 'slow'"), *ARGS, 1.0, 50.0, 1000.0, 0.3, upsampled=10.0).collect()}
    assert len(more) == 36 and more["slow", 1_600_000].x == pytest.approx(32.0) and more["slow", 1_600_000].speed == pytest.approx(20.0)


def test_points_all_apart_are_an_error(spark):
    rows = spark.createDataFrame([("good", 0, 0.0, 0.0, 1.0, 0.0), ("bad", 0, 0.0, 0.0, 99.0, 0.0), ("bad", 1, 0.0, 0.0, 98.0, 0.0)], SCHEMA)
    with pytest.raises(ValueError, match="bad"):
        P.two_point_position(rows, *ARGS, 1.0, 50.0, 1000.0, 0.3)
    assert P.two_point_position(rows.limit(0), *ARGS, 1.0, 50.0, 1000.0, 0.3).count() == 0
