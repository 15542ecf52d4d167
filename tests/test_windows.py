"""The known values around a row: right with ties and holes, and without a window that goes over all later rows for each row."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tidemark.functions.blocks import nearest_known
from tidemark.operators import signal as S

SF = "/root/testdata/sf0.001"


def ends_last(df):
    """The frames of the plan that end with the last row."""
    return re.findall(r"unboundedfollowing", df._jdf.queryExecution().optimizedPlan().toString())


def test_known_values_around_a_row(spark):
    rnd = random.Random(8)
    rows = [(k, i // 3, i, None if rnd.random() < 0.6 else rnd.random()) for k in "ab" for i in range(200)]
    df = spark.createDataFrame(rnd.sample(rows, len(rows)), "k string, t long, n long, v double")
    for block in (1, 9, 1000):
        made = nearest_known(df, ["k"], "t", F.col("v"), "a", "b", block=block, then=("n",))
        got = {(r.k, r.n): (r.a, r.b) for r in made.collect()}
        for k, _, n, _ in rows:
            known = [(r[2], r[3]) for r in rows if r[0] == k and r[3] is not None]
            assert got[k, n] == (max((x for x in known if x[0] <= n), default=(0, None))[1], min((x for x in known if x[0] >= n), default=(0, None))[1])
        assert not ends_last(made)


def test_whole_series_are_filled_in_one_pass(spark):
    df = spark.createDataFrame([(1, float(i), None if i % 4 else float(i)) for i in range(40)], "k int, x double, v double")
    made = S.interpolate(df, ["k"], "x", "v", ends=True)
    assert not ends_last(made)
    assert sorted((r.x, r.filled) for r in made.collect()) == [(float(i), float(min(i, 36))) for i in range(40)]


@pytest.mark.parametrize("name", ["e6_ripple_inputs", "f22_upsample", "f20_interpolate", "f21_resample"])
def test_no_window_over_all_later_rows(spark, name):
    assert not ends_last(__spark_entry__.queries()[name](spark, SF))
