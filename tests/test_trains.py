"""Correlograms and pooled intervals against all pairs of spikes; spikes at one time are counted, not paired one by one."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tidemark.operators import spikes as K


def _trains(spark, many=1):
    rnd = random.Random(4)
    rows = [(s, u, rnd.choice([rnd.randrange(-60, 400), 7, 8])) for s in "xy" for u in (1, 2, 3, 4) for _ in range(40)] * many
    rows += [("x", 1, None), ("x", None, 5), (None, 2, 5), ("y", 9, 50)]
    return rows, spark.createDataFrame(rows, "s string, u int, t long")


@pytest.mark.parametrize("stretch", [1, 37, 10_000])
def test_correlogram(spark, stretch):
    rows, df = _trains(spark)
    good = [r for r in rows if None not in r]
    want = Counter((s, u, v, (w - t) // 7) for s, u, t in good for r, v, w in good if r == s and u != v and -20 <= w - t < 20)
    assert {tuple(r)[:4]: r.n for r in K.correlogram(df, "u", "t", 40, 7, ("s",), stretch).collect()} == want


@pytest.mark.parametrize("stretch", [1, 37, 10_000])
def test_pooled_intervals(spark, stretch):
    rows, df = _trains(spark)
    pairs = spark.createDataFrame([(s, a, b) for s in "xyz" for a in (1, 2, 3, 9) for b in (1, 2, 3, 9) if a != b], "s string, a int, b int")
    want = {}
    for s, a, b in map(tuple, pairs.collect()):
        both = [r[2] for r in rows if r[0] == s and r[1] in (a, b)]
        known = sorted(t for t in both if t is not None)
        if both:
            want[s, a, b] = (len(both), sum(y - x < 5 for x, y in zip(known, known[1:], strict=False)))
    assert {(r.s, r.a, r.b): (r.n, r.close) for r in K.pooled_isi(df, "u", "t", pairs, 5, ("s",), stretch).collect()} == want


def test_dense_and_sparse_stretches_agree():
    rng = np.random.default_rng(6)
    at = np.sort(rng.integers(0, 3000, 900))
    unit, n, own = rng.integers(0, 3, 900), rng.integers(1, 4, 900), rng.random(900) < 0.7
    for half in (3, 40, 2000):  # few pairs, and more than counting by edges takes
        want = np.zeros((3, 3, (half - 1) // 9 + 1 + -(-half // 9)), int)
        for i in np.flatnonzero(own):
            for j in np.flatnonzero((at - at[i] >= -half) & (at - at[i] < half)):
                want[unit[i], unit[j], (at[j] - at[i]) // 9 + -(-half // 9)] += n[i] * n[j]
        assert (K._differences(unit, at, n, own, 3, half, 9) == want).all()


def test_copies_of_spikes_make_no_pairs(spark):
    """Thirty spikes at each time: a join of spikes would make 900 rows for each pair of times."""
    rows, df = _trains(spark, 30)
    assert df.count() > 9000
    made = K.correlogram(df, "u", "t", 40, 7, ("s",))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    one = {tuple(r)[:4]: r.n for r in K.correlogram(df.dropDuplicates(["s", "u", "t"]).join(df.groupBy("s", "u", "t").count(), ["s", "u", "t"]).where(F.col("count") == 30), "u", "t", 40, 7, ("s",)).collect()}
    got = {tuple(r)[:4]: r.n for r in made.collect()}
    assert all(got[k] >= 900 * n for k, n in one.items())


@pytest.mark.parametrize("name", ["k24_asymmetry", "k23_correlogram_by_session", "k21_burst_pairs", "k21_burst_pairs_by_session"])
def test_queries_pair_no_spikes(spark, name):
    plan = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "_ta" not in plan and "lag(" not in plan
