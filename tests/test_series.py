"""One long series in stretches: numbers, islands, neighbours and medians are the same whatever the stretches are."""

import math
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.blocks import block_width, gap_islands, numbered
from tidemark.functions.ranks import medians
from tidemark.operators import events as E
from tidemark.operators import intervals as I
from tidemark.operators import signal as S

WIDTHS = [1, 7, 10_000]


@pytest.fixture(scope="module")
def series(spark):
    """One key holds nearly all rows; times repeat, and stretches are missing."""
    rnd, t, rows = random.Random(5), -300, []
    for n in range(900):
        t += rnd.choice([0, 1, 1, 2, 3, 11])
        rows.append(("a" if n % 50 else "b", t, n, rnd.gauss(0, 10)))
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, t long, n long, v double").cache()


@pytest.mark.parametrize("width", WIDTHS)
def test_numbers_follow_the_order(series, width):
    rows, df = series
    got = {(r.k, r.n): r.i for r in numbered(df, ["k"], ["t", "n"], "i", 1, width).collect()}
    for k in "ab":
        assert [got[k, n] for _, _, n, _ in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))] == list(range(1, 1 + sum(r[0] == k for r in rows)))


def islands(times, gap):
    out = []
    for t in sorted(times):
        if out and t - out[-1][1] <= gap:
            out[-1][1] = t
        else:
            out.append([t, t])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("gap", [0, 1, 2, 10])
def test_islands_join_over_stretches(series, width, gap):
    rows, df = series
    got = gap_islands(df, ["k"], "t", F.lit(gap), width).collect()
    for k in "ab":
        assert sorted((r.start, r.stop) for r in got if r.k == k) == islands([r[1] for r in rows if r[0] == k], gap)


def test_islands_of_nothing(spark):
    assert gap_islands(spark.createDataFrame([("a", None)], "k string, t long"), ["k"], "t", F.lit(1)).collect() == []


@pytest.mark.parametrize("width", WIDTHS)
def test_rate_and_alignment_do_not_depend_on_the_width(series, width):
    rows, df = series
    steps = df.withColumn("t", F.col("t") * 1000)
    rate = {r.k: r.rate for r in S.sampling_rate(steps, ["k"], "t", width=width * 1000).collect()}
    assert rate == {r.k: r.rate for r in S.sampling_rate(steps, ["k"], "t").collect()} and rate["a"] > 0
    clock = [-280, -280, 0, 5, 400]
    ticks = df.sparkSession.createDataFrame([(k, t) for k in "ab" for t in clock], "k string, t long")
    got = {(r.k, r.t): r.v for r in S.align_to_clock(df.where("v is not null"), ticks, ["k"], "t", "v", width).collect()}
    for k in "ab":
        for t, after in zip([-280, 0, 5, 400], [0, 5, 400, math.inf], strict=True):
            inside = [r for r in rows if r[0] == k and t <= r[1] < after]
            latest = max((r[1] for r in inside), default=None)
            assert got[k, t] in ([r[3] for r in inside if r[1] == latest] or [None])
    counted = {(r.k, r.x): r.position for r in I.to_indices(ticks.select("k", F.col("t").alias("x")).distinct(), df, ["k"], "t", "right", width).collect()}
    assert counted == {(k, t): sum(r[0] == k and r[1] <= t for r in rows) for k in "ab" for t in set(clock)}


def test_resampling_in_stretches(spark):
    df = spark.createDataFrame([("a", t, float(t * t)) for t in (0, 4, 10, 30)], "k string, t long, v double")
    grid = spark.createDataFrame([("a", t) for t in (-1, 2, 4, 7, 20, 31)], "k string, t long")
    for width in WIDTHS:
        got = {r.t: r.v for r in S.resample(df, grid, ["k"], "t", "v", width=width).collect()}
        assert got == {-1: None, 2: 8.0, 4: 16.0, 7: 58.0, 20: 500.0, 31: 900.0}


def test_medians_by_any_bins(spark):
    rnd = random.Random(9)
    made = {
        "even": [rnd.gauss(0, 1) for _ in range(400)],
        "odd": [rnd.lognormvariate(0, 8) for _ in range(401)],
        "ties": [1.0] * 200 + [2.0] * 200,
        "one": [3.5],
        "same": [7.0] * 50,
        "wide": [-1.7e308, 1.7e308, 0.0, 1e-300, -1e-300, 5.0],
        "endless": [math.inf, -math.inf, 1.0, 2.0, 3.0],
    }
    rows = [(k, x) for k, xs in made.items() for x in xs] + [("even", None), ("even", math.nan), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    for bins, few in ((3, 2), (64, 10), (1024, 100_000)):
        assert {r.k: r.m for r in medians(df, ["k"], "v", "m", bins, few).collect()} == {k: pytest.approx(statistics.median(xs), rel=1e-12) for k, xs in made.items()}
    assert medians(df.where("k = 'none'"), ["k"], "v", "m").collect() == []


def test_width_of_an_empty_series(spark):
    assert block_width(spark.createDataFrame([], "t long"), "t") == 1


def test_events_by_blocks(spark):
    """Detectors find the same in blocks, where numbers of samples are missing as well."""
    rnd = random.Random(12)
    at = [k for k in range(400) if rnd.random() < 0.9]
    rows = [(c, k, k * 10, rnd.gauss(0, 1) + 4 * (k % 60 < 6)) for k in at for c in "xy" if c == "x" or rnd.random() < 0.97]
    df = spark.createDataFrame([("a", *r) for r in rows], "k string, c string, i long, t long, v double").cache()
    rest = spark.createDataFrame([("a", k * 10, float(k % 7)) for k in at], "k string, t long, speed double")
    for block in (3, 1000):
        for found in (
            lambda b: E.consensus_events(df, rest, ["k"], "c", "i", "t", "v", "speed", 2.0, 1.0, gap=50, block=b),
            lambda b: E.channel_events(df, rest, ["k"], "c", "i", "t", "v", "speed", 2.0, 1.0, block=b),
            lambda b: E.high_synchrony(df.where("c = 'x'"), ["k"], "i", "t", "v", 1.0, 20, 2.0, block=b),
            lambda b: I.dilate(df.where("c = 'x'").withColumn("i", F.dense_rank().over(Window.orderBy("i")) + 0).select("k", "i", (F.col("v") > 3).alias("f")), ["k"], "i", "f", 2, b),
        ):
            plain, blocks = ([tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in found(b).collect()] for b in (None, block))
            assert sorted(plain) == sorted(blocks) and plain
